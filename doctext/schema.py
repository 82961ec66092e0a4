"""Table schemas, state sentinels and the other fixed values of the catalogue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values.  These strings are part of the public contract of the text
# table (readers and tests compare them literally), so they are kept exactly.
# --------------------------------------------------------------------------
UNPROCESSED = "UNPROCESSED_FULLTEXT"
UNAVAILABLE = "NOT_AVAILABLE"
ERROR = "ERROR_FULLTEXT"

# Texts that mark a package as "in error" (UNPROCESSED counts as error).
ERROR_PHRASES = (
    "UNPROCESSED_FULLTEXT",
    "ERROR_FULLTEXT",
    "Es ist ein interner Serverfehler aufgetreten.",
    "Wrong parameter set",
    "Wrong parameter set!",
    "Portlet Application ingrid-portal-apps not available",
    "404 Not Found   Not Found  The requested URL was not found on this server.",
    "Service Unavailable  Service Unavailable   HTTP Error 503. The service is unavailable.",
)

# A fetched document containing one of these is an error page.
ERROR_PAGE_MARKERS = (
    "404 - File or directory not found",
    "404 Not Found   Not Found",
    "NOT_AVAILABLE",
    "The page cannot be displayed because",
    "The requested URL could not be retrieved",
)

# Word splitting: default delimiter set and the characters stripped from
# both ends of every word (the strip set includes a backslash).
WORD_DELIMITERS = ",.!?/&-:;' "
WORD_STRIP = "-_,.;:'\"!$%&/()=?[]\\{}+*@"
# Characters inside a token that make it a candidate compound.
COMPOUND_CHARS = "._-"

# Special characters: deleted, and turned into a space.
SPECIALS_DELETE = "!(),;?:"
SPECIALS_SPACE = "\n\tâ\u0080¢ï¿½"

# Meeting-record (council information system) markers.
MEETING_URL_MARK = "sitzungsdienst"
MEETING_DOCUMENT_MARK = "Drucksache "
MEETING_PROTOCOL_MARK = "Sitzungsprotokoll (Druckversion) "
NO_TEXT_URL_MARK = "alkis_liegenschaftskarte"

# Operating defaults.
DEFAULT_MAX_FILE_SIZE = 5 * 1024 ** 2
RETRY_LIMIT = 5
FACET_LIMIT = 50
WINDOW_SIZE = 20
WORD_MAX_LENGTH = 30
WORD_MIN_LENGTH = 2


# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------
FULLTEXT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("resource_id", T.StringType(), True),
    T.StructField("package_id", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
    T.StructField("text_clear", T.StringType(), True),
])

INPUT_SCHEMAS = {
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]),
    "pages": T.StructType([
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]),
    "events": T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()),
    ]),
}

RESOURCE_STRUCT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("position", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("file_size", T.LongType()),
])

EXTRA_STRUCT = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])


@dataclass(frozen=True)
class Settings:
    """Every knob of the catalogue, passed explicitly (no INI reading)."""

    format_blacklist: tuple[str, ...] = ()          # URL suffixes -> ''
    resource_format_blacklist: tuple[str, ...] = ()  # resource formats, exact
    package_blacklist: tuple[str, ...] = ()
    archive_blacklist: tuple[str, ...] = ()          # member suffixes
    max_file_size: int = DEFAULT_MAX_FILE_SIZE
    max_chars: int = 0                               # 0 = keep whole text
    read_limit: int = 0                              # LEFT(..) on read, 0 = off
    clean_sources: tuple[str, ...] = ()
    hide_extras: tuple[str, ...] = ()
    hide_main: tuple[str, ...] = ()
    https_host: str = ""
    window_size: int = WINDOW_SIZE
    word_max_length: int = WORD_MAX_LENGTH
    word_min_length: int = WORD_MIN_LENGTH
    ignore_upper_case: bool = True
