"""Parameters of the registered queries (one place, never tuned per test)."""

from ..schema import Settings

SETTINGS = Settings(
    format_blacklist=("gml",),            # URL suffixes whose text is ''
    resource_format_blacklist=("de",),    # of the queries about that list only
    package_blacklist=("p3", "p10"),
    archive_blacklist=("gml",),
    clean_sources=("source1",),
    hide_extras=("owner",),
    hide_main=("url",),
    https_host="files.example.org",
)

MODIFIED_SINCE = "2024-01-01 08:00:00"
RESOURCE_ID = "r5"
PACKAGE_ID = "p2"
MAX_SIZE = 5000
#: The cuts are features of their own queries only; all others read whole texts.
READ_LIMIT = 200
CUT_CHARS = 5000
OVERSIZE = 20000
