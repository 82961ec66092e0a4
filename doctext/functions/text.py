"""Text normalisation and token predicates as built-in Column expressions.

Everything here compiles to JVM expressions inside whole-stage codegen; no
Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (ERROR_PAGE_MARKERS, SPECIALS_DELETE, SPECIALS_SPACE,
                      WORD_DELIMITERS, WORD_STRIP)

# White space as Python's str.strip() sees it.
PY_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
PY_WS = r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_class(chars: str) -> str:
    """A regex character class matching exactly the given characters."""
    return "[" + "".join("\\" + ch if not ch.isalnum() else ch for ch in chars) + "]"


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove white space at both ends (linear in the
    text, however long its inner runs of white space are)."""
    return F.btrim(_col(c), F.lit(PY_SPACES))


def is_blank(c) -> Column:
    """NULL, empty or white space only."""
    return F.coalesce(_col(c), F.lit("")).rlike(rf"^{PY_WS}*$")


def remove_specials(c, is_csv: bool = False) -> Column:
    """N2: ';' to space for CSV, delete ``!(),;?:``, line breaks, tabs and the
    mis-decoded bullet/replacement bytes to a space.  Digits stay."""
    x = _col(c)
    if is_csv:
        x = F.translate(x, ";", " ")
    x = F.translate(x, SPECIALS_DELETE, "")
    return F.translate(x, SPECIALS_SPACE, " " * len(SPECIALS_SPACE))


def normalise(c, remove_special_characters: bool = True, is_csv: bool = False) -> Column:
    """Drop U+FFFD, join hyphenated line breaks, then N2."""
    x = F.replace(_col(c), F.lit("�"), F.lit(""))
    x = F.replace(x, F.lit("-\n"), F.lit(""))
    return remove_specials(x, is_csv) if remove_special_characters else x


def normalise_list(c, remove_special_characters: bool = True, is_csv: bool = False) -> Column:
    """N1 over every element of an array of texts."""
    return F.transform(_col(c), lambda t: normalise(t, remove_special_characters, is_csv))


def words(c, delimiters: str = WORD_DELIMITERS, strip: str = WORD_STRIP) -> Column:
    """Split on any delimiter character, strip ``strip`` at both ends of
    every piece, drop empty pieces.  Returns array<string>."""
    parts = F.split(_col(c), char_class(delimiters))
    stripped = F.transform(parts, lambda w: F.btrim(w, F.lit(strip)))
    return F.filter(stripped, lambda w: w != F.lit(""))


def flatten_tokens(c) -> Column:
    """Array of arrays to one array."""
    return F.flatten(_col(c))


def is_url_token(c) -> Column:
    """Ends with .de / .com or starts with http."""
    x = _col(c)
    return x.endswith(".de") | x.endswith(".com") | x.startswith("http")


def is_email_token(c) -> Column:
    """P25: longer than 7 and shaped like local@host.tld at the start."""
    x = _col(c)
    return (F.length(x) > 7) & x.rlike(r"^[^@]+@[^@]+\.[^@]+")


def has_digit(c) -> Column:
    return _col(c).rlike(r"\p{Nd}")


def is_upper_word(c) -> Column:
    """Python ``str.isupper()``: has cased letters and none is lower-case."""
    x = _col(c)
    return (F.upper(x) == x) & (F.lower(x) != x)


def starts_upper(c) -> Column:
    return is_upper_word(F.substring(_col(c), 1, 1))


def is_error_page(c) -> Column:
    """The text contains one of the error-page markers; NULL -> false."""
    x = _col(c)
    cond = F.lit(False)
    for m in ERROR_PAGE_MARKERS:
        cond = cond | x.contains(m)
    return F.coalesce(cond, F.lit(False))


def truncate(c, max_chars: int) -> Column:
    """Keep the first ``max_chars`` characters when ``max_chars > 0``."""
    x = _col(c)
    return F.left(x, F.lit(max_chars)) if max_chars and max_chars > 0 else x


def sql_quote(s: str) -> str:
    """A SQL string literal (single quotes doubled)."""
    return "'" + s.replace("'", "''") + "'"


def sql_regex_class(chars: str) -> str:
    return sql_quote(char_class(chars))


def re2_class(chars: str) -> str:
    """The same character class for engines that reject needless escapes."""
    return "[" + "".join("\\" + ch if ch in "]\\^-[" else ch for ch in chars) + "]"
