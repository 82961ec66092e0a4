"""URL scalar functions (normalise, case-file repair, relative resolution,
file stems, local paths, https fixing, meeting-record text URLs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MEETING_DOCUMENT_MARK, MEETING_PROTOCOL_MARK, MEETING_URL_MARK
from .text import _col, strip_ws

# RFC 3986 appendix B split, with Python's rules for the scheme.
_URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def url_part(c, part: str) -> Column:
    idx = {"scheme": 1, "netloc": 2, "path": 3, "query": 4, "fragment": 5}[part]
    v = F.regexp_extract(_col(c), _URL_RE, idx)
    return F.lower(v) if part == "scheme" else v


def case_file_url(c) -> Column:
    """Repair a case-file ('/Akte') URL: '///' -> '//', and after
    '/Akte' delete '/', '%' and ':'."""
    u = _col(c)
    u1 = F.when(F.instr(u, "///") > 1, F.replace(u, F.lit("///"), F.lit("//"))).otherwise(u)
    p = F.instr(u1, "//")
    before = F.left(u1, p + 1)
    rest = F.substring(u1, p + 2, 1 << 30)
    a = F.instr(rest, "/Akte")
    head = F.left(rest, a)
    tail = F.translate(F.substring(rest, a + 1, 1 << 30), "/%:", "")
    return F.concat(before, head, tail)


def quote_path(path: Column) -> Column:
    """Percent-encode a path like Python's quote(safe='/'), then turn '%25'
    back into '%' (an already-encoded '%20' stays '%20')."""
    enc = F.array_join(F.transform(F.split(path, "/"), lambda s: F.url_encode(s)), "/")
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    enc = F.replace(enc, F.lit("%7E"), F.lit("~"))
    return F.replace(enc, F.lit("%25"), F.lit("%"))


def normalise_url(c) -> Column:
    """Local paths unchanged; '/Akte' URLs repaired (U2); path
    percent-encoded; query kept, path parameters and fragment dropped."""
    u0 = _col(c)
    u = F.when(F.instr(u0, "/Akte") > 1, case_file_url(u0)).otherwise(u0)
    path = F.regexp_replace(url_part(u, "path"), r";[^/]*$", "")
    query = url_part(u, "query")
    base = F.concat(url_part(u, "scheme"), F.lit("://"), url_part(u, "netloc"), quote_path(path))
    out = F.when(query != "", F.concat(base, F.lit("?"), query)).otherwise(base)
    return F.when(u0.startswith("/"), u0).otherwise(out)


def _dirname(path: Column, times: Column) -> Column:
    """posixpath.split(..)[0] applied ``times`` times."""
    segs = F.split(path, "/")
    keep = F.greatest(F.size(segs) - times, F.lit(1))
    head = F.array_join(F.slice(segs, 1, keep), "/")
    return F.when((head == "") & path.startswith("/"), F.lit("/")).otherwise(head)


def resolve_relative(rel, url) -> Column:
    """Resolve a relative redirect path against the page URL.  '../'
    climbs one level per occurrence beyond the page's folder; query and
    fragment are dropped; a result at the root gets a single slash."""
    r, u = _col(rel), _col(url)
    ups = (F.length(r) - F.length(F.replace(r, F.lit("../"), F.lit("")))) / 3
    times = F.when(r.startswith(".."), ups.cast("int") + 1).otherwise(F.lit(1))
    begin = _dirname(url_part(u, "path"), times)
    append = F.concat(F.lit("/"), F.btrim(r, F.lit("./")))
    newpath = F.concat(F.when(begin == "/", F.lit("")).otherwise(begin), append)
    netloc = url_part(u, "netloc")
    return F.concat(url_part(u, "scheme"), F.lit(":"),
                    F.when(netloc != "", F.concat(F.lit("//"), netloc)).otherwise(F.lit("")),
                    newpath)


def file_stem(c) -> Column:
    """U4: URLs lose '/' and ':' and dots become '_'; paths give the last
    segment up to its first dot."""
    x = _col(c)
    as_url = F.replace(F.translate(x, "/:", ""), F.lit("."), F.lit("_"))
    last = F.element_at(F.split(x, "/"), -1)
    as_path = strip_ws(F.substring_index(last, ".", 1))
    return F.when(x.startswith("htt"), as_url).otherwise(as_path)


def local_url(c) -> Column:
    """Local absolute paths become file:// URLs."""
    x = _col(c)
    return F.when(x.startswith("/"), F.concat(F.lit("file://"), x)).otherwise(x)


def fix_https(c, host: str) -> Column:
    """Http -> https for one host."""
    return F.replace(_col(c), F.lit("http://" + host), F.lit("https://" + host))


def installation_path(path: Column) -> Column:
    return (F.when(F.instr(path, "/bi/") > 0, F.lit("/bi/"))
             .when(F.instr(path, "/ti/") > 0, F.lit("/ti/")))


def meeting_doctype(url, title, name) -> Column:
    """P26: 'protocol' (wins), 'document', or NULL for a meeting-record URL."""
    u, t, n = _col(url), _col(title), _col(name)
    return (F.when(~u.contains(MEETING_URL_MARK), F.lit(None).cast("string"))
             .when(n.contains(MEETING_PROTOCOL_MARK), F.lit("protocol"))
             .when(t.contains(MEETING_DOCUMENT_MARK), F.lit("document")))


def fulltext_url(url, title, name, guid) -> Column:
    """The URL the text is fetched from.  Meeting records use the
    harvest guid: protocols always over https with dtyp=116, documents keep
    the scheme with dtyp=130; anything missing falls back to the URL."""
    u, g = _col(url), _col(guid)
    doctype = meeting_doctype(u, title, name)
    inst = installation_path(url_part(u, "path"))
    netloc = url_part(u, "netloc")
    volfdnr = F.substring_index(F.try_element_at(F.split(g, "#volfdnr="), F.lit(2)), "#", 1)
    docid = F.try_element_at(F.split(g, "#guid="), F.lit(2))
    protocol = F.concat(F.lit("https://"), netloc, inst, F.lit("do027.asp?DOLFDNR="), volfdnr,
                        F.lit("&options=64&dtyp=116"))
    document = F.concat(url_part(u, "scheme"), F.lit("://"), netloc, inst,
                        F.lit("do027.asp?DOLFDNR="), docid, F.lit("&options=64&dtyp=130"))
    computed = (F.when(doctype == "protocol", protocol)
                 .when(doctype == "document", document))
    return F.coalesce(computed, u)
