"""End-to-end plans: the processing outcome (W6, W8), the batch run (B1)
and the search-index documents (Q1)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls as U
from ..operators import archive, assemble, select, state
from ..operators.index import SearchIndex, shown_keys, text_bytes, text_differences
from ..operators.keys import key_bits, near_keys, split_by_bits
from ..operators.repair import clear_text
from ..operators.texttable import TextTable
from ..schema import ERROR, NO_TEXT_URL_MARK, UNAVAILABLE, Settings
from ..session import written
from ..sources.pages import page_text, pages_by_url, redirect_target


def fetched_texts(documents: DataFrame) -> DataFrame:
    """What fetching a resource returns: the stored document text of the
    resource (the fetch itself is outside Spark)."""
    return documents.select(F.concat(F.lit("r"), "doc_id").alias("resource_id"),
                            F.col("text").alias("raw"))


def archive_texts(members: DataFrame, settings: Settings, roots: DataFrame | None = None) -> DataFrame:
    """Text of the archives; of ``roots(resource_id)`` only, if given."""
    ids = None if roots is None else roots.select(F.expr("cast(substring(resource_id, 2) as bigint)").alias("root_id"))
    return archive.archive_text(members, settings.archive_blacklist, ids).select(
        F.concat(F.lit("r"), "archive_id").alias("resource_id"), F.col("text").alias("archive_raw"))


def routes(resources: DataFrame, packages: DataFrame, harvest: DataFrame, settings: Settings) -> DataFrame:
    """Where the text of every resource comes from, by its narrow columns:
    ``none`` (a URL that has no text: NOT_AVAILABLE), ``empty`` (blacklisted
    suffix or package, blank URL, over-size file), ``archive`` or ``fetch``."""
    s = settings
    r = (resources.join(packages.select("package_id", "title"), "package_id")
                  .join(assemble.harvest_guid(harvest), "package_id", "left"))
    r = r.withColumn("text_url", U.fulltext_url("url", "title", "name", "guid"))
    route = (F.when(F.col("text_url").contains(NO_TEXT_URL_MARK), "none")
              .when(select.has_blacklisted_suffix("text_url", s.format_blacklist)
                    | select.in_list("package_id", s.package_blacklist) | tx.is_blank("text_url")
                    | select.is_oversize("file_size", s.max_file_size), "empty")
              .when(select.is_archive_url(U.normalise_url("text_url")), "archive").otherwise("fetch"))
    return r.select("resource_id", "package_id", route.alias("route"),
                    F.lower("text_url").endswith(".csv").alias("is_csv"),
                    F.lower("text_url").endswith(".html").alias("is_page"))


def outcome(resources: DataFrame, packages: DataFrame, harvest: DataFrame,
            fetched: DataFrame, members: DataFrame, settings: Settings,
            do_clean: bool = False, dictionary: DataFrame | None = None,
            pages: DataFrame | None = None) -> DataFrame:
    """The text stored for every given resource.

    The rules that need no text come first (``routes``): a no-text URL ->
    NOT_AVAILABLE; blacklisted URL suffix or package, blank URL, over-size
    file -> ''.  Only the resources that are left meet texts: an archive URL
    takes its members' text, or ERROR when there is no readable archive; a
    fetched page (``pages(resource_id, page_raw, is_read)``, if given) its
    plain text after redirects; others the fetched text, ERROR without one
    (W8: the pessimistic default) and for an error page; texts are stripped
    and normalised.  Then: blank -> NOT_AVAILABLE (text_clear ''), cut to
    ``max_chars``; text_clear is the repaired text only where cleaning applies
    (package source listed, URL ends in rar/zip/pdf) and never for a sentinel.

    The routes are written once (keys and flags, also whether cleaning
    applies); texts of other resources are held back by a bitmap of the keys
    before the joins shuffle anything.  Texts that are to be cleaned are
    written with their text_clear, the others once and not moved again.
    """
    s = settings
    r = routes(resources, packages, harvest, s)
    keys = ["resource_id", "package_id"]
    if do_clean:
        r = r.join(assemble.clean_eligible(resources, harvest, s.clean_sources).select("resource_id", "clean"), "resource_id", "left")
        keys.append("clean")
    r = written(r, "routes")
    plain = r.where("route in ('none', 'empty')").select(
        *keys, F.when(F.col("route") == "empty", "").alias("got"), (F.col("route") == "none").alias("none"))

    kept = r.where("route = 'archive'").select(*keys)
    zipped = kept.join(archive_texts(members, s, kept), "resource_id", "left").select(
        *keys, F.coalesce("archive_raw", F.lit(ERROR)).alias("got"), F.lit(False).alias("none"))

    asked = r.where("route = 'fetch'").select(*keys, "is_csv", "is_page")
    f = asked.join(near_keys(fetched, asked, "resource_id"), "resource_id", "left")
    if pages is not None:
        mine = near_keys(pages, asked.where("is_page"), "resource_id")
        f = f.join(page_texts(mine, pages), F.col("is_page") & (F.col("resource_id") == F.col("page_resource")), "left")
        f = f.withColumn("raw", F.when(F.col("page_resource").isNotNull(), F.col("page_raw")).otherwise(F.col("raw")))
    stripped = tx.strip_ws(F.col("raw"))
    raw_text = F.when(F.col("is_csv"), tx.normalise(stripped, is_csv=True)).otherwise(tx.normalise(stripped))
    got = F.when(F.col("raw").isNull() | tx.is_error_page("raw"), F.lit(ERROR)).otherwise(raw_text)
    read = f.select(*keys, got.alias("got"), F.lit(False).alias("none"))

    o = plain.unionByName(zipped).unionByName(read).withColumn("got", tx.truncate("got", s.max_chars))
    blank = tx.is_blank("got")
    text = F.when(F.col("none") | blank, F.lit(UNAVAILABLE)).otherwise(F.col("got"))
    out = o.select(*keys, text.alias("text"), (F.col("none") | blank).alias("_blank_or_none"), blank.alias("_blank"))
    if not do_clean:
        return out.select("resource_id", "package_id", "text",
                          F.lit(None).cast("string").alias("text_clear"))
    out = written(out, "uncleaned", "zstd")
    todo = out.filter(F.col("clean") & ~F.col("_blank_or_none") & ~state.is_sentinel("text"))
    cleaned = clear_text(todo.select("resource_id", "text"), "resource_id", "text", dictionary, s)
    near, away = split_by_bits(out, written(key_bits(todo, "resource_id"), "bits"), "resource_id")
    tc = (F.when(F.col("_blank"), F.lit(""))
           .when(F.col("text_clear").isNotNull(), tx.truncate("text_clear", s.max_chars)))
    ends = lambda df: df.select("resource_id", "package_id", "text", tc.alias("text_clear"))
    done = written(ends(near.join(cleaned, "resource_id", "left")), "cleaned", "zstd")
    return done.unionByName(ends(away.withColumn("text_clear", F.lit(None).cast("string"))))


def page_texts(mine: DataFrame, pages: DataFrame) -> DataFrame:
    """S4 with J6: ``(page_resource, page_raw)`` for fetched pages
    ``mine(resource_id, page_id, url, html)``: the plain text of the page, or
    of the page its script sends to; null when that one is not there.  Only
    pages that are read are turned into text."""
    src = mine.select(F.col("resource_id").alias("page_resource"), "page_id", "url", "html",
                      redirect_target("url", "html").alias("target"))
    own = src.where(F.col("target").eqNullSafe(F.col("url"))).select(
        "page_resource", F.coalesce(page_text("html"), F.lit("")).alias("page_raw"))
    sent = src.where(~F.col("target").eqNullSafe(F.col("url"))).select("page_resource", "target")
    return own.unionByName(sent.join(pages_by_url(pages, sent), "target", "left").select(
        "page_resource", F.when(F.col("target_id").isNotNull(), F.coalesce("text", F.lit(""))).alias("page_raw")))


@dataclass
class Run:
    """What a batch run leaves behind."""
    table: TextTable                  # the stored texts (S5)
    buckets: list[int]                # partitions that were replaced
    outcome: DataFrame                # new texts of the processed resources
    documents: DataFrame              # index documents of the packages processed (Q1)
    index: SearchIndex | None         # the search index with the run's differences


def process_packages(catalog, package_ids: DataFrame, settings: Settings, table: TextTable,
                     do_clean: bool = True, dictionary: DataFrame | None = None,
                     fetched: DataFrame | None = None, pages: DataFrame | None = None,
                     index: SearchIndex | None = None, batch: int = 1) -> Run:
    """B1: selected packages end to end, as one job with several outputs.

    Narrow rules -> texts of what is left (fetched, pages after redirects,
    archives) -> outcome -> repair, written once; from there the touched
    buckets of the text table as they will be, the differences of the search
    index from them to the table as it is, and then the table itself and the
    index documents of the processed packages.
    """
    ids = package_ids.distinct()
    res = catalog.resource.join(ids, "package_id", "left_semi")
    fetched = fetched if fetched is not None else fetched_texts(catalog.raw("documents"))
    o = outcome(res, catalog.package, catalog.harvest, fetched, catalog.members, settings, do_clean, dictionary, pages)
    if not do_clean:      # else its parts are written
        o = written(o, "outcome", "zstd")
    buckets = table.touched(o)
    packages = catalog.package.join(ids, "package_id", "left_semi")
    after = table.after(o, buckets)
    if index is not None:
        shown = packages.where((F.col("type") != "harvest") & ~select.in_list("package_id", settings.package_blacklist))
        listed = res.join(shown.select("package_id"), "package_id", "left_semi")
        was, will = near_keys(table.read(buckets), o, "package_id"), near_keys(after, o, "package_id")
        size = text_bytes(was) + text_bytes(will)
        index = index.add(text_differences(was, shown_keys(was, listed), will, shown_keys(will, listed), size), batch, size)
    table.replace(after, buckets, apart=True)
    after = near_keys(table.read(buckets), o, "package_id")
    return Run(table, buckets, o, index_documents(packages, res, after, settings), index)


def index_documents(packages: DataFrame, resources: DataFrame, ft: DataFrame,
                    settings: Settings) -> DataFrame:
    """Q1: the search-index document of every non-harvest package:
    ``res_fulltext`` / ``res_fulltext_clear`` in resource order, the
    whole package without text fields as JSON ``data_dict`` and
    ``validated_data_dict``, and the old catch-all fields set to ''."""
    pk = packages.filter(F.col("type") != "harvest")
    texts = assemble.attach_fulltext(resources, ft, (), settings.read_limit, settings.package_blacklist)
    agg = texts.groupBy("package_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "text", "text_clear"))).alias("_t"))
    nested = assemble.strip_fulltext(assemble.nest_resources(pk, resources))
    doc = nested.join(agg, "package_id", "left")
    main = F.struct(F.col("package_id").alias("id"), "name", "title", "state", "type", "owner", "resources")
    # The validated form also says how many resources there are.
    valid = F.struct(F.col("package_id").alias("id"), "name", "title", "state", "type", "owner",
                     F.coalesce(F.size("resources"), F.lit(0)).alias("num_resources"), "resources")
    return doc.select(
        "package_id", "name", "title", "state", "type",
        F.transform("_t", lambda x: x["text"]).alias("res_fulltext"),
        F.transform("_t", lambda x: F.coalesce(x["text_clear"], F.lit(""))).alias("res_fulltext_clear"),
        F.to_json(main).alias("data_dict"), F.to_json(valid).alias("validated_data_dict"),
        F.lit("").alias("fulltext"), F.lit("").alias("fulltext_clear"))


def write_index(docs: DataFrame, path: str) -> None:
    """Q1's last step: the index documents written out, one JSON line each."""
    docs.write.mode("overwrite").json(path)
