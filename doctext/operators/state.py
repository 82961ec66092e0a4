"""State-table writes (W1-W10): initialise, merge, dedupe, outcome, cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, truncate
from ..schema import ERROR, UNAVAILABLE, UNPROCESSED
from .keys import split_by_keys

FT_COLS = ["id", "resource_id", "package_id", "text", "text_clear"]


def new_row_id(resource_id) -> F.Column:
    """Ids of inserted rows: derived from the resource so re-running the
    same batch writes the same table (idempotent, comparable)."""
    return F.concat(F.col(resource_id) if isinstance(resource_id, str) else resource_id,
                    F.lit("-new"))


def is_sentinel(c) -> F.Column:
    x = F.col(c) if isinstance(c, str) else c
    return x.isin(UNPROCESSED, ERROR)


def dedupe_resource(ft: DataFrame) -> DataFrame:
    """Keep one row per resource, preferring a processed row (neither
    UNPROCESSED nor ERROR), then the smallest id.

    The winner is chosen on narrow columns (a partial aggregate, so a
    resource with very many rows does not arrive whole in one task); the
    texts are then joined to the winners' ids, once and unsorted by text.
    """
    win = dedupe_winners(ft).select(F.col("resource_id").alias("_r"), F.col("id").alias("_i"))
    same = F.col("resource_id").eqNullSafe(F.col("_r")) & (F.col("id") == F.col("_i"))
    return ft.join(win, same, "left_semi").select(*FT_COLS)


def dedupe_winners(ft: DataFrame) -> DataFrame:
    """``(resource_id, id)`` of the row W4 keeps of every resource."""
    key = F.min(F.struct(is_sentinel("text").cast("int").alias("s"), F.col("id")))
    return ft.groupBy("resource_id").agg(key.alias("k")).select("resource_id", F.col("k.id").alias("id"))


def init_unprocessed(ft: DataFrame, resources: DataFrame, package_ids: DataFrame,
                     check_exist: bool = True) -> DataFrame:
    """Every resource of the selected packages gets UNPROCESSED.

    With ``check_exist`` the first existing row of a resource (smallest id)
    is reset (text UNPROCESSED, text_clear NULL) and only resources without
    a row get one inserted; without it a row is always inserted.  Returns the
    whole new table.
    """
    targets = resources.join(package_ids, "package_id", "left_semi").select("resource_id", "package_id")
    inserts = targets.select(new_row_id("resource_id").alias("id"), "resource_id", "package_id",
                             F.lit(UNPROCESSED).alias("text"),
                             F.lit(None).cast("string").alias("text_clear"))
    if not check_exist:
        return ft.select(*FT_COLS).unionByName(inserts)
    first_ids = (ft.groupBy("resource_id").agg(F.min("id").alias("id"))
                   .join(targets.select("resource_id"), "resource_id", "left_semi"))
    marked = ft.join(first_ids.withColumn("_reset", F.lit(True)), ["resource_id", "id"], "left")
    reset = F.coalesce(F.col("_reset"), F.lit(False))
    kept = marked.select(
        "id", "resource_id", "package_id",
        F.when(reset, F.lit(UNPROCESSED)).otherwise(F.col("text")).alias("text"),
        F.when(reset, F.lit(None).cast("string")).otherwise(F.col("text_clear")).alias("text_clear"))
    missing = inserts.join(ft.select("resource_id"), "resource_id", "left_anti").select(*FT_COLS)
    return kept.unionByName(missing)


def empty_to_unavailable(c) -> F.Column:
    """Blank text becomes NOT_AVAILABLE."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(is_blank(x), F.lit(UNAVAILABLE)).otherwise(x)


def merge_actions(old: DataFrame, incoming: DataFrame, packages: DataFrame) -> DataFrame:
    """What saving a batch of package texts does to every row.

    ``incoming`` holds, per package in the batch, its full new resource list
    ``(package_id, resource_id, position, text)``.  For every package of the
    batch: deleted package -> all its old rows go (nothing is inserted);
    otherwise old rows whose resource is still listed are updated (text
    replaced, text_clear NULL), the others deleted, and listed resources
    without an old row inserted.  Packages outside the batch keep their rows.

    Old rows outside the batch are told by a bitmap of its package ids and
    pass by without being moved; only texts of batch packages (and the few
    whose hash meets one) are shuffled, for one full outer join on
    (package_id, resource_id).
    """
    new = incoming.select("package_id", "resource_id",
                          empty_to_unavailable("text").alias("new_text"))
    batch = (incoming.select("package_id").distinct()
             .join(packages.select("package_id", F.col("state").alias("pstate")), "package_id", "left")
             .withColumn("in_batch", F.lit(True)))
    near, away = split_by_keys(old.select(*FT_COLS), incoming.select("package_id").distinct(), "package_id")
    j = near.join(new, ["package_id", "resource_id"], "full_outer").join(batch, "package_id", "left")
    deleted = F.col("pstate") == "deleted"
    in_batch = F.coalesce(F.col("in_batch"), F.lit(False))
    action = (F.when(~in_batch, F.lit("keep"))
               .when(deleted & F.col("id").isNotNull(), F.lit("delete"))
               .when(deleted, F.lit("skip"))
               .when(F.col("id").isNull(), F.lit("insert"))
               .when(F.col("new_text").isNull(), F.lit("delete"))
               .otherwise(F.lit("update")))
    moved = j.select(
        F.coalesce(F.col("id"), new_row_id("resource_id")).alias("id"),
        "resource_id", "package_id", action.alias("action"),
        F.when(action.isin("insert", "update"), F.col("new_text"))
         .otherwise(F.col("text")).alias("text"),
        F.when(action.isin("insert", "update"), F.lit(None).cast("string"))
         .otherwise(F.col("text_clear")).alias("text_clear"))
    return moved.unionByName(away.withColumn("action", F.lit("keep")))


def merge_rows(old: DataFrame, incoming: DataFrame, packages: DataFrame, tasks: int) -> DataFrame:
    """The rows that a batch writes, those ``merge_actions`` updates or
    inserts (text_clear is NULL there), without the old texts: ``old`` are keys
    ``(id, resource_id, package_id)``.  New texts, keys and packages meet in
    one exchange by package; a new row meets every old row of its resource and
    every row of its package."""
    none = F.lit(None).cast("string")
    new = incoming.select("package_id", "resource_id", empty_to_unavailable("text").alias("text"), none.alias("id"),
                          none.alias("state"), F.lit("new").alias("kind"))
    all_rows = (new.unionByName(old.select("package_id", "resource_id", none.alias("text"), "id", none.alias("state"), F.lit("old").alias("kind")))
                .unionByName(packages.select("package_id", none.alias("resource_id"), none.alias("text"), none.alias("id"), "state",
                                             F.lit("package").alias("kind")))
                .repartition(tasks, "package_id"))
    known, kind = F.col("package_id").isNotNull(), F.col("kind")
    resource, package = Window.partitionBy("package_id", "resource_id"), Window.partitionBy("package_id")
    met = (all_rows.withColumn("ids", F.collect_list(F.when((kind == "old") & known & F.col("resource_id").isNotNull(), F.struct("id"))).over(resource))
           .withColumn("sent", F.max((kind == "new") & F.col("resource_id").isNotNull()).over(resource))
           .withColumn("in_batch", F.max(kind == "new").over(package))
           .withColumn("states", F.collect_list(F.when((kind == "package") & known, F.struct("state"))).over(package)))
    # An old row without an id reads as an insert, of no text where none is sent.
    alone = (kind == "old") & F.col("id").isNull() & known & F.col("in_batch") & ~F.col("sent")
    met = met.where((kind == "new") | alone).withColumn("ids", F.when(kind == "new", F.col("ids")))
    pairs = (met.select("package_id", "resource_id", "text", "ids", F.explode_outer("states").alias("s"))
             .select("package_id", "resource_id", "text", "s.state", F.explode_outer("ids").alias("o")))
    # A row of no package belongs to no batch: it is kept without a text.
    return pairs.where(~F.coalesce(F.col("state") == "deleted", F.lit(False))).select(
        F.coalesce("o.id", new_row_id("resource_id")).alias("id"), "resource_id", "package_id",
        F.when(known, F.col("text")).alias("text"), none.alias("text_clear"))


def merge_result(old: DataFrame, incoming: DataFrame, packages: DataFrame) -> DataFrame:
    """The table after the save (inserted rows have text_clear NULL)."""
    a = merge_actions(old, incoming, packages)
    return a.filter(F.col("action").isin("keep", "update", "insert")).select(*FT_COLS)


def cascade_delete(ft: DataFrame, resources: DataFrame) -> DataFrame:
    """Rows whose resource (of that package) no longer exists go."""
    live = resources.select("resource_id", "package_id")
    return ft.join(live, ["resource_id", "package_id"], "left_semi").select(*FT_COLS)


def apply_outcome(ft: DataFrame, outcome: DataFrame) -> DataFrame:
    """Write the processing outcome back: the kept row of each processed
    resource takes the new text / text_clear, other rows of it go; rows of
    resources not processed stay as they are.

    Of a processed resource only the keys of its old rows are needed, and
    which of them is kept is decided on narrow columns; they meet the outcome
    in a full outer join.  The texts of other resources are told by a bitmap
    and stay where they lie (those whose hash meets a processed one are told
    exactly by a join).
    """
    done = outcome.select("resource_id").where("resource_id is not null").distinct()
    near, away = split_by_keys(ft.select(*FT_COLS), done, "resource_id")
    mine = near.select("resource_id", "id", "package_id", is_sentinel("text").cast("int").alias("s")) \
               .join(done, "resource_id", "left_semi")
    kept = mine.groupBy("resource_id").agg(F.min(F.struct("s", "id"))["id"].alias("kept_id"))
    old = mine.join(kept, "resource_id").where(F.col("id").isNull() | (F.col("id") == F.col("kept_id"))) \
              .select("resource_id", "id", "package_id")
    o = outcome.select("resource_id", F.col("package_id").alias("o_package"), "text", "text_clear")
    new = o.join(old, "resource_id", "left").select(
        F.coalesce("id", new_row_id("resource_id")).alias("id"), "resource_id",
        F.coalesce("package_id", "o_package").alias("package_id"), "text", "text_clear")
    other = near.select("resource_id").where("resource_id is not null").distinct().join(done, "resource_id", "left_anti")
    met = split_by_keys(near, other, "resource_id")[0].join(other, "resource_id", "left_semi").select(*FT_COLS)
    return away.unionByName(met).unionByName(near.where("resource_id is null")).unionByName(new)


def truncate_both(df: DataFrame, max_chars: int) -> DataFrame:
    """W9 on both text columns."""
    return df.withColumn("text", truncate("text", max_chars)) \
             .withColumn("text_clear", truncate("text_clear", max_chars))

