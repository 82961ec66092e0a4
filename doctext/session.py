"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE for runtime re-planning (partition
# coalescing and skew-join splitting), UTC session time so timestamps compare
# the same in every engine, and Arrow for the rare pandas hand-off.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Joins and aggregates keyed on (document, position) reuse the
    # document partitioning instead of re-shuffling token rows.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def get_spark(master: str | None = None, app: str = "doctext",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session as it is, or build a local one for tests
    and benches with the settings above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the workers, wherever the driver was
    started.  Once per application; later calls do nothing."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    out = os.path.join(tempfile.mkdtemp(prefix="doctext-ship-"), "doctext.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the
    context).  Only a local master may go without: then one private folder
    per application is made, as in tests."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="doctext-shared-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written table."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder, written once and read back, so
    that a frame with several readers is computed once.  Texts take a third
    less room by ``zstd``."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
