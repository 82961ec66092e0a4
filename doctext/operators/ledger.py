"""Failure ledger (B2-B5) over an attempts table
``(package_id, attempt_no, ended_at, failed, error_class)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import RETRY_LIMIT


def attempt_summary(attempts: DataFrame) -> DataFrame:
    """Per package: the latest attempt and the trailing run of failures.
    One aggregate with map-side pre-aggregation; no window, no sort."""
    return attempts.groupBy("package_id").agg(
        F.max("attempt_no").alias("last_no"),
        F.max(F.when(~F.col("failed"), F.col("attempt_no"))).alias("last_ok"),
        F.max_by(F.struct("ended_at", "failed", "error_class"), "attempt_no").alias("last"))


def retry_candidates(attempts: DataFrame, limit: int = RETRY_LIMIT,
                     error_classes: tuple[str, ...] = ()) -> DataFrame:
    """B2: the latest attempt failed and the failures since the last success
    are at most ``limit`` (the first failure is retry 1, each retry +1, and
    a job is requeued while its retry count is below the limit).  With
    ``error_classes`` only failures of these classes are retried."""
    s = attempt_summary(attempts)
    streak = F.col("last_no") - F.coalesce(F.col("last_ok"), F.lit(0))
    wanted = F.col("last.error_class").isin(*error_classes) if error_classes else F.lit(True)
    return s.filter(F.col("last.failed") & (streak <= limit) & wanted) \
            .select("package_id", streak.alias("retry"))


def failed_packages(attempts: DataFrame) -> DataFrame:
    """Packages whose latest attempt failed."""
    s = attempt_summary(attempts)
    return s.filter(F.col("last.failed")).select(
        "package_id", F.col("last_no").alias("attempt_no"),
        F.col("last.ended_at").alias("ended_at"), F.col("last.error_class").alias("error_class"))


def failed_count(attempts: DataFrame) -> DataFrame:
    return failed_packages(attempts).agg(F.count("*").alias("n"))


def failure_report(attempts: DataFrame) -> DataFrame:
    """Two lines per failed package, or one line when nothing failed."""
    f = failed_packages(attempts)
    first = F.struct(F.lit(1).alias("line_no"),
                     F.format_string("Job with args ['%s'] failed at %s with error:", F.col("package_id"),
                                     F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss")).alias("line"))
    second = F.struct(F.lit(2).alias("line_no"), F.col("error_class").alias("line"))
    lines = f.select("package_id", F.explode(F.array(first, second)).alias("l"))
    lines = lines.select("package_id", "l.line_no", "l.line")
    none = f.agg(F.count("*").alias("n")).filter(F.col("n") == 0).select(
        F.lit(None).cast("string").alias("package_id"), F.lit(1).alias("line_no"),
        F.lit("No failed jobs found.").alias("line"))
    return lines.unionByName(none)


def requeue(attempts: DataFrame, selection: DataFrame) -> DataFrame:
    """Failed packages put back into the work set (distinct ids)."""
    return failed_packages(attempts).select("package_id").unionByName(
        selection.select("package_id")).distinct()


def requeue_report(attempts: DataFrame) -> DataFrame:
    return failed_packages(attempts).agg(
        F.format_string("%d have been requeued.", F.count("*")).alias("message"))
