"""Days whose reports changed after they were imported, found by content fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.operators.usage_days import DAY


def day_prints(answers: DataFrame) -> DataFrame:
    """(org_slug, report_day, fingerprint) of one answer per request (see `latest_answers`).

    Sums of hashes: they combine before the shuffle, whatever the order of the answers. When an
    answer was landed plays no part.
    """
    content = ("feed", "page_no", "status", "after_cursor", "body")
    hashes = answers.select(
        F.col("group_key").alias("org_slug"),
        F.col("request_key").try_cast("date").alias("report_day"),
        F.xxhash64(*content).cast("decimal(38,0)").alias("a"),
        F.xxhash64(F.lit(1), *reversed(content)).cast("decimal(38,0)").alias("b"),
    )
    sums = hashes.groupBy(*DAY).agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sums.select(*DAY, F.concat_ws("/", "n", "a", "b").alias("fingerprint"))


def latest_prints(stored: DataFrame) -> DataFrame:
    """(org_slug, report_day, fingerprint, imported_at) of each day's last import."""
    last = F.max_by("fingerprint", "imported_at").alias("fingerprint")
    return stored.groupBy(*DAY).agg(last, F.max("imported_at").alias("imported_at"))


def changed_days(imported: DataFrame, landed: DataFrame) -> DataFrame:
    """(org_slug, report_day) of imported days that are landed with another content now."""
    now = landed.withColumnRenamed("fingerprint", "landed_print")
    return (
        imported.join(now, DAY).filter(F.col("fingerprint") != F.col("landed_print")).select(*DAY)
    )
