"""Where an import starts and which days it asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.functions.temporal import next_day, strict_day
from shiplog.plans.ledger import org_key

# `completed_at` may miss what changed between fetch and completion; `started_at` does not.
WATERMARKS = ("completed_at", "started_at")


def run_watermark(
    last_run: DataFrame, initial: Column, as_of: Column, column: str = "completed_at"
) -> DataFrame:
    """One row: the watermark of the latest run, else the configured date, else now."""
    if column not in WATERMARKS:
        raise ValueError(f"watermark must be one of {WATERMARKS}")
    return last_run.agg(
        F.coalesce(F.max(column), initial.cast("timestamp"), as_of.cast("timestamp")).alias(
            "updated_after"
        )
    )


def org_watermarks(
    orgs: DataFrame,
    last_runs: DataFrame,
    initial: Column,
    as_of: Column,
    column: str = "completed_at",
) -> DataFrame:
    """(org_slug, updated_after) with the same rule per org."""
    if column not in WATERMARKS:
        raise ValueError(f"watermark must be one of {WATERMARKS}")
    last = last_runs.select("org_slug", F.col(column).alias("_last"))
    return orgs.join(last, "org_slug", "left").select(
        "org_slug",
        F.coalesce("_last", initial.cast("timestamp"), as_of.cast("timestamp")).alias(
            "updated_after"
        ),
    )


def resume_points(orgs: DataFrame, imports: DataFrame, last_runs: DataFrame) -> DataFrame:
    """(org_slug, start_day): the day after the cursor, else the day after the last run's last
    day, else the UTC day of the import's watermark.

    `imports` are the imports to run, keyed by the org's group key.
    """
    chosen = imports.select(
        F.col("group_full_path").alias("_key"), "last_cursor", "updated_after"
    )
    last = last_runs.select("org_slug", "last_completed_report_day")
    return (
        orgs.select("org_slug")
        .join(chosen, org_key(F.col("org_slug")) == F.col("_key"), "left")
        .join(last, "org_slug", "left")
        .select(
            "org_slug",
            F.coalesce(
                next_day(strict_day(F.col("last_cursor"))),
                next_day(F.col("last_completed_report_day")),
                F.to_date("updated_after"),
            ).alias("start_day"),
        )
    )


def plan_days(points: DataFrame, end_day: Column) -> DataFrame:
    """(org_slug, report_day, end_day) for every day from start to end; none if start > end.

    The guard sits around `sequence` itself: reversed bounds raise, and a filter before it may be
    evaluated after it.
    """
    days = F.when(
        F.col("start_day") <= F.col("end_day"),
        F.sequence("start_day", "end_day", F.make_dt_interval(days=F.lit(1))),
    )
    return points.withColumn("end_day", end_day.cast("date")).select(
        "org_slug", F.explode(days).alias("report_day"), "end_day"
    )
