"""Verdicts on usage days: a day commits as a whole or not at all.

  commit   every part and every record is good
  empty    no report for a day before the end day; final
  stop     no report yet for the end day
  wait     the index or a part has not been landed
  fail     an error in the index, a part or a record
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.operators.prefix import committed_prefix, first_failures
from shiplog.operators.usage_records import INDEX_STAGE, PART_STAGE

DAY = ["org_slug", "report_day"]
_PLACE = ("stage", "part_no", "block_start", "line_no", "check_no")


def first_errors(index: DataFrame, parts: DataFrame, checked: DataFrame) -> DataFrame:
    """(org_slug, report_day, first) with `first` the first error in processing order.

    Only failing rows reach the aggregate.
    """

    def errors(df: DataFrame, stage, part_no, block_start, line_no, check_no) -> DataFrame:
        place = (stage, part_no, block_start, line_no, check_no)
        types = ("int", "int", "bigint", "bigint", "int")
        return df.filter(F.col("error").isNotNull()).select(
            *DAY,
            F.struct(
                *[p.cast(t).alias(n) for p, t, n in zip(place, types, _PLACE, strict=True)],
                F.col("error"),
            ).alias("e"),
        )

    before = F.lit(-1)
    rows = (
        errors(index, F.lit(INDEX_STAGE), before, before, before, before)
        .unionByName(
            errors(parts, F.lit(PART_STAGE), F.col("part_no"), before, before, before)
        )
        .unionByName(errors(checked, *[F.col(c) for c in _PLACE]))
    )
    return rows.groupBy(*DAY).agg(F.min("e").alias("first"))


def judge_days(
    plan: DataFrame, index: DataFrame, parts: DataFrame, checked: DataFrame
) -> DataFrame:
    """Planned days (org_slug, report_day, end_day) with verdict, records, error and its place."""
    landed_parts = parts.groupBy(*DAY).agg(F.countDistinct("part_no").alias("landed"))
    records = checked.groupBy(*DAY).agg(F.count(F.lit(1)).alias("records"))
    judged = (
        plan.join(index.drop("error"), DAY, "left")
        .join(landed_parts, DAY, "left")
        .join(first_errors(index, parts, checked), DAY, "left")
        .join(records, DAY, "left")
    )
    stage = F.col("first.stage")
    missing = F.coalesce(F.col("landed"), F.lit(0)) < F.col("n_parts")
    verdict = (
        F.when(F.col("kind").isNull(), "wait")
        .when(
            F.col("kind") == "none",
            F.when(F.col("report_day") == F.col("end_day"), "stop").otherwise("empty"),
        )
        .when(F.col("kind") == "error", "fail")
        .when(stage <= PART_STAGE, "fail")
        .when(missing, "wait")
        .when(stage.isNotNull(), "fail")
        .otherwise("commit")
    )
    return judged.select(
        *DAY,
        "end_day",
        verdict.alias("verdict"),
        F.when(verdict == "commit", F.coalesce("records", F.lit(0)))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("records"),
        *[F.when(verdict == "fail", F.col(f"first.{c}")).alias(c) for c in (*_PLACE, "error")],
    )


def committed_days(judged: DataFrame) -> DataFrame:
    """Days before the first one of their org that does not advance the cursor."""
    return committed_prefix(judged, ["org_slug"], "report_day", _holds())


def _holds():
    return F.col("verdict").isin("fail", "stop", "wait")


def import_summary(judged: DataFrame, distinct_users: DataFrame | None = None) -> DataFrame:
    """Per org: days advanced, records, last completed day, and how the import ended."""
    halts = judged.filter(_holds()).join(
        first_failures(judged, ["org_slug"], "report_day", _holds()), "org_slug"
    )
    halts = halts.filter(F.col("report_day") == F.col("first_bad")).select(
        "org_slug",
        F.col("verdict").alias("halted_by"),
        F.col("report_day").alias("halted_on"),
        F.col("error").alias("error"),
    )
    done = committed_days(judged).groupBy("org_slug").agg(
        F.count(F.lit(1)).alias("days_advanced"),
        F.sum("records").alias("records_persisted"),
        F.max("report_day").alias("last_completed_report_day"),
    )
    orgs = judged.select("org_slug").distinct()
    summary = orgs.join(done, "org_slug", "left").join(halts, "org_slug", "left")
    if distinct_users is not None:
        summary = summary.join(distinct_users, "org_slug", "left")
    return summary.withColumns(
        {
            "days_advanced": F.coalesce("days_advanced", F.lit(0)).cast("bigint"),
            "records_persisted": F.coalesce("records_persisted", F.lit(0)).cast("bigint"),
        }
    )
