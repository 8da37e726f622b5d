"""A usage feed made from the `events` table: an org is a fifth of the users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.workloads.registry import dealt, table

# Measures of one event, the same text in both engines.
MEASURE_SQL = {
    "user_initiated_interaction_count": "1",
    "code_generation_activity_count": "CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END",
    "code_acceptance_activity_count": "CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END",
    "loc_suggested_to_add_sum": "k",
    "loc_suggested_to_delete_sum": "k % 10",
    "loc_added_sum": "k % 5",
    "loc_deleted_sum": "k % 3",
}

# Base table as seen by the oracles.
EVENTS_SQL = """ev AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS report_day, user_id, user_id % 5 AS org_no,
         'org-' || (user_id % 5) AS org_slug, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("event_id", "ts", "user_id", "event_type", "value", "props")
    rows = table(spark, sf_dir, "events", *columns).selectExpr(
        "event_id",
        "ts",
        "cast(ts as date) report_day",
        "user_id",
        "user_id % 5 org_no",
        "concat('org-', user_id % 5) org_slug",
        "event_type",
        "value",
        "cast(get_json_object(props, '$.k') as int) k",
    )
    return dealt(rows, "org_slug", "report_day", "user_id")


def daily_lines(ev: DataFrame) -> DataFrame:
    """One report line per (org, day, user) with counts by feature, IDE, language and model.

    The fine counts combine before the shuffle. What is then collected per user and day is bounded
    by the vocabulary of features, languages and models, not by the number of events.
    """
    sums = [F.expr(f"sum({e})").alias(m) for m, e in MEASURE_SQL.items()]
    fine = (
        ev.selectExpr(
            "*",
            """stack(5,
                 'totals_by_feature', event_type, '',
                 'totals_by_ide', concat('ide-', k % 3), '',
                 'totals_by_language_feature', concat('lang-', k % 7), event_type,
                 'totals_by_language_model', concat('lang-', k % 7), concat('model-', k % 4),
                 'totals_by_model_feature', concat('model-', k % 4), event_type
               ) as (kind, a, b)""",
        )
        .groupBy("org_slug", "report_day", "user_id", "kind", "a", "b")
        .agg(*sums)
    )
    lists = []
    for kind, (keys, measures) in schemas.BREAKDOWNS.items():
        names = [F.col(c).alias(k) for c, k in zip("ab", keys, strict=False)]
        extra = []
        if kind == "totals_by_ide":
            version = F.struct(
                F.lit("2024-01-01T00:00:00Z").alias("sampled_at"),
                F.concat("a", F.lit("-1.2.3")).alias("ide_version"),
            )
            extra = [F.when(F.col("a") != "ide-0", version).alias("last_known_ide_version")]
        entry = F.struct(*names, *measures, *extra)
        lists.append(F.collect_list(F.when(F.col("kind") == kind, entry)).alias(kind))
    daily = fine.groupBy("org_slug", "report_day", "user_id").agg(*lists)
    line = F.to_json(
        F.struct(
            "user_id",
            F.concat(F.lit("user-"), F.col("user_id")).alias("user_login"),
            F.col("report_day").cast("string").alias("day"),
            F.lit("7").alias("organization_id"),
            *schemas.BREAKDOWN_ORDER,
        )
    )
    return daily.select(
        "org_slug",
        "report_day",
        F.lit(0).alias("part_no"),
        F.lit(0).cast("bigint").alias("block_start"),
        F.col("user_id").alias("line_no"),
        line.alias("line"),
    )


def event_lines(ev: DataFrame) -> DataFrame:
    """One report line per event, in three parts; a user repeats within a day."""
    line = """concat('{"user_id":', user_id,
        ',"user_login":"user-', user_id,
        '","day":"', report_day,
        '","organization_id":"id-', org_no, '"',
        case when k % 3 = 0 then ',"enterprise_id":""'
             when k % 3 = 1 then concat(',"enterprise_id":"ent-', k, '"') else '' end,
        ',"user_initiated_interaction_count":', k,
        ',"loc_added_sum":', event_id,
        ',"used_chat":', event_type = 'click',
        ',"totals_by_feature":[{"feature":"', event_type, '","loc_added_sum":', k,
        '},{"feature":"all"}]',
        case when k % 2 = 0 then concat(',"totals_by_cli":{"session_count":', k,
             ',"token_usage":{"output_tokens_sum":', k * 10,
             ',"avg_tokens_per_request":', cast(k as double) / 4, '}}') else '' end,
        '}')"""
    return ev.selectExpr(
        "*",
        "cast(event_id % 3 as int) part_no",
        "0L block_start",
        "event_id line_no",
        f"{line} line",
    )
