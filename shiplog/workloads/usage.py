"""Queries on the usage feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.functions.text import has_content
from shiplog.operators import late_days, usage_days, usage_facts
from shiplog.operators.prefix import committed_prefix
from shiplog.operators.usage_records import check_records, checked_lines, decode_lines
from shiplog.session import staged
from shiplog.sources import landing as landed
from shiplog.sources.usage_parts import lines_of_bodies
from shiplog.workloads.registry import query, table
from shiplog.workloads.usage_feed import (
    EVENTS_SQL,
    MEASURE_SQL,
    daily_lines,
    event_lines,
    events,
)


def _now() -> Column:
    return F.lit("2024-02-01T00:00:00Z").cast("timestamp")


def _day_text() -> Column:
    return F.col("report_day").cast("string").alias("report_day")



def _facts(lines: DataFrame, *columns: str) -> DataFrame:
    good = decode_lines(lines).filter(F.col("record").isNotNull())
    return usage_facts.fold_facts(usage_facts.facts_of_records(good, _now()), *columns)


# ---------------------------------------------------------------- breakdowns

_KEY_SQL = {
    "feature": "event_type",
    "ide": "'ide-' || (k % 3)",
    "language": "'lang-' || (k % 7)",
    "model": "'model-' || (k % 4)",
}


def _breakdown_oracle(name: str) -> str:
    keys, measures = schemas.BREAKDOWNS[name]
    named = ", ".join(f"{_KEY_SQL[k]} AS {k}" for k in keys)
    sums = ", ".join(f"CAST(sum({MEASURE_SQL[m]}) AS BIGINT) AS {m}" for m in measures)
    extra, group = "", ", ".join(_KEY_SQL[k] for k in keys)
    if name == "totals_by_ide":
        extra = (
            ", CAST(NULL AS VARCHAR) AS plugin_version, CASE WHEN k % 3 <> 0 THEN"
            " 'ide-' || (k % 3) || '-1.2.3' END AS ide_version"
        )
        group = "k % 3"
    return f"""WITH {EVENTS_SQL}
SELECT org_slug, CAST(report_day AS VARCHAR) AS report_day, user_id, {named}, {sums}{extra}
FROM ev GROUP BY org_slug, report_day, user_id, {group}"""


def _register_breakdown(name: str) -> None:
    @query(f"usage_by_{name.removeprefix('totals_by_')}", _breakdown_oracle(name))
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        facts = _facts(daily_lines(events(spark, sf_dir)), name)
        rows = usage_facts.breakdown(facts, name).withColumn("report_day", _day_text())
        if name == "totals_by_ide":
            rows = rows.withColumns(
                {
                    "plugin_version": F.col("last_known_plugin_version.plugin_version"),
                    "ide_version": F.col("last_known_ide_version.ide_version"),
                }
            ).drop("last_known_plugin_version", "last_known_ide_version")
        return rows


for _name in schemas.BREAKDOWNS:
    _register_breakdown(_name)

# ---------------------------------------------------------------- decoding


@query(
    "usage_strict_decode",
    f"""WITH {EVENTS_SQL}
SELECT event_id, event_id % 10 IN (7, 9) AS good,
       CASE WHEN event_id % 10 IN (7, 9) THEN user_id END AS user_id,
       CASE WHEN event_id % 10 IN (7, 9) THEN CAST(report_day AS VARCHAR) END AS report_day,
       CASE WHEN event_id % 10 IN (7, 9) THEN CAST(k AS BIGINT) END AS interactions,
       CASE WHEN event_id % 10 IN (7, 9) THEN CAST(0 AS BIGINT) END AS loc_deleted_sum,
       CASE WHEN event_id % 10 = 9 THEN
            CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN 'ent-' || k END END AS enterprise_id
FROM ev WHERE event_id % 10 <> 6""",
)
def usage_strict_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a line; eight in ten carry a defect, of eight kinds."""
    lines = event_lines(events(spark, sf_dir)).withColumn(
        "line",
        F.expr(
            """case event_id % 10
            when 0 then concat(line, ' trailing')
            when 1 then regexp_replace(line, '"user_login":"user-([0-9]+)"', '"user_login":$1')
            when 2 then regexp_replace(line, 'interaction_count":[0-9]+', 'interaction_count":null')
            when 3 then regexp_replace(line, '"organization_id":"[^"]*",?', '')
            when 4 then concat('{"day":"x",', substr(line, 2))
            when 5 then regexp_replace(line, '"loc_added_sum":([0-9]+)', '"loc_added_sum":"$1"')
            when 6 then ' \t '
            when 7 then regexp_replace(concat('{"enterprise_id":null,', substr(line, 2)),
                                       ',"enterprise_id":"[^"]*"', '')
            when 8 then replace(line, '{"feature":"all"}', '{"feature":null}')
            else line end"""
        ),
    )
    return decode_lines(lines).select(
        "event_id",
        F.col("record").isNotNull().alias("good"),
        "record.user_id",
        F.col("record.day").alias("report_day"),
        F.col("record.user_initiated_interaction_count").alias("interactions"),
        "record.loc_deleted_sum",
        "record.enterprise_id",
    )


@query(
    "usage_repeated_keys",
    f"""WITH {EVENTS_SQL}
SELECT event_id, event_id % 8 IN (0, 1, 2, 3, 7) AS good,
       CASE WHEN event_id % 8 IN (0, 1, 2, 3, 7) THEN user_id END AS user_id,
       CASE WHEN event_id % 8 IN (0, 1, 2, 3, 7) THEN CAST(k AS BIGINT) END AS interactions,
       CASE WHEN event_id % 8 IN (0, 1, 2, 3, 7) THEN CAST(2 AS BIGINT) END AS features
FROM ev""",
)
def usage_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a line; three in eight repeat a key of the record, four a key it has not."""
    lines = event_lines(events(spark, sf_dir)).withColumn(
        "line",
        F.expr(
            """case event_id % 8
            when 0 then concat('{"zzz":1,"zzz":"2",', substr(line, 2))
            when 1 then replace(line, '{"feature":"all"}', '{"feature":"all","x":1,"x":[]}')
            when 2 then concat('{"zzz":{"user_id":1,"user_id":2},', substr(line, 2))
            when 3 then concat('{"a":{"b":[{"c":1,"c":1}]},"a":0,', substr(line, 2))
            when 4 then concat('{"user_id":7,', substr(line, 2))
            when 5 then replace(line, '{"feature":"all"}', '{"feature":"all","feature":"x"}')
            when 6 then concat('{"zzz":1,"zzz":2,"used_chat":true,', substr(line, 2))
            else line end"""
        ),
    )
    return checked_lines(lines).select(
        "event_id",
        F.col("record").isNotNull().alias("good"),
        "record.user_id",
        F.col("record.user_initiated_interaction_count").alias("interactions"),
        F.size("record.totals_by_feature").cast("long").alias("features"),
    )


@query(
    "usage_parts_union",
    r"""WITH l AS (
  SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents)
SELECT source, CAST(count(DISTINCT doc_id) AS BIGINT) AS parts, CAST(count(*) AS BIGINT) AS lines,
       md5(arg_min(line, row(doc_id, n))) AS first_line,
       md5(arg_max(line, row(doc_id, n))) AS last_line
FROM l WHERE regexp_matches(line, '\S') GROUP BY source""",
)
def usage_parts_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as report parts: the lines of all parts of a source in one order."""
    parts = table(spark, sf_dir, "documents", "source", "doc_id", "text").selectExpr(
        "source org_slug", "date'2024-01-01' report_day", "doc_id part_no", "text body"
    )
    lines = lines_of_bodies(parts).filter(has_content(F.col("line")))
    place = F.struct("part_no", "line_no")
    # Two levels, so that distinct parts are not shuffled line by line.
    by_part = lines.groupBy("org_slug", "part_no").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min_by("line", place).alias("first_line"),
        F.max_by("line", place).alias("last_line"),
    )
    return (
        by_part.groupBy("org_slug")
        .agg(
            F.count(F.lit(1)).alias("parts"),
            F.sum("lines").alias("lines"),
            F.md5(F.min_by("first_line", "part_no")).alias("first_line"),
            F.md5(F.max_by("last_line", "part_no")).alias("last_line"),
        )
        .withColumnRenamed("org_slug", "source")
    )


# ---------------------------------------------------------------- facts
#
# The table holds the reports up to the 20th. The batch re-imports the days from the 10th, from
# reports that know the events of value 20 and more only: on the days of overlap some users are
# replaced and some are missing from the batch.

_LAST = "arg_max({c}, row(event_id % 3, event_id))"


def _merged_sql(columns: dict[str, str]) -> str:
    picked = ",\n ".join(f"{_LAST.format(c=e)} AS {c}" for c, e in columns.items())
    chosen = ", ".join(
        f"CASE WHEN b.user_id IS NOT NULL THEN b.{c} ELSE t.{c} END AS {c}" for c in columns
    )
    return f"""WITH {EVENTS_SQL},
t AS (SELECT org_slug, report_day, user_id, {picked}
      FROM ev WHERE report_day <= DATE '2024-01-20' GROUP BY 1, 2, 3),
b AS (SELECT org_slug, report_day, user_id, {picked}
      FROM ev WHERE report_day >= DATE '2024-01-10' AND value >= 20 GROUP BY 1, 2, 3),
merged AS (SELECT coalesce(b.org_slug, t.org_slug) AS org_slug,
       CAST(coalesce(b.report_day, t.report_day) AS VARCHAR) AS report_day,
       coalesce(b.user_id, t.user_id) AS user_id, t.user_id IS NOT NULL AS kept_id, {chosen}
  FROM t FULL OUTER JOIN b
    ON t.org_slug = b.org_slug AND t.report_day = b.report_day AND t.user_id = b.user_id)"""


_FACT_SQL = {
    # '' stands for NULL: arg_max passes over NULLs.
    "enterprise_id": "CASE WHEN k % 3 = 1 THEN 'ent-' || k ELSE '' END",
    "user_initiated_interaction_count": "CAST(k AS BIGINT)",
    "loc_added_sum": "event_id",
    "used_chat": "event_type = 'click'",
}


def _old_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = event_lines(events(spark, sf_dir))
    old = _facts(lines.filter("report_day <= date'2024-01-20'"))
    new = _facts(lines.filter("report_day >= date'2024-01-10' and value >= 20"))
    return old.withColumn("created_at", _now() - F.make_dt_interval(days=F.lit(9))), new


def _fact_rows(facts: DataFrame) -> DataFrame:
    return facts.select(
        "org_slug",
        _day_text(),
        "user_id",
        F.coalesce("enterprise_id", F.lit("")).alias("enterprise_id"),
        "user_initiated_interaction_count",
        "loc_added_sum",
        "used_chat",
        (F.col("created_at") < _now()).alias("kept_id"),
    )


_UPSERT_SQL = f"{_merged_sql(_FACT_SQL)} SELECT * FROM merged"


@query("usage_fact_upsert", _UPSERT_SQL)
def usage_fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_rows(usage_facts.merge_facts(*_old_and_new(spark, sf_dir)))


@query("replay_idempotent", _UPSERT_SQL)
def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merging the same batch again changes nothing."""
    old, new = _old_and_new(spark, sf_dir)
    return _fact_rows(usage_facts.merge_facts(usage_facts.merge_facts(old, new), new))


@query(
    "usage_children_replace",
    f"""{_merged_sql({"event_type": "event_type", "k": "k"})}
SELECT org_slug, report_day, user_id, event_type AS feature, CAST(k AS BIGINT) AS loc_added_sum
FROM merged UNION ALL SELECT org_slug, report_day, user_id, 'all', 0 FROM merged""",
)
def usage_children_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = usage_facts.merge_facts(*_old_and_new(spark, sf_dir))
    return usage_facts.breakdown(merged, "totals_by_feature").select(
        "org_slug", _day_text(), "user_id", "feature", "loc_added_sum"
    )


@query(
    "usage_cli_totals",
    f"""WITH {EVENTS_SQL},
f AS (SELECT org_slug, report_day, user_id, {_LAST.format(c="k")} AS k FROM ev GROUP BY 1, 2, 3)
SELECT org_slug, CAST(report_day AS VARCHAR) AS report_day, user_id, k % 2 = 0 AS has_cli,
  CASE WHEN k % 2 = 0 THEN CAST(k AS BIGINT) END AS session_count,
  CASE WHEN k % 2 = 0 THEN CAST(0 AS BIGINT) END AS prompt_count,
  CASE WHEN k % 2 = 0 THEN CAST(k * 10 AS BIGINT) END AS output_tokens_sum,
  CASE WHEN k % 2 = 0 THEN k / 4.0 END::DOUBLE AS avg_tokens_per_request
FROM f""",
)
def usage_cli_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(event_lines(events(spark, sf_dir))).select(
        "org_slug",
        _day_text(),
        "user_id",
        F.col("totals_by_cli").isNotNull().alias("has_cli"),
        "totals_by_cli.session_count",
        "totals_by_cli.prompt_count",
        "totals_by_cli.token_usage.output_tokens_sum",
        "totals_by_cli.token_usage.avg_tokens_per_request",
    )


@query(
    "usage_raw_payload",
    f"""WITH {EVENTS_SQL},
f AS (SELECT org_slug, report_day, user_id, {_LAST.format(c="k")} AS k,
      {_LAST.format(c="event_id")} AS e, {_LAST.format(c="event_type")} AS t FROM ev GROUP BY 1, 2, 3)
SELECT org_slug, CAST(report_day AS VARCHAR) AS report_day, user_id,
  CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN 'ent-' || k END AS enterprise_id,
  'user-' || user_id AS user_login, CAST(report_day AS VARCHAR) AS day,
  CAST(e AS VARCHAR) AS loc_added_sum, '0' AS loc_deleted_sum,
  k % 3 = 2 AS null_enterprise, k % 2 = 1 AS null_cli, t AS first_feature
FROM f""",
)
def usage_raw_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = usage_facts.raw_payload(_facts(event_lines(events(spark, sf_dir))))

    def at(path: str) -> Column:
        return F.get_json_object("raw_payload", path)

    return facts.select(
        "org_slug",
        _day_text(),
        "user_id",
        at("$.enterprise_id").alias("enterprise_id"),
        at("$.user_login").alias("user_login"),
        at("$.day").alias("day"),
        at("$.loc_added_sum").alias("loc_added_sum"),
        at("$.loc_deleted_sum").alias("loc_deleted_sum"),
        F.contains("raw_payload", F.lit('"enterprise_id":null')).alias("null_enterprise"),
        F.contains("raw_payload", F.lit('"totals_by_cli":null')).alias("null_cli"),
        at("$.totals_by_feature[0].feature").alias("first_feature"),
    )


# ---------------------------------------------------------------- day verdicts
#
# Outcomes follow from the number of the day (d) and the org (o); defects of lines from the event.

_END = "DATE '2024-01-30'"
_STATUS = """CASE WHEN (d * 7 + o) % 43 = 0 THEN 204 WHEN (d * 5 + o) % 53 = 0 THEN 500
            WHEN (d + o * 3) % 37 = 0 THEN NULL ELSE 200 END"""
_PART_BAD = "(d * 3 + o + p) % 83 = 0"
_DEFECT = """CASE WHEN event_id % 9973 = 1 THEN 'unreadable record'
            WHEN event_id % 10007 = 2 THEN 'record of day 2023-12-31'
            WHEN event_id % 10009 = 3 THEN 'repeated key in totals_by_feature' END"""

_JUDGED_SQL = f"""WITH {EVENTS_SQL},
days AS (SELECT DISTINCT org_slug, org_no AS o, report_day, day(report_day) AS d FROM ev),
idx AS (SELECT *, {_STATUS} AS status FROM days),
errs AS (
  SELECT org_slug, report_day, 0 AS stage, -1 AS part_no, -1 AS line_no,
         'unexpected status 500: index' AS error FROM idx WHERE status = 500
  UNION ALL
  SELECT org_slug, report_day, 1, p, -1, 'unexpected status 503: part'
  FROM idx, (SELECT unnest([0, 1, 2]) AS p) WHERE {_PART_BAD} AND status = 200
  UNION ALL
  SELECT ev.org_slug, ev.report_day,
         CASE WHEN event_id % 9973 = 1 THEN 1 ELSE 2 END, CAST(event_id % 3 AS INTEGER), event_id,
         {_DEFECT}
  FROM ev JOIN idx ON ev.org_slug = idx.org_slug AND ev.report_day = idx.report_day
  WHERE status = 200 AND ({_DEFECT}) IS NOT NULL
    AND NOT (idx.d * 3 + idx.o + event_id % 3) % 83 = 0),
firsts AS (SELECT org_slug, report_day, arg_min(error, row(stage, part_no, line_no)) AS error
           FROM errs GROUP BY 1, 2),
recs AS (SELECT org_slug, report_day, count(*) AS n, count(DISTINCT user_id) AS users
         FROM ev GROUP BY 1, 2),
judged AS (
  SELECT idx.org_slug, idx.report_day,
    CASE WHEN status IS NULL THEN 'wait'
         WHEN status = 204 THEN CASE WHEN idx.report_day = {_END} THEN 'stop' ELSE 'empty' END
         WHEN error IS NOT NULL THEN 'fail' ELSE 'commit' END AS verdict, error, n, users
  FROM idx LEFT JOIN firsts USING (org_slug, report_day) JOIN recs USING (org_slug, report_day)),
bad AS (SELECT org_slug, min(report_day) AS first_bad FROM judged
        WHERE verdict IN ('fail', 'stop', 'wait') GROUP BY 1),
prefix AS (SELECT judged.* FROM judged LEFT JOIN bad USING (org_slug)
           WHERE first_bad IS NULL OR report_day < first_bad)"""


def _plan_index_parts(ev: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    days = (
        ev.groupBy("org_slug", "org_no", "report_day")
        .agg(F.count(F.lit(1)).alias("_"))
        .selectExpr("org_slug", "org_no o", "report_day", "day(report_day) d")
    )
    # One row per org and day, written once: plan, index and parts all come from it.
    days = staged(days, "event-days")
    rows = days.selectExpr("*", f"{_STATUS} status").filter("status is not null")
    index_body = F.when(
        F.col("status") == 200,
        F.to_json(
            F.struct(
                F.array(*[F.lit(f"https://reports.example/{p}") for p in range(3)]).alias(
                    "download_links"
                ),
                F.col("report_day").cast("string").alias("report_day"),
            )
        ),
    ).otherwise("index")
    answers = rows.select(
        F.lit(landed.USAGE_INDEX).alias("feed"),
        F.col("org_slug").alias("group_key"),
        F.col("report_day").cast("string").alias("request_key"),
        "status",
        index_body.alias("body"),
    )
    part_answers = (
        rows.filter("status = 200")
        .selectExpr("*", "explode(array(0, 1, 2)) p")
        .selectExpr(
            f"'{landed.USAGE_PART}' feed",
            "org_slug group_key",
            "cast(report_day as string) request_key",
            "p page_no",
            f"case when {_PART_BAD} then 503 else 200 end status",
            "'part' body",
        )
    )
    plan = days.selectExpr("org_slug", "report_day", f"{_END} end_day")
    index = staged(landed.usage_index(answers), "usage-index")
    return plan, index, landed.usage_part_answers(part_answers)


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(judged days, checked records); the records are used twice and written out once."""
    ev = events(spark, sf_dir)
    plan, index, parts = _plan_index_parts(ev)
    lines = event_lines(ev).withColumn(
        "line",
        F.expr(
            """case when event_id % 9973 = 1 then concat(line, ']')
            when event_id % 10007 = 2 then regexp_replace(line, '"day":"[^"]*"', '"day":"2023-12-31"')
            when event_id % 10009 = 3
              then replace(line, '{"feature":"all"}', '{"feature":"all"},{"feature":"all"}')
            else line end"""
        ),
    )
    good_parts = parts.filter("error is null").select("org_slug", "report_day", "part_no")
    lines = lines.join(good_parts, ["org_slug", "report_day", "part_no"], "left_semi")
    checked = check_records(decode_lines(lines)).select(
        "org_slug", "report_day", "part_no", "block_start", "line_no", "stage", "check_no",
        "error", "record",
    )
    checked = staged(checked, "usage-records")
    return usage_days.judge_days(plan, index, parts, checked), checked


@query(
    "usage_day_verdict",
    f"""{_JUDGED_SQL}
SELECT org_slug, CAST(report_day AS VARCHAR) AS report_day, verdict,
       CASE WHEN verdict = 'commit' THEN n ELSE 0 END AS records,
       CASE WHEN verdict = 'fail' THEN error END AS error FROM judged""",
)
def usage_day_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = _judged(spark, sf_dir)
    return judged.select("org_slug", _day_text(), "verdict", "records", "error")


@query(
    "usage_day_commit",
    f"""{_JUDGED_SQL}
SELECT ev.org_slug, CAST(ev.report_day AS VARCHAR) AS report_day, user_id,
       {_LAST.format(c="k")}::BIGINT AS interactions, {_LAST.format(c="event_id")} AS loc_added_sum
FROM ev JOIN prefix ON ev.org_slug = prefix.org_slug AND ev.report_day = prefix.report_day
WHERE verdict = 'commit' GROUP BY ev.org_slug, ev.report_day, user_id""",
)
def usage_day_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, checked = _judged(spark, sf_dir)
    days = usage_days.committed_days(judged).filter("verdict = 'commit'")
    # A list of days, of known size once written: records stay where they are, and the fold
    # deals them out by the full key.
    days = staged(days.select(*usage_days.DAY), "committed-days")
    records = checked.join(days, usage_days.DAY, "left_semi")
    facts = usage_facts.last_facts(usage_facts.facts_of_records(records, _now()))
    return facts.select(
        "org_slug",
        _day_text(),
        "user_id",
        F.col("user_initiated_interaction_count").alias("interactions"),
        "loc_added_sum",
    )


@query(
    "usage_import_summary",
    f"""{_JUDGED_SQL},
orgs AS (SELECT DISTINCT org_slug FROM ev),
done AS (SELECT org_slug, count(*) AS days_advanced,
                sum(CASE WHEN verdict = 'commit' THEN n ELSE 0 END) AS records_persisted,
                sum(CASE WHEN verdict = 'commit' THEN users ELSE 0 END) AS user_days,
                max(report_day) AS last_day FROM prefix GROUP BY 1),
halts AS (SELECT judged.org_slug, verdict, error FROM judged JOIN bad
          ON judged.org_slug = bad.org_slug AND report_day = first_bad)
SELECT orgs.org_slug, coalesce(days_advanced, 0)::BIGINT AS days_advanced,
       coalesce(records_persisted, 0)::BIGINT AS records_persisted,
       coalesce(user_days, 0)::BIGINT AS user_days,
       CAST(last_day AS VARCHAR) AS last_completed_report_day, verdict AS halted_by,
       CASE WHEN verdict = 'fail' THEN error END AS error
FROM orgs LEFT JOIN done USING (org_slug) LEFT JOIN halts USING (org_slug)""",
)
def usage_import_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats of a user count in `records_persisted`; `user_days` counts them once."""
    judged, checked = _judged(spark, sf_dir)
    judged = staged(judged, "judged-days")
    days = usage_days.committed_days(judged).filter("verdict = 'commit'")
    users = (
        checked.select(*usage_days.DAY, "record.user_id")
        .join(days.select(*usage_days.DAY), usage_days.DAY, "left_semi")
        .groupBy(*usage_days.DAY, "user_id")
        .agg(F.count(F.lit(1)).alias("_"))
        .groupBy("org_slug")
        .agg(F.count(F.lit(1)).alias("user_days"))
    )
    summary = usage_days.import_summary(judged, users)
    return summary.select(
        "org_slug",
        "days_advanced",
        "records_persisted",
        F.coalesce("user_days", F.lit(0)).cast("bigint").alias("user_days"),
        F.col("last_completed_report_day").cast("string").alias("last_completed_report_day"),
        "halted_by",
        "error",
    )


@query(
    "prefix_commit",
    """SELECT o_custkey, o_orderkey FROM (
  SELECT *, max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) OVER (
      PARTITION BY o_custkey ORDER BY o_orderkey
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS failed FROM orders)
WHERE failed = 0""",
)
def prefix_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer before its first one with status P."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return committed_prefix(
        orders, ["o_custkey"], "o_orderkey", F.col("o_orderstatus") == "P"
    ).drop("o_orderstatus")




# ---------------------------------------------------------------- late days


@query(
    "late_days",
    f"""WITH {EVENTS_SQL}
SELECT DISTINCT org_slug, CAST(report_day AS VARCHAR) AS report_day FROM ev
WHERE (day(report_day) % 4 = 0 AND event_id % 3 = 1) OR (day(report_day) % 4 = 2 AND event_id % 3 = 0)""",
)
def late_days_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts a day, imported; then some days get another part 1, some the same parts again,
    some a part 7, and some an answer that was landed before the one that was imported."""
    parts = (
        events(spark, sf_dir)
        .groupBy("org_slug", "report_day", F.expr("cast(event_id % 3 as int)").alias("p"))
        .agg(F.concat_ws(":", F.count("*"), F.sum("k")).alias("body"))
    )
    parts = staged(parts.withColumn("d", F.expr("day(report_day) % 4")), "event-parts")

    def answers(rows: DataFrame, landed_at: str, page_no: str = "p", body: str = "body") -> DataFrame:
        return rows.selectExpr(
            f"'{landed.USAGE_PART}' feed", "org_slug group_key", "cast(report_day as string) request_key",
            f"{page_no} page_no", "cast(null as string) after_cursor", "200 status", f"{body} body",
            f"timestamp'{landed_at}' landed_at",
        )

    first = answers(parts, "2024-06-02")
    later = [
        answers(parts.filter("d = 0 and p = 1"), "2024-06-03", body="body || 'x'"),
        answers(parts.filter("d = 1"), "2024-06-03"),
        answers(parts.filter("d = 2 and p = 0"), "2024-06-03", page_no="7"),
        answers(parts.filter("d = 3"), "2024-06-01", body="'older'"),
    ]
    everything = reduce(DataFrame.unionByName, later, first)
    return late_days.changed_days(
        late_days.day_prints(landed.latest_answers(first)),
        late_days.day_prints(landed.latest_answers(everything)),
    ).select("org_slug", _day_text())
