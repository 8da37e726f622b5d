"""Queries on run and import ledgers, day plans, and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.functions.temporal import report_end_day, rfc3339
from shiplog.functions.text import scope_names
from shiplog.operators import audits
from shiplog.plans import day_plan, ledger
from shiplog.sources import landing as landed
from shiplog.workloads.registry import query, table
from shiplog.workloads.usage_feed import EVENTS_SQL, events

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_SQL_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def _stamp(name: str) -> Column:
    return F.date_format(name, STAMP).alias(name)


def _utc(column: str) -> str:
    """A zoneless timestamp column as an instant; the session zone is UTC."""
    return f"cast({column} as timestamp)"


# ---------------------------------------------------------------- runs
#
# Every event is a run of its user that took k seconds.

_RUNS_SQL = f"""{EVENTS_SQL},
runs AS (SELECT 'team-' || user_id AS org_slug, user_id, ts AS started_at,
  ts + to_seconds(k) AS completed_at, report_day AS last_completed_report_day FROM ev)"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "concat('team-', user_id) org_slug",
        f"{_utc('ts')} started_at",
        f"{_utc('ts')} + make_dt_interval(0, 0, 0, k) completed_at",
        "report_day last_completed_report_day",
    )


@query(
    "run_ledger_latest",
    f"""WITH {_RUNS_SQL}
SELECT {_SQL_STAMP.format("started_at")} AS started_at, {_SQL_STAMP.format("completed_at")} AS completed_at,
  date_sub('second', started_at, completed_at) AS elapsed_seconds
FROM runs ORDER BY runs.started_at DESC, runs.completed_at DESC LIMIT 1""",
)
def run_ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir).select("started_at", "completed_at")
    return ledger.elapsed_seconds(ledger.latest_run(runs)).select(
        _stamp("started_at"), _stamp("completed_at"), "elapsed_seconds"
    )


@query(
    "run_latest_per_org",
    f"""WITH {_RUNS_SQL}
SELECT org_slug, {_SQL_STAMP.format("started_at")} AS started_at,
  {_SQL_STAMP.format("completed_at")} AS completed_at,
  CAST(last_completed_report_day AS VARCHAR) AS last_completed_report_day
FROM runs QUALIFY row_number() OVER (PARTITION BY org_slug ORDER BY runs.started_at DESC) = 1""",
)
def run_latest_per_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ledger.latest_run_per_org(_runs(spark, sf_dir))
    return latest.select(
        "org_slug",
        _stamp("started_at"),
        _stamp("completed_at"),
        F.col("last_completed_report_day").cast("string").alias("last_completed_report_day"),
    )


@query(
    "run_gate",
    f"""WITH {EVENTS_SQL}
SELECT CAST(report_day AS VARCHAR) AS report_day, user_id, bool_and(event_type <> 'error') AS succeeded
FROM ev GROUP BY ev.report_day, user_id""",
)
def run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's day is a run; it succeeds if none of its events is an error."""
    results = events(spark, sf_dir).selectExpr(
        "cast(report_day as string) report_day", "user_id", "event_type <> 'error' ok"
    )
    return ledger.all_succeeded(results, by=["report_day", "user_id"])


@query(
    "watermark_resolve",
    f"""WITH {_RUNS_SQL},
latest AS (SELECT user_id, max(completed_at) FILTER (WHERE started_at = last) AS completed_at
  FROM (SELECT *, max(started_at) OVER (PARTITION BY user_id) AS last FROM runs) GROUP BY 1)
SELECT 'team-' || c_custkey AS org_slug, {_SQL_STAMP.format(
    "coalesce(completed_at, TIMESTAMP '2023-06-01')")} AS updated_after
FROM customer LEFT JOIN latest ON user_id = c_custkey""",
)
def watermark_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as orgs; those without a run take the configured date."""
    orgs = table(spark, sf_dir, "customer").selectExpr("concat('team-', c_custkey) org_slug")
    initial = F.lit("2023-06-01T00:00:00Z").cast("timestamp")
    last = ledger.latest_run_per_org(_runs(spark, sf_dir))
    marks = day_plan.org_watermarks(orgs, last, initial, F.lit("2024-03-01").cast("timestamp"))
    return marks.select("org_slug", _stamp("updated_after"))


# ---------------------------------------------------------------- imports
#
# Eight events in a row are the history of one import; its first event creates it.

_EVENT_KIND = """CASE WHEN event_id % 8 = 0 THEN 'created' ELSE CASE event_type
  WHEN 'click' THEN 'advanced' WHEN 'view' THEN 'advanced' WHEN 'error' THEN 'failed'
  WHEN 'purchase' THEN 'completed' ELSE 'reset' END END"""
_CURSOR = "CASE WHEN k % 10 <> 0 THEN 'c' || k END"

_IMPORTS_SQL = f"""{EVENTS_SQL},
hist AS (SELECT *, event_id // 8 AS no, {_EVENT_KIND} AS event, {_CURSOR} AS cursor FROM ev),
imports AS (SELECT 'imp-' || no AS import_id, no,
  any_value('github_org:team-' || (no % 97)) AS group_full_path,
  any_value(CASE WHEN no % 2 = 0 THEN 'merge_requests' ELSE 'copilot_users_1_day' END) AS import_type,
  min(ts) FILTER (WHERE event = 'created') AS started_at,
  min(ts - INTERVAL 3 DAY) FILTER (WHERE event = 'created') AS updated_after,
  arg_max_null(cursor, event_id) FILTER (WHERE event = 'advanced') AS last_cursor,
  coalesce(sum(k) FILTER (WHERE event = 'advanced'), 0)::INTEGER AS total_processed,
  CASE arg_max(event, event_id) FILTER (WHERE event <> 'advanced')
    WHEN 'completed' THEN 'completed' WHEN 'failed' THEN 'failed' ELSE 'in_progress' END AS status,
  max(ts) AS last_activity_at, arg_max(ts, event_id) FILTER (WHERE event = 'completed') AS completed_at,
  arg_max_null(CASE WHEN event = 'failed' THEN 'failed at ' || k END, event_id)
    FILTER (WHERE event IN ('failed', 'reset')) AS error_message
  FROM hist GROUP BY no)"""


def _import_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "concat('imp-', event_id div 8) import_id",
        "concat('github_org:team-', (event_id div 8) % 97) group_full_path",
        "if((event_id div 8) % 2 = 0, 'merge_requests', 'copilot_users_1_day') import_type",
        f"{_utc('ts')} - interval 3 days updated_after",
        "event_id seq",
        f"{_EVENT_KIND} event",
        f"{_CURSOR} cursor",
        "cast(k as bigint) n",
        "concat('failed at ', k) message",
        f"{_utc('ts')} at",
    )


_IMPORT_COLUMNS = (
    "import_id, group_full_path, import_type, "
    + ", ".join(
        f"{_SQL_STAMP.format('imports.' + c)} AS {c}"
        for c in ("updated_after", "started_at", "last_activity_at", "completed_at")
    )
    + ", last_cursor, total_processed, status, error_message"
)


def _import_rows(imports: DataFrame) -> DataFrame:
    return imports.select(
        "import_id", "group_full_path", "import_type", _stamp("updated_after"),
        _stamp("started_at"), _stamp("last_activity_at"), _stamp("completed_at"),
        "last_cursor", "total_processed", "status", "error_message",
    )


@query("import_ledger_fold", f"WITH {_IMPORTS_SQL} SELECT {_IMPORT_COLUMNS} FROM imports")
def import_ledger_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _import_rows(ledger.fold_imports(_import_events(spark, sf_dir)))


@query(
    "import_latest_resumable",
    f"""WITH {_IMPORTS_SQL} SELECT {_IMPORT_COLUMNS} FROM imports
WHERE status IN ('in_progress', 'failed') QUALIFY row_number() OVER (
  PARTITION BY group_full_path, import_type ORDER BY imports.started_at DESC) = 1""",
)
def import_latest_resumable(spark: SparkSession, sf_dir: str) -> DataFrame:
    imports = ledger.fold_imports(_import_events(spark, sf_dir))
    return _import_rows(ledger.latest_resumable(imports))


_AS_OF = "2024-01-31 00:00:00"


@query(
    "import_retention",
    f"""WITH {_IMPORTS_SQL},
old AS (SELECT no FROM imports WHERE status IN ('completed', 'failed')
        AND last_activity_at < TIMESTAMP '{_AS_OF}' - INTERVAL 10 DAY)
SELECT 'imp-' || no AS import_id, count(*) AS events, false AS removed
FROM hist WHERE no NOT IN (SELECT no FROM old) GROUP BY no
UNION ALL SELECT 'imp-' || no, 0, true FROM old""",
)
def import_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that stay, and the imports that go."""
    history = _import_events(spark, sf_dir)
    as_of = F.lit(_AS_OF).cast("timestamp")
    expired = ledger.expired_imports(ledger.fold_imports(history), as_of, 10)
    kept = ledger.retained(history, expired)
    counts = kept.groupBy("import_id").agg(F.count(F.lit(1)).alias("events"))
    gone = expired.select("import_id", F.lit(0).cast("bigint").alias("events"))
    return counts.withColumn("removed", F.lit(False)).unionByName(
        gone.withColumn("removed", F.lit(True))
    )


@query(
    "import_resume",
    f"""WITH {_IMPORTS_SQL},
open AS (SELECT * FROM imports WHERE import_type = 'copilot_users_1_day'
  AND status IN ('in_progress', 'failed') QUALIFY row_number() OVER (
  PARTITION BY group_full_path ORDER BY started_at DESC) = 1)
SELECT 'github_org:team-' || c_custkey AS group_full_path,
  {_SQL_STAMP.format("coalesce(updated_after, TIMESTAMP '2024-02-01')")} AS updated_after, last_cursor,
  coalesce(total_processed, 0) AS total_processed,
  CASE WHEN import_id IS NULL THEN 'create' WHEN status = 'failed' THEN 'reset' ELSE 'resume' END
    AS action, coalesce(import_id, 'new') AS import_id
FROM customer LEFT JOIN open ON group_full_path = 'github_org:team-' || c_custkey""",
)
def import_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    scopes = table(spark, sf_dir, "customer").select(
        ledger.org_key(F.concat(F.lit("team-"), "c_custkey")).alias("group_full_path"),
        F.lit(ledger.USAGE_IMPORT).alias("import_type"),
        as_of.alias("updated_after"),
    )
    imports = ledger.fold_imports(_import_events(spark, sf_dir))
    chosen = ledger.resume_or_create(scopes, imports, as_of)
    return chosen.select(
        "group_full_path",
        _stamp("updated_after"),
        "last_cursor",
        "total_processed",
        "action",
        F.when(F.col("action") == "create", "new").otherwise(F.col("import_id")).alias("import_id"),
    )


# ---------------------------------------------------------------- day plan
#
# A third of the users have a cursor, a third a last run, the rest only a watermark.

_POINTS_SQL = f"""{EVENTS_SQL},
firsts AS (SELECT user_id, min(report_day) AS first_day, max(report_day) AS last_day FROM ev GROUP BY 1),
points AS (SELECT 'team-' || user_id AS org_slug, user_id,
  CAST(CASE user_id % 3 WHEN 0 THEN first_day + 5 + 1 WHEN 1 THEN last_day - 3 + 1
       ELSE first_day END AS DATE) AS start_day FROM firsts)"""


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = events(spark, sf_dir).groupBy("user_id").agg(
        F.min("report_day").alias("first_day"), F.max("report_day").alias("last_day")
    )
    orgs = spans.selectExpr("concat('team-', user_id) org_slug")
    imports = spans.select(
        ledger.org_key(F.concat(F.lit("team-"), "user_id")).alias("group_full_path"),
        F.expr("if(user_id % 3 = 0, cast(date_add(first_day, 5) as string), null)").alias("last_cursor"),
        F.expr("cast(first_day as timestamp) + interval 23 hours").alias("updated_after"),
    )
    runs = spans.filter("user_id % 3 < 2").selectExpr(
        "concat('team-', user_id) org_slug", "date_sub(last_day, 3) last_completed_report_day"
    )
    return day_plan.resume_points(orgs, imports, runs)


@query(
    "resume_point",
    f"WITH {_POINTS_SQL} SELECT org_slug, CAST(start_day AS VARCHAR) AS start_day FROM points",
)
def resume_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).select(
        "org_slug", F.col("start_day").cast("string").alias("start_day")
    )


@query(
    "usage_day_plan",
    f"""WITH {_POINTS_SQL}
SELECT org_slug, CAST(unnest(generate_series(start_day, DATE '2024-01-29', INTERVAL 1 DAY)) AS DATE)::VARCHAR
  AS report_day, '2024-01-29' AS end_day
FROM points WHERE start_day <= DATE '2024-01-29'""",
)
def usage_day_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the default lag of two days; a negative lag would count as none."""
    end_day = report_end_day(F.lit("2024-01-31 12:00:00").cast("timestamp"), F.lit(2))
    return day_plan.plan_days(_points(spark, sf_dir), end_day).selectExpr(
        "org_slug", "cast(report_day as string) report_day", "cast(end_day as string) end_day"
    )


# ---------------------------------------------------------------- texts

_STAMP_TEXT = """CASE {key} % 8
  WHEN 0 THEN {t} || 'Z' WHEN 1 THEN {t} || '+05:30' WHEN 2 THEN lower({t}) || 'z'
  WHEN 3 THEN {t} || '.125-01:00' WHEN 4 THEN {t} WHEN 5 THEN {d}
  WHEN 6 THEN {d} || ' 10:00:00' ELSE {d} || 'T25:00:00Z' END"""


@query(
    "rfc3339_parse",
    f"""SELECT o_orderkey, CASE o_orderkey % 8
  WHEN 0 THEN {_SQL_STAMP.format("o_orderdate")}
  WHEN 1 THEN {_SQL_STAMP.format("o_orderdate - INTERVAL 330 MINUTE")}
  WHEN 2 THEN {_SQL_STAMP.format("o_orderdate")}
  WHEN 3 THEN {_SQL_STAMP.format("o_orderdate + INTERVAL 3600125 MILLISECOND")} END AS at
FROM orders""",
)
def rfc3339_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the texts are no RFC 3339 timestamps: no zone, no time, a blank, hour 25."""
    stamp = """date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss")"""
    text = _STAMP_TEXT.format(key="o_orderkey", t=stamp, d="date_format(o_orderdate, 'yyyy-MM-dd')")
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{text} text")
    return rows.select("o_orderkey", F.date_format(rfc3339(F.col("text")), STAMP).alias("at"))


@query(
    "scope_list",
    """SELECT c_custkey, c_name || '|' || c_mktsegment AS scopes, 2 AS n_scopes FROM customer
UNION ALL SELECT n_nationkey, '', 0 FROM nation""",
)
def scope_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "concat(' ', c_name, ' ,, ', c_mktsegment, ', ') text"
    )
    empty = table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as bigint) c_custkey", "' , ,' text"
    )
    names = scope_names(F.col("text"))
    return lists.unionByName(empty).select(
        "c_custkey", F.array_join(names, "|").alias("scopes"), F.size(names).alias("n_scopes")
    )


# ---------------------------------------------------------------- audits


@query(
    "child_key_violations",
    f"""WITH {EVENTS_SQL}
SELECT event_id, 'totals_by_feature' AS breakdown FROM ev WHERE k % 3 = k % 5
UNION ALL SELECT event_id, 'totals_by_language_model' FROM ev WHERE k % 7 = k % 4
UNION ALL SELECT event_id, 'totals_by_model_feature' FROM ev WHERE k % 2 = 0""",
)
def child_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event carries breakdowns of two entries, some with the same key."""

    def entry(**keys: str) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in keys.items()) + ")"

    pairs = {
        "totals_by_feature": (entry(feature="k % 3"), entry(feature="k % 5")),
        "totals_by_ide": (entry(ide="'a'"), entry(ide="'b'")),
        "totals_by_language_feature": (
            entry(language="'x'", feature="'a'"),
            entry(language="'x'", feature="'b'"),
        ),
        "totals_by_language_model": (
            entry(language="k % 7", model="'m'"),
            entry(language="k % 4", model="'m'"),
        ),
        "totals_by_model_feature": (
            entry(model="'m'", feature="event_type"),
            entry(model="'m'", feature="if(k % 2 = 0, event_type, 'none')"),
        ),
    }
    facts = events(spark, sf_dir).selectExpr(
        "org_slug",
        "report_day",
        "event_id user_id",
        *[f"array({first}, {second}) {name}" for name, (first, second) in pairs.items()],
    )
    return audits.child_key_violations(facts).selectExpr("user_id event_id", "breakdown")


@query(
    "table_audit",
    """SELECT 'unique' AS rule, 'l_orderkey,l_linenumber' AS column_name, count(*) AS violations
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'not_null', 'l_returnflag', count(*) FROM lineitem WHERE l_returnflag = 'R'""",
)
def table_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines lose their flag, so that there is something to find."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "nullif(l_returnflag, 'R') l_returnflag"
    )
    return audits.audit(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_returnflag"])


@query(
    "landing_latest",
    """SELECT 'org-' || (event_id // 4 % 7) AS group_key, (event_id // 4)::VARCHAR AS request_key,
  'answer ' || max(event_id // 2) AS body, count(DISTINCT event_id // 2 % 2) = 2 AS renewed
FROM events GROUP BY event_id // 4""",
)
def landing_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request was answered twice, an hour apart, and each answer landed twice."""
    answers = table(spark, sf_dir, "events", "event_id").selectExpr(
        f"'{landed.USAGE_INDEX}' feed",
        "concat('org-', event_id div 4 % 7) group_key",
        "cast(event_id div 4 as string) request_key",
        "cast(null as int) page_no",
        "cast(null as string) after_cursor",
        "200 status",
        "concat('answer ', event_id div 2) body",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(event_id div 2 % 2)) landed_at",
    )
    times = answers.groupBy("group_key", "request_key").agg(
        (F.count_distinct("landed_at") == 2).alias("renewed")
    )
    latest = landed.latest_answers(answers).select("group_key", "request_key", "body")
    return latest.join(times, ["group_key", "request_key"])
