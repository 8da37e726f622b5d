"""Queries on the change-request and project feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.functions.text import file_block
from shiplog.operators import enrich, merge, pages
from shiplog.operators.budget import diff_text, diff_text_of_changes, within_budget
from shiplog.operators.flatten import flatten_merge_requests, flatten_projects, merged_since
from shiplog.operators.prefix import committed_prefix
from shiplog.session import staged
from shiplog.sources import landing as landed
from shiplog.workloads.change_feed import (
    FILES_SQL,
    ORDERS_SQL,
    change_requests,
    mr_change_answers,
    mr_pages,
    project_pages,
)
from shiplog.workloads.registry import dealt, query, table

STAMP = "yyyy-MM-dd HH:mm:ss"


def _stamp(name: str) -> Column:
    return F.date_format(name, STAMP).alias(name)


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = pages.judge_pages(mr_pages(spark, sf_dir), "mergeRequests")
    return flatten_merge_requests(judged)


# ---------------------------------------------------------------- flattening

_SQL_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_CREATED = _SQL_STAMP.format("day - INTERVAL 10 DAY")
_UPDATED = _SQL_STAMP.format("day - INTERVAL 2 HOUR")
_MERGED = f"CASE WHEN status = 'F' THEN {_SQL_STAMP.format('day')} END"


@query(
    "mr_flatten",
    f"""WITH {ORDERS_SQL}
SELECT group_key, page_no, pos, 'mr-' || key AS mr_id, CAST(key AS VARCHAR) AS mr_iid,
  prio || ' #' || key AS mr_title,
  CASE WHEN cust % 4 <> 0 THEN 'By ' || c_name END AS mr_description,
  'https://forge.example/' || key AS mr_web_url, CAST(cust AS VARCHAR) AS project_id,
  c_name AS project_name, 'p/' || cust AS project_path, {_CREATED} AS created_at,
  {_UPDATED} AS updated_at, {_MERGED} AS merged_at, c_name AS created_by,
  CASE WHEN status = 'F' THEN 'm-' || cust END AS merged_by, status = 'F' AS approved
FROM o""",
)
def mr_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir).select(
        "group_key", "page_no", "pos", "mr_id", "mr_iid", "mr_title", "mr_description",
        "mr_web_url", "project_id", "project_name", "project_path", _stamp("created_at"),
        _stamp("updated_at"), _stamp("merged_at"), "created_by", "merged_by", "approved",
    )


@query(
    "mr_approvers_labels",
    f"""WITH {ORDERS_SQL}
SELECT 'mr-' || key AS mr_id,
  CASE cust % 3 WHEN 0 THEN NULL WHEN 1 THEN c_name ELSE '' END AS approvers,
  CASE cust % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 0 END::INTEGER AS n_approvers,
  CASE cust % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE segment || ',' || prio END AS labels,
  CASE cust % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2 END::INTEGER AS n_labels
FROM o""",
)
def mr_approvers_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir).select(
        "mr_id",
        F.array_join("approved_by", ",").alias("approvers"),
        F.when(F.col("approved_by").isNotNull(), F.size("approved_by")).alias("n_approvers"),
        F.array_join("labels", ",").alias("labels"),
        F.when(F.col("labels").isNotNull(), F.size("labels")).alias("n_labels"),
    )


@query(
    "mr_diff_stats",
    f"""WITH {ORDERS_SQL}
SELECT 'mr-' || key AS mr_id, key % 6 <> 0 AS has_stats,
  CASE WHEN key % 6 <> 0 THEN CAST(trunc(price) AS INTEGER) END AS additions,
  CASE WHEN key % 6 <> 0 THEN CAST(key % 100 AS INTEGER) END AS deletions,
  CASE WHEN key % 6 <> 0 AND key % 50 <> 7 THEN CAST(key % 1000 AS INTEGER) END AS changes,
  CASE WHEN key % 6 <> 0 THEN CAST(key % 9 AS INTEGER) END AS file_count
FROM o""",
)
def mr_diff_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A count beyond the 32-bit range becomes NULL."""
    stats = F.col("diff_stats_summary")
    return _flat(spark, sf_dir).select("mr_id", stats.isNotNull().alias("has_stats"), "diff_stats_summary.*")


@query(
    "mr_merged_since",
    f"""WITH {ORDERS_SQL}
SELECT 'mr-' || key AS mr_id, {_MERGED} AS merged_at FROM o
WHERE status = 'F' AND day >= TIMESTAMP '1995-01-02 00:00:00'""",
)
def mr_merged_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark falls on a day on which something was merged; it is included."""
    watermark = F.lit("1995-01-02T00:00:00Z").cast("timestamp")
    return merged_since(_flat(spark, sf_dir), watermark).select("mr_id", _stamp("merged_at"))


_PROJECT_SQL = """'p-' || c_custkey AS p_id, c_name AS p_name, lower(c_name) AS p_path,
  r_name || '/' || n_name || '/' || c_name AS p_full_path,
  'https://forge.example/' || c_custkey AS p_web_url,
  CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_mktsegment || ',' || n_name END AS topics
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_projects(pages.judge_pages(project_pages(spark, sf_dir), "projects"))


@query(
    "project_flatten",
    f"""SELECT 'prj-' || (c_custkey // 50 % 5) AS group_key,
  CAST(c_custkey // 50 // 5 AS INTEGER) AS page_no, CAST(c_custkey % 50 AS INTEGER) AS pos,
  {_PROJECT_SQL}""",
)
def project_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _projects(spark, sf_dir).withColumn("topics", F.array_join("topics", ","))


@query(
    "project_upsert",
    f"""WITH p AS (SELECT c_custkey, c_acctbal, {_PROJECT_SQL})
SELECT p_id, CASE WHEN c_acctbal < 5000 THEN 'old ' || p_name ELSE p_name END AS p_name,
       p_path, p_full_path, p_web_url, topics FROM p""",
)
def project_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table holds all projects under old names; the batch has those of richer customers,
    each twice, the first copy under another name."""
    flat = _projects(spark, sf_dir)
    old = flat.withColumn("p_name", F.concat(F.lit("old "), "p_name")).drop(
        "group_key", "page_no", "pos"
    )
    rich = table(spark, sf_dir, "customer").filter("c_acctbal >= 5000").selectExpr(
        "concat('p-', c_custkey) p_id"
    )
    batch = flat.join(rich, "p_id", "left_semi").selectExpr("*", "explode(array(1, 2)) copy")
    batch = batch.withColumn(
        "p_name", F.when(F.col("copy") == 1, F.lit("draft")).otherwise(F.col("p_name"))
    )
    folded = merge.fold_batch(batch, merge.PROJECT_POLICY, ("copy", "page_no", "pos"))
    return merge.merge_by_key(old, folded, merge.PROJECT_POLICY).withColumn(
        "topics", F.array_join("topics", ",")
    )


# ---------------------------------------------------------------- merging
#
# The table holds the requests up to 1996; the batch brings those from 1994 on, each twice.

_TARGET = "day < TIMESTAMP '1996-01-01'"
_BATCH = "day >= TIMESTAMP '1994-01-01'"
_ROW = {
    "mr_iid": "'iid-' || {v}",
    "mr_title": "prio || {v}",
    "merged_by": "CASE WHEN key % 2 = 0 THEN 'm-' || {v} END",
    "approved": "key % 3 = {v}",
    "mr_web_url": "'url-' || {v}",
    "project_id": "cust || '-' || {v}",
    "created_by": "c_name || {v}",
    "mr_ai_title": "CASE WHEN (key + {v}) % 3 = 0 THEN 'title ' || {v} END",
    "mr_ai_category": "CASE WHEN (key + {v}) % 4 = 0 THEN 'category ' || {v} END",
}
_POLICY = merge.MergePolicy(
    keys=("mr_id",),
    overwrite=("mr_iid", "mr_title", "merged_by", "approved"),
    insert_only=("mr_web_url", "project_id", "created_by"),
    keep_known=("mr_ai_title", "mr_ai_category"),
)


def _row_sql(version: str) -> str:
    return ", ".join(f"{e.format(v=version)} AS {c}" for c, e in _ROW.items())


def _target_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    requests = change_requests(spark, sf_dir)
    spelled = {c: e.format(v="v") for c, e in _ROW.items()}
    target = requests.filter(_TARGET.replace("TIMESTAMP", "timestamp_ntz")).selectExpr("*", "0 v")
    batch = requests.filter(_BATCH.replace("TIMESTAMP", "timestamp_ntz")).selectExpr(
        "*", "explode(array(1, 2)) v"
    )
    columns = ["concat('mr-', key) mr_id", *[f"{e} {c}" for c, e in spelled.items()]]
    return (
        target.selectExpr(*columns),
        batch.selectExpr(*columns, "v arrival", "group_key", "page_no", "pos"),
    )


@query(
    "mr_upsert_policies",
    f"""WITH {ORDERS_SQL},
t AS (SELECT 'mr-' || key AS mr_id, {_row_sql("0")} FROM o WHERE {_TARGET}),
b AS (SELECT 'mr-' || key AS mr_id, v, {_row_sql("v")} FROM o, (SELECT unnest([1, 2]) AS v)
      WHERE {_BATCH}),
f AS (SELECT mr_id, {", ".join(f"arg_max_null({c}, v) AS {c}" for c in _POLICY.overwrite)},
      {", ".join(f"arg_min_null({c}, v) AS {c}" for c in _POLICY.insert_only)},
      {", ".join(f"arg_max({c}, v) AS {c}" for c in _POLICY.keep_known)} FROM b GROUP BY mr_id)
SELECT coalesce(f.mr_id, t.mr_id) AS mr_id,
  {", ".join(f"CASE WHEN f.mr_id IS NOT NULL THEN f.{c} ELSE t.{c} END AS {c}" for c in _POLICY.overwrite)},
  {", ".join(f"CASE WHEN t.mr_id IS NOT NULL THEN t.{c} ELSE f.{c} END AS {c}" for c in _POLICY.insert_only)},
  {", ".join(f"coalesce(f.{c}, t.{c}) AS {c}" for c in _POLICY.keep_known)}
FROM t FULL OUTER JOIN f ON t.mr_id = f.mr_id""",
)
def mr_upsert_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    folded = merge.fold_batch(batch, _POLICY, ("arrival", *pages.PAGE_ORDER))
    return merge.merge_by_key(target, folded, _POLICY)


@query(
    "mr_insert_only",
    f"""WITH {ORDERS_SQL}
SELECT 'mr-' || key AS mr_id, {_row_sql("0")} FROM o WHERE {_TARGET}
UNION ALL SELECT 'mr-' || key, {_row_sql("1")} FROM o WHERE {_BATCH} AND NOT {_TARGET}""",
)
def mr_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    return merge.insert_absent(target, batch, ["mr_id"], ["arrival", *pages.PAGE_ORDER])


@query(
    "mr_exists_semi",
    f"""WITH {ORDERS_SQL} SELECT 'mr-' || key AS mr_id, v AS arrival
FROM o, (SELECT unnest([1, 2])::INTEGER AS v) WHERE {_BATCH} AND {_TARGET}""",
)
def mr_exists_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    return merge.existing(batch.select("mr_id", "arrival"), target, ["mr_id"])


@query(
    "batch_fold",
    """SELECT o_custkey, arg_max(o_orderpriority, row(o_orderdate, o_orderkey)) AS last_priority,
  arg_max(o_orderkey, row(o_orderdate, o_orderkey)) AS last_order,
  arg_min(o_orderstatus, row(o_orderdate, o_orderkey)) AS first_status,
  arg_max(CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END, row(o_orderdate, o_orderkey))
    AS last_closed
FROM orders GROUP BY o_custkey""",
)
def batch_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of a customer folded in order of date."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey",
        "o_orderpriority last_priority",
        "o_orderkey last_order",
        "o_orderstatus first_status",
        "case when o_orderstatus <> 'O' then o_orderkey end last_closed",
        "o_orderdate",
        "o_orderkey",
    )
    policy = merge.MergePolicy(
        keys=("o_custkey",),
        overwrite=("last_priority", "last_order"),
        insert_only=("first_status",),
        keep_known=("last_closed",),
    )
    return merge.fold_batch(rows, policy, ("o_orderdate", "o_orderkey"))


# ---------------------------------------------------------------- pages

_PAGES_SQL = f"""{ORDERS_SQL},
p AS (SELECT group_key, page_no, count(*) AS n FROM o GROUP BY 1, 2),
t AS (SELECT group_key, count(*) AS total FROM o GROUP BY 1)"""
# Page and group numbers decide what is wrong with a page.
_CASE = "(page_no * 20 + CAST({g} AS INTEGER)) % 29"
_SQL_CASE = _CASE.format(g="substr(group_key, 5)")


@query(
    "page_chain_prefix",
    f"""WITH {_PAGES_SQL},
gone AS (SELECT group_key, min(page_no) AS first_gone FROM p
         WHERE {_SQL_CASE} = 5 AND page_no > 0 GROUP BY 1)
SELECT p.group_key, page_no, n AS rows FROM p LEFT JOIN gone USING (group_key)
WHERE first_gone IS NULL OR page_no < first_gone""",
)
def page_chain_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some pages after the first are not landed; what follows them in the chain waits."""
    landed_pages = mr_pages(spark, sf_dir).filter(f"not ({_SQL_CASE} = 5 and page_no > 0)")
    judged = pages.judge_pages(landed_pages, "mergeRequests")
    narrow = staged(
        judged.withColumn("rows", F.size("nodes").cast("bigint")).drop("nodes"), "pages"
    )
    chained = pages.chain_breaks(narrow)
    bad = F.col("error").isNotNull() | F.col("broken")
    return committed_prefix(chained, ["group_key", "request_key"], "page_no", bad).select(
        "group_key", "page_no", "rows"
    )


@query(
    "page_verdict",
    f"""WITH {_PAGES_SQL}
SELECT group_key, page_no, CASE {_SQL_CASE}
  WHEN 1 THEN 'errors: too complex; slow' WHEN 2 THEN 'no data' WHEN 3 THEN 'group not found'
  WHEN 4 THEN 'no nodes' WHEN 5 THEN 'null node' WHEN 6 THEN 'bad timestamp'
  WHEN 7 THEN 'unreadable page' WHEN 8 THEN 'unreadable page' END AS error,
  CASE WHEN {_SQL_CASE} NOT BETWEEN 1 AND 8 THEN n END AS rows FROM p""",
)
def page_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = mr_pages(spark, sf_dir).withColumn(
        "body",
        F.expr(
            f"""case {_SQL_CASE}
        when 1 then concat('{{"errors":[{{"message":"too complex"}},{{"message":"slow"}}],', substr(body, 2))
        when 2 then '{{"data":null}}'
        when 3 then '{{"data":{{"group":null}}}}'
        when 4 then regexp_replace(body, '"nodes":[\\\\[].*,"pageInfo"', '"nodes":null,"pageInfo"')
        when 5 then replace(body, '"nodes":[{{"id"', '"nodes":[null,{{"id"')
        when 6 then regexp_replace(body, '"createdAt":"[^"]*"', '"createdAt":"1999-01-01"')
        when 7 then substr(body, 1, length(body) - 1)
        when 8 then replace(body, '"approved":', '"authorized":')
        else body end"""
        ),
    )
    judged = pages.judge_pages(broken, "mergeRequests")
    return judged.select(
        "group_key",
        "page_no",
        "error",
        F.when(F.col("nodes").isNotNull(), F.size("nodes").cast("bigint")).alias("rows"),
    )


@query(
    "page_totals",
    f"""WITH {_PAGES_SQL}
SELECT p.group_key, page_no, n::INTEGER AS batch_count, total::INTEGER AS total_count
FROM p JOIN t USING (group_key)""",
)
def page_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_totals(pages.judge_pages(mr_pages(spark, sf_dir), "mergeRequests"))


# ---------------------------------------------------------------- diffs and prompts

_BUDGET = 100
_BLOCKS_SQL = f"""{ORDERS_SQL},
files AS (SELECT key, i, 'File: ' || {FILES_SQL["path"]} || chr(10) || 'Diff:' || chr(10)
            || {FILES_SQL["diff"]} || chr(10) || chr(10) AS block, {FILES_SQL["path"]} AS path
          FROM (SELECT *, unnest(range(1, 2 + key % 7)) AS i FROM o WHERE key % 11 > 2)),
texts AS (SELECT key, string_agg(block, '' ORDER BY i) AS text, count(*) AS n,
            arg_min(path, i) AS first_path FROM files GROUP BY key)"""


def _with_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = change_requests(spark, sf_dir)
    answers = landed.mr_changes(mr_change_answers(requests))
    return requests.selectExpr(
        "key",
        "concat('mr-', key) mr_id",
        "cast(cust as string) project_id",
        "cast(key as string) mr_iid",
        "concat(prio, ' #', key) mr_title",
        "if(cust % 4 = 0, null, concat('By ', c_name)) mr_description",
    ).join(answers, ["project_id", "mr_iid"], "left")


@query(
    "mr_changes_join",
    f"""WITH {_BLOCKS_SQL}
SELECT 'mr-' || key AS mr_id,
  CASE WHEN key % 11 = 2 THEN NULL ELSE coalesce(n, 0) END::INTEGER AS n_changes, first_path
FROM o LEFT JOIN texts USING (key)""",
)
def mr_changes_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of an answer plays no part; an unreadable one gives NULL."""
    changes = F.col("changes")
    return _with_changes(spark, sf_dir).select(
        "mr_id",
        F.when(changes.isNotNull(), F.size(changes)).alias("n_changes"),
        F.get(changes, F.lit(0))["new_path"].alias("first_path"),
    )


_PROMPT_PARTS = (enrich.INSTRUCTIONS + "\nTitle: ").replace("'", "''")


@query(
    "prompt_build",
    f"""WITH {_BLOCKS_SQL}
SELECT 'mr-' || key AS mr_id, left(coalesce(text, ''), {_BUDGET}) AS diff_text,
  md5('{_PROMPT_PARTS}' || prio || ' #' || key || chr(10) || 'Description: '
    || CASE WHEN cust % 4 = 0 THEN '' ELSE 'By ' || c_name END || chr(10) || 'Changes:' || chr(10)
    || left(coalesce(text, ''), {_BUDGET})) AS prompt_md5
FROM o LEFT JOIN texts USING (key) WHERE key % 11 <> 2""",
)
def prompt_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = diff_text_of_changes(F.col("changes"), _BUDGET)
    found = _with_changes(spark, sf_dir).filter("changes is not null").withColumn("diff_text", text)
    prompt = enrich.prompt(F.col("mr_title"), F.col("mr_description"), F.col("diff_text"))
    return found.select("mr_id", "diff_text", F.md5(prompt).alias("prompt_md5"))


_LINE_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
)
_LINE_PLACE = ", ".join(_LINE_ORDER)
_LINE_BLOCK = "'part ' || l_partkey || ' from ' || l_suppkey || ' on line ' || l_linenumber"


@query(
    "diff_byte_budget",
    f"""WITH b AS (SELECT *, strlen({_LINE_BLOCK})::BIGINT AS n_bytes FROM lineitem),
r AS (SELECT *, coalesce(sum(n_bytes) OVER (PARTITION BY l_orderkey ORDER BY {_LINE_PLACE}
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS bytes_before FROM b)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n_bytes, bytes_before,
       least(n_bytes, {_BUDGET} - bytes_before)::BIGINT AS bytes_used
FROM r WHERE bytes_before < {_BUDGET}""",
)
def diff_byte_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as blocks of its text."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", *_LINE_ORDER)
    blocks = lines.selectExpr("l_orderkey", *_LINE_ORDER, f"{_LINE_BLOCK} block")
    return within_budget(blocks, ["l_orderkey"], _LINE_ORDER, _BUDGET, span=7).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "n_bytes", "bytes_before",
        "bytes_used",
    )


_SHORT_BUDGET, _WIDE_BUDGET = 100, 100_000


def _short_or_wide(budget: int, block: str) -> str:
    return f"""WITH b AS (SELECT *, strlen({block})::BIGINT AS n_bytes FROM lineitem),
r AS (SELECT *, coalesce(sum(n_bytes) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, {_LINE_PLACE}
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS bytes_before FROM b)
SELECT l_suppkey, l_orderkey, l_linenumber, n_bytes, bytes_before,
       least(n_bytes, {budget} - bytes_before)::BIGINT AS bytes_used
FROM r WHERE bytes_before < {budget}"""


def _supplier_budget(spark: SparkSession, sf_dir: str, budget: int, block: str) -> DataFrame:
    order = ["l_orderkey", *(c for c in _LINE_ORDER if c != "l_suppkey")]
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey", *order, f"{block} block")
    # Orders come in runs of 512: a supplier's blocks are spread over many slices.
    used = within_budget(lines, ["l_suppkey"], order, budget, F.expr("l_orderkey div 512"))
    return used.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "n_bytes", "bytes_before", "bytes_used"
    )


@query("diff_byte_budget_short", _short_or_wide(_SHORT_BUDGET, "repeat('x', (l_partkey % 5)::INT)"))
def diff_byte_budget_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of no to four bytes, all lines of a supplier."""
    return _supplier_budget(
        spark, sf_dir, _SHORT_BUDGET, "repeat('x', cast(l_partkey % 5 as int))"
    )


@query("diff_byte_budget_wide", _short_or_wide(_WIDE_BUDGET, _LINE_BLOCK))
def diff_byte_budget_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A budget of which a thousandth of the blocks' number would already be large."""
    return _supplier_budget(spark, sf_dir, _WIDE_BUDGET, _LINE_BLOCK)


_TEXT_BUDGET = 10000
_HEX_PAIR = "substr(h, 2 * ({n}) + 1, 2) BETWEEN '80' AND 'BF'"


@query(
    "diff_text",
    f"""WITH b AS (SELECT source, doc_id, 'File: ' || doc_id || chr(10) || 'Diff:' || chr(10) || text
               || chr(10) || chr(10) AS block FROM documents),
s AS (SELECT *, strlen(block) AS n FROM b),
r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s),
c AS (SELECT *, hex(encode(block)) AS h, least(n, {_TEXT_BUDGET} - before)::BIGINT AS cut FROM r
      WHERE before < {_TEXT_BUDGET}),
k AS (SELECT *, CASE WHEN cut = n OR NOT {_HEX_PAIR.format(n="cut")} THEN cut
                     WHEN NOT {_HEX_PAIR.format(n="cut - 1")} THEN cut - 1
                     WHEN NOT {_HEX_PAIR.format(n="cut - 2")} THEN cut - 2
                     ELSE cut - 3 END AS kept FROM c)
SELECT source, md5(string_agg(decode(unhex(substr(h, 1, 2 * kept))), '' ORDER BY doc_id)) AS text_md5,
       sum(kept)::INTEGER AS n_bytes
FROM k GROUP BY source""",
)
def diff_text_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source as files of one diff."""
    blocks = table(spark, sf_dir, "documents").select(
        "source",
        "doc_id",
        file_block(F.col("doc_id").cast("string"), F.col("text")).alias("block"),
    )
    slices = F.expr("doc_id div 256")
    return diff_text(blocks, ["source"], ["doc_id"], _TEXT_BUDGET, slices).select(
        "source",
        F.md5("diff_text").alias("text_md5"),
        F.octet_length("diff_text").alias("n_bytes"),
    )


# ---------------------------------------------------------------- replies

_VALID = "event_id % 8 < 5"
_TITLE = "CASE WHEN event_id % 3 = 0 THEN 'fix(api): ' || event_type ELSE event_type || '.' END"
_CATEGORY = "CASE WHEN event_id % 2 = 0 THEN 'Bugfix' ELSE event_type END"


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with and without fences, and three kinds of invalid ones."""
    columns = ("event_id", "user_id", "event_type")
    return dealt(table(spark, sf_dir, "events", *columns), "event_id").selectExpr(
        "event_id",
        f"""concat('{{"category":"', {_CATEGORY}, '","title":"', {_TITLE},
            '","summary":"s', user_id, '","extra":', event_id, '}}') good""",
    ).selectExpr(
        "event_id",
        r"""case event_id % 8
          when 0 then good
          when 1 then concat(' \n```json\n', good, '\n```\n')
          when 2 then concat('```\n', good, '```')
          when 3 then concat('```json```json', good, '``````')
          when 4 then concat('\t', good, '\n\n')
          when 5 then concat('Here it is: ', good)
          when 6 then replace(good, '"title"', '"headline"')
          else replace(good, '"summary":"s', '"summary":null,"s":"') end reply""",
    )


@query(
    "reply_parse",
    f"""SELECT event_id, {_VALID} AS valid, CASE WHEN {_VALID} THEN {_CATEGORY} END AS category,
  CASE WHEN {_VALID} THEN {_TITLE} END AS title, CASE WHEN {_VALID} THEN 's' || user_id END AS summary
FROM events""",
)
def reply_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.parse_replies(_replies(spark, sf_dir)).select(
        "event_id", F.col("answer").isNotNull().alias("valid"), "answer.*"
    )


@query(
    "reply_invalid",
    f"""SELECT 'turn' AS kind, conv_id AS id, turn AS part FROM conversations
UNION ALL SELECT 'reply', event_id, event_id % 8 FROM events WHERE NOT {_VALID}""",
)
def reply_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation are no JSON."""
    turns = table(spark, sf_dir, "conversations").selectExpr(
        "'turn' kind", "conv_id id", "turn part", "text reply"
    )
    replies = _replies(spark, sf_dir).selectExpr(
        "'reply' kind", "event_id id", "event_id % 8 part", "reply"
    )
    parsed = enrich.parse_replies(turns.unionByName(replies))
    return parsed.filter("answer is null").select("kind", "id", "part")


@query(
    "reply_audit",
    f"""SELECT event_id, event_id % 2 = 0 AS known_category, event_id % 3 = 0 AS formed_title
FROM events WHERE {_VALID}""",
)
def reply_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = enrich.parse_replies(_replies(spark, sf_dir))
    return enrich.audit_replies(parsed).select("event_id", "known_category", "formed_title")


@query(
    "mr_enrich_attach",
    f"""SELECT 'mr-' || o_orderkey AS mr_id, CASE WHEN {_VALID} THEN {_TITLE} END AS mr_ai_title,
  CASE WHEN {_VALID} THEN 's' || user_id END AS mr_ai_summary,
  CASE WHEN {_VALID} THEN 'stub' END AS mr_ai_model,
  CASE WHEN {_VALID} THEN {_CATEGORY} END AS mr_ai_category
FROM orders LEFT JOIN events ON o_orderkey = event_id""",
)
def mr_enrich_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request without a valid reply keeps NULLs."""
    answers = enrich.parse_replies(_replies(spark, sf_dir)).withColumns(
        {"mr_id": F.concat(F.lit("mr-"), "event_id"), "model": F.lit("stub")}
    )
    requests = table(spark, sf_dir, "orders").selectExpr("concat('mr-', o_orderkey) mr_id")
    return enrich.attach_answers(requests, answers, ["mr_id"])
