"""Change-request and project feeds made from `orders` and `customer`.

Fifty consecutive order keys make a page; pages are dealt out to twenty groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.workloads.registry import table

# Flat columns of a change request, the same text in both engines.
# `key`, `cust`, `status`, `day` and `prio` are the order's columns.
ORDERS_SQL = """o AS (
  SELECT o_orderkey AS key, o_custkey AS cust, o_orderstatus AS status, o_orderdate AS day,
         o_orderpriority AS prio, o_totalprice AS price, c_name, c_mktsegment AS segment,
         'grp-' || (o_orderkey // 50 % 20) AS group_key,
         CAST(o_orderkey // 50 // 20 AS INTEGER) AS page_no,
         CAST(o_orderkey % 50 AS INTEGER) AS pos
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def change_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "orderkey custkey orderstatus orderdate orderpriority totalprice".split()
    orders = table(spark, sf_dir, "orders", *[f"o_{c}" for c in columns])
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "o_orderkey key",
        "o_custkey cust",
        "o_orderstatus status",
        "cast(o_orderdate as timestamp_ntz) day",
        "o_orderpriority prio",
        "o_totalprice price",
        "c_name",
        "c_mktsegment segment",
        "concat('grp-', (o_orderkey div 50) % 20) group_key",
        "cast((o_orderkey div 50) div 20 as int) page_no",
        "cast(o_orderkey % 50 as int) pos",
    )


_NODE = """named_struct(
  'id', concat('mr-', key), 'iid', cast(key as string), 'title', concat(prio, ' #', key),
  'description', if(cust % 4 = 0, null, concat('By ', c_name)),
  'webUrl', concat('https://forge.example/', key),
  'labels', if(cust % 5 = 0, null, named_struct('nodes',
      if(cust % 5 = 1, null, array(named_struct('title', segment), null, named_struct('title', prio))))),
  'approved', status = 'F',
  'approvedBy', if(cust % 3 = 0, null, named_struct('nodes',
      array(if(cust % 3 = 1, named_struct('username', c_name), null)))),
  'author', named_struct('username', c_name),
  'diffStatsSummary', if(key % 6 = 0, null, named_struct(
      'additions', cast(price as bigint), 'deletions', key % 100,
      'changes', if(key % 50 = 7, 3000000000, key % 1000), 'fileCount', key % 9)),
  'mergeUser', if(status = 'F', named_struct('username', concat('m-', cust)), null),
  'createdAt', date_format(day - interval 10 days, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
  'updatedAt', date_format(day, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"),
  'mergedAt', if(status = 'F', date_format(day, "yyyy-MM-dd'T'HH:mm:ss.000'Z'"), null),
  'projectId', cust, 'project', named_struct('name', c_name, 'path', concat('p/', cust)))"""


def pages_of(nodes: DataFrame, connection: str, feed: str) -> DataFrame:
    """Landed pages from (group_key, page_no, pos, node). At most fifty nodes make a page."""
    counted = nodes.groupBy("group_key").agg(
        F.count(F.lit(1)).alias("total"), F.max("page_no").alias("last_no")
    )
    pages = nodes.groupBy("group_key", "page_no").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "node"))), lambda n: n["node"]
        ).alias("nodes")
    )
    body = f"""to_json(named_struct('data', named_struct('group', named_struct('{connection}',
      named_struct('count', total, 'nodes', nodes, 'pageInfo', named_struct(
        'endCursor', concat('c', page_no), 'hasNextPage', page_no < last_no))))),
      map('ignoreNullFields', 'false'))"""
    # There are twenty groups at most, by construction.
    return pages.join(F.broadcast(counted), "group_key").selectExpr(
        f"'{feed}' feed",
        "group_key",
        "'all' request_key",
        "page_no",
        "if(page_no = 0, null, concat('c', page_no - 1)) after_cursor",
        "200 status",
        f"{body} body",
    )


def mr_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = change_requests(spark, sf_dir).selectExpr(
        "group_key", "page_no", "pos", f"{_NODE} node"
    )
    return pages_of(nodes, "mergeRequests", "mr_page")


def project_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        regions, F.col("c_nationkey") == F.col("n_nationkey")
    )
    nodes = customers.selectExpr(
        "concat('prj-', (c_custkey div 50) % 5) group_key",
        "cast((c_custkey div 50) div 5 as int) page_no",
        "cast(c_custkey % 50 as int) pos",
        """named_struct('id', concat('p-', c_custkey), 'name', c_name, 'path', lower(c_name),
           'fullPath', concat(r_name, '/', n_name, '/', c_name),
           'webUrl', concat('https://forge.example/', c_custkey),
           'topics', if(c_custkey % 7 = 0, null,
                        if(c_custkey % 7 = 1, array(), array(c_mktsegment, n_name)))) node""",
    )
    return pages_of(nodes, "projects", "project_page")


# Files of a change request: one to seven, from its own columns.
FILES_SQL = {
    "path": "'src/' || (key % 13) || '/f' || i",
    "diff": "'+' || prio || ' ' || (key * i)",
}


def mr_change_answers(requests: DataFrame) -> DataFrame:
    """Landed change lists: missing, null and unreadable ones among them."""
    path, diff = FILES_SQL["path"], FILES_SQL["diff"]
    return requests.selectExpr(
        "'mr_changes' feed",
        "cast(cust as string) group_key",
        "concat(cust, '/', key) request_key",
        "if(key % 17 = 0, 404, 200) status",
        f"""case key % 11
          when 0 then '{{"message":"none"}}'
          when 1 then '{{"changes":null}}'
          when 2 then '<html>'
          else to_json(named_struct('changes', transform(sequence(1, cast(1 + key % 7 as int)),
               i -> named_struct('diff', {diff}, 'new_path', {path}, 'old_path', 'old')))) end
          body""",
    )
