"""Decoded pages to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.functions.temporal import rfc3339


def connection_names(connection: Column, field: str) -> Column:
    """Names of a connection's entries; null entries dropped, null `nodes` gives []."""
    names = F.transform(
        F.filter(connection["nodes"], lambda n: n.isNotNull()), lambda n: n[field]
    )
    return F.when(
        connection.isNotNull(), F.coalesce(names, F.array().cast("array<string>"))
    )


def diff_stats(stats: Column) -> Column:
    return F.when(
        stats.isNotNull(),
        F.struct(
            stats["additions"].try_cast("int").alias("additions"),
            stats["deletions"].try_cast("int").alias("deletions"),
            stats["changes"].try_cast("int").alias("changes"),
            stats["fileCount"].try_cast("int").alias("file_count"),
        ),
    )


def merge_request_columns(node: Column) -> list[Column]:
    """The flat row of a change-request node; the description is used only for the prompt."""
    return [
        node["id"].alias("mr_id"),
        node["iid"].alias("mr_iid"),
        node["title"].alias("mr_title"),
        node["description"].alias("mr_description"),
        node["webUrl"].alias("mr_web_url"),
        node["projectId"].cast("string").alias("project_id"),
        node["project"]["name"].alias("project_name"),
        node["project"]["path"].alias("project_path"),
        rfc3339(node["createdAt"]).alias("created_at"),
        rfc3339(node["updatedAt"]).alias("updated_at"),
        rfc3339(node["mergedAt"]).alias("merged_at"),
        node["author"]["username"].alias("created_by"),
        node["mergeUser"]["username"].alias("merged_by"),
        node["approved"].alias("approved"),
        connection_names(node["approvedBy"], "username").alias("approved_by"),
        diff_stats(node["diffStatsSummary"]).alias("diff_stats_summary"),
        connection_names(node["labels"], "title").alias("labels"),
    ]


def project_columns(node: Column) -> list[Column]:
    return [
        node["id"].alias("p_id"),
        node["name"].alias("p_name"),
        node["path"].alias("p_path"),
        node["fullPath"].alias("p_full_path"),
        node["webUrl"].alias("p_web_url"),
        node["topics"].alias("topics"),
    ]


def _placed_nodes(pages: DataFrame) -> DataFrame:
    """(group_key, page_no, pos, node) of the pages' nodes; pages without nodes give no row.

    The outer form, because Spark derives a filter from the other one and would evaluate the
    decoded nodes once more for it.
    """
    nodes = pages.select("group_key", "page_no", F.posexplode_outer("nodes").alias("pos", "node"))
    return nodes.filter(F.col("pos").isNotNull())


def flatten_merge_requests(pages: DataFrame) -> DataFrame:
    """One row per node of (group_key, page_no, nodes), with its place in the page."""
    columns = merge_request_columns(F.col("node"))
    return _placed_nodes(pages).select("group_key", "page_no", "pos", *columns)


def flatten_projects(pages: DataFrame) -> DataFrame:
    columns = project_columns(F.col("node"))
    return _placed_nodes(pages).select("group_key", "page_no", "pos", *columns)


def merged_since(mrs: DataFrame, watermark: Column) -> DataFrame:
    """Change requests merged at or after the watermark; unmerged ones are dropped."""
    return mrs.filter(F.col("merged_at") >= watermark)
