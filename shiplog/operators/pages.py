"""Verdicts on landed pages and the chain they form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.functions.strict_json import with_decoded
from shiplog.functions.temporal import rfc3339

PAGE_ORDER = ("page_no", "pos")


def judge_pages(answers: DataFrame, connection: str) -> DataFrame:
    """Decode pages of `connection` (mergeRequests or projects) and judge them.

    Gives (group_key, request_key, page_no, after_cursor, error, nodes, end_cursor, has_next_page,
    total_count); error is NULL for a good page and nodes is NULL for a bad one.
    """
    changes = connection == "mergeRequests"
    spec = schemas.MR_PAGE if changes else schemas.PROJECT_PAGE
    pages = with_decoded(answers, "body", spec, "_page")
    body = F.col("_page.data.group")[connection]
    nodes = body["nodes"]
    error = (
        F.when(F.col("_page").isNull(), "unreadable page")
        .when(
            F.size(F.coalesce(F.col("_page.errors"), F.array())) > 0,
            F.concat(F.lit("errors: "), F.array_join(F.col("_page.errors.message"), "; ")),
        )
        .when(F.col("_page.data").isNull(), "no data")
        .when(F.col("_page.data.group").isNull(), "group not found")
        .when(nodes.isNull(), "no nodes")
        .when(F.exists(nodes, lambda n: n.isNull()), "null node")
    )
    if changes:
        untimely = F.exists(
            nodes,
            lambda n: rfc3339(n["createdAt"]).isNull()
            | rfc3339(n["updatedAt"]).isNull()
            | (n["mergedAt"].isNotNull() & rfc3339(n["mergedAt"]).isNull()),
        )
        error = error.when(untimely, "bad timestamp")
    total = body["count"].try_cast("int") if changes else F.lit(None).cast("int")
    judged = pages.select(
        "group_key",
        "request_key",
        "page_no",
        "after_cursor",
        error.alias("error"),
        nodes.alias("nodes"),
        body["pageInfo"]["endCursor"].alias("end_cursor"),
        body["pageInfo"]["hasNextPage"].alias("has_next_page"),
        total.alias("total_count"),
    )
    return judged.withColumn("nodes", F.when(F.col("error").isNull(), F.col("nodes")))


def chain_breaks(pages: DataFrame, keys: tuple[str, ...] = ("group_key", "request_key")):
    """Add `broken`: the page does not follow its predecessor in the chain.

    A page follows if the page before it was landed, has a next page, and ends at the cursor this
    page was asked with. The page with the lowest number starts the chain; it must have been asked
    without a cursor unless the chain is resumed, which the caller checks.

    The predecessor is found by an equi-join on (keys, page number), which spreads a long chain
    over all tasks; a window over the chain would put it into one.
    """
    before = pages.select(
        *keys,
        (F.col("page_no") + 1).alias("page_no"),
        F.col("end_cursor").alias("_cursor"),
        F.col("has_next_page").alias("_more"),
        F.lit(True).alias("_found"),
    )
    starts = pages.groupBy(*keys).agg(F.min("page_no").alias("_first_no"))
    follows = (
        F.col("_found") & F.col("_more") & F.col("_cursor").eqNullSafe(F.col("after_cursor"))
    )
    return (
        pages.join(before, [*keys, "page_no"], "left")
        .join(starts, list(keys), "left")
        .withColumn(
            "broken",
            (F.col("page_no") != F.col("_first_no")) & ~F.coalesce(follows, F.lit(False)),
        )
        .drop("_cursor", "_more", "_found", "_first_no")
    )


def page_totals(pages: DataFrame) -> DataFrame:
    """Rows per page beside the total the feed reports."""
    return pages.select(
        "group_key", "page_no", F.size("nodes").alias("batch_count"), "total_count"
    )
