"""Landed API answers: one row per answer, so that HTTP outcomes become predicates.

Row keys by feed
  mr_page, project_page   group_key = group path, request_key = start of the chain (RFC 3339 text
                          for change requests, any run label for projects), page_no, after_cursor
  mr_changes              group_key = project id, request_key = '<project id>/<iid>'
  usage_index             group_key = org, request_key = day
  usage_part              group_key = org, request_key = day, page_no = place in the link list
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.functions.strict_json import with_decoded

MR_PAGE, PROJECT_PAGE, MR_CHANGES = "mr_page", "project_page", "mr_changes"
USAGE_INDEX, USAGE_PART = "usage_index", "usage_part"

#: Files that are named in a scan at most.
FILES = 10_000

REQUEST = ["feed", "group_key", "request_key", "page_no"]


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LANDING).parquet(path)


def land(rows: DataFrame, path: str) -> None:
    """Append answers; one folder per feed so that a reader of one feed skips the others."""
    (
        rows.select(*schemas.LANDING.fieldNames())
        .write.mode("append")
        .partitionBy("feed")
        .parquet(path)
    )


def in_files_of(landing: DataFrame, wanted: DataFrame) -> DataFrame:
    """`landing`, read from those files only that hold a request whose key columns `wanted` has.

    A first pass over the narrow keys names the files: keys come in the order of their landing,
    so a batch lies in few files, while least and greatest keys would span most of them. Rows
    of other requests in these files stay. Beyond FILES of them, or where `landing` does not lie in
    files, all are read: the caller joins with `wanted` in any case.
    """
    try:
        keyed = landing.select(*wanted.columns, F.col("_metadata.file_path").alias("_file"))
        keyed.schema  # noqa: B018 - resolves the columns
    except AnalysisException:
        return landing
    held = keyed.join(wanted, wanted.columns, "left_semi").select("_file").distinct()
    files = [r["_file"] for r in held.limit(FILES + 1).collect()]
    if len(files) > FILES:
        return landing
    return landing.filter(F.col("_metadata.file_path").isin(files))


def repeated_requests(landing: DataFrame) -> DataFrame:
    """Requests landed more than once; found from the narrow key columns, normally few."""
    return (
        landing.groupBy(*REQUEST)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .select(*[F.col(c).alias(f"_{c}") for c in REQUEST])
    )


def latest_answers(landing: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """One answer for every request: the latest, and of several at that time the one whose
    content has the greatest hash. Landing is append-only, so the same answer may lie there twice.

    With `repeated` written out by the caller, its known size lets Spark broadcast it and leave
    the bodies where they are; only those of repeated requests are compared.
    """
    if repeated is None:
        repeated = repeated_requests(landing)
    same = [landing[c].eqNullSafe(repeated[f"_{c}"]) for c in REQUEST]
    single = landing.join(repeated, same, "left_anti")
    rest = [c for c in landing.columns if c not in REQUEST]
    content = F.struct("landed_at", F.xxhash64(*rest), "status", "after_cursor", "body")
    best = (
        landing.join(repeated, same, "left_semi")
        .groupBy(*REQUEST)
        .agg(F.max_by(F.struct(*rest), content).alias("_best"))
        .select(*REQUEST, *[F.col(f"_best.{c}").alias(c) for c in rest])
    )
    return single.unionByName(best)


def status_kind(status: Column) -> Column:
    return (
        F.when(status == 204, "none").when(status.between(200, 299), "ok").otherwise("error")
    )


def usage_index(answers: DataFrame) -> DataFrame:
    """(org_slug, report_day, kind, n_parts, error) of the landed day indexes.

    `kind` is none (no report), ok or error; n_parts is set where ok.
    """
    rows = answers.filter(F.col("feed") == USAGE_INDEX).select(
        F.col("group_key").alias("org_slug"),
        F.col("request_key").try_cast("date").alias("report_day"),
        status_kind(F.col("status")).alias("_http"),
        "status",
        "body",
    )
    rows = with_decoded(rows, "body", schemas.USAGE_INDEX, "_index")
    broken = (F.col("_http") == "ok") & F.col("_index").isNull()
    return rows.select(
        "org_slug",
        "report_day",
        F.when(broken, "error").otherwise(F.col("_http")).alias("kind"),
        F.when((F.col("_http") == "ok") & ~broken, F.size("_index.download_links")).alias(
            "n_parts"
        ),
        F.when(broken, "unreadable day index")
        .when(F.col("_http") == "error", _http_error())
        .alias("error"),
    )


def _http_error() -> Column:
    return F.concat(
        F.lit("unexpected status "), F.col("status").cast("string"), F.lit(": "), F.col("body")
    )


def usage_part_answers(answers: DataFrame) -> DataFrame:
    """(org_slug, report_day, part_no, body, error) of the landed usage parts."""
    return answers.filter(F.col("feed") == USAGE_PART).select(
        F.col("group_key").alias("org_slug"),
        F.col("request_key").try_cast("date").alias("report_day"),
        F.col("page_no").alias("part_no"),
        "body",
        F.when(status_kind(F.col("status")) != "ok", _http_error()).alias("error"),
    )


def mr_changes(answers: DataFrame) -> DataFrame:
    """(project_id, mr_iid, changes) of the landed file-change answers.

    The HTTP status plays no part: an answer counts if its body decodes. Missing or null `changes`
    is an empty list; an undecodable body gives NULL.
    """
    key = F.split("request_key", "/")
    rows = answers.filter(F.col("feed") == MR_CHANGES).select(
        F.get(key, F.lit(0)).alias("project_id"), F.get(key, F.lit(1)).alias("mr_iid"), "body"
    )
    rows = with_decoded(rows, "body", schemas.MR_CHANGES, "_answer")
    empty = F.array().cast("array<struct<diff:string,new_path:string,old_path:string>>")
    return rows.select(
        "project_id",
        "mr_iid",
        F.when(
            F.col("_answer").isNotNull(), F.coalesce(F.col("_answer.changes"), empty)
        ).alias("changes"),
    )
