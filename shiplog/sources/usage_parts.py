"""Lines of usage report parts, with their place in the day.

Both readers give (org_slug, report_day, part_no, block_start, line_no, line). The triple
(part_no, block_start, line_no) is the arrival order of the lines of one day.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = ("part_no", "block_start", "line_no")
LINE_COLUMNS = ["org_slug", "report_day", *ORDER, "line"]


def lines_of_bodies(parts: DataFrame) -> DataFrame:
    """Lines of parts that were landed as one text each."""
    return parts.select(
        "org_slug",
        "report_day",
        "part_no",
        F.lit(0).cast("bigint").alias("block_start"),
        F.posexplode(F.split("body", "\n")).alias("_pos", "line"),
    ).select(
        "org_slug",
        "report_day",
        "part_no",
        "block_start",
        F.col("_pos").cast("bigint").alias("line_no"),
        F.regexp_replace("line", "\r$", "").alias("line"),
    )


def part_files(
    spark: SparkSession, root: str
) -> Callable[[Sequence[str], date, date], DataFrame]:
    """A reader of the files under `root` for the jobs, which tell it what they have planned."""
    return lambda orgs, first, last: read_part_files(spark, root, orgs, first, last)


def read_part_files(
    spark: SparkSession,
    root: str,
    orgs: Sequence[str] | None = None,
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame:
    """Lines of files <root>/org_slug=<org>/report_day=<day>/<part number>.jsonl.

    With `orgs`, only folders of these orgs and of the days from `first_day` to `last_day` are
    addressed, and no others are listed. A large file is read in splits by many tasks: the byte
    offset of the split orders the splits of a file, and the row counter of the task orders the
    lines of a split.
    """
    schema = "value string, org_slug string, report_day date"
    if orgs is None:
        paths = [root]
    else:
        paths = _day_folders(spark, root, orgs, first_day or date.min, last_day or date.max)
    if paths:
        reader = spark.read.schema(schema).option("basePath", root)
        files = reader.text(paths, lineSep="\n", pathGlobFilter="*.jsonl")
    else:
        files = spark.createDataFrame([], schema)
    if orgs is not None:
        files = files.filter(F.col("org_slug").isin(*orgs))
    if first_day is not None:
        files = files.filter(F.col("report_day") >= F.lit(first_day))
    if last_day is not None:
        files = files.filter(F.col("report_day") <= F.lit(last_day))
    place = {"part_no": F.lit(None).cast("int"), "block_start": F.lit(None).cast("bigint")}
    if paths:
        name = F.regexp_extract("_metadata.file_name", r"(\d+)\.jsonl$", 1)
        place = {"part_no": name.cast("int"), "block_start": F.col("_metadata.file_block_start")}
    return files.select(
        "org_slug",
        "report_day",
        *[column.alias(name) for name, column in place.items()],
        F.monotonically_increasing_id().alias("line_no"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )


def _day_folders(
    spark: SparkSession, root: str, orgs: Sequence[str], first: date, last: date
) -> list[str]:
    """The folders of these orgs and days that exist. A few days are asked for one by one; of more
    days the org's own folder is listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    few = [first + timedelta(n) for n in range((last - first).days + 1)] if (last - first).days < 8 else None

    def of_org(org: str) -> list[str]:
        folder = path(f"{root.rstrip('/')}/org_slug={escaped(org)}")
        if few is not None:
            days = [path(folder, f"report_day={d}") for d in few]
            return [d.toString() for d in days if fs.exists(d)]
        if not fs.exists(folder):
            return []
        found = [s.getPath() for s in fs.listStatus(folder)]
        span = f"report_day={first}", f"report_day={last}"
        return [d.toString() for d in found if span[0] <= d.getName() <= span[1]]

    with ThreadPoolExecutor(16) as pool:
        return [d for days in pool.map(of_org, dict.fromkeys(orgs)) for d in days]
