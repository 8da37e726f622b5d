"""The nested usage fact, one row per (org, day, user), and the flat views of it.

The breakdowns are array columns of the fact, so replacing a row replaces its children with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.operators.merge import MergePolicy, fold_batch, last_arrivals, merge_by_key

KEY = ("org_slug", "report_day", "user_id")

USAGE_POLICY = MergePolicy(
    keys=KEY,
    overwrite=tuple(
        c for c in schemas.USAGE_FACTS.fieldNames() if c not in KEY and c != "created_at"
    ),
    insert_only=("created_at",),
)


def facts_of_records(records: DataFrame, as_of: Column) -> DataFrame:
    """Fact rows of good records, with their place; users may repeat."""
    r = F.col("record")
    taken = {
        "user_id",
        "user_login",
        "day",
        "organization_id",
        "enterprise_id",
    }
    plain = [f.name for f in schemas.USAGE_RECORD.fields if f.name not in taken]
    return records.select(
        "org_slug",
        "report_day",
        r["user_id"].alias("user_id"),
        r["user_login"].alias("user_login"),
        r["organization_id"].alias("organization_id"),
        F.nullif(r["enterprise_id"], F.lit("")).alias("enterprise_id"),
        r["enterprise_id"].alias("enterprise_id_sent"),
        *[r[c].alias(c) for c in plain],
        as_of.cast("timestamp").alias("created_at"),
        as_of.cast("timestamp").alias("updated_at"),
        "part_no",
        "block_start",
        "line_no",
    )


def fold_facts(facts: DataFrame, *columns: str) -> DataFrame:
    """One fact per key, the last sent; of its other columns all or those named."""
    order = ("part_no", "block_start", "line_no")
    folded = fold_batch(facts, USAGE_POLICY, order, columns or None)
    names = [c for c in schemas.USAGE_FACTS.fieldNames() if not columns or c in (*KEY, *columns)]
    return folded.select(*names)


def last_facts(facts: DataFrame) -> DataFrame:
    """`fold_facts` of records that are read from files: only keys and places are folded.

    `created_at` is the same for all rows of an import, so the last row may give it.
    """
    last = last_arrivals(facts, KEY, ("part_no", "block_start", "line_no"))
    return last.select(*schemas.USAGE_FACTS.fieldNames())


def merge_facts(target: DataFrame, folded: DataFrame) -> DataFrame:
    """Users missing from a re-import stay; everything but `created_at` is overwritten."""
    return merge_by_key(target, folded, USAGE_POLICY)


def breakdown(facts: DataFrame, name: str) -> DataFrame:
    """Rows of one breakdown, keyed by the fact's natural key."""
    return facts.select(*KEY, F.inline(name))


def raw_payload(facts: DataFrame) -> DataFrame:
    """Add the normalised record as JSON text: defaults filled, absent parts as null.

    Computed on read from the typed columns, so it costs no storage.
    """
    names = [f.name for f in schemas.USAGE_RECORD.fields]
    source = {
        "day": F.date_format("report_day", "yyyy-MM-dd"),
        "enterprise_id": F.col("enterprise_id_sent"),
    }
    record = F.struct(*[source.get(n, F.col(n)).alias(n) for n in names])
    return facts.withColumn("raw_payload", F.to_json(record, {"ignoreNullFields": "false"}))
