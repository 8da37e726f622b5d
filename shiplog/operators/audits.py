"""Checks on written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog import schemas
from shiplog.operators.usage_records import repeats_key

# Columns that must not be NULL, besides the key.
REQUIRED_COLUMNS = {
    "projects": ("p_name", "p_path", "p_full_path", "p_web_url"),
    "merge_requests": (
        "mr_iid",
        "mr_title",
        "mr_web_url",
        "project_id",
        "project_name",
        "project_path",
        "created_at",
        "updated_at",
        "created_by",
        "approved",
    ),
    "usage_facts": ("user_login", "organization_id", *schemas.MEASURES, *schemas.FLAGS),
}


def repeated_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        table.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )


def null_counts(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the number of NULLs per column."""
    return table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def audit(table: DataFrame, keys: Sequence[str], required: Sequence[str]) -> DataFrame:
    """One row per broken rule: (rule, column_name, violations)."""
    columns = [*keys, *required]
    nulls = null_counts(table, columns).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("not_null").alias("rule"),
                        F.lit(c).alias("column_name"),
                        F.col(c).alias("violations"),
                    )
                    for c in columns
                ]
            )
        )
    )
    repeats = repeated_keys(table, keys).agg(F.count(F.lit(1)).alias("violations"))
    unique = repeats.select(
        F.lit("unique").alias("rule"), F.lit(",".join(keys)).alias("column_name"), "violations"
    )
    return nulls.unionByName(unique).filter(F.col("violations") > 0)


def child_key_violations(facts: DataFrame) -> DataFrame:
    """(fact key, breakdown) of every breakdown that repeats a key."""
    found = F.array(
        *[
            F.when(repeats_key(F.col(name), keys), F.lit(name))
            for name, (keys, _) in schemas.BREAKDOWNS.items()
        ]
    )
    return facts.select(
        "org_slug", "report_day", "user_id", F.explode(F.array_compact(found)).alias("breakdown")
    )
