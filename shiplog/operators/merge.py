"""Keyed merge of a batch into a table, with a policy per column.

  overwrite    the batch wins; within a batch the last arrival wins
  insert_only  the table wins; within a batch the first arrival wins
  keep_known   the batch wins unless NULL; within a batch the last value that is not NULL wins

A batch may repeat a key. It is folded first, with aggregates that combine before the shuffle, so
a key that fills a large part of the batch costs one row per task. After the fold both sides of
the join have unique keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.session import staged


@dataclass(frozen=True)
class MergePolicy:
    keys: tuple[str, ...]
    overwrite: tuple[str, ...] = ()
    insert_only: tuple[str, ...] = ()
    keep_known: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return self.keys + self.overwrite + self.insert_only + self.keep_known


PROJECT_POLICY = MergePolicy(
    keys=("p_id",), overwrite=("p_name", "p_path", "p_full_path", "p_web_url", "topics")
)

MERGE_REQUEST_POLICY = MergePolicy(
    keys=("mr_id",),
    overwrite=(
        "mr_iid",
        "mr_title",
        "updated_at",
        "merged_at",
        "merged_by",
        "approved",
        "approved_by",
        "diff_stats_summary",
        "labels",
    ),
    insert_only=(
        "mr_web_url",
        "project_id",
        "project_name",
        "project_path",
        "created_at",
        "created_by",
    ),
    keep_known=("mr_ai_title", "mr_ai_summary", "mr_ai_model", "mr_ai_category"),
)


def fold_batch(
    batch: DataFrame,
    policy: MergePolicy,
    order: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, as if the rows had been merged one by one in `order`.

    Columns travel through the fold packed together, where Spark cannot prune them: a caller that
    reads only some names them in `columns`.
    """

    def wanted(names: Sequence[str]) -> list[str]:
        return [c for c in names if columns is None or c in columns]

    overwrite, insert_only = wanted(policy.overwrite), wanted(policy.insert_only)
    keep_known = wanted(policy.keep_known)
    place = F.struct(*order)
    merged: list[Column] = []
    if overwrite:
        merged.append(F.max_by(F.struct(*overwrite), place).alias("_last"))
    if insert_only:
        merged.append(F.min_by(F.struct(*insert_only), place).alias("_first"))
    for c in keep_known:
        # max_by passes over rows whose ordering is NULL.
        merged.append(F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c))
    folded = batch.groupBy(*policy.keys).agg(*merged)
    unpacked = [F.col(f"_last.{c}").alias(c) for c in overwrite]
    unpacked += [F.col(f"_first.{c}").alias(c) for c in insert_only]
    return folded.select(*policy.keys, *unpacked, *keep_known)


def last_arrivals(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole last row of every key, of a batch that is read from files.

    Keys and places are folded alone; whole rows are neither sorted nor aggregated, and cross the
    network only if the list of repeated keys is too long to be sent to all tasks. That list is
    written first, so that Spark knows its size; it has one row for a key however often that comes,
    and nothing is grouped after the join, so that Spark may split a hot key there.
    """
    place = F.struct(*order)
    narrow = batch.groupBy(*keys, place.alias("_place")).agg(F.count("*").alias("_n"))
    last = narrow.groupBy(*keys).agg(
        F.max(F.struct("_place", "_n")).alias("_last"), F.sum("_n").alias("_rows")
    )
    repeated = staged(last.filter("_rows > 1").select(*keys, "_last"), "repeated-keys")
    renamed = repeated.select(*[F.col(k).alias(f"_{k}") for k in keys], "_last")

    def same_key() -> Column:
        return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])

    met = batch.join(renamed, same_key(), "left")
    alone = F.col("_last").isNull() | (
        place.eqNullSafe(F.col("_last._place")) & (F.col("_last._n") == 1)
    )
    last_rows = met.filter(alone).select(*batch.columns)
    tied = renamed.filter("_last._n > 1")
    # Normally no place comes twice; the join would sort and shuffle the batch again for nothing.
    if tied.isEmpty():
        return last_rows
    # Rows at one place of one key: any of them.
    ties = batch.join(tied, same_key(), "left_semi")
    rest = [c for c in batch.columns if c not in keys]
    one = ties.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("_one"))
    return last_rows.unionByName(one.select(*keys, "_one.*"))


def first_arrivals(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole first row of every key."""
    rest = [c for c in batch.columns if c not in keys and c not in order]
    return (
        batch.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
        .select(*keys, "_first.*")
    )


def merge_by_key(target: DataFrame, batch: DataFrame, policy: MergePolicy) -> DataFrame:
    """`target` after merging a folded batch; columns in the order of `target`."""
    if not policy.insert_only and not policy.keep_known:
        return replace_by_key(target, batch, policy.keys)
    old = target.select(*policy.keys, F.struct(*_rest(target, policy)).alias("_old"))
    new = batch.select(*policy.keys, F.struct(*_rest(target, policy)).alias("_new"))
    both = old.join(new, list(policy.keys), "full_outer")
    in_old, in_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def merged(c: str) -> Column:
        o, n = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        if c in policy.keys:
            return F.col(c)
        if c in policy.insert_only:
            return F.when(in_old, o).otherwise(n).alias(c)
        if c in policy.keep_known:
            return F.coalesce(n, o).alias(c)
        return F.when(in_new, n).otherwise(o).alias(c)

    return both.select(*[merged(c) for c in target.columns])


def _rest(target: DataFrame, policy: MergePolicy) -> list[str]:
    return [c for c in target.columns if c not in policy.keys]


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Untouched rows of `target` and all rows of a folded batch.

    Only the keys of the batch take part in the join.
    """
    untouched = target.join(batch.select(*keys), list(keys), "left_anti")
    return untouched.select(*target.columns).unionByName(batch.select(*target.columns))


def new_only(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the table does not hold."""
    return batch.join(target.select(*keys), list(keys), "left_anti")


def existing(ids: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `ids` whose key the table holds."""
    return ids.join(target.select(*keys), list(keys), "left_semi")


def insert_absent(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """`target` and, for every key it does not hold, the first arrival in the batch."""
    fresh = new_only(first_arrivals(batch, keys, order), target, keys)
    return target.unionByName(fresh.select(*target.columns))
