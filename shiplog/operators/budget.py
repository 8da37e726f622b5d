"""Diff text under a byte budget.

Blocks are taken in order while they fit; the first that would exceed the budget is cut to what is
left and the rest is dropped. An exact fit is allowed. A cut never splits a character.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplog.functions.text import BLOCK_OVERHEAD, byte_prefix, file_block


#: Sums that meet in one window, at most, where slices are whole numbers within `span`.
FAN = 10_000


def _most_blocks(max_bytes: int) -> int:
    """No block is shorter than its fixed text, so later ones cannot be reached."""
    return max(max_bytes, 0) // BLOCK_OVERHEAD + 1


def diff_text_of_changes(changes: Column, max_bytes: int) -> Column:
    """The diff text of one answer's change list; needs no shuffle."""
    blocks = F.transform(
        F.slice(changes, 1, _most_blocks(max_bytes)),
        lambda c: file_block(c["new_path"], c["diff"]),
    )
    start = F.struct(F.lit("").alias("text"), F.lit(max_bytes).alias("left"))

    def add(state: Column, block: Column) -> Column:
        fits = F.octet_length(block) <= state["left"]
        return F.struct(
            F.concat(
                state["text"],
                F.when(fits, block).otherwise(byte_prefix(block, state["left"])),
            ).alias("text"),
            # What does not fit ends the text, also if the cut left some bytes free.
            F.when(fits, state["left"] - F.octet_length(block))
            .otherwise(F.lit(0))
            .cast("int")
            .alias("left"),
        )

    return F.aggregate(blocks, start, add, lambda state: state["text"])


def within_budget(
    blocks: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_bytes: int,
    slice_of: Column | None = None,
    span: int = FAN**2,
) -> DataFrame:
    """Rows of `blocks` (keys, order, block) that contribute to their group's text.

    Adds `n_bytes`, `bytes_before` and `bytes_used`. Blocks may have any length, also none, and a
    group may hold any number of them; the plan is the same for every budget.

    `slice_of` cuts a group along the order: it never falls as the order goes on (by default the
    first order column). Bytes are summed by slice before the shuffle, running offsets come from
    the sums, and only the blocks of slices that start below the budget meet in a window, each
    slice in its own, each block cut to the budget.

    Slices that are whole numbers are summed level by level, FAN of them at a time, so that a
    window holds FAN sums however many slices a group has. `span` is how far their numbers reach;
    beyond it the uppermost windows grow, the result is the same.
    """
    cut = F.col(order[0]) if slice_of is None else slice_of
    sized = blocks.withColumns({"_slice": cut, "n_bytes": F.octet_length("block").cast("bigint")})
    sums = sized.groupBy(*keys, "_slice").agg(F.sum("n_bytes").alias("_sum"))
    whole = isinstance(sums.schema["_slice"].dataType, T.IntegralType)
    levels = max(1, math.ceil(math.log(max(span, 2), FAN) - 1e-9)) if whole else 1
    starts = _starts(sums, keys, levels, max_bytes)
    reach = _joined(
        sized.withColumn("block", byte_prefix(F.col("block"), F.lit(max_bytes))), starts, keys, "_slice"
    )
    place = Window.partitionBy(*keys, "_slice").orderBy(*order)
    inside = F.sum("n_bytes").over(place.rowsBetween(Window.unboundedPreceding, -1))
    return (
        reach.withColumn("bytes_before", F.col("_start") + F.coalesce(inside, F.lit(0)))
        .filter(F.col("bytes_before") < max_bytes)
        .withColumn("bytes_used", F.least("n_bytes", F.lit(max_bytes) - F.col("bytes_before")))
        .drop("_slice", "_start")
    )


def _starts(sums: DataFrame, keys: Sequence[str], levels: int, max_bytes: int) -> DataFrame:
    """(keys, _slice, _start): the bytes before every slice that starts below the budget.

    On all levels but the uppermost, a window holds the slices of one cell of FAN; cells that start
    beyond the budget are dropped before.
    """
    if levels == 1:
        inside = Window.partitionBy(*keys)
        before = F.lit(0)
    else:
        sums = sums.withColumn("_cell", F.expr(f"_slice div {FAN}"))
        cells = sums.groupBy(*keys, F.col("_cell").alias("_slice")).agg(F.sum("_sum").alias("_sum"))
        upper = _starts(cells, keys, levels - 1, max_bytes).withColumnRenamed("_slice", "_cell")
        sums = _joined(sums, upper.withColumnRenamed("_start", "_before"), keys, "_cell")
        inside = Window.partitionBy(*keys, "_cell")
        before = F.col("_before")
    earlier = F.sum("_sum").over(inside.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    started = sums.withColumn("_start", before + F.coalesce(earlier, F.lit(0)))
    return started.filter(F.col("_start") < max_bytes).select(*keys, "_slice", "_start")


def _joined(rows: DataFrame, some: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
    """`rows` with the columns of `some` for their keys and part; nulls are equal."""
    names = [*keys, part]
    other = some.withColumnsRenamed({k: f"_of_{k}" for k in names})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in names]
    return rows.join(other, same).drop(*[f"_of_{k}" for k in names])


def diff_text(
    blocks: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_bytes: int,
    slice_of: Column | None = None,
    span: int = FAN**2,
) -> DataFrame:
    """(keys, diff_text): the text of every group; at most the budget is collected per group."""
    used = within_budget(blocks, keys, order, max_bytes, slice_of, span)
    # Blocks without bytes add nothing, however many there are.
    used = used.filter(F.col("bytes_used") > 0).select(
        *keys,
        F.struct(*order, byte_prefix(F.col("block"), F.col("bytes_used")).alias("text")).alias("b"),
    )
    texts = used.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list("b")), lambda b: b["text"]), ""
        ).alias("diff_text")
    )
    return texts
