"""Streams of record batches sorted by keys, cut where a key ends."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def whole_groups(
    batches: Iterable[pa.RecordBatch], *keys: str
) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole groups, with the bounds of the groups; keys are integers.

    A group that a batch may not end waits for the next: memory is a batch and a group.
    """

    def bounds(table: pa.Table) -> list[int]:
        change = np.zeros(max(len(table) - 1, 0), bool)
        for k in keys:
            column = table.column(k).to_numpy()
            change |= column[1:] != column[:-1]
        return [0, *(np.flatnonzero(change) + 1).tolist(), len(table)]

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        cuts = bounds(table)
        if len(cuts) > 2:
            yield table.slice(0, cuts[-2]), cuts[:-1]
        held = table.slice(cuts[-2])
    if held is not None:
        yield held, [0, len(held)]
