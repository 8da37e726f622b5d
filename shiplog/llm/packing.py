"""Best-fit decreasing packing of documents into windows of fixed size.

Documents are tokenized and cut once, in the scan; only the numbers that describe a piece are
shuffled. Pieces are dealt at random into shards of bounded size, each packed alone: a shard
wastes space in its last windows only, so the padding does not grow with the number of shards.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import prepared, stage, tokenizer_path
from shiplog.llm.token_ids import IDS, Encoder, pieces

CAPACITY = 2048
END_ID = 1
#: Pieces packed together, about.
SHARD_PIECES = 16_000


class OpenWindows:
    """Open windows by the room they have left, with a segment tree over the amounts of room:
    a node tells how many windows have an amount below it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out the window with the least room of at least `length`: (window, room)."""
        node, count = length + self.leaves, self.count
        if not count[node]:
            # Up to the first subtree on the right that holds a window, then down to its left.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return self.windows[room].pop(), room


def best_fit(lengths: list[int], capacity: int) -> Iterator[tuple[int, int]]:
    """(window, offset) of each length, which must come in decreasing order."""
    opened, next_window = OpenWindows(capacity), 0
    for length in lengths:
        found = opened.tightest(length)
        if found is None:
            found = next_window, capacity
            next_window += 1
        window, room = found
        if room > length:
            opened.put(window, room - length)
        yield window, capacity - room


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END_ID,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document is its ids and then `end`; a null text is an empty one, one id long. Documents
    over `capacity` ids are cut into full windows and a rest. Null keys and repeated rows are
    packed like any others, every row for itself; ties in length go by the order of the staged
    rows. Columns besides key and text are not read.
    """
    path = path or tokenizer_path()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for b in batches:
            rows = [
                (i, start, len(part) // IDS.itemsize, zlib.crc32(part), total)
                for i, ids in enumerate(encoder.encode(b.column(1).to_pylist()))
                for start, total, part in pieces(ids, end, capacity)
            ]
            at, *numbers = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), *map(pa.array, numbers)],
                ["key", "start", "length", "ids_crc32", "doc_tokens"],
            )

    prepared(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("body"))
    kind = rows.schema["key"].dataType.simpleString()
    columns = f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    cut_rows = rows.mapInArrow(cut, columns)
    # The staged number spreads rows that are equal in all else.
    staged = stage(cut_rows.withColumn("at", F.monotonically_increasing_id()), "pieces")
    shards = max(1, math.ceil(staged.count() / shard_pieces))

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "at"], ascending=[False, True])
        found = np.array(list(best_fit(shard["length"].tolist(), capacity)), np.int64)
        found = found.reshape(-1, 2)
        return shard.drop(columns=["at", "shard"]).assign(
            sequence_id=shard["shard"].to_numpy(np.int64) * 2**32 + found[:, 0], offset=found[:, 1]
        )

    return (
        staged.withColumn("shard", F.pmod(F.xxhash64("at"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(fit, f"{columns}, sequence_id bigint, offset bigint")
        .withColumnRenamed("key", key)
    )
