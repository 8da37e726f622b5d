"""Packed token ids as binary matrices, by best-fit decreasing within blocks of documents.

Each task packs what it reads, block by block: token ids never cross the network, and a block's
ids are all that a task holds. Overlong documents are cut into full windows and a rest, so that
concatenating a document's segments gives its ids back.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.llm.common import prepared, tokenizer_path
from shiplog.llm.packing import CAPACITY, END_ID, best_fit
from shiplog.llm.token_ids import IDS, Encoder, pieces

PAD_ID = 0
#: Ids after which a block is packed and written.
BLOCK_IDS = 2_000_000


def block_of(held: list[tuple], capacity: int, pad: int, kind: str) -> dict:
    """Packs pieces (key, start, ids) into one matrix, its segments row by row.

    cu_seqlens: for each row the cumulative lengths of its segments, from 0. resets: for each
    row where positions begin again at 0: at each segment, and at the padding.
    """
    held = sorted(held, key=lambda p: -len(p[2]))
    places = list(best_fit([len(p[2]) // IDS.itemsize for p in held], capacity))
    rows = 1 + max(w for w, _ in places)
    ids = np.full((rows, capacity), pad, kind)
    segments: list[list[tuple]] = [[] for _ in range(rows)]
    for (key, start, data), (row, offset) in zip(held, places, strict=True):
        part = np.frombuffer(data, IDS)
        ids[row, offset : offset + len(part)] = part
        segments[row].append((key, start, offset, len(part)))
    ends = [[0, *(o + n for _, _, o, n in row)] for row in segments]
    return {
        "n_rows": rows,
        "width": capacity,
        "dtype": kind,
        "ids": ids.tobytes(),
        "doc_keys": [[k for k, *_ in row] for row in segments],
        "doc_starts": [[s for _, s, *_ in row] for row in segments],
        "cu_seqlens": ends,
        "resets": [e if e[-1] < capacity else e[:-1] for e in ends],
    }


def packed_blocks(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END_ID,
    pad: int = PAD_ID,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """One row per block: (block, n_rows, width, dtype, ids, doc_keys, doc_starts, cu_seqlens,
    resets); `ids` is the row-major little-endian matrix.

    A document is its ids and then `end`; a null text is an empty one. Repeated rows and null
    keys are packed like others. Columns besides key and text are not read.
    """
    path = path or tokenizer_path()
    kind_of_key = docs.schema[key].dataType.simpleString()
    schema = (
        f"block bigint, n_rows int, width int, dtype string, ids binary, "
        f"doc_keys array<array<{kind_of_key}>>, doc_starts array<array<bigint>>, "
        f"cu_seqlens array<array<int>>, resets array<array<int>>"
    )
    prepared(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        most = max(encoder.tokenizer.get_vocab_size(), end + 1, pad + 1)
        kind = "<u2" if most <= 1 << 16 else "<u4"
        first = TaskContext.get().partitionId() << 20
        held: list[tuple] = []
        size = blocks = 0
        types = None

        def flush() -> pa.RecordBatch:
            nonlocal held, size, blocks
            row = {"block": first + blocks, **block_of(held, capacity, pad, kind)}
            held, size, blocks = [], 0, blocks + 1
            return pa.RecordBatch.from_pylist([row], schema=types)

        for b in batches:
            types = pa.schema(
                [
                    ("block", pa.int64()),
                    ("n_rows", pa.int32()),
                    ("width", pa.int32()),
                    ("dtype", pa.string()),
                    ("ids", pa.binary()),
                    ("doc_keys", pa.list_(pa.list_(b.schema.field(0).type))),
                    ("doc_starts", pa.list_(pa.list_(pa.int64()))),
                    ("cu_seqlens", pa.list_(pa.list_(pa.int32()))),
                    ("resets", pa.list_(pa.list_(pa.int32()))),
                ]
            )
            texts = b.column(1).to_pylist()
            for k, ids in zip(b.column(0).to_pylist(), encoder.encode(texts), strict=True):
                for start, _, part in pieces(ids, end, capacity):
                    held.append((k, start, part))
                    size += len(part) // IDS.itemsize
                    if size >= block_ids:
                        yield flush()
        if held:
            yield flush()

    return rows.mapInArrow(run, schema)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Writes the blocks of `docs` as a Parquet data set; options as for `packed_blocks`."""
    packed_blocks(docs, **options).write.option("compression", "zstd").parquet(path)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """One row per packed sequence of a written data set, with a digest of its ids in 32 bits.

    (sequence_id, n_ids, doc_ids, doc_starts, cu_seqlens, resets, ids_crc32): the crc32 is of
    the whole row of the matrix, padding included, as little-endian unsigned 32-bit ids.
    """
    blocks = spark.read.parquet(path)

    @F.pandas_udf("array<bigint>")
    def digests(ids: pd.Series, dtypes: pd.Series, widths: pd.Series) -> pd.Series:
        out = []
        for data, kind, width in zip(ids, dtypes, widths, strict=True):
            matrix = np.frombuffer(data, kind).reshape(-1, width).astype(IDS)
            out.append([zlib.crc32(row.tobytes()) for row in matrix])
        return pd.Series(out, dtype=object)

    rows = F.arrays_zip("doc_keys", "doc_starts", "cu_seqlens", "resets", F.col("crc").alias("crc"))
    return (
        blocks.withColumn("crc", digests("ids", "dtype", "width"))
        .select("block", F.posexplode(rows))
        .select(
            (F.col("block") * 2**20 + F.col("pos")).alias("sequence_id"),
            F.element_at("col.cu_seqlens", -1).cast("long").alias("n_ids"),
            F.col("col.doc_keys").alias("doc_ids"),
            "col.doc_starts",
            "col.cu_seqlens",
            "col.resets",
            F.col("col.crc").alias("ids_crc32"),
        )
    )
