"""Toxicity by FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Learning takes a bounded sample of labelled rows, whose hashed features are made in parallel and
meet in one task. L1 leaves few weights other than zero; these go to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import in_split, sampled

BITS = 20
#: Labelled rows to learn from at most; the sample goes by a hash of the id.
SAMPLE_ROWS = 12_000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 5.0, 1.0, 5.0, 0.001
TABLE_ENTRIES = 500_000
EDGES = "\"'`.,;:!?()[]{}<>*&%$#|-_+=~^/\\"


class Features:
    """Hashed features of texts: words in lower case without marks at their ends, pairs of
    neighbours, and pairs with one word between."""

    def __init__(self, bits: int = BITS):
        self.mask = np.uint64((1 << bits) - 1)
        self.table: dict[str, int] = {}

    def words(self, parts: list[str]) -> list[int]:
        import xxhash

        table = self.table
        if len(table) > TABLE_ENTRIES:
            table.clear()
        for p in set(parts).difference(table):
            word = p.lower().strip(EDGES)
            table[p] = xxhash.xxh64_intdigest(word.encode(), 7) if word else 0
        return list(map(table.__getitem__, parts))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of every occurrence in the batch."""
        cut = [t.split() for t in texts]
        word = np.array(self.words([p for parts in cut for p in parts]), np.uint64)
        row = np.repeat(np.arange(len(cut)), [len(parts) for parts in cut])
        row, word = row[word != 0], word[word != 0]
        rows, found = [row], [word]
        for gap in (1, 2):
            same = row[gap:] == row[:-gap]
            a, b = word[:-gap][same], word[gap:][same]
            rows.append(row[gap:][same])
            found.append((a * np.uint64(0x9E3779B97F4A7C15) + np.uint64(gap)) ^ (b >> np.uint64(7)))
        mixed = np.concatenate(found)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return np.concatenate(rows), (mixed >> np.uint64(40)) & self.mask


def distinct(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once in its row, ordered by row."""
    pairs = np.unique(row.astype(np.uint64) << np.uint64(32) | feature)
    return (pairs >> np.uint64(32)).astype(np.int64), pairs & np.uint64(0xFFFFFFFF)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """Per-coordinate learning rates; a weight stays zero until its gradients outweigh L1.

    The last coordinate is the bias, free of L1.
    """

    def __init__(self, bits: int = BITS):
        size = (1 << bits) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, L1)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.r_[at, len(self.z) - 1]
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def learn(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int):
    """Weights other than zero, as (features, weights), the bias last.

    A repeated id takes its largest label; null ids and null labels teach nothing.
    """
    known = labels.groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("y"))
    known = known.filter(F.col("y").isNotNull() & F.col("id").isNotNull())
    order = F.xxhash64("id")
    # At most `rows` narrow rows, so every task may have them.
    sample = sampled(known, order, rows)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for b in batches:
            row, found = distinct(*make.of(b.column(2).to_pylist()))
            cut = np.searchsorted(row, np.arange(b.num_rows + 1))
            lists = pa.ListArray.from_arrays(cut.astype(np.int32), found.astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], ["id", "y", "f"])

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ftrl()
        data = [
            (y, f.values.to_numpy(zero_copy_only=False))
            for b in batches
            for y, f in zip(b.column(1).to_pylist(), b.column(2), strict=True)
        ]
        for _ in range(EPOCHS if data else 0):
            for y, f in data:
                model.learn(f, y)
        w = model.weights(np.arange(len(model.z)))
        at = np.r_[np.flatnonzero(w[:-1]), len(w) - 1]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["f", "w"])

    rows_of = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("body"))
    chosen = rows_of.join(F.broadcast(sample), "id").select("id", "y", "body")
    kind = rows_of.schema["id"].dataType.simpleString()
    taught = chosen.mapInArrow(features, f"id {kind}, y int, f array<int>")
    # A hard bound on what meets in the one task that learns, in an order that is random in kind.
    taught = taught.orderBy(order, "id", "y", "f").limit(rows)
    # At most one row per coordinate, few of them by L1.
    found = taught.mapInArrow(fit, "f bigint, w double").collect()
    return np.array([r.f for r in found]), np.array([r.w for r in found], np.float64)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = 0.7,
    held_out: tuple[int, int] = (3, 1),
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(key, held_out, score, predicted) for every row of `docs`, from its whole text.

    Rows whose crc32 of the id modulo `held_out[0]` is `held_out[1]` are held out and teach
    nothing; a null id is neither held out nor learned from. A null text scores as an empty one,
    by the bias alone; without any labelled rows every score is 0.5. Repeated rows are scored
    each. Columns besides key and text are not read.
    """
    may_learn = in_split(key, *held_out)
    at, w = learn(docs.filter(may_learn), labels.filter(may_learn), key, text, label, sample_rows)
    bias = float(w[-1]) if len(w) else 0.0
    at, w = at[:-1], w[:-1]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = w
        for b in batches:
            row, found = make.of(b.column(2).to_pylist())
            hit = dense[found] != 0
            row, found = distinct(row[hit], found[hit])
            total = np.bincount(row, dense[found].astype(np.float64), b.num_rows) + bias
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sigmoid(total))], ["key", "held", "score"]
            )

    rows = docs.select(
        F.col(key).alias("key"),
        (F.col(key).isNotNull() & ~may_learn).alias("held"),
        F.coalesce(text, F.lit("")).alias("body"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(score, f"key {kind}, held boolean, score double").select(
        F.col("key").alias(key),
        F.col("held").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
