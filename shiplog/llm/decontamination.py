"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Test items are a query set, taken in blocks of bounded size; each block meets all documents. A
first pass counts the items' words in the corpus; triples of words that would be rare by chance
are the seeds: three neighbours, or three of four, so that a copy in which every third word is
another one has seeds too. A second pass joins them with the documents' triples and aligns the
words around each hit with the whole item, so that edited copies are scored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplog.llm.common import boxed, prepared, slices, stage

#: Places of a seed's words. The last two are for items of one and two words: the whole item.
SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0,), (0, 1))
SEED_WORDS = 3
#: Chance of a triple at a place of the corpus, by its words' shares, up to which it is rare;
#: this many of an item's rarest triples of each shape are seeds in any case.
RARE = 1e-6
LEAST_SEEDS = 5
#: Of the score of the whole item: from here on a passage is a copy.
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Items that meet the documents at once, about.
BLOCK_ITEMS = 10_000
EDGES = "\"'`.,;:!?()[]{}<>*&%$#|-_+=~^/\\"
OTHER = -1
#: Bytes of texts that are cut into words together.
SLICE_BYTES = 4_000_000


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, and where each text's words begin and end: lower case, cut at white
    space, without marks at the ends."""
    parts = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    words_, ends = pc.ascii_trim(parts.flatten(), characters=EDGES), parts.offsets.to_numpy()
    real = pc.not_equal(pc.binary_length(words_), 0).to_numpy(zero_copy_only=False)
    return words_.filter(pa.array(real)), np.r_[0, np.cumsum(real)][ends - ends[0]]


def words(text: str | None) -> list[str]:
    return cut(pa.array([text], pa.string()))[0].to_pylist()


def numbers(texts: pa.Array, vocabulary: pa.Array) -> Iterator[np.ndarray]:
    """Each text's words by their place in the vocabulary; OTHER where it lacks them."""
    for start, end in slices(texts, SLICE_BYTES):
        found, bounds = cut(texts.slice(start, end - start))
        known = pc.fill_null(pc.index_in(found, value_set=vocabulary), OTHER)
        yield from np.split(known.to_numpy().astype(np.int64), bounds[1:-1])


def seeds(words_: np.ndarray, size: int, shape: int) -> np.ndarray:
    """The words at the places of a shape, from each word on, as one number; -1 where a word is
    none of the items'."""
    places = SHAPES[shape]
    n = len(words_) - places[-1]
    if n <= 0:
        return np.zeros(0, np.int64)
    parts = [words_[i : i + n] for i in places]
    key = reduce(lambda a, b: a * size + b, parts) + shape * size**SEED_WORDS
    return np.where(np.min(parts, axis=0) < 0, -1, key)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, item words up to its end, passage words up to its end).

    Row by row; gaps along a row come from a running maximum.
    """
    at = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(item.tolist(), 1):
        new = np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(passage == word, MATCH, MISMATCH), out=new[1:])
        row = np.maximum.accumulate(new + at) - at
        j = int(np.argmax(row))
        if row[j] > best[0]:
            best = (int(row[j]), i, j)
    return best


class Items:
    """A block of items: their words as numbers, and their seeds."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        found, bounds = cut(pa.array([r[1] for r in rows], pa.string()))
        self.vocabulary = found.unique().sort()
        self.size = len(self.vocabulary) + 1
        if len(SHAPES) * self.size**SEED_WORDS >= 2**63:
            raise ValueError("too many words in a block of items: lower block_items")
        known = pc.index_in(found, value_set=self.vocabulary).to_numpy().astype(np.int64)
        self.words = np.split(known, bounds[1:-1]) if rows else []
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.bags = [np.unique(w, return_counts=True) for w in self.words]
        self.shapes: list[int] = []

    def choose_seeds(self, shares: np.ndarray) -> None:
        """The seeds that are rare by the words' shares of the corpus, as sorted arrays. Of items
        of one or two words the whole item is the only seed."""
        keys, items, places = [], [], []
        for i, w in enumerate(self.words):
            for shape in (0, 1, 2) if len(w) >= SEED_WORDS else (2 + len(w),) if len(w) else ():
                key = seeds(w, self.size, shape)
                if not len(key):
                    continue
                chance = reduce(np.multiply, [shares[w[k : k + len(key)]] for k in SHAPES[shape]])
                rank = np.argsort(np.argsort(chance, kind="stable"), kind="stable")
                kept = np.flatnonzero((chance <= RARE) | (rank < LEAST_SEEDS))
                keys.append(key[kept])
                items.append(np.full(len(kept), i))
                places.append(kept)
        none = [np.zeros(0, np.int64)]
        keys, items, places = (np.concatenate(x or none) for x in (keys, items, places))
        order = np.argsort(keys, kind="stable")
        self.keys, self.of, self.places = keys[order], items[order], places[order]
        self.shapes = np.unique(self.keys // self.size**SEED_WORDS).tolist()

    def hits(self, words_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, where the item would begin) of every seed in a document."""
        found, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for shape in self.shapes:
            key = seeds(words_, self.size, shape)
            at = np.flatnonzero(key >= 0)
            low, high = (np.searchsorted(self.keys, key[at], side) for side in ("left", "right"))
            count = high - low
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            hit = np.repeat(low, count) + step
            found.append(self.of[hit])
            starts.append(np.repeat(at, count) - self.places[hit])
        return np.concatenate(found), np.concatenate(starts)

    def passages(self, words_: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first word, end) of the document's parts that hold seeds of an item."""
        item, start = self.hits(words_)
        order = np.lexsort((start, item))
        item, start = item[order], start[order]
        length = self.length
        # Hits whose copies of the item would overlap are aligned together.
        apart = (item[1:] != item[:-1]) | (start[1:] - start[:-1] > length[item[1:]] // 2)
        cuts = [0, *(np.flatnonzero(apart) + 1).tolist(), len(item)] if len(item) else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            i = int(item[a])
            pad = int(length[i]) // 2 + 2
            yield i, max(0, int(start[a]) - pad), int(start[b - 1]) + int(length[i]) + pad

    def may_reach(self, i: int, passage: np.ndarray) -> bool:
        """Whether the item and the passage share words enough, in whatever order."""
        known, needed = self.bags[i]
        at = np.minimum(np.searchsorted(known, passage), len(known) - 1)
        shared = np.bincount(at[known[at] == passage], minlength=len(known))
        return np.minimum(shared, needed).sum() >= THRESHOLD * len(self.words[i])

    def leaks(self, words_: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item, score, first word, end) of each item's best copy, if it reaches THRESHOLD."""
        found: dict[int, tuple[int, float, int, int]] = {}
        for i, a, b in self.passages(words_):
            item, passage = self.words[i], words_[a:b]
            # An alignment scores no more than all shared words in a row would.
            if not self.may_reach(i, passage):
                continue
            points, to_item, to = align(item, passage)
            score = points / (MATCH * len(item))
            if score >= THRESHOLD and score > found.get(i, (0, 0.0))[1]:
                _, _, back = align(item[:to_item][::-1], passage[:to][::-1])
                found[i] = (i, score, a + to - back, a + to)
        return [found[i] for i in sorted(found)]


def _shares(docs: DataFrame, text: str, items: Items) -> np.ndarray:
    """Shares of the items' words among all words of the corpus."""
    vocabulary, size = items.vocabulary, items.size

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for start, end in slices(b.column(0), SLICE_BYTES):
                known = pc.index_in(cut(b.column(0).slice(start, end - start))[0], value_set=vocabulary)
                # The last place counts the words that no item has.
                total += np.bincount(pc.fill_null(known, size - 1).to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["word", "n"])

    counts = docs.select(F.col(text).cast("string")).mapInArrow(count, "word bigint, n bigint")
    found = np.zeros(size)
    # A row for each word of the block of items.
    for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect():
        found[r["word"]] = r["n"]
    return found / max(1.0, found.sum())


def _blocks(items: DataFrame, key: str, text: str, size: int) -> Iterator[Items]:
    """The items in blocks of about `size`, told apart by a hash."""
    rows = items.select(F.col(key), F.col(text).cast("string")).dropDuplicates()
    n = -(-rows.count() // size)
    part = F.pmod(F.xxhash64(key, text), F.lit(max(1, n)))
    for i in range(n):
        yield Items(sorted(map(tuple, rows.filter(part == i).collect()), key=repr))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    into: str = "leaks",
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """`docs` with the test items that their whole texts hold copies of, in `into`.

    A list of (item, score, first word, end): the score is that of the best local alignment of
    words over that of the whole item, THRESHOLD at least; of equal ones the first. Null and empty
    texts hold none. Items of one or two words are found where they stand exactly, those without
    words never. Items with a null key are sought like others, repeated ones once. Rows, also
    repeated ones, keep their columns; one called `into` is replaced; without items every list is
    empty. Each block of `block_items` items scans the texts twice; blocks follow one another, so
    that the driver and the tasks hold one at a time.
    """
    prepared(docs.sparkSession)
    leak = T.StructType(
        [
            T.StructField("item", items.schema[item_key].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("first", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )

    def search(block: Items) -> Column:
        @F.pandas_udf(T.ArrayType(leak))
        def leaks_of(texts: pd.Series) -> pd.Series:
            names = ("item", "score", "first", "end")
            found = numbers(pa.array(texts, pa.string()), block.vocabulary)
            return pd.Series(
                [
                    [
                        dict(zip(names, (block.ids[i], *rest), strict=True))
                        for i, *rest in block.leaks(words_)
                    ]
                    for words_ in found
                ],
                dtype=object,
            )

        return leaks_of(F.col(text).cast("string"))

    rows = docs.withColumn(into, F.array().cast(T.ArrayType(leak)))
    for n, block in enumerate(_blocks(items, item_key, item_text, block_items)):
        rows = stage(rows, "leaks") if n else rows
        block.choose_seeds(_shares(docs, text, block))
        rows = rows.withColumn(into, F.concat(into, search(block)) if n else search(block))
    return rows


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and item that it holds: (key, item_id, score, first_word, end_word).

    Repeated documents and those with null keys give their rows each; null and empty texts, and
    empty tables, give none. See `find_leaks` for items.
    """
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    found = find_leaks(narrow, items, "body", into="found")
    return found.select("key", F.explode("found").alias("leak")).select(
        F.col("key").alias(key),
        F.col("leak.item").alias("item_id"),
        "leak.score",
        F.col("leak.first").alias("first_word"),
        F.col("leak.end").alias("end_word"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no copy of an item, with all their columns.

    Rows with null and empty texts stay, as do repeated ones; without items all rows stay.
    """
    rows = docs.select(boxed(docs), F.col(text).alias("body"))
    found = find_leaks(rows, items, "body", into="found")
    return found.filter(F.size("found") == 0).select("row.*")
