"""Language identification by rank-order profiles and out-of-place distance.

A profile lists the most frequent letter n-grams (one to three letters, words padded by a space)
of a language; a text takes the language whose ranks lie nearest to its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplog.llm.common import in_split

PROFILE = 300
#: Characters looked at together, each of which takes about 100 bytes.
CHARS = 1 << 20
#: What is no letter, or a blank at least, in any script.
NO_LETTER = re.compile(r"[\W\d_]")
#: n-grams a task holds before it hands on its partial counts.
HELD_COUNTS = 500_000
SPACE = 1


def pieces(texts: Iterable[str]) -> Iterator[tuple[list[int], list[str]]]:
    """(rows, texts) of about CHARS characters together, in lower case.

    A longer text is cut where no letter stands, so that its pieces have its n-grams.
    """
    rows: list[int] = []
    parts: list[str] = []
    room = CHARS
    for row, text in enumerate(texts):
        text, at = text.lower(), 0
        while at < len(text):
            end = min(at + room, len(text))
            if end < len(text):
                stop = NO_LETTER.search(text, end)
                end = stop.start() if stop else len(text)
            rows.append(row)
            parts.append(text[at:end])
            room -= end - at
            at = end
            if room <= 0:
                yield rows, parts
                rows, parts, room = [], [], CHARS
    if rows:
        yield rows, parts


def letters(lower: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, code point) of the letters of texts in lower case, one space before, between and
    after words."""
    code = np.frombuffer("\0".join(["", *lower, ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.cumsum(code == 0) - 1
    # A null character in a text must not begin a row.
    if code.size - np.count_nonzero(code) != len(lower) + 1:
        return letters([t.replace("\0", " ") for t in lower])
    present = np.flatnonzero(np.bincount(code))
    table = np.full(present[-1] + 1, SPACE, np.int64)
    table[present] = [c if chr(c).isalpha() else SPACE for c in present.tolist()]
    code = table[code]
    keep = (code != SPACE) | np.r_[True, code[:-1] != SPACE]
    return row[keep], code[keep]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, n-gram) of every n-gram within a padded word; an n-gram is a number."""
    row, c = letters(texts)
    letter = c != SPACE
    two = letter[1:] | letter[:-1]
    pairs = (c[:-1] << 21 | c[1:])[two]
    pair_row = np.where(letter[1:], row[1:], row[:-1])[two]
    middle = letter[1:-1]
    triples = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[middle]
    rows = np.concatenate([row[letter], pair_row, row[1:-1][middle]])
    found = np.concatenate([c[letter], pairs, triples])
    return rows, found


def by_row(texts: Iterable[str], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-grams of each of `n` texts with their counts."""
    nothing = np.zeros(0, np.int64)
    at, held = 0, []
    for rows, parts in pieces(texts):
        place, found = grams(parts)
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(1, len(parts)))
        for row, own in zip(rows, np.split(found[order], cuts), strict=True):
            while at < row:
                yield merged(held) if held else (nothing, nothing)
                at, held = at + 1, []
            held.append(np.unique(own, return_counts=True))
    while at < n:
        yield merged(held) if held else (nothing, nothing)
        at, held = at + 1, []


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all parts, each once, with the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    gram, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return gram, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def ranked(gram: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """The `size` most frequent n-grams; ties by their number."""
    return gram[np.lexsort((gram, -count))[:size]]


def profiles(docs: DataFrame, text: str, lang: str, size: int) -> dict[str, list[int]]:
    """The `size` most frequent n-grams of each language over all rows with text and language."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                gram, n = merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(gram)), pa.array(gram), pa.array(n)], ["lang", "gram", "n"]
                )

        for b in batches:
            texts, names = b.column(0).to_pylist(), b.column(1).to_pylist()
            for name in sorted(set(names)):
                own = (t for t, x in zip(texts, names, strict=True) if x == name)
                for _, parts in pieces(own):
                    found = np.unique(grams(parts)[1], return_counts=True)
                    if len(found[0]):
                        held[name] = [merged([*held.get(name, []), found])]
            if sum(len(v[0][0]) for v in held.values()) > HELD_COUNTS:
                yield from out()
                held = {}
        yield from out()

    known = docs.select(F.col(text).cast("string"), F.col(lang).cast("string")).dropna()
    counts = known.mapInArrow(count, "lang string, gram bigint, n bigint")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    # `size` rows for each language.
    rows = totals.withColumn("place", place).filter(F.col("place") <= size).collect()
    found: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.place)):
        found.setdefault(r.lang, []).append(r.gram)
    return found


def language_id(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    held_out: tuple[int, int] = (4, 2),
    size: int = PROFILE,
) -> DataFrame:
    """(key, held_out, lang_pred, score) for every row of `docs`, from its whole text.

    Profiles come from the rows with text and language whose crc32 of the id modulo
    `held_out[0]` is not `held_out[1]`; rows of a null id teach nothing and are not held out.
    The prediction is the language at the smallest distance, the first by name among equals,
    and the score one minus that distance over the largest possible one. `und` with score 0
    where the text is null or has no letter, or no language was learned. Repeated rows are
    each predicted; other columns are not read.
    """
    may_learn = in_split(key, *held_out)
    known = profiles(docs.filter(may_learn), text, lang, size)
    names = sorted(known)
    grams_known = np.unique(np.array([g for p in known.values() for g in p], np.int64))
    ranks = np.full((len(names), len(grams_known) + 1), size, np.int64)
    for i, name in enumerate(names):
        ranks[i, np.searchsorted(grams_known, known[name])] = np.arange(len(known[name]))

    def nearest(gram: np.ndarray, count: np.ndarray) -> tuple[str, float]:
        own = ranked(gram, count, size)
        if not len(own) or not names:
            return "und", 0.0
        at = np.minimum(np.searchsorted(grams_known, own), len(grams_known) - 1)
        at = np.where(grams_known[at] == own, at, len(grams_known))
        theirs = ranks[:, at]
        away = np.where(theirs == size, size, np.abs(theirs - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(away))
        return names[best], float(1 - away[best] / (size * len(own)))

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            found = [nearest(*g) for g in by_row(texts, len(texts))]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["key", "held", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col(key).alias("key"),
        (F.col(key).isNotNull() & ~may_learn).alias("held"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        predict, f"key {kind}, held boolean, lang_pred string, score double"
    ).select(F.col("key").alias(key), F.col("held").alias("held_out"), "lang_pred", "score")
