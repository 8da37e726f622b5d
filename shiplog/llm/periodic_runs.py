"""Periodic runs of words: stretches in which a few words repeat over and over.

A run of period q holds at least four of its periods, so each of its words occurs at least four
times in it. Words that occur more rarely within a segment cannot join a run and split it; in
the smaller segments other words become too rare, and so on until nothing changes. What survives
is scanned lag by lag: of every lag only the words at its multiples are compared, four of which
lie in each of its runs, which makes n log n comparisons for n words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import prepared, slices

#: A run has this many periods and words at least.
PERIODS, WORDS = 4, 6
#: Characters of texts that are worked on together.
SLICE_BYTES = 8_000_000

Run = tuple[int, int, int]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and where each text's words begin and end among them."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, ends = cut.flatten(), cut.offsets.to_numpy().astype(np.int64)
    ends -= ends[0]
    real = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    return words.filter(pa.array(real)), np.r_[0, np.cumsum(real)][ends]


def surviving(codes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the segments left when no segment holds a word too rare for a run."""
    at = np.arange(len(codes))
    segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    while len(at):
        _, of, count = np.unique(
            segment.astype(np.int64) * (int(codes.max()) + 1) + codes[at],
            return_inverse=True,
            return_counts=True,
        )
        frequent = count[of] >= PERIODS
        settled = frequent.all()
        at, segment = at[frequent], segment[frequent]
        begins = np.r_[True, (np.diff(at) > 1) | (np.diff(segment) > 0)][: len(at)]
        segment = np.cumsum(begins) - 1
        long = np.bincount(segment, minlength=1)[segment] >= WORDS
        settled &= long.all()
        at, segment = at[long], segment[long]
        if settled:
            break
    if len(at):
        first = np.flatnonzero(np.r_[True, np.diff(segment) > 0])
        yield from zip(at[first].tolist(), (at[np.r_[first[1:], len(at)] - 1] + 1).tolist())


def _forward(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    at, step, n = 0, 64, min(len(a), len(b))
    while at < n:
        other = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        if other.any():
            return at + int(other.argmax())
        at, step = at + step, 2 * step
    return n


def lag_scan(words: np.ndarray) -> list[Run]:
    """(start, length, period) of all runs, by start and period.

    A candidate within a run whose period divides the lag belongs to that run; each other one is
    extended both ways, and those it covers are skipped. A stretch
    whose smallest period is shorter has been found before, since that period divides the lag.
    """
    n, runs = len(words), []
    by_period: dict[int, tuple[np.ndarray, ...]] = {}
    divisors = defaultdict(list)
    for q in range(1, n // PERIODS + 1):
        grid = words[::q]
        same = grid[1:] == grid[:-1]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        periods = divisors.pop(q, ())
        if not len(hits):
            continue
        shorter = [by_period[p] for p in periods]
        for starts, ends in shorter:
            run = np.searchsorted(starts, hits, "right") - 1
            hits = hits[(run < 0) | (ends[run] <= hits + 3 * q)]
        # Equal words go on for half of a run's 3 q at least, on one of the two sides.
        if len(hits) > 4:
            after, before = np.ones((2, len(hits)), bool)
            for k in range(1, min(8, (3 * q - 1) // 2) + 1):
                right, left = np.minimum(hits + k, n - 1 - q), np.maximum(hits - k, 0)
                after &= (hits + k < n - q) & (words[right] == words[right + q])
                before &= (hits >= k) & (words[left] == words[left + q])
            hits = hits[after | before]
        end, found = -1, []
        for at in hits.tolist():
            if at < end - q:
                continue
            start = at - _forward(words[:at][::-1], words[: at + q][::-1])
            end = at + _forward(words[at:], words[at + q :]) + q
            repeats = any(((a <= start) & (b >= end)).any() for a, b in shorter)
            if end - start >= max(WORDS, PERIODS * q) and not repeats:
                found.append((start, end))
        if found:
            runs += [(a, b - a, q) for a, b in found]
            by_period[q] = tuple(np.array(found).T)
            for multiple in range(2 * q, n // PERIODS + 1, q):
                divisors[multiple].append(q)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of(codes: np.ndarray, bounds: np.ndarray) -> tuple[list[list[Run]], np.ndarray]:
    """The runs of each text, and which of all words are kept: those that no run holds after its
    first period."""
    runs: list[list[Run]] = [[] for _ in range(len(bounds) - 1)]
    change = np.zeros(len(codes) + 1, np.int64)
    for start, end in surviving(codes, bounds):
        text = int(np.searchsorted(bounds, start, "right")) - 1
        for at, length, period in lag_scan(codes[start:end]):
            runs[text].append((int(start + at - bounds[text]), length, period))
            change[start + at + period] += 1
            change[start + at + length] -= 1
    return runs, np.cumsum(change)[:-1] == 0


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, runs, collapsed) for every row of `docs`, in one pass, no shuffle.

    Words are what stands between spaces, tabs and line ends. A run is a stretch of words with
    smallest period q, of at least four periods and six words, that no neighbouring word extends.
    `runs`: array of (start, length, period) by start and period, counted in words from 0.
    `collapsed`: the words that no run holds after its first period, joined by single spaces.

    A null or blank text has no words, no runs and an empty `collapsed`. Null keys and repeated
    rows stay as they are; other columns, whatever their names, are not read; an empty table
    gives an empty one. A text of any length is worked on whole, by one task.
    """
    prepared(docs.sparkSession)
    kind = pa.list_(
        pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column(1), SLICE_BYTES):
                part = batch.slice(start, end - start)
                words, bounds = split_words(part.column(1))
                codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
                runs, kept = runs_of(codes, bounds)
                left = np.r_[0, np.cumsum(kept)][bounds].astype(np.int32)
                lists = pa.ListArray.from_arrays(left, words.filter(pa.array(kept)))
                fields = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(fields, kind),
                        pc.binary_join(lists, " "),
                    ],
                    ["key", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("body"))
    found = rows.mapInArrow(
        run,
        f"key {rows.schema['key'].dataType.simpleString()}, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string",
    )
    return found.withColumnRenamed("key", key)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) in which one text of ten goes on with a period from some word on.

    With h the crc32 of the id's digits and g = floor(h / 10), a text of n words with h % 10 = 0
    has word a + (i - a) % p in the place of each word i >= a; a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and those with a null id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    named = docs.select("doc_id", "text", h.alias("h"))
    chosen = F.coalesce((F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    cut = named.withColumn("words", F.when(chosen, words)).withColumn("g", F.expr("h div 10"))
    cut = cut.withColumn("a", F.expr("cast(if(size(words) > 0, g % size(words), 0) as int)"))
    cut = cut.withColumn("p", F.expr("cast(1 + (size(words) - a) div (3 + g % 8) as int)"))
    body = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[a + (i - a) % p])), ' ')")
    return cut.select("doc_id", F.when(F.col("words").isNotNull(), body).otherwise(F.col("text")).alias("text"))


def run_report(found: DataFrame) -> DataFrame:
    """Per document: number of runs, the longest one (ties: the first, then the shortest period),
    digests of all runs and of the collapsed text. No run: nulls for the longest one."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period))
    )
    length, period = best["length"], -best["col3"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["col2"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(
            F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), "").cast("binary"),
            256,
        ).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
