"""Removal of repeated byte strings by bucket-pointer refinement over sampled suffixes.

Every window of 200 bytes is stood for by an anchor, a q-gram that its own bytes choose; equal
windows have equal anchors. The initial buckets hold the anchors with equal q-grams. They are
refined by identifiers of later offsets (see suffix_buckets): first by all windows an anchor
stands for, then, only where a bucket still has suffixes of different surroundings, window by
window. Buckets of one suffix are settled and leave at every step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import boxed, prepared, stage
from shiplog.llm.runs import whole_groups
from shiplog.llm.suffix_buckets import (
    CHUNK,
    REFINED,
    WINDOW,
    anchors,
    refined,
    window_ids,
)
from shiplog.session import scratch

#: Suffixes of a bucket that one task compares; a larger bucket is dealt out by its windows.
BUCKET_ROWS = 1024
ANCHOR = "row bigint, also int, bucket bigint, context bigint, first bigint, windows int, place int"
SPANS = "array<struct<start: bigint, end: bigint>>"


def _chunks(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a text that together hold each of its windows once."""
    for at in range(0, len(data) - WINDOW + 1, CHUNK):
        yield at, data[at : at + CHUNK + WINDOW - 1]


def _anchors_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found: list[tuple] = []
        names = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        for (row, also), text in zip(names, b.column(2), strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            for at, part in _chunks(data):
                bucket, context, first, windows, place = anchors(*refined(part))
                of = np.full(len(bucket), row, np.int64)
                second = np.full(len(bucket), also, np.int32)
                found.append((of, second, bucket, context, first + at, windows, place - first))
        if found:
            columns = map(np.concatenate, zip(*found, strict=True))
            of, second, bucket, context, first, windows, place = columns
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(of),
                    pa.array(second),
                    pa.array(bucket.view(np.int64)),
                    pa.array(context.view(np.int64)),
                    pa.array(first),
                    pa.array(windows.astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                ],
                ["row", "also", "bucket", "context", "first", "windows", "place"],
            )


def _windows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For texts with their open suffixes: the identifiers of all windows of each suffix."""
    for b in batches:
        out: list[tuple] = []
        names = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        for (row, also), text, suffixes in zip(names, b.column(2), b.column(3), strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            begin = 0
            ids = np.zeros(0, np.uint64)
            for s in sorted(suffixes.as_py(), key=lambda s: s["first"]):
                first, n = s["first"], s["windows"]
                # Identifiers of up to a chunk of the text, made anew where a suffix leaves it.
                if not len(ids) or first + n - 1 + WINDOW - REFINED - begin >= len(ids):
                    begin = first
                    ids = refined(data[begin : begin + CHUNK + WINDOW])[1]
                found = window_ids(ids, np.arange(first - begin, first - begin + n))
                out.append((s["bucket"], row, also, first, s["place"], found.view(np.int64), s["large"]))
        if out:
            bucket, row, also, first, place, ids, large = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket, pa.int64()),
                    pa.array(row, pa.int64()),
                    pa.array(also, pa.int32()),
                    pa.array(first, pa.int64()),
                    pa.array(place, pa.int32()),
                    pa.ListArray.from_arrays(
                        np.r_[0, np.cumsum([len(i) for i in ids])].astype(np.int32),
                        np.concatenate(ids),
                    ),
                    pa.array(large, pa.bool_()),
                ],
                ["bucket", "row", "also", "first", "place", "ids", "large"],
            )


def _equal_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, also, start, end) of windows that occur again in their bucket at the same offset."""
    for table, bounds in whole_groups(batches, "bucket"):
        ids = table.column("ids").combine_chunks()
        sizes = np.diff(ids.offsets.to_numpy())
        owner = np.repeat(np.arange(len(sizes)), sizes)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[owner]
        place = table.column("place").to_numpy()[owner].astype(np.int64) - step
        start = table.column("first").to_numpy()[owner] + step
        row = table.column("row").to_numpy()[owner]
        also = table.column("also").to_numpy()[owner]
        value = ids.flatten().to_numpy().view(np.uint64)
        order = np.lexsort((value, place, group))
        same = np.ones(max(len(order) - 1, 0), bool)
        for x in (group, place, value):
            same &= x[order][1:] == x[order][:-1]
        twice = np.r_[same, False] | np.r_[False, same]
        if twice.any():
            at = np.sort(order[twice])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row[at]),
                    pa.array(also[at]),
                    pa.array(start[at]),
                    pa.array(start[at] + WINDOW),
                ],
                ["row", "also", "start", "end"],
            )


def _marks(rows: DataFrame) -> DataFrame:
    """(row, also, start, end) whose union is, in every text, what repeated windows cover."""
    found = stage(rows.mapInArrow(_anchors_of, ANCHOR), "anchors")
    # Counts are written out before they are joined: between two plain shuffles Spark can split
    # the rows of a hot bucket, below an aggregate it could not.
    often = found.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    often = stage(often.select("bucket"), "often")
    suffixes = stage(found.join(often, "bucket"), "suffixes")

    one = F.min(F.struct("row", "also", "first", "windows", "place"))
    kinds = suffixes.groupBy("bucket", "context").agg(F.count("*").alias("n"), one.alias("one"))
    kinds = stage(kinds, "contexts")
    # All windows of a context that occurs again are repeated.
    settled = suffixes.join(kinds.filter("n > 1").select("bucket", "context"), ["bucket", "context"])
    last = F.col("first") + F.col("windows") - 1
    marks = settled.select("row", "also", F.col("first").alias("start"), (last + WINDOW).alias("end"))

    # Buckets with a context that occurs once, beside others, are refined by single windows;
    # one suffix stands for each context.
    unlike = (
        kinds.groupBy("bucket")
        .agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
        .filter("kinds > 1 and least = 1")
    )
    open_rows = (
        kinds.join(stage(unlike, "unlike"), "bucket")
        .select("one.*", "bucket", (F.col("kinds") > BUCKET_ROWS).alias("large"))
        .groupBy("row", "also")
        .agg(F.collect_list(F.struct("bucket", "first", "windows", "place", "large")).alias("open"))
    )
    # A row that is equal to another in key and text opens no context that occurs once, so that
    # reading both adds no window that was not repeated before.
    texts = rows.join(stage(open_rows, "open"), ["row", "also"])
    windows = "bucket bigint, row bigint, also int, first bigint, place int, ids array<bigint>, large boolean"
    texts = texts.select("row", "also", "body", "open")
    opened = stage(texts.mapInArrow(_windows_of, windows), "windows")
    few = opened.filter("not large").repartition("bucket").sortWithinPartitions("bucket")
    marked = "row bigint, also int, start bigint, end bigint"
    equal = few.drop("large").mapInArrow(_equal_windows, marked)

    single = opened.filter("large").select("bucket", "row", "also", "first", "place", F.posexplode("ids"))
    single = single.select(
        F.xxhash64("bucket", F.expr("place - pos"), "col").alias("a"),
        F.hash("col", F.expr("place - pos"), "bucket").alias("b"),
        "row",
        "also",
        F.expr("first + pos").alias("start"),
    )
    again = single.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1")
    dealt = single.join(stage(again.select("a", "b"), "again"), ["a", "b"])
    dealt = dealt.select("row", "also", "start", (F.col("start") + WINDOW).alias("end"))
    return marks.unionByName(equal).unionByName(dealt)


def _names(key: str, text: str) -> list[Column]:
    """96 bits of hashes that tell rows apart: two rows of 10^11 share them once in 10^7 runs."""
    return [
        F.xxhash64(F.col(key), F.lit(0), F.col(text)).alias("row"),
        F.hash(F.col(text), F.lit(1), F.col(key)).alias("also"),
    ]


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", into: str = "repeated"
) -> DataFrame:
    """`docs` with the maximal byte runs that repeated windows cover, as (start, end) in `into`.

    A window is WINDOW bytes of the text's UTF-8 form; it is repeated if equal bytes start
    anywhere else, in the same text or another. Texts shorter than a window, null and empty
    ones, have no runs. Rows that are equal in key and text are separate documents. Keys may
    be null or repeated: rows are told apart by two hashes of key and text. Other columns
    stay as they are; one called `into` is replaced.
    """
    prepared(docs.sparkSession)
    body = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(*_names(key, text), body.alias("body"))

    @F.pandas_udf(SPANS)
    def merged(starts: pd.Series, ends: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(starts, ends, strict=True):
            if a is None or not len(a):
                out.append([])
                continue
            order = np.argsort(a, kind="stable")
            a, b = a[order], np.maximum.accumulate(b[order])
            cut = np.flatnonzero(np.r_[True, a[1:] > b[:-1]])
            last = np.r_[cut[1:], len(a)] - 1
            out.append(
                [{"start": int(s), "end": int(e)} for s, e in zip(a[cut], b[last], strict=True)]
            )
        return pd.Series(out, dtype=object)

    name = ["row", "also"]
    with scratch(docs.sparkSession):
        marks = stage(_marks(rows.filter(F.length("body") >= WINDOW)), "marks")
        lists = marks.groupBy(*name).agg(
            F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
        )
        spans = stage(lists.select(*name, merged("starts", "ends").alias("spans")), "spans", keep=True)
    joined = docs.select(boxed(docs).alias("doc"), *_names(key, text)).join(spans, name, "left")
    found = F.coalesce("spans", F.array().cast(SPANS))
    return joined.select(F.col("doc").withField(into, found).alias("doc")).select("doc.*")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (key, n_bytes, n_removed, n_spans, kept_sha256)."""
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("body"))
    found = repeated_spans(narrow, "key", "body", "found")

    @F.pandas_udf("string")
    def digest(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans, strict=True):
            data = (text or "").encode()
            end, kept = 0, hashlib.sha256()
            for s in found:
                kept.update(data[end : s["start"]])
                end = s["end"]
            kept.update(data[end:])
            out.append(kept.hexdigest())
        return pd.Series(out, dtype=object)

    length = F.aggregate(
        "found", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"]
    )
    return found.select(
        F.col("key").alias(key),
        F.coalesce(F.octet_length("body"), F.lit(0)).cast("long").alias("n_bytes"),
        length.alias("n_removed"),
        F.size("found").cast("long").alias("n_spans"),
        digest("body", "found").alias("kept_sha256"),
    )
