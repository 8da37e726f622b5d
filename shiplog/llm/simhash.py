"""SimHash near-duplicates: exact comparison of fingerprints in tiles.

Two fingerprints that differ in at most r bits agree in at least two of r + 2 bands, so only
fingerprints that share two bands meet, in blocks. A block is compared tile by tile with numpy's
exclusive-or and bit counts; tiles whose population counts lie further apart than the radius are
skipped. A block reports a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import boxed, prepared, row_key, stage
from shiplog.llm.components import components
from shiplog.llm.runs import whole_groups
from shiplog.session import scratch

SEED = 42
SHINGLE = 3
RADIUS = 2
#: Fingerprints compared against each other at once, and those of a block that stay together.
TILE = 1024
BLOCK = 8192


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The majority of each bit over the hashes of all word shingles; 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts: Iterable[bytes] = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.array([xxh64_intdigest(p, SEED) for p in parts], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        octets = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (print, earlier print) of a spanning forest of the prints within the radius.

    Distinct unsigned prints. What a tile of reached prints has not yet reached is compared
    with it, tile by tile in order of population count.
    """
    count = np.bitwise_count(prints)
    order = np.argsort(count, kind="stable")
    open_prints, open_counts = prints[order], count[order]
    child, parent = [], []
    while len(open_prints):
        frontier, fcount = open_prints[:1], open_counts[:1]
        open_prints, open_counts = open_prints[1:], open_counts[1:]
        while len(frontier) and len(open_prints):
            tile, tcount = frontier[:TILE], fcount[:TILE]
            frontier, fcount = frontier[TILE:], fcount[TILE:]
            lo = np.searchsorted(open_counts, max(int(tcount.min()) - radius, 0), "left")
            hi = np.searchsorted(open_counts, int(tcount.max()) + radius, "right")
            reached = np.zeros(len(open_prints), bool)
            for at in range(lo, hi, TILE):
                part = slice(at, min(at + TILE, hi))
                if (
                    int(open_counts[part][0]) - int(tcount.max()) > radius
                    or int(tcount.min()) - int(open_counts[part][-1]) > radius
                ):
                    continue
                near = np.bitwise_count(tile[:, None] ^ open_prints[part][None, :]) <= radius
                hit = near.any(axis=0)
                reached[part] = hit
                child.append(open_prints[part][hit])
                parent.append(tile[near.argmax(axis=0)[hit]])
            frontier = np.r_[frontier, open_prints[reached]]
            fcount = np.r_[fcount, open_counts[reached]]
            open_prints, open_counts = open_prints[~reached], open_counts[~reached]
    if not child:
        return prints[:0], prints[:0]
    return np.concatenate(child), np.concatenate(parent)


def _bands(column: Column, radius: int) -> Column:
    """The blocks of a fingerprint: every two of its bands, numbered."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    band = [
        F.shiftrightunsigned(column, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    return F.array(
        *(F.xxhash64(F.lit(f"{i}.{j}"), band[i], band[j]) for i, j in combinations(range(n), 2))
    )


def _links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all distinct prints within the radius of each other."""
    cut = prints.select("print", F.explode(_bands(F.col("print"), radius)).alias("block"))
    blocks = stage(cut, "blocks")
    # Written out, so that the join stands between two plain shuffles and a hot block is split.
    shared = stage(
        blocks.groupBy("block").agg(F.count("*").alias("n")).filter("n > 1"), "shared-blocks"
    )
    met = blocks.join(shared, "block")
    # A block beyond BLOCK prints is cut into parts by population count and salt; every two
    # parts with counts within the radius meet, so no pair is lost and no task gets it whole.
    salts = F.ceil(F.col("n") / BLOCK).cast("int")
    bits = F.bit_count("print")
    part = F.struct(bits.alias("bits"), F.pmod(F.hash("print"), salts).alias("salt"))
    others = F.flatten(
        F.transform(
            F.sequence(bits - radius, bits + radius),
            lambda c: F.transform(
                F.sequence(F.lit(0), salts - 1),
                lambda s: F.struct(c.alias("bits"), s.alias("salt")),
            ),
        )
    )
    pairs = F.transform(others, lambda o: F.struct(F.least(part, o), F.greatest(part, o)))
    whole = F.array(F.lit(0).cast("long"))
    tiles = F.when(F.col("n") <= BLOCK, whole).otherwise(
        F.transform(pairs, lambda p: F.xxhash64(p))
    )
    dealt = met.select("block", "print", F.explode(tiles).alias("tile"))
    grouped = dealt.repartition("block", "tile").sortWithinPartitions("block", "tile", "print")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, "block", "tile"):
            prints = table.column("print").to_numpy().view(np.uint64)
            found = [
                forest(prints[a:b], radius)
                for a, b in zip(bounds, bounds[1:], strict=False)
                if b - a > 1
            ]
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return grouped.select("block", "tile", "print").mapInArrow(compare, "a bigint, b bigint")


def simhash_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """(key, fingerprint, component_id) for every row of `docs`, from its whole text.

    A null text counts as empty; texts without words have fingerprint zero and are linked like
    any others. The component is the least key reachable over links of at most `radius`
    differing bits; rows with a null key link others but name no component, so it is null where
    all keys are. Repeated rows stay. Other columns are not read.
    """
    prepared(docs.sparkSession)

    @F.pandas_udf("bigint")
    def print_of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    with scratch(docs.sparkSession):
        prints = docs.select(F.col(key).alias("key"), print_of(text).alias("print"))
        rows = stage(prints, "prints", keep=True)
        least = rows.groupBy("print").agg(F.min("key").alias("least"))
        roots = components(_links(least.select("print"), radius))
        named = least.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
            "print", "least", F.coalesce("root", "print").alias("root")
        )
        named = stage(named, "named-prints")
        ids = stage(named.groupBy("root").agg(F.min("least").alias("component_id")), "group-ids")
        of = stage(named.join(ids, "root").select("print", "component_id"), "groups", keep=True)
    return rows.join(of, "print").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_group(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows of `docs` whose key is least in their group, one of each group, all columns.

    Null keys come last; among rows of equal key the one of least text hash stays. Of rows that
    are equal in key and text any one stays.
    """
    tagged = docs.select(boxed(docs), *row_key(F.col(key), F.col(text)))
    rank = F.struct(
        F.col("row")[key].isNull().alias("absent"), F.col("row")[key].alias("id"), "row_a", "row_b"
    )
    ranked = tagged.select(rank.alias("rank"), F.col("row")[text].alias("text"))
    with scratch(docs.sparkSession):
        groups = simhash_groups(ranked, "rank", "text", shingle, radius)
        first = groups.filter(F.col("rank") == F.col("component_id"))
        kept = stage(first.select("rank.row_a", "rank.row_b").distinct(), "kept", keep=True)
    found = tagged.join(kept, ["row_a", "row_b"], "left_semi").dropDuplicates(["row_a", "row_b"])
    return found.select("row.*")
