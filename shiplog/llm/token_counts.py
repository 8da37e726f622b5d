"""Byte-level BPE token counts by rank-synchronous merging of ragged numpy arrays.

A text is cut at its single spaces; what stands between is looked up in a bounded table of the
task, and what is new is cut into pre-tokens, whose symbols lie in one flat array. Each round
merges, in all sequences at once, every occurrence of the sequence's lowest-ranked pair; the
symbols that survive are the tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import tokenizer_path
from shiplog.llm.parts import PartTable

# Fixed value: the pre-tokenizer's pattern of byte-level BPE vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.iinfo(np.int32).max
#: Symbols merged at once.
ROUND_SYMBOLS = 2_000_000


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Merges:
    """The vocabulary's merges as sorted arrays: pair -> rank and merged symbol."""

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        order = np.argsort(left << 32 | right)
        self.keys = (left << 32 | right)[order]
        self.ranks = order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.bytes = np.array([vocab[c] for c in byte_letters()], np.int32)
        self.specials = [t["content"] for t in spec["added_tokens"]]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)


def alternate(flags: np.ndarray) -> np.ndarray:
    """Of each run of flagged neighbours the first, third, ...: matches must not overlap."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at
    first = np.r_[True, np.diff(at) > 1]
    start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - start) % 2 == 0]


def merged_counts(merges: Merges, pieces: list[bytes]) -> np.ndarray:
    """Symbols of each piece after all merges."""
    counts = np.array([len(p) for p in pieces], np.int64)
    symbols = merges.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), counts)
    if not len(symbols):
        return counts

    def ranks(at: np.ndarray) -> np.ndarray:
        """Of the pairs that begin at `at`; none across two pieces or at the end."""
        after = np.minimum(at + 1, len(symbols) - 1)
        found = merges.rank(symbols[at], symbols[after])
        return np.where((after > at) & (owner[after] == owner[at]), found, NO_RANK)

    rank = ranks(np.arange(len(symbols)))
    while True:
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lowest = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.r_[starts, len(owner)])
        counts[owner[starts]] = sizes
        live = lowest != NO_RANK
        if not live.any():
            return counts
        keep = np.repeat(live, sizes)
        symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
        lowest = np.repeat(lowest[live], sizes[live])
        at = alternate((rank == lowest) & (rank != NO_RANK))
        symbols[at] = merges.merged[rank[at]]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        place = np.cumsum(stay) - 1
        symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
        at = place[at]
        changed = np.r_[at, np.maximum(at - 1, 0)]
        rank[changed] = ranks(changed)


class Counter:
    """Token counts of texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.merges = Merges(json.load(f))
        self.pattern = regex.compile(PRE_TOKEN)
        specials = self.merges.specials
        self.special = regex.compile("|".join(map(regex.escape, specials)) or r"(?!)")
        self.table = PartTable(self.totals, specials)

    def merged(self, pieces: list[bytes]) -> list[int]:
        """Symbols of each piece, merged in groups of bounded size."""
        counts, start, size = [], 0, 0
        for i, p in enumerate(pieces):
            size += len(p)
            if size >= ROUND_SYMBOLS or i + 1 == len(pieces):
                counts += merged_counts(self.merges, pieces[start : i + 1]).tolist()
                start, size = i + 1, 0
        return counts

    def totals(self, texts: list[str]) -> list[int]:
        """Sums over the pre-tokens of each text, each distinct pre-token merged once.

        Letters only, a space before them or not, are one pre-token.
        """
        cut = [
            [t.encode()]
            if t.removeprefix(" ").isalpha()
            else [p.encode() for p in self.pattern.findall(t)]
            for t in texts
        ]
        distinct = list({p for pieces in cut for p in pieces})
        of = dict(zip(distinct, self.merged(distinct), strict=True))
        return [sum(map(of.__getitem__, pieces)) for pieces in cut]

    def count(self, texts: list[str]) -> list[int]:
        out = []
        for text, found in zip(texts, self.table.look_up(texts), strict=True):
            if found is None:
                parts = self.special.split(text)
                found = [len(parts) - 1, *self.totals(parts)]
            out.append(sum(found))
        return out


def token_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    limit: int = 512,
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for every row of `docs`, in one pass, no shuffle.

    A null text counts as empty: no bytes, no tokens. Null keys and repeated rows stay as they
    are; other columns, whatever their names, are not read. The text of a special token counts
    as one token, as the library has it. `path`: the vocabulary's file, the same on all
    executors.
    """
    path = path or tokenizer_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            counts = counter.count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                ["key", "n_bytes", "n_tokens"],
            )

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"), body.alias("body"), F.octet_length(body).cast("long").alias("n")
    )
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_bytes bigint, n_tokens bigint").select(
        F.col("key").alias(key),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
