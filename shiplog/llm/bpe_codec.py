"""Byte-pair encoding and decoding with reuse of chunks.

Texts are cut into content-defined chunks (see `chunks`). Chunks that many documents share are
found by a first pass, encoded once and given to all tasks; further chunks that come back are
encoded once by each task. What a text gains or loses where two of its chunks meet is repaired: a
window around the join is encoded as one text, and grows until it ends on both sides in words
whose ids agree exactly with those that the chunks gave. White space never takes part in a token,
so what lies beyond such a word cannot depend on the join.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm import chunks
from shiplog.llm.common import prepared, slices, stage, tokenizer_path

WORD_FILE = "word_bpe_49k.json"
IDS = np.dtype("<u4")
#: Chunks that all tasks get encoded: the most shared ones, a few KB at most each.
SHARED_CHUNKS = 2_048
#: Bytes of chunks that a task keeps encoded before it starts again.
TABLE_BYTES = 8_000_000
#: Bytes on each side of a join that are encoded first.
WINDOW = 24
#: Bytes of texts worked on together.
SLICE_BYTES = 1_000_000
WORD_END = "</w>"
#: Bytes that words are cut at.
WHITE = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
#: Characters that plain words may hold; others have rules of their own.
PLAIN = regex.compile("[\t-\r -~]*")
UNUSUAL = regex.compile("[^\t-\r -~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f]")
BLANK, DIGIT = 0, 2
KINDS = np.full(0x180, 3, np.uint8)
for _c in range(0x180):
    if regex.match(r"\p{L}", chr(_c)):
        KINDS[_c] = 1
    elif regex.match(r"\p{N}", chr(_c)):
        KINDS[_c] = DIGIT
KINDS[:256][WHITE] = BLANK
# The pre-tokenizer's pattern of such vocabularies, and the endings it takes apart.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


class Words:
    """Ids of words, as the tokenizers library gives them for texts of one word.

    Plain words are encoded together by tiktoken, loaded with the same merges: a byte that ends
    each pre-token stands for the vocabulary's mark of a word's end, and is merged with the letter
    before it first of all. Other words, and all if the file is of another kind, go through the
    library.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.plain = None
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        pattern = steps[0].get("pattern", {}).get("Regex") if len(steps) == 2 else None
        if kinds == ["NFC", "Replace", "Lowercase"] and pattern == PRE_TOKEN:
            self.plain = self._ranks(spec["model"])

    @cached_property
    def tokenizer(self):
        """The library's, loaded when a word needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def _ranks(self, model: dict):
        """The merges as tiktoken's ranks; None unless they give every token in one way."""
        import tiktoken

        from shiplog.llm.token_counts import byte_letters

        byte = {c: bytes([b]) for b, c in enumerate(byte_letters())}

        def raw(token: str) -> bytes:
            ends = token.endswith(WORD_END)
            letters = token.removesuffix(WORD_END)
            return b"".join(byte[c] for c in letters) + b"\0" * ends

        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [a + b for a, b in pairs]
        first = [c + WORD_END for c in byte]
        ranked = [*first, *byte, *made]
        ranks = {raw(t): i for i, t in enumerate(ranked)}
        if len(ranks) < len(ranked) or model["end_of_word_suffix"] != WORD_END:
            return None
        self.ids = np.array([vocab[t] for t in ranked], IDS)
        self.sizes = np.array([len(raw(t).rstrip(b"\0")) or 1 for t in ranked], np.int64)
        return tiktoken.Encoding(
            "words", pat_str="[^\0]*\0", mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        odd = self._odd(text)
        if not odd:
            return self._plain(text)
        words = [w.decode() for w in text.encode().split()]
        spaces = np.cumsum([len(w) + 1 for w in words])
        text = " ".join(words)
        alone = np.zeros(len(words), bool)
        alone[np.searchsorted(spaces, self._odd(text), "right")] = True
        if self.plain is None:
            alone[:] = True
        own = [w for w, a in zip(words, alone.tolist(), strict=True) if a]
        others = iter(self.tokenizer.encode_batch(own, add_special_tokens=False))
        ids, counts = self._plain(" ".join(w for w, a in zip(words, alone.tolist(), strict=True) if not a))
        each = iter(np.split(ids, np.cumsum(counts)[:-1]))
        parts = [np.array(next(others).ids, IDS) if a else next(each) for a in alone.tolist()]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _odd(self, text: str) -> list[int]:
        """Where a word has something that must go through the library."""
        if self.plain is None:
            return [0] if text.strip() else []
        found = [] if PLAIN.fullmatch(text) else [m.start() for m in UNUSUAL.finditer(text)]
        for special in self.specials:
            found += [m.start() for m in regex.finditer(regex.escape(special), text)]
        return found

    def _plain(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Of a text of plain words, cut in arrays of characters; normalization only lowers these."""
        letters = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        kind = KINDS[letters]
        letters, kind, last = _without_blanks(letters, kind)
        if not len(letters):
            return np.zeros(0, IDS), np.zeros(0, np.int64)
        ends = _pre_token_ends(letters, kind, last)
        room = np.arange(len(letters)) + np.cumsum(ends) - ends
        marked = np.zeros(len(letters) + int(ends.sum()), np.uint32)
        marked[room] = letters
        text = marked.tobytes().decode("utf-32-le")
        rank = np.array(self.plain.encode_ordinary(text), np.int64)
        word_ends = np.cumsum(1 + (letters > 0x7F))[last]
        upto = np.searchsorted(np.cumsum(self.sizes[rank]), word_ends, "right")
        return self.ids[rank], np.diff(upto, prepend=0)


def _without_blanks(letters: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
    """The letters and kinds of words, and where each word's last letter lies among them."""
    black = kind != BLANK
    final = black & np.r_[~black[1:], True] if len(black) else black
    return letters[black], kind[black], np.flatnonzero(final[black])


def _pre_token_ends(letters: np.ndarray, kind: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether a pre-token ends with each letter: runs of letters, single digits, runs of other
    signs, and before all of these an apostrophe with one of CONTRACTIONS at the begin of a run."""
    change = np.r_[kind[1:] != kind[:-1], True]
    change[last] = True
    ends = change | (kind == DIGIT)
    begins = np.r_[True, change[:-1]]
    marks = np.flatnonzero((letters == ord("'")) & begins)
    if len(marks):
        word_end = last[np.searchsorted(last, marks)]
        for ending in CONTRACTIONS:
            size = len(ending)
            fits = marks[word_end - marks >= size]
            for i, c in enumerate(ending):
                fits = fits[letters[fits + 1 + i] == ord(c)]
            # An apostrophe that is followed by letters is a run of its own.
            ends[fits] = False
            for i in range(size):
                ends[fits + 1 + i] = i + 1 == size
    return ends


@dataclass(slots=True)
class Encoded:
    """A chunk's ids, and where its words lie in its bytes and in its ids."""

    size: int
    starts: np.ndarray
    ends: np.ndarray
    ids: np.ndarray
    firsts: np.ndarray

    def word(self, number: int) -> np.ndarray:
        return self.ids[self.firsts[number] : self.firsts[number + 1]]


def word_bounds(parts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Where the words of each part begin and end in it."""
    data = np.frombuffer(b" ".join(parts), np.uint8)
    black = np.r_[False, ~WHITE[data], False]
    edges = np.flatnonzero(black[1:] != black[:-1])
    base = np.cumsum([0, *(len(p) + 1 for p in parts)])
    of = np.searchsorted(edges[::2], base)
    rows = list(zip(base.tolist(), of[:-1].tolist(), of[1:].tolist()))
    edges = edges.astype(np.int32)
    return tuple([edges[k::2][a:b] - at for at, a, b in rows] for k in (0, 1))


@dataclass
class Window:
    """A stretch text[left:right] around one or more joins, which ends in whole words of which the
    chunks' ids are known; `before` and `after` are None at what is done and at the text's end."""

    left: int
    right: int
    before: np.ndarray | None
    after: np.ndarray | None
    first: int
    last: int

    def agrees(self, ids: np.ndarray) -> bool:
        ok = self.before is None or np.array_equal(ids[: len(self.before)], self.before)
        return ok and (self.after is None or np.array_equal(ids[len(ids) - len(self.after) :], self.after))


class Chunked:
    """A text as chunks whose ids are known."""

    def __init__(self, text: bytes, parts: list[Encoded]):
        self.text, self.parts = text, parts
        self.base = np.cumsum([0, *(p.size for p in parts)]).tolist()

    def windows(self, width: int) -> list[Window]:
        """The stretches to encode again, `width` bytes or more to each side of every join."""
        out, done, part = [], 0, 0
        while part + 1 < len(self.parts):
            window = self._around(part, done, width)
            out.append(window)
            done, part = window.right, window.last
            if window.after is None:
                break
        return out

    def _around(self, part: int, done: int, width: int) -> Window:
        chunk, base, join = self.parts[part], self.base[part], self.base[part + 1]
        # The last whole word that is not done and begins early enough.
        word = int(np.searchsorted(chunk.starts, join - width - base, "right")) - 1
        word = min(word, int(np.searchsorted(chunk.ends, chunk.size, "left")) - 1)
        left, before = done, None
        if word >= 0 and chunk.starts[word] + base >= done and (chunk.starts[word] or not part):
            left, before = int(chunk.starts[word]) + base, chunk.word(word)
        # The first whole word that ends late enough, maybe some chunks further on.
        for last in range(part + 1, len(self.parts)):
            chunk, base = self.parts[last], self.base[last]
            word = int(np.searchsorted(chunk.ends, join + width - base, "left"))
            word += bool(word == 0 and len(chunk.starts) and not chunk.starts[0])
            if word < len(chunk.ends) and chunk.ends[word] < chunk.size:
                right = int(chunk.ends[word]) + base
                return Window(left, right, before, chunk.word(word), part, last)
        return Window(left, len(self.text), before, None, part, len(self.parts) - 1)

    def joined(self, windows: list[Window], ids: list[np.ndarray]) -> np.ndarray:
        """The chunks' ids, with those of the windows in their places."""
        out, done, part = [], 0, 0
        for window, found in zip(windows, ids, strict=True):
            out += [self._between(part, done, window.left), found]
            done, part = window.right, window.last
        if self.parts:
            out.append(self._between(part, done, len(self.text)))
        return np.concatenate(out) if out else np.zeros(0, IDS)

    def _between(self, part: int, start: int, end: int) -> np.ndarray:
        chunk, base = self.parts[part], self.base[part]
        words = np.searchsorted(chunk.starts, [start - base, end - base], "left")
        return chunk.ids[slice(*chunk.firsts[words])]


class Codec:
    """Encodes texts by way of their chunks; `shared` are chunks that are known already."""

    def __init__(self, path: str, shared: Iterable[tuple[bytes, bytes, bytes]] = ()):
        self.words = Words(path)
        self.shared = {}
        for part, ids, firsts in shared:
            (starts,), (ends,) = word_bounds([part])
            numbers = np.frombuffer(ids, IDS), np.frombuffer(firsts, "<i4")
            self.shared[part] = Encoded(len(part), starts, ends, *numbers)
        self.table: dict[bytes, Encoded] = {}
        self.held = 0

    def encode_parts(self, parts: list[bytes]) -> list[Encoded]:
        """All parts, encoded together: white space between them keeps them apart."""
        ids, counts = self.words.encode(b" ".join(parts).decode())
        upto = np.r_[0, np.cumsum(counts)].astype(np.int64)
        out, word = [], 0
        for part, starts, ends in zip(parts, *word_bounds(parts), strict=True):
            firsts = upto[word : word + len(starts) + 1]
            own = ids[firsts[0] : firsts[-1]]
            out.append(Encoded(len(part), starts, ends, own, (firsts - firsts[0]).astype(np.int32)))
            word += len(starts)
        return out

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [chunks.chunks(text) for text in texts]
        if self.held > TABLE_BYTES:
            self.table, self.held = {}, 0
        new = [*({p for parts in cut for p in parts} - self.shared.keys() - self.table.keys())]
        self.table.update(zip(new, self.encode_parts(new), strict=True))
        self.held += sum(map(len, new))
        rows = [
            Chunked(text, [self.shared.get(p) or self.table[p] for p in parts])
            for text, parts in zip(texts, cut, strict=True)
        ]
        out: list[np.ndarray | None] = [None] * len(texts)
        todo, width = list(range(len(texts))), WINDOW
        while todo:
            plans = [rows[i].windows(width) for i in todo]
            stretches = [texts[i][w.left : w.right] for i, ws in zip(todo, plans) for w in ws]
            found = iter([e.ids for e in self.encode_parts(stretches)])
            open_ = []
            for i, windows in zip(todo, plans, strict=True):
                ids = [next(found) for _ in windows]
                if all(w.agrees(x) for w, x in zip(windows, ids, strict=True)):
                    out[i] = rows[i].joined(windows, ids)
                else:
                    open_.append(i)
            todo, width = open_, 2 * width
        return out


def shared_chunks(bodies: DataFrame, path: str, count: int = SHARED_CHUNKS) -> list[tuple]:
    """(chunk, ids, numbers of its words' first ids) of the chunks whose reuse saves most, encoded in one stage.

    Each task counts its chunks in a table of bounded size and hands on those it has met again;
    the `count` of them with the most bytes to save come to the driver, at most
    MOST bytes and as many ids each.
    """

    def count_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        held = 0

        def met_again() -> pa.RecordBatch:
            again = {p: n for p, n in seen.items() if n > 1}
            columns = [pa.array(again.keys(), pa.binary()), pa.array(again.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["part", "times"])

        for batch in batches:
            for value in batch.column(0):
                for part in chunks.chunks(value.as_buffer().to_pybytes()):
                    times = seen.get(part, 0)
                    held += 0 if times else len(part)
                    seen[part] = times + 1
                if held > TABLE_BYTES:
                    yield met_again()
                    seen, held = {}, 0
        yield met_again()

    def encode_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            parts = batch.column(0).to_pylist()
            rows = [(e.ids.tobytes(), e.firsts.tobytes()) for e in codec.encode_parts(parts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([r[0] for r in rows], pa.binary()),
                    pa.array([r[1] for r in rows], pa.binary()),
                ],
                ["part", "ids", "firsts"],
            )

    met = bodies.mapInArrow(count_task, "part binary, times bigint")
    total = met.groupBy("part").agg(F.sum("times").alias("times"))
    saved = F.octet_length("part") * F.col("times")
    best = total.orderBy(saved.desc(), "part").limit(count).select("part")
    encoded = stage(best, "shared-chunks").mapInArrow(
        encode_task, "part binary, ids binary, firsts binary"
    )
    return [tuple(map(bytes, r)) for r in encoded.collect()]


def encoded(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None
) -> DataFrame:
    """(key, n_tokens, ids) for every row of `docs`; `ids` as little-endian 32-bit integers.

    The ids are those of the tokenizers library for the file at `path`, without added special
    tokens, truncation or padding; special tokens within a text get their ids.

    A null text counts as empty and has no ids. Null keys and repeated rows stay as they are; other
    columns, whatever their names, are not read; an empty table gives an empty one. A text of any
    length is encoded whole, by one task. Two scans; only chunks that a task has met twice are
    shuffled.
    """
    prepared(docs.sparkSession)
    path = path or tokenizer_path(WORD_FILE)
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("key"), body.alias("body"))
    shared = shared_chunks(rows.select("body"), path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, shared)
        for batch in batches:
            for start, end in slices(batch.column(1), SLICE_BYTES):
                part = batch.slice(start, end - start)
                ids = codec.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype(IDS).tobytes() for x in ids], pa.binary()),
                    ],
                    ["key", "n_tokens", "ids"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    found = rows.mapInArrow(run, f"key {kind}, n_tokens bigint, ids binary")
    return found.withColumnRenamed("key", key)


def token_texts(path: str) -> pa.Array:
    """The text of each id; null where the vocabulary has none."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    top = max(tokenizer.get_vocab(with_added_tokens=True).values(), default=-1)
    return pa.array([tokenizer.id_to_token(i) for i in range(top + 1)], pa.string())


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """`rows` with a column `decoded`: the text of its column `ids`, special tokens included.

    As the library decodes with a vocabulary that names no decoder: the tokens, separated by spaces.
    Ids that the vocabulary lacks give nothing; null ids a null text. Repeated rows stay as they are.
    """
    tokens = token_texts(path or tokenizer_path(WORD_FILE))

    @F.pandas_udf("string")
    def texts(ids: pd.Series) -> pd.Series:
        values, out = pa.array(ids, pa.binary()), []
        for start, end in slices(values, SLICE_BYTES):
            out.append(decode(values.slice(start, end - start), tokens).to_pandas())
        return pd.concat(out) if out else pd.Series([], dtype=object)

    return rows.withColumn("decoded", texts("ids"))


def decode(ids: pa.Array, tokens: pa.Array) -> pa.Array:
    """The texts of lists of ids."""
    sizes = pc.fill_null(pc.binary_length(ids), 0).to_numpy(zero_copy_only=False) // IDS.itemsize
    known = np.frombuffer(b"".join(x for x in ids.to_pylist() if x), IDS)
    found = tokens.take(pa.array(np.minimum(known, len(tokens)), mask=known >= len(tokens)))
    real = found.is_valid().to_numpy(zero_copy_only=False)
    ends = np.r_[0, np.cumsum(real)][np.r_[0, np.cumsum(sizes)]].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), found.drop_null())
    return pc.if_else(ids.is_valid(), pc.binary_join(lists, " "), pa.scalar(None, pa.string()))


def codec_report(rows: DataFrame) -> DataFrame:
    """Digests of the ids and of the decoded text of each document."""
    return decoded(rows).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
