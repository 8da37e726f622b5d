"""Encoding by chunks: ids and decoded texts are those of the tokenizers library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from cases import LONG, TEXTS, documents, empty, hostile
from tokenizers import Tokenizer

from shiplog.llm import bpe_codec, chunks
from shiplog.llm.bpe_codec import Codec, codec_report, decode, encoded, shared_chunks, token_texts
from shiplog.llm.common import tokenizer_path

PATH = tokenizer_path(bpe_codec.WORD_FILE)
LETTERS = " \n\t\x1c\x0b　\xa0 ̧́abcdeABCÀÉÑßİıſ'''sretvmldo019²½漢字😀_-!?.,;<|>ȺƁΣσςé\0\x85ﬁẞ"
WORDS = ["the", "'s", "don't", "x.y", "<|endoftext|>", "<|startof", "text|>", "é", "́", "I'LL", "漢", "''s", " "]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def strange(n):
    rng = random.Random(9)
    out = ["".join(rng.choices(LETTERS, k=rng.randrange(120))) for _ in range(n)]
    out += ["".join(rng.choice(WORDS) + rng.choice(["", " "]) for _ in range(60)) for _ in range(n)]
    return [*out, "a" * 5000, "x " + "é漢" * 2000, "'s" * 500, "<|endoftext|>" * 200, "", " ", "\0"]


def wanted(library, texts):
    return [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_tiny_chunks_are_joined_without_a_trace(library, monkeypatch):
    for name, value in (("LEAST", 3), ("MEAN", 4), ("MOST", 12)):
        monkeypatch.setattr(chunks, name, value)
    monkeypatch.setattr(bpe_codec, "WINDOW", 2)
    texts = strange(1200)
    got = Codec(PATH).encode([t.encode() for t in texts])
    assert [g.tolist() for g in got] == wanted(library, texts)


def test_words_of_any_make(library):
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoinshrdlu'19.", k=rng.randrange(1, 14))) for _ in range(20_000)]
    vocabulary = [t.removesuffix("</w>") for t in library.get_vocab() if t.endswith("</w>")]
    text = " ".join([*words, *(v for v in vocabulary if v.isascii())])
    assert Codec(PATH).encode([text.encode()])[0].tolist() == wanted(library, [text])[0]


def test_a_disagreeing_window_grows(library):
    codec = Codec(PATH)
    texts = [LONG.encode()[:9000]]
    parts = chunks.chunks(texts[0])
    known = codec.encode_parts(parts)
    first = bpe_codec.Chunked(texts[0], known).windows(bpe_codec.WINDOW)
    # A chunk whose ids of the word before its end are wrong never agrees there.
    word = int(np.searchsorted(known[0].starts, len(parts[0]) - bpe_codec.WINDOW, "right")) - 1
    spoilt = known[0].ids.copy()
    spoilt[known[0].firsts[word]] += 1
    codec.table = dict(zip(parts, known, strict=True))
    codec.table[parts[0]] = bpe_codec.Encoded(
        known[0].size, known[0].starts, known[0].ends, spoilt, known[0].firsts
    )
    assert first[0].before is not None
    assert codec.encode(texts)[0].tolist() == wanted(library, [texts[0].decode()])[0]


def test_chunks_cover_texts_and_shared_passages_cut_alike():
    rng = random.Random(1)
    passage = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(2000))
    a, b = (("".join(rng.choices("xyz é漢", k=700)) + passage).encode() for _ in range(2))
    cut_a, cut_b = chunks.chunks(a), chunks.chunks(b)
    assert b"".join(cut_a) == a and all(p.decode() for p in cut_a)
    assert max(map(len, cut_a)) <= chunks.MOST + 3
    shared = set(cut_a) & set(cut_b)
    assert sum(map(len, shared)) > 0.8 * len(passage)
    assert chunks.chunks(b"") == []


def test_decoding(library):
    rng = random.Random(2)
    lists = [[rng.randrange(49_408) for _ in range(rng.randrange(20))] for _ in range(200)]
    lists += [[49_500, 5], [], None]
    want = [None if x is None else library.decode(x, skip_special_tokens=False) for x in lists]
    ids = pa.array([None if x is None else np.array(x, "<u4").tobytes() for x in lists], pa.binary())
    assert decode(ids, token_texts(PATH)).to_pylist() == want


def digest(data):
    return hashlib.sha256(data).hexdigest()


def test_query_on_hostile_tables(spark, library):
    docs = hostile(spark)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        row = (r.doc_id, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(text.encode()))
        want.append(row)
    got = [tuple(r) for r in codec_report(encoded(docs)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert codec_report(encoded(empty(spark))).count() == 0


def test_shared_chunks_are_found_and_used(spark, library):
    texts = [f"{i} {LONG[:20_000]} {i}" for i in range(12)] + [t or "" for t in TEXTS]
    docs = documents(spark, texts).coalesce(2)
    shared = shared_chunks(docs.selectExpr("cast(text as binary) as body"), PATH)
    assert sum(part in LONG.encode() for part, _, _ in shared) > 10
    codec = Codec(PATH, shared)
    got = codec.encode([t.encode() for t in texts])
    assert [g.tolist() for g in got] == wanted(library, texts)
    assert not codec.table.keys() & codec.shared.keys()
