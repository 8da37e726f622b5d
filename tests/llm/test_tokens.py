"""Token counts, token ids, packing: against the tokenizers library and by round trip."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import LONG, TEXTS, by_id, documents, empty, hostile
from tokenizers import Tokenizer

from shiplog.llm.common import tokenizer_path
from shiplog.llm.packed_output import packed_blocks, read_sequences, write_packed
from shiplog.llm.packing import best_fit, pack
from shiplog.llm.token_counts import Counter, token_counts
from shiplog.llm.token_ids import Encoder

LETTERS = " \n\t\x1c　abcdeABC'stremdl019²½éß漢字😀_-!?.,;<|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def strange(n):
    rng = random.Random(7)
    made = ["".join(rng.choices(LETTERS, k=rng.randrange(50))) for _ in range(n)]
    made += [" ".join(rng.choices(["the", "'s", "ab1", "don't", "éa", "x.y"], k=30)) for _ in range(50)]
    return [*made, "a" * 5000, "ab" * 3000, "a " + "é漢" * 3000, "aaa" * 7 + "!" * 999, LONG]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_and_ids_are_the_librarys(library):
    rng = random.Random(11)
    blanks = ["".join(rng.choices(" \n\t\xa0\x1cab'", k=rng.randrange(40))) for _ in range(3000)]
    texts = [*strange(3000), *blanks, *(t or "" for t in TEXTS)]
    want = [ids_of(library, t) for t in texts]
    path = tokenizer_path()
    assert Counter(path).count(texts) == [len(w) for w in want]
    assert [np.frombuffer(b, "<u4").tolist() for b in Encoder(path).encode(texts)] == want


def test_counts_on_hostile_tables(spark, library):
    docs = hostile(spark)
    got = sorted((tuple(r) for r in token_counts(docs).collect()), key=repr)
    want = []
    for r in docs.collect():
        n = len(ids_of(library, r.text))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
    assert got == sorted(want, key=repr)
    assert token_counts(empty(spark)).count() == 0


def naive_best_fit(lengths, capacity):
    rooms, out = [], []
    for n in lengths:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if fits:
            room, i = min(fits)
        else:
            rooms.append(capacity)
            room, i = capacity, len(rooms) - 1
        rooms[i] = room - n
        out.append((room, n))
    return out, len(rooms)


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(3)
    for capacity in (1, 7, 64, 100):
        lengths = sorted((rng.randrange(1, capacity + 1) for _ in range(300)), reverse=True)
        placed = list(best_fit(lengths, capacity))
        used = defaultdict(int)
        rooms = []
        for (window, offset), n in zip(placed, lengths, strict=True):
            assert used[window] == offset and offset + n <= capacity
            rooms.append((capacity - offset, n))
            used[window] += n
        want, windows = naive_best_fit(lengths, capacity)
        assert rooms == want and len(used) == windows


def test_pieces_are_the_documents_and_sequences_have_no_gaps(spark, library):
    docs = hostile(spark)
    found = pack(docs, capacity=64, shard_pieces=100).collect()
    want = defaultdict(int)
    for r in docs.collect():
        ids = [*ids_of(library, r.text), 1]
        for at in range(0, len(ids), 64):
            part = np.array(ids[at : at + 64], "<u4")
            want[r.doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in found:
        got[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 64
    total = sum(len(p) for p in sequences.values())
    assert total == len(found)
    assert pack(empty(spark)).count() == 0


def test_packed_matrices_give_the_ids_back(spark, library, tmp_path):
    docs = hostile(spark).repartition(2)
    path = str(tmp_path / "packed")
    write_packed(docs, path, capacity=64, block_ids=20_000)
    blocks = spark.read.parquet(path).collect()
    pieces = defaultdict(list)
    for b in blocks:
        matrix = np.frombuffer(b.ids, b.dtype).reshape(b.n_rows, b.width)
        for row, keys, starts, cu, resets in zip(
            matrix, b.doc_keys, b.doc_starts, b.cu_seqlens, b.resets, strict=True
        ):
            assert cu[0] == 0 and len(cu) == len(keys) + 1
            assert resets == (cu if cu[-1] < 64 else cu[:-1])
            assert not row[cu[-1] :].any()
            for k, s, a, e in zip(keys, starts, cu, cu[1:], strict=False):
                pieces[k].append((s, tuple(row[a:e].tolist())))
    want = defaultdict(list)
    for r in docs.collect():
        ids = [*ids_of(library, r.text), 1]
        want[r.doc_id] += [(a, tuple(ids[a : a + 64])) for a in range(0, len(ids), 64)]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    rows = read_sequences(spark, path).collect()
    assert len(rows) == sum(b.n_rows for b in blocks) == len({r.sequence_id for r in rows})
    assert sum(r.n_ids for r in rows) == sum(len(p) for v in want.values() for _, p in v)
    assert packed_blocks(empty(spark)).count() == 0


def test_one_document_alone(spark, library):
    got = by_id(pack(documents(spark, ["one"])))
    assert got[0].length == 2 and got[0].offset == 0
