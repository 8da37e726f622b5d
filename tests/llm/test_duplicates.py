"""SimHash groups, repeated byte strings, components: against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import xxhash
from cases import SCHEMA, documents, empty, hostile
from pyspark.sql import functions as F

from shiplog.llm import common, simhash, suffix_buckets, suffix_dedup
from shiplog.llm.components import components


def union_find(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint_by_hand(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def groups_by_hand(rows):
    prints = [fingerprint_by_hand(t) for _, t in rows]
    near = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 2
    ]
    root = union_find(len(rows), near)
    least = {}
    for (k, _), r in zip(rows, root, strict=True):
        if k is not None:
            least[r] = min(least.get(r, k), k)
    return sorted(
        ((k, f"{p:016x}", least.get(r)) for (k, _), p, r in zip(rows, prints, root, strict=True)),
        key=repr,
    )


def near_copies(seed, n=120):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(150, 300))] for _ in range(6)]
    texts = []
    for _ in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        texts.append(" ".join(words))
    return texts


def test_forest_connects_exactly_what_is_near():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**64, 20, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (20, 60, 3)).astype(np.uint64)
    noise = np.bitwise_xor.reduce(flips, axis=2)
    prints = np.unique((centres[:, None] ^ noise).ravel())
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    want = union_find(len(prints), zip(*np.nonzero(near), strict=True))
    place = {int(p): i for i, p in enumerate(prints)}
    child, parent = simhash.forest(prints, 2)
    links = [(place[int(a)], place[int(b)]) for a, b in zip(child, parent, strict=True)]
    assert all(near[a, b] for a, b in links)
    assert union_find(len(prints), links) == want
    assert len(links) == len(prints) - len(set(want))


def test_simhash_groups(spark, monkeypatch):
    rows = list(enumerate(near_copies(1)))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    want = groups_by_hand(rows)
    assert len({r[2] for r in want}) < 60
    assert sorted(map(tuple, simhash.simhash_groups(docs).collect()), key=repr) == want
    # Blocks that are dealt out in parts by population count and salt.
    monkeypatch.setattr(simhash, "BLOCK", 3)
    assert sorted(map(tuple, simhash.simhash_groups(docs).collect()), key=repr) == want


def test_simhash_on_hostile_tables(spark):
    docs = hostile(spark)
    want = groups_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, simhash.simhash_groups(docs).collect()), key=repr) == want
    assert simhash.simhash_groups(empty(spark)).count() == 0
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    # Id 0 names two texts, in two groups.
    roots = {w[2] for w in want}
    assert sorted(r.doc_id for r in kept.collect()) == sorted([0, *(roots - {None})])
    assert simhash.one_per_group(empty(spark)).count() == 0


def test_components_of_long_paths(spark):
    rng = random.Random(4)
    path = list(range(60))
    rng.shuffle(path)
    links = list(zip(path, path[1:], strict=False)) + [(100, 101), (101, 100), (7, 7)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint"))
    want = {i: 0 for i in range(60)} | {100: 100, 101: 100}
    assert {r.node: r.root for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def kept_by_hand(rows, window=200):
    data = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(b[i : i + window] for _, b in data for i in range(len(b) - window + 1))
    out = []
    for k, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = (b"\0" + bytes(gone)).count(b"\0\1")
        out.append((k, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed):
    """Texts that share passages of about the window, cut and edited at random."""
    rng = random.Random(seed)
    letters = "abcé "
    shared = ["".join(rng.choices(letters, k=rng.randrange(150, 700))) for _ in range(8)]
    texts = []
    for _ in range(60):
        text = ""
        for _ in range(rng.randrange(5)):
            p = rng.choice(shared)
            a = rng.randrange(len(p) // 2)
            p = p[a : a + rng.randrange(120, 400)]
            if rng.random() < 0.4 and p:
                i = rng.randrange(len(p))
                p = p[:i] + "#" + p[i + 1 :]
            text += p + "".join(rng.choices(letters, k=rng.randrange(40)))
        texts.append(text)
    return [*texts, "ab" * 300, "a" * 450, "xyz" * 90 + "ab" * 120]


def test_repeats_by_brute_force(spark, monkeypatch):
    for seed, bucket, chunk in ((1, 1024, 1 << 20), (2, 1, 1 << 20), (3, 2, 101)):
        monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", bucket)
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        rows = list(enumerate(passages(seed)))
        docs = documents(spark, [t for _, t in rows])
        got = sorted(map(tuple, suffix_dedup.without_repeats(docs).collect()), key=repr)
        assert got == kept_by_hand(rows)
        assert sum(r[2] for r in got) > 5000 and any(0 < r[2] < r[1] for r in got)


def staged_folders(monkeypatch, tmp_path, run):
    """The result of `run` and the kinds of staged tables that are left then."""
    monkeypatch.setattr(common, "scratch_root", lambda _: str(tmp_path))
    result = sorted(map(tuple, run().collect()), key=repr)
    return result, sorted(f.name.rpartition("-")[0] for f in (tmp_path / "llm" / "staged").iterdir())


def test_rows_of_one_hash_are_told_apart_and_leftovers_go(spark, tmp_path, monkeypatch):
    names = suffix_dedup._names
    monkeypatch.setattr(
        suffix_dedup, "_names", lambda k, t: [F.lit(7).cast("long").alias("row"), names(k, t)[1]]
    )
    rows = list(enumerate(passages(6)))
    docs = documents(spark, [t for _, t in rows])
    for bucket in (1, 1024):
        monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", bucket)
        folder = tmp_path / str(bucket)
        got, left = staged_folders(monkeypatch, folder, lambda: suffix_dedup.without_repeats(docs))
        assert got == kept_by_hand(rows)
        assert left == ["spans"]


def test_simhash_leaves_what_its_result_reads(spark, tmp_path, monkeypatch):
    rows = list(enumerate(near_copies(2, 40)))
    docs = documents(spark, [t for _, t in rows])
    got, left = staged_folders(monkeypatch, tmp_path / "a", lambda: simhash.simhash_groups(docs))
    assert got == groups_by_hand(rows) and left == ["groups", "prints"]
    _, left = staged_folders(monkeypatch, tmp_path / "b", lambda: simhash.one_per_group(docs))
    assert left == ["kept"]


def test_repeats_on_hostile_tables(spark):
    docs = hostile(spark)
    twice = docs.union(docs.filter("doc_id = 10"))
    got = sorted(map(tuple, suffix_dedup.without_repeats(twice).collect()), key=repr)
    want = sorted((r.doc_id, len((r.text or "").encode())) for r in twice.collect() if r.doc_id is not None)
    assert sorted(r[:2] for r in got if r[0] is not None) == want
    assert [r[2] for r in got if r[0] == 10] == [len(t.encode()) for t in [docs.filter("doc_id = 10").first().text] * 2]
    assert suffix_dedup.without_repeats(empty(spark)).count() == 0
    spans = suffix_dedup.repeated_spans(twice, into="key")
    assert spans.columns == docs.columns


def test_anchors_cover_every_window_once():
    rng = np.random.default_rng(2)
    for data in (rng.integers(97, 101, 3000), np.full(900, 97), np.tile([97, 98, 99], 300)):
        data = data.astype(np.uint8)
        bucket, _, first, windows, place = suffix_buckets.anchors(*suffix_buckets.refined(data))
        covered = np.concatenate([np.arange(a, a + n) for a, n in zip(first, windows, strict=True)])
        assert covered.tolist() == list(range(len(data) - 199))
        assert (first + windows - 1 <= place).all() and (place + 64 <= first + 200).all()
        assert len(bucket) == len(first)
