"""Periodic runs: against all lags and all stretches, on small and hostile tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from cases import by_id, documents, empty, hostile

from shiplog.llm.periodic_runs import (
    lag_scan,
    periodic_runs,
    run_report,
    runs_of,
    with_planted_runs,
)


def plain_runs(words):
    """All (start, length, period), by looking at every lag and every stretch."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            shorter = any(
                all(words[k] == words[k + p] for k in range(start, end - p)) for p in range(1, q)
            )
            if end - start >= max(6, 4 * q) and not shorter:
                out.append((start, end - start, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_kept(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def repetitive(rng):
    words = []
    while len(words) < rng.randrange(90):
        words += [rng.randrange(3) for _ in range(rng.randrange(1, 7))] * rng.randrange(1, 9)
    return words


def test_runs_are_those_of_all_lags():
    rng = random.Random(5)
    for _ in range(400):
        docs = [repetitive(rng) for _ in range(4)]
        bounds = np.r_[0, np.cumsum([len(d) for d in docs])]
        runs, kept = runs_of(np.array(sum(docs, []), np.int64), bounds)
        assert runs == [plain_runs(d) for d in docs]
        for d, rs, a, b in zip(docs, runs, bounds, bounds[1:], strict=False):
            assert [w for w, k in zip(d, kept[a:b], strict=True) if k] == plain_kept(d, rs)


@pytest.mark.parametrize(
    "words, want",
    [
        (np.zeros(100_000, np.int64), [(0, 100_000, 1)]),
        (np.tile(np.arange(1000), 50), [(0, 50_000, 1000)]),
        (np.arange(50_000), []),
    ],
)
def test_long_texts_take_few_comparisons(words, want):
    assert lag_scan(words) == want


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, words_of(text))
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    lines = "".join("{},{},{}\n".format(*r) for r in runs)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(" ".join(plain_kept(words, runs)).encode()).hexdigest(),
    )


def test_report_on_documents(spark):
    rng = random.Random(8)
    texts = [" \t".join(f"w{x}" for x in repetitive(rng)) + "\n" * (i % 2) for i in range(150)]
    texts += [" ".join(rng.choices("abcdefg", k=rng.randrange(40))) for _ in range(150)]
    got = run_report(periodic_runs(with_planted_runs(documents(spark, texts))))
    rows = by_id(got)
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert tuple(rows[i]) == expected(i, text)


def test_hostile_and_empty_tables(spark):
    docs = hostile(spark)
    got = run_report(periodic_runs(with_planted_runs(docs)))
    short = docs.filter("text is null or length(text) < 1000").select("doc_id", "text").collect()
    want = [expected(*r) for r in short]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == docs.count()
    assert all(rows.count(w) == want.count(w) for w in want)
    plain = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert plain[4].n_words == 0 and plain[4].runs == [] and plain[4].collapsed == ""
    assert run_report(periodic_runs(with_planted_runs(empty(spark)))).count() == 0
