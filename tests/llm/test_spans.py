"""Personal data and leaked test items: patterns, alignments and planted cases by hand."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, documents, empty, hostile

from shiplog.llm import decontamination, pii

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def base_by_hand(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, *m.span()))
    return pii.ordered(found)


def test_base_spans_are_the_patterns():
    rng = random.Random(1)
    alphabets = ("a.@-1 ", "0123.5 ", "+1 (-)0", "12 -+.@a", "@a.@_é", "4 -1")
    for _ in range(40_000):
        text = "".join(rng.choices(rng.choice(alphabets), k=rng.randrange(40)))
        assert pii.base_spans(text) == base_by_hand(text)
    # Long runs stay quick.
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" * 50_000, "@a" * 50_000):
        pii.base_spans(text)


def letters(rng, n):
    return " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(n))


def private(rng):
    digits = [4, *(rng.randrange(10) for _ in range(14))]
    card = "".join(map(str, digits))
    card += next(c for c in "0123456789" if pii.luhn(card + c))
    parts = [
        f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
        card,
        ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
        f"{letters(rng, 1)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
    ]
    return rng.choice(parts)


def test_field_adds_what_the_patterns_miss(spark):
    rng = random.Random(3)
    texts = [f"{letters(rng, 5)} {private(rng)} {letters(rng, 5)} v{i}.4" for i in range(240)]
    texts += ["ring (415) 555-1234 today", "on 2024-01-15 we met", "+1 (836) 555-9331 4913187196670932 x"]
    texts += ["version 3.14.15 of 12345678 items", "no digits at all"]
    docs = documents(spark, texts)
    found = {r.doc_id: r for r in pii.personal_data(docs, sample_rows=200).collect()}
    spans = {}
    for i, text in enumerate(texts):
        base, row = base_by_hand(text), found[i]
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert row.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        spans[i] = [tuple(s.split(":")) for s in row.spans.split(",") if s]
        assert {(k, str(a), str(b)) for k, a, b in base} <= set(spans[i])
        assert spans[i] == sorted(spans[i], key=lambda s: (int(s[1]), pii.KINDS.index(s[0])))
    assert spans[240] == [("phone", "5", "19")]
    assert [k for k, *_ in spans[242]] == ["phone", "card"]
    assert spans[241] == spans[243] == spans[244] == []
    masked = {r.doc_id: r.text for r in pii.redacted(docs, sample_rows=200).collect()}
    assert masked[240] == "ring <PHONE> today" and masked[244] == texts[244]
    assert not any(base_by_hand(t) for t in masked.values())


def test_personal_data_on_hostile_tables(spark):
    docs = hostile(spark)
    found = pii.personal_data(docs).collect()
    assert len(found) == docs.count()
    none = hashlib.sha256(b"").hexdigest()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all((r.base_sha256 == none) == (r.n_email + r.n_phone == 0) for r in found)
    assert [r.spans for r in found if r.doc_id == 8] == ["email:5:13,phone:22:39"]
    masked = pii.redacted(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert {r.doc_id: r.text for r in masked.collect()}[8] == "mail <EMAIL> or call <PHONE> now"
    assert texts[8] and pii.personal_data(empty(spark)).count() == 0


def best_cut_by_hand(field, lattice):
    """Every cut of the island, scored one by one."""
    out, turns = len(pii.KINDS), field.turns()

    def cuts(j, last):
        if j == len(lattice):
            yield 0.0, ()
            return
        for s, rest in cuts(j + 1, out):
            yield s + turns[last, out], rest
        for e in range(j + 1, len(lattice) + 1):
            for i, found in lattice.into[e]:
                if i == j:
                    for k, score in enumerate(field.scores(found)):
                        for s, rest in cuts(e, k):
                            yield s + turns[last, k] + score - pii.MARGIN, ((k, j, e), *rest)

    return max(cuts(0, out), key=lambda c: c[0])


def test_decoding_is_the_best_cut_and_the_gradient_is_right():
    rng = np.random.default_rng(1)
    field = pii.Field()
    field.w[:] = rng.normal(0, 0.4, field.w.size)
    for text in ("12 +34 5678", "a@b.co 1234", "(12) 34-56"):
        lattice = pii.Lattice(text, 0, len(text))
        _, best = best_cut_by_hand(field, lattice)
        got = sorted(field.best(lattice), key=lambda s: s[1])
        assert got == [(pii.KINDS[k], lattice.starts[i], lattice.ends[e - 1]) for k, i, e in best]
    lattice = pii.Lattice("12 3456", 0, 7)
    i, e = next((i, e) for e, x in enumerate(lattice.into) for i, _ in x)
    gold = {(i, e): 2}
    at, grad = field.gradient(lattice, gold)
    total = np.bincount(at, grad, field.w.size)

    def likelihood():
        score, j, last, out = 0.0, 0, len(pii.KINDS), len(pii.KINDS)
        while j < len(lattice):
            if j == i:
                found = dict(lattice.into[e])[i]
                score += field.turns()[last, 2] + field.scores(found)[2]
                j, last = e, 2
            else:
                score += field.turns()[last, out]
                j, last = j + 1, out
        return score - np.logaddexp.reduce(field.forward(lattice)[-1])

    for c in rng.choice(np.unique(at), 12, replace=False):
        field.w[c] += 1e-5
        up = likelihood()
        field.w[c] -= 2e-5
        down = likelihood()
        field.w[c] += 1e-5
        assert abs((up - down) / 2e-5 - total[c]) < 1e-4


def test_spans_of_long_islands_are_those_of_the_whole_lattice():
    rng, texts = random.Random(5), []
    for alphabet in ("0123456789 ", "0123456789 .-()+", "ab1@. 2\n", "12é٣@._ x-+(", "1 2.3-4+(5)a@b.c\n_"):
        texts += ["".join(rng.choices(alphabet, k=rng.randrange(1, 160))) for _ in range(60)]
    for seed, text in enumerate(texts):
        field = pii.Field()
        field.w[:] = np.random.default_rng(seed).normal(0.3 * (seed % 3), 0.8, field.w.size)
        lattice = pii.Lattice(text, 0, len(text))
        # Two pieces beside each other, which no span may cross.
        found = list(pii.decoded(field, [(3, text, 0, len(text)), (seed, text, 0, len(text))]))
        best = sorted(field.best(lattice))
        assert sorted(found) == sorted([(3, s) for s in best] + [(seed, s) for s in best])
        plain = [
            (lattice.starts[i], lattice.ends[j - 1], sorted(found))
            for j, here in enumerate(lattice.into)
            for i, found in here
        ]
        blocks = pii.candidates([(0, text, 0, len(text))], block=7)
        grown = [
            (a, b, sorted(f))
            for spans, slots in blocks
            for *_, a, b, f in zip(*(c.tolist() for c in spans), slots.tolist(), strict=True)
        ]
        assert sorted(plain) == sorted(grown)


def align_by_hand(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = decontamination.MATCH if a[i - 1] == b[j - 1] else decontamination.MISMATCH
            h[i][j] = max(0, h[i - 1][j - 1] + s, h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_scores():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(1, 14)) for _ in range(2))
        assert decontamination.align(a, b)[0] == align_by_hand(a.tolist(), b.tolist())


def test_copies_and_edited_copies_are_found(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(2000)]
    items = [" ".join(rng.choices(words, k=rng.randrange(15, 60))) for _ in range(12)]
    texts, want = [], {}
    for i in range(200):
        text = rng.choices(words, k=rng.randrange(50, 400))
        if i % 5 == 0:
            item, which = items[i // 5 % 12].split(), i // 5 % 12
            for _ in range(len(item) // 8 if i % 2 else 0):
                item[rng.randrange(len(item))] = "edited"
            if i % 3 == 0:
                del item[len(item) // 2]
            at = rng.randrange(len(text))
            text[at:at] = [x.upper() + "," for x in item]
            want[i] = (which, at, at + len(item))
        texts.append(" ".join(text))
    docs = documents(spark, texts)
    table = spark.createDataFrame(
        [*enumerate(items), (50, None), (51, ""), (52, "two words"), (53, "..."), (3, items[3])],
        "item_id bigint, text string",
    )
    for block in (10_000, 4):
        monkeypatch.setattr(decontamination, "BLOCK_ITEMS", block)
        found = decontamination.find_leaks(docs, table, block_items=block).select("doc_id", "leaks").collect()
        got = {r.doc_id: r.leaks for r in found if r.leaks}
        assert got.keys() == want.keys()
        for i, leaks in got.items():
            which, a, b = want[i]
            assert [x.item for x in leaks] == [which] and leaks[0].score >= 0.5
            assert abs(leaks[0].first - a) <= 3 and abs(leaks[0].end - b) <= 3
    exact = [r for r in decontamination.contaminated(docs, table).collect() if r.score == 1]
    assert {r.doc_id for r in exact} >= {i for i in want if i % 2 == 0 and i % 3}
    left = decontamination.without_leaks(docs, table)
    assert {r.doc_id for r in left.collect()} == set(range(200)) - want.keys()


def test_leaks_on_hostile_tables(spark):
    docs = hostile(spark)
    items = spark.createDataFrame(
        [(1, "the quick brown fox jumps over the lazy dog"), (None, "mail a.b@c.de or call"), (2, None)],
        "item_id bigint, text string",
    )
    found = sorted(((r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()), key=repr)
    assert found == sorted([(0, 1), (0, 1), (1, 1), (2, 1), (8, None), (None, 1)], key=repr)
    left = decontamination.without_leaks(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 6
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0
    assert decontamination.contaminated(empty(spark), items).count() == 0


def test_schema_of_items_may_be_text(spark):
    docs = spark.createDataFrame([(1, "x one two three four y", None, None, None)], SCHEMA)
    items = spark.createDataFrame([("q", "one two three four")], "item_id string, text string")
    assert [tuple(r)[:3] for r in decontamination.contaminated(docs, items).collect()] == [(1, "q", 1.0)]


EDITS = {
    "every third word": lambda rng, w: ["x" if k % 3 == 2 else v for k, v in enumerate(w)],
    "replaced": lambda rng, w: ["x" if rng.random() < 0.25 else v for v in w],
    "inserted": lambda rng, w: [u for v in w for u in ([v, "x"] if rng.random() < 0.3 else [v])],
    "deleted": lambda rng, w: [v for v in w if rng.random() > 0.3],
    "upper case and marks": lambda rng, w: [f"({v.upper()})," for v in w],
}


@pytest.mark.parametrize("edit", EDITS)
def test_recall_against_full_alignment(edit):
    """Every item is aligned with every whole text; the seeds find 0.95 of what that finds, at least."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [rng.choices(vocabulary, k=rng.randrange(12, 50)) for _ in range(60)]
    texts = []
    for k in range(240):
        text = rng.choices(vocabulary, k=rng.randrange(0, 200))
        at = rng.randrange(len(text) + 1)
        text[at:at] = EDITS[edit](rng, items[k % 60]) if k % 4 else []
        texts.append(" ".join(text))
    block = decontamination.Items([(i, " ".join(w)) for i, w in enumerate(items)])
    rows = list(decontamination.numbers(pa.array(texts), block.vocabulary))
    words = np.concatenate(rows)
    counts = np.bincount(words[words >= 0], minlength=block.size)
    block.choose_seeds(counts / len(words))
    full = {
        (t, i)
        for t, row in enumerate(rows)
        for i, item in enumerate(block.words)
        if decontamination.align(item, row)[0] >= decontamination.THRESHOLD * 2 * len(item)
    }
    found = {(t, i) for t, row in enumerate(rows) for i, *_ in block.leaks(row)}
    assert len(full) > 100 and found <= full
    assert len(found) >= 0.95 * len(full)


def test_items_of_one_and_two_words(spark):
    docs = documents(spark, ["a solitary word", "Two, words here", "two other words", "", None])
    items = spark.createDataFrame([(1, "solitary"), (2, "two words"), (3, " - ")], "item_id int, text string")
    found = decontamination.contaminated(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.score) for r in found) == [(0, 1, 1.0), (1, 2, 1.0)]
    assert {r.doc_id for r in decontamination.without_leaks(docs, items).collect()} == {2, 3, 4}
