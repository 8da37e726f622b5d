"""Toxicity, language and quality rules: held-out accuracy and base statistics by hand."""

import math
import random
import re
import zlib
from collections import Counter

import xxhash
from cases import SCHEMA, by_id, empty, hostile
from pyspark.sql import functions as F

from shiplog.llm import language_id as profiling
from shiplog.llm import quality_rules as rules
from shiplog.llm import toxicity as ftrl
from shiplog.llm.common import sampled
from shiplog.llm.language_id import language_id
from shiplog.llm.quality_rules import BASE, keep_good, learn_rules, quality
from shiplog.llm.toxicity import toxicity

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held(i, parts, rest):
    return i is not None and zlib.crc32(str(i).encode()) % parts == rest


def insults(n=1500):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    rows, labels = [], []
    for i in range(n):
        text, toxic = rng.choices(words, k=rng.randrange(30, 80)), int(rng.random() < 0.2)
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["Idiot,", "moron", "SCUM"]))
        rows.append((i, " ".join(text), None, None, None))
        labels.append((i, toxic))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = insults()
    docs = spark.createDataFrame(rows, SCHEMA)
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = by_id(toxicity(docs, table))
    assert all(r.held_out == held(i, 3, 1) and 0 <= r.score <= 1 for i, r in found.items())
    assert all(r.predicted == (r.score >= 0.7) for r in found.values())
    test = [(y, found[i].predicted) for i, y in labels if found[i].held_out]
    right = sum(y == p for y, p in test)
    assert right / len(test) > 0.97
    assert not any(p for y, p in test if not y)


def plain_features(text):
    words = [w.lower().strip(ftrl.EDGES) for w in text.split()]
    words = [xxhash.xxh64_intdigest(w.encode(), 7) for w in words if w]
    found = list(words)
    for gap in (1, 2):
        for a, b in zip(words, words[gap:], strict=False):
            found.append(((a * 0x9E3779B97F4A7C15 + gap) % 2**64) ^ (b >> 7))
    mixed = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % 2**64 for x in found)
    return {(x >> 40) % 2**ftrl.BITS for x in mixed}


def test_toxicity_scores_are_those_of_plain_ftrl(spark):
    rows, labels = insults(240)
    rows.append((1000, "", None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    texts, z, n = {r[0]: r[1] for r in rows}, Counter(), Counter()

    def weight(f):
        l1 = ftrl.L1 if f != "bias" else 0.0
        if abs(z[f]) <= l1:
            return 0.0
        return -(z[f] - math.copysign(l1, z[f])) / ((ftrl.BETA + math.sqrt(n[f])) / ftrl.ALPHA + ftrl.L2)

    order = table.orderBy(F.xxhash64("doc_id")).collect()
    taught = [(r.toxic, plain_features(texts[r.doc_id]) | {"bias"}) for r in order if not held(r.doc_id, 3, 1)]
    for _ in range(ftrl.EPOCHS):
        for y, at in taught:
            w = {f: weight(f) for f in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for f in at:
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / ftrl.ALPHA * w[f]
                n[f] += g * g
    # The three words that tell, at least, and the bias.
    assert sum(weight(f) != 0 for f in z) >= 4
    for i, r in by_id(toxicity(docs, table)).items():
        total = sum(weight(f) for f in plain_features(texts[i]) | {"bias"})
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-4


def test_toxicity_on_hostile_tables(spark):
    docs = hostile(spark)
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1)], "doc_id bigint, toxic int")
    found = toxicity(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    nothing = toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    assert toxicity(empty(spark), labels).count() == 0


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = by_id(language_id(docs))
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert all(r.held_out == held(i, 4, 2) for i, r in found.items())
    test = [found[i].lang_pred == lang for i, lang in truth.items() if found[i].held_out]
    assert len(test) > 150 and sum(test) / len(test) > 0.97


def plain_grams(text):
    """One to three letters of words between blanks, counted one by one."""
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    found = Counter()
    for word in clean.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                part = padded[i : i + n]
                if (n == 1 and part != " ") or (n == 2) or (n == 3 and part[1] != " "):
                    found[part] += 1
    return found


def number(gram):
    codes = [1 if c == " " else ord(c) for c in gram]
    return sum(c << 21 * i for i, c in enumerate(reversed(codes)))


def plain_order(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:size]


def test_language_by_plain_out_of_place_distances(spark, monkeypatch):
    rng = random.Random(8)
    words = {x: ["".join(rng.choices(x, k=rng.randrange(2, 8))) for _ in range(30)] for x in ("abcdeé", "defghß", "ghiaσς")}
    rows = []
    for i in range(90):
        lang = rng.choice(list(words))
        text = " ".join(rng.choices(words[lang], k=rng.randrange(1, 40))) + rng.choice(["", ". 12", "\0ΑΣ", "\n-"])
        rows.append((i, text, lang, None, None))
    rows += [(90, "", None, None, None), (91, "12 !", None, None, None), (92, None, "abcdeé", None, None)]
    learned = {}
    for i, text, lang, *_ in rows:
        if text and lang and not held(i, 4, 2):
            learned.setdefault(lang, Counter()).update(plain_grams(text))
    size = 40
    profiles = {k: {g: r for r, g in enumerate(plain_order(c, size))} for k, c in learned.items()}
    want = {}
    for i, text, *_ in rows:
        own = plain_order(plain_grams(text or ""), size)
        away = {
            k: sum(abs(p[g] - r) if g in p else size for r, g in enumerate(own))
            for k, p in sorted(profiles.items())
        }
        best = min(away, key=away.get)
        want[i] = (best, 1 - away[best] / (size * len(own))) if own else ("und", 0.0)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id(docs, size=size).collect()}
    assert got == want
    texts = [t or "" for _, t, *_ in rows]
    for chars in (1, 5, 1 << 20):
        monkeypatch.setattr(profiling, "CHARS", chars)
        found = [dict(zip(x[0].tolist(), x[1].tolist(), strict=True)) for x in profiling.by_row(texts, len(texts))]
        assert found == [{number(g): n for g, n in plain_grams(t).items()} for t in texts]


def test_language_on_hostile_tables(spark):
    docs = hostile(spark)
    found = language_id(docs).collect()
    assert len(found) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id}
    for r in found:
        if r.doc_id:
            lettered = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred != "und") == lettered and 0 <= r.score <= 1
    unlabelled = language_id(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in unlabelled.collect()} == {("und", 0.0)}
    assert language_id(empty(spark)).count() == 0


def statistics(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen, repeated = Counter(windows), [0] * len(w)
    for i, x in enumerate(windows):
        if seen[x] > 1:
            repeated[i : i + 8] = [1] * 8
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = sum(repeated)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 20 or 100 * n > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), n, failed


def labels_of(spark, docs):
    """Bad where symbols abound, which the list has to find."""
    return docs.select("doc_id", F.when(F.col("text").contains("### "), 0).otherwise(1).alias("quality"))


def prose(spark, n=400):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(10, 90))]
        if i % 5 == 0:
            words = [x + "###" for x in words]
        if i % 7 == 0:
            words += ["one two three four five six seven eight nine"] * rng.randrange(1, 9)
        text = " ".join(words)
        rows.append((i, text.replace(" w1", "\nw1") if i % 3 else text, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


def test_quality_statistics_and_list(spark):
    docs = prose(spark)
    strange = hostile(spark).filter("doc_id > 2").withColumn("doc_id", F.col("doc_id") + 10_000)
    docs = docs.union(strange.select(docs.columns))
    labels = labels_of(spark, docs)
    found = by_id(quality(docs, labels))
    for r in docs.collect():
        got = found[r.doc_id]
        assert (*(got[c] for c in BASE), got.base_failed) == statistics(r.text)
        bad = "### " in (r.text or "")
        assert got.kept == (not got.base_failed and not bad)
    rules = learn_rules(docs, labels)
    assert {c.name for rule in rules for c in rule} <= {"symbols_per_word", "chars_per_word"}


def test_quality_on_hostile_tables(spark):
    docs = hostile(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 0), (2, None)], "doc_id bigint, quality int")
    found = quality(docs, labels).collect()
    assert len(found) == docs.count()
    want = sorted(statistics(r.text) for r in docs.collect())
    assert sorted((*(r[c] for c in BASE), r.base_failed) for r in found) == want
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in found)
    assert quality(empty(spark), labels).count() == 0
    assert learn_rules(docs, labels.limit(0)) == []


def test_samples_are_full_whatever_the_table_claims_to_hold(spark, monkeypatch):
    rows = spark.range(5000).withColumn("doc_id", F.col("id"))
    order = F.xxhash64("doc_id")
    least = sorted(r[0] for r in rows.select(order).collect())[:700]
    with monkeypatch.context() as patched:
        patched.setattr(type(rows), "count", lambda self: 10**11)
        found = sampled(rows, order, 700)
        every = sampled(rows, order, 9000).collect()
        none = sampled(rows.limit(0), order, 5).collect()
    assert sorted(r[0] for r in found.select(order).collect()) == least
    assert len(every) == 5000 and none == []


def covered_by_hand(rows, cuts):
    """Rules of (name, above, threshold), grown and pruned over plain rows."""

    def holds(rule, r):
        return all(r[name] > t if above else r[name] <= t for name, above, t in rule)

    def count(some):
        return sum(r["bad"] for r in some), sum(1 - r["bad"] for r in some)

    least = rules.LEAST_SHARE * sum(r["prunes"] and r["bad"] for r in rows)
    found, left = [], rows
    while len(found) < rules.MAX_RULES:
        rule = []
        while len(rule) < rules.MAX_CONDITIONS:
            inside = [r for r in left if not r["prunes"] and holds(rule, r)]
            p0, n0 = count(inside)
            best = 0.0, None
            for name in sorted(cuts) if p0 else ():
                for t in cuts[name]:
                    for above in (True, False):
                        p, n = count([r for r in inside if holds([(name, above, t)], r)])
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0
                        if gain > best[0] + 1e-9:
                            best = gain, (name, above, t)
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        scored = []
        for k in range(1, len(rule) + 1):
            p, n = count([r for r in left if r["prunes"] and holds(rule[:k], r)])
            scored.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n))
        _, k, p, n = max(scored)
        if p <= least or p < rules.LEAST_PRECISION * (p + n):
            break
        found.append(tuple(rule[:-k]))
        left = [r for r in left if not holds(rule[:-k], r)]
    return found


def test_the_learned_list_is_that_of_plain_sequential_covering(spark):
    rng, texts, labels = random.Random(11), [], []
    for i in range(400):
        words = [rng.choice("abcdefgh") * rng.randrange(2, 9) + str(rng.randrange(99)) for _ in range(60)]
        kind = rng.randrange(5)
        if kind == 0:
            words = [w + rng.choice("#*$%&|") for w in words]
        elif kind == 1:
            words = [w[:2] for w in words]
        texts.append((i, " ".join(words), None, None, None))
        # Some labels are wrong.
        labels.append((i, int((kind > 1) != (rng.random() < 0.04))))
    docs = spark.createDataFrame(texts, SCHEMA)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int")
    learned = learn_rules(docs, table)
    assert learned
    stats = rules.with_statistics(docs.join(table, "doc_id"), "text").filter("not base_failed")
    stats = stats.select(
        (1 - F.col("quality")).alias("bad"),
        (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) == 0).alias("prunes"),
        *(value.alias(name) for name, value in rules._ratios().items()),
    )
    rows = [r.asDict() for r in stats.collect()]
    expected = covered_by_hand(rows, rules._thresholds(stats))
    assert [tuple((c.name, c.above, c.threshold) for c in rule) for rule in learned] == expected
