"""Quality rules: text statistics and a learned decision list, all in DataFrame functions.

Sequential covering learns rules that reject: a rule grows by the threshold condition of highest
gain on two thirds of the labelled rows, loses the last conditions that do not hold on the other
third, and takes the rows it covers out of both. The list is applied as one ordered conditional
expression. Candidates are counted by grouping on binned statistics, a few hundred rows a step.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import boxed, prepared, sampled, stage

BLANK = r"\x20\x09-\x0D"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: Labelled rows to learn from, about; the sample goes by a hash of the id.
SAMPLE_ROWS = 20_000
#: Size of the list and of a rule, and what a rule must show on the rows that prune it.
MAX_RULES, MAX_CONDITIONS = 8, 3
LEAST_PRECISION, LEAST_SHARE = 0.9, 0.01
QUANTILES = [i / 16 for i in range(17)]

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct_words", "n_exclaim", "n_capitals")


def _ratios() -> dict[str, Column]:
    """What rules compare with thresholds."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "exclaims_per_word": F.col("n_exclaim") / words,
        "capitals_per_char": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
        "chars_per_word": F.col("word_chars") / words,
        "distinct_words": F.col("n_distinct_words") / words,
        "repeated_words": F.col("n_repeat_words") / words,
        "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "words": F.col("n_words").cast("double"),
    }


def _matches(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern, -1)) - 1


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with BASE and MORE as long columns and `base_failed`; a null text has no words.

    Columns of these names are replaced; helper columns start with two underscores.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = docs.withColumn("__text", body)
    cut = F.split(F.btrim("__text", F.lit(" \t\n\x0b\f\r")), f"[{BLANK}]+")
    df = df.withColumn("__words", F.filter(cut, lambda w: w != ""))
    lines = F.filter(F.split("__text", "\n", -1), lambda x: x.rlike(f"[^{BLANK}]"))
    df = df.withColumn("__lines", lines).withColumn("__n", F.size("__words"))
    # Windows are compared by a 64-bit hash of their words; only within one text.
    starts = F.sequence(F.lit(1), F.col("__n") - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("__words", i, WINDOW)))
    none = F.array().cast("array<bigint>")
    df = df.withColumn("__hash", F.when(F.col("__n") >= WINDOW, hashes).otherwise(none))
    same = F.size("__hash") == F.size(F.array_distinct("__hash"))
    placed = F.transform("__hash", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    pairs = F.when(same, F.lit(None)).otherwise(F.array_sort(placed))
    df = df.withColumn("__pairs", pairs)

    def repeated(pair: Column, j: Column) -> Column:
        def like(k: Column) -> Column:
            return F.coalesce(F.get("__pairs", k)["h"] == pair["h"], F.lit(False))

        return F.when(like(j - 1) | like(j + 1), pair["i"])

    places = F.array_sort(F.array_compact(F.transform("__pairs", repeated)))
    df = df.withColumn("__places", places)
    # Every window adds its words up to where the next begins.
    covered = F.transform(
        "__places",
        # least() passes over the null after the last place.
        lambda p, k: F.least(F.get("__places", k + 1) - p, F.lit(WINDOW)),
    )
    total = F.aggregate(covered, F.lit(0), lambda a, b: a + b)
    found = {
        "n_words": F.col("__n"),
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": _matches(F.col("__text"), SYMBOLS),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(total, F.lit(0)),
        "n_lines": F.size("__lines"),
        "n_distinct_words": F.size(F.array_distinct("__words")),
        "n_exclaim": _matches(F.col("__text"), "!"),
        "n_capitals": _matches(F.col("__text"), r"\p{Lu}"),
    }
    # A generator: a later filter on a statistic must not be pushed down and repeat its making.
    each = F.struct(*(value.cast("long").alias(name) for name, value in found.items()))
    df = df.withColumn("__found", F.explode(F.array(each)))
    df = df.withColumns({name: F.col("__found")[name] for name in found})
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    helpers = ("__text", "__words", "__lines", "__n", "__hash", "__pairs", "__places", "__found")
    return df.withColumn("base_failed", failed).drop(*helpers)


@dataclass(frozen=True)
class Condition:
    """A ratio beyond (above) or up to a threshold."""

    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = _ratios()[self.name]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _all(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns, F.lit(True))


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional expression: whether a document is kept."""
    kept = F.when(F.col("base_failed"), False)
    for rule in rules:
        kept = kept.when(_all([c.column() for c in rule]), False)
    return kept.otherwise(True)


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Midpoints between the quantiles that either class has of a ratio."""
    names = list(_ratios())
    quantiles = [F.percentile_approx(n, QUANTILES, 10_000).alias(n) for n in names]
    found = rows.groupBy("bad").agg(*quantiles).collect()  # two rows
    out = {}
    for name in names:
        values = sorted({v for r in found for v in r[name]})
        out[name] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    return out


def _binned(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Ratios as the number of thresholds that lie below them."""
    bins = [
        sum((F.col(n) > t).cast("int") for t in ts).alias(n) if ts else F.lit(0).alias(n)
        for n, ts in cuts.items()
    ]
    return rows.select("bad", "prunes", *bins)


def _holds(conditions: list[tuple[str, bool, int]]) -> Column:
    """On binned ratios: above threshold number i means at least i + 1 thresholds below."""
    return _all([F.col(n) > i if above else F.col(n) <= i for n, above, i in conditions])


def _best(rows: DataFrame, rule: list[tuple[str, bool, int]], cuts: dict) -> tuple[float, tuple | None]:
    """The condition that raises FOIL's gain most; ties by name, direction and threshold."""
    each = (F.struct(F.lit(n).alias("name"), F.col(n).alias("bin")) for n in cuts)
    one = F.explode(F.array(*each))
    counts = (
        rows.filter(~F.col("prunes") & _holds(rule))
        .select(one.alias("at"), "bad")
        .groupBy("at.name", "at.bin")
        .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
        .collect()  # a row for each ratio and bin
    )
    best: tuple[float, tuple | None] = (0.0, None)
    for name in sorted(cuts):
        mine = {r["bin"]: (r["p"], r["n"]) for r in counts if r["name"] == name}
        p0, n0 = (sum(x[i] for x in mine.values()) for i in (0, 1))
        if not p0:
            continue
        before = math.log2(p0 / (p0 + n0))
        for i in range(len(cuts[name])):
            low = [sum(x[j] for b, x in mine.items() if b <= i) for j in (0, 1)]
            for above, (p, n) in ((True, (p0 - low[0], n0 - low[1])), (False, tuple(low))):
                gain = p * (math.log2(p / (p + n)) - before) if p else 0.0
                if gain > best[0] + 1e-9:
                    best = gain, (name, above, i)
    return best


def _pruned(rows: DataFrame, rule: list[tuple]) -> tuple[list[tuple], int, int]:
    """The leading conditions with the best (p - n) / (p + n) on the pruning rows, and p, n."""
    sums = []
    for k in range(1, len(rule) + 1):
        hit = (F.col("prunes") & _holds(rule[:k])).cast("int")
        sums += [F.sum(hit * F.col("bad")), F.sum(hit * (1 - F.col("bad")))]
    counts = rows.agg(*sums).first()
    scored = []
    for k in range(len(rule)):
        p, n = counts[2 * k] or 0, counts[2 * k + 1] or 0
        scored.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n))
    _, k, p, n = max(scored)
    return rule[: 1 - k], p, n


def learn_rules(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """Rules that reject, learned from the documents of `sample_rows` labelled ids at most.

    A repeated id takes its smallest label; null ids and labels teach nothing; without labelled
    rows of both kinds the list is empty. Rows that fail the base rules teach nothing either.
    """
    prepared(docs.sparkSession)
    known = labels.groupBy(F.col(key).alias("__id")).agg(F.min(label).alias("__label")).dropna()
    # At most `sample_rows` narrow rows, so every task may have them.
    known = sampled(known, F.xxhash64("__id"), sample_rows)
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("__body"))
    rows = with_statistics(rows.join(F.broadcast(known), "__id"), "__body")
    rows = rows.filter("not base_failed")
    rows = stage(
        rows.select(
            (F.col("__label") == 0).cast("int").alias("bad"),
            (F.pmod(F.xxhash64("__id", F.lit("part")), F.lit(3)) == 0).alias("prunes"),
            *(value.alias(name) for name, value in _ratios().items()),
        ),
        "ratios",
    )
    if rows.select("bad").distinct().count() < 2:
        return []
    cuts = _thresholds(rows)
    rows = stage(_binned(rows, cuts), "bins")
    least = LEAST_SHARE * rows.filter("prunes and bad = 1").count()
    rules: list[Rule] = []
    left = rows
    while len(rules) < MAX_RULES:
        grown: list[tuple[str, bool, int]] = []
        while len(grown) < MAX_CONDITIONS:
            gain, condition = _best(left, grown, cuts)
            if condition is None:
                break
            grown.append(condition)
        if not grown:
            break
        rule, p, n = _pruned(left, grown)
        if p <= least or p < LEAST_PRECISION * (p + n):
            break
        rules.append(tuple(Condition(n, above, cuts[n][i]) for n, above, i in rule))
        left = left.filter(~_holds(rule))
    return rules


def quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per document: (key, BASE, base_failed, kept). Repeated rows and null keys stay."""
    rules = learn_rules(docs, labels, key, text, sample_rows=sample_rows)
    narrow = docs.select(F.col(key).alias("__key"), F.col(text).alias("__body"))
    found = with_statistics(narrow, "__body").withColumn("kept", verdict(rules))
    return found.select(F.col("__key").alias(key), *BASE, "base_failed", "kept")


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows of `docs` that the base rules and the learned list keep, with their columns."""
    rules = learn_rules(docs, labels, key, text, sample_rows=sample_rows)
    found = with_statistics(docs.select(boxed(docs), F.col(text).alias("__body")), "__body")
    return found.filter(verdict(rules)).select("row.*")
