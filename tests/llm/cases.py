"""Tables with everything that may go wrong, and small helpers for the tests of the operators."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"wörd{i % 977}" for i in range(40_000))
TEXTS = [
    "The quick brown fox jumps over the lazy dog, then naps.",
    "The quick brown fox jumps over the lazy dog, then naps.",
    "the quick  brown fox\njumps over the lazy dog, then naps.",
    "",
    None,
    " \t\n ",
    "\0",
    "<|endoftext|> a<|endoftext|>",
    "mail a.b@c.de or call +1 (578) 555-6437 now",
    "漢字 и ñandú 😀",
    LONG,
]


def hostile(spark):
    """Nulls in every column, repeated rows and ids, ties, and columns named like helpers."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)]
    rows += [(0, TEXTS[0], "en", "s", 1), (0, "other text", "de", None, None)]
    rows += [(None, TEXTS[0], None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    names = ("key", "body", "row", "row_a", "print", "at", "shard", "found", "rank", "n_words", "kept", "score")
    return docs.withColumns({n: F.lit(f"own {n}") for n in names})


def empty(spark):
    return hostile(spark).limit(0)


def documents(spark, texts, **columns):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}
