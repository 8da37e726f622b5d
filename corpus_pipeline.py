"""A training corpus out of `documents`: quality, near-duplicates, benchmarks, privacy, packing.

Each stage calls one operator of shiplog.llm on all that the stage before it kept. `run` writes
every result as Parquet to the shared folder and reads it again as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.llm.common import prepared, read, stage
from shiplog.llm.decontamination import without_leaks
from shiplog.llm.packing import pack
from shiplog.llm.pii import redacted
from shiplog.llm.quality_rules import keep_good
from shiplog.llm.simhash import one_per_group

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    prepared(spark)
    return keep_good(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the least id."""
    prepared(spark)
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a test item go."""
    prepared(spark)
    return without_leaks(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind; `n_chars` follows the text."""
    prepared(spark)
    return redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL has neither the learned rules nor the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of `documents`."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
