"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shiplog.llm.bpe_codec import codec_report, encoded
from shiplog.llm.common import read
from shiplog.llm.decontamination import contaminated
from shiplog.llm.language_id import language_id
from shiplog.llm.packed_output import read_sequences, write_packed
from shiplog.llm.packing import pack
from shiplog.llm.periodic_runs import periodic_runs, run_report, with_planted_runs
from shiplog.llm.pii import personal_data
from shiplog.llm.quality_rules import quality
from shiplog.llm.simhash import simhash_groups
from shiplog.llm.suffix_dedup import without_repeats
from shiplog.llm.token_counts import token_counts
from shiplog.llm.toxicity import toxicity
from shiplog.llm.whitening import component_rows, whitened
from shiplog.session import scratch_root

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return quality(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return contaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents", "doc_id", "text"))


def op10_packed_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/llm/packed-{uuid.uuid4().hex}"
    write_packed(read(spark, sf_dir, "documents", "doc_id", "text"), path)
    return read_sequences(spark, path)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(read(spark, sf_dir, "documents", "doc_id", "text"))
    return run_report(periodic_runs(docs))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return component_rows(whitened(read(spark, sf_dir, "embeddings", "vec_id", "embedding")))


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_report(encoded(read(spark, sf_dir, "documents", "doc_id", "text")))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_personal_data": op5_personal_data,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_language_id": op7_language_id,
    "op8_decontamination": op8_decontamination,
    "op9_packing": op9_packing,
    "op10_packed_output": op10_packed_output,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_bpe_codec": op13_bpe_codec,
}
#: SQL has no tokenizer, learned model, alignment or packing: these queries are tested against
#: brute force, held-out labels and round trips in tests/llm.
ORACLES: dict[str, str] = {}
