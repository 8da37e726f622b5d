"""The pipeline's stages, each beside plain Python on its own input."""

import zlib
from collections import Counter

import numpy as np
import pytest
from cases import SCHEMA, TEXTS
from test_classifiers import statistics
from test_duplicates import groups_by_hand
from test_spans import base_by_hand
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from shiplog.llm import decontamination
from shiplog.llm.common import stage, tokenizer_path

SF = "/root/testdata/sf0.001"


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        found = stage(function(spark, docs, SF), name)
        out.append((docs, found))
        docs = found
    return out


def test_stages_keep_the_columns(stages):
    columns = stages[0][0].columns
    assert all(out.columns == columns for _, out in stages[:-1])
    assert corpus_pipeline.ORACLE_SQL is None
    assert driver.queries()["pipeline"] is corpus_pipeline.run


def test_quality_stage(spark, stages):
    docs, kept = stages[0]
    bad = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0")
    bad = {r.doc_id for r in bad.collect()}
    rows, ids = docs.collect(), {r.doc_id for r in kept.collect()}
    failed = {r.doc_id for r in rows if statistics(r.text)[-1]}
    assert not ids & failed and not ids & bad
    symbols = {r.doc_id for r in rows if statistics(r.text)[2] > 0.2 * statistics(r.text)[0]}
    assert not ids & symbols
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    assert good - failed <= ids


def test_dedup_stage(stages):
    docs, kept = stages[1]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    least = {component for _, _, component in groups_by_hand(rows)}
    assert tuples(kept) == [r for r in tuples(docs) if r[0] in least]


def test_decontamination_stage(spark, stages):
    docs, kept = stages[2]
    items = [decontamination.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    joined = [f" {' '.join(w)} " for w in items]

    def leaks(text):
        text = f" {' '.join(decontamination.words(text))} "
        return any(i in text for i in joined)

    assert tuples(kept) == [r for r in tuples(docs) if not leaks(r[1])]
    assert kept.count() < docs.count()


def test_privacy_stage(stages):
    docs, masked = stages[3]
    before = {r.doc_id: r for r in docs.collect()}
    for r in masked.collect():
        assert r.n_chars == len(r.text) and not base_by_hand(r.text)
        if not base_by_hand(before[r.doc_id].text):
            assert r == before[r.doc_id]
    assert masked.count() == docs.count()


def test_packing_stage_and_run(spark, stages):
    docs, packed = stages[4]
    library, want = Tokenizer.from_file(tokenizer_path()), Counter()
    for r in docs.collect():
        ids = [*library.encode(r.text, add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 2048):
            part = np.array(ids[at : at + 2048], "<u4")
            want[r.doc_id, at, len(part), zlib.crc32(part.tobytes())] += 1
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, packed.select(columns).collect())) == want
    ran = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, ran.select(columns).collect())) == want


def test_stages_on_strange_and_empty_documents(spark):
    rows = [(i, t, None, "s", 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for table in (docs, docs.limit(0)):
        for _, function in corpus_pipeline.STAGES:
            table_out = function(spark, table, SF)
            assert table_out.count() <= max(60, table.count() * 40)
