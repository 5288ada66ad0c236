"""The pipeline against a plain version of its stages, on the smallest tables."""

import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from readloom.llm import lines, mixing, pieces, quality
from readloom.llm.common import documents
from tests.llm.fixtures import no_documents, odd_documents
from tests.llm.test_likeness import plain_components
from tests.llm.test_lines import plain as plain_lines
from tests.llm.test_mixing import water
from tests.llm.test_quality import plain as plain_quality

SF = "/root/testdata/sf0.001"


def expected(spark):
    docs = documents(spark, SF)
    settings = quality.Settings()
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    rows = [r for r in rows if plain_quality(r[1], model, settings) >= corpus_pipeline.LEAST_QUALITY]
    text = plain_lines(rows, lines.THRESHOLDS)
    rows = [(d, text[d], s) for d, _, s in rows]
    component = dict(plain_components([(d, t) for d, t, _ in rows]))
    rows = [r for r in rows if component[r[0]] == r[0]]
    size = {d: len(t.encode().split()) for d, t, _ in rows}
    key = {r.doc_id: r.key for r in spark.createDataFrame([(d,) for d in size], "doc_id long").withColumn("key", mixing.random_key("doc_id", 7)).collect()}
    own = defaultdict(list)
    for d, _, s in rows:
        own[s].append(d)
    names = sorted(own)
    targets = water([sum(size[d] for d in own[n]) for n in names], [i % 3 + 1 for i in range(len(names))])
    copies = {}
    for n, target in zip(names, targets, strict=True):
        total, budget, prior = sum(size[d] for d in own[n]), int(target + 1e-9), 0
        epochs = budget // total if total else 0
        for d in sorted(own[n], key=lambda d: (key[d], d)):
            copies[d] = epochs + (prior < budget - epochs * total)
            prior += size[d]
    return [(d, t) for d, t, _ in rows for _ in range(copies[d])]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_run_equals_the_plain_stages(spark):
    want = expected(spark)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in want)
    text = dict(want)
    encoder = pieces.Encoder(pieces.load())
    for r in got:
        assert r.token_ids == encoder.encode([text[r.doc_id]])[0].tolist() and r.round_trip
    assert 0 < len(set(text)) < 200


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_stages_keep_clean_documents_and_columns(spark):
    docs = documents(spark, SF)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, SF).collect()}
    assert np.mean([(d in kept) == bool(q) for d, q in labels.items()]) > 0.97
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_odd_rows_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, 1), (2, 1), (4, 0)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_documents(spark), no_documents(spark)):
        for name in ("_drop", "_id", "_hash", "id", "times", "nth", "row", "taken", "component_id"):
            docs = docs.withColumn(name, F.lit(5))
        rows = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            n, ids = out.count(), {r.doc_id for r in out.select("doc_id").collect()}
            if name != "pieces":
                assert out.columns == docs.columns
            if name in ("lines", "pieces"):
                assert n == rows
            if name == "near duplicates":
                # 1 and 2 are equal, so are 3, 4 and 5 without words; 6 and 7 differ in one word of 30,000.
                assert ids == ({1, 3, 6, 8, 9, None, 10, 11} if rows else set())
            if name == "mixing":
                assert n >= 1 or not rows
            assert ids <= {r.doc_id for r in docs.select("doc_id").collect()}
