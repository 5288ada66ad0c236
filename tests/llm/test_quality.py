import math
import tracemalloc
import zlib

import numpy as np
import pytest

from readloom.llm import quality
from tests.llm.fixtures import generator, invented, no_documents, odd_documents

SMALL = quality.Settings(buckets=4096, dim=6, epochs=4, sample=400)


def labelled(spark, n=500):
    rng = generator(7)
    rows = []
    for i, t in enumerate(invented(rng, n)):
        bad = i % 4 == 0
        rows.append((i, " ".join(w + "$$" for w in t.split()) if bad else t, int(not bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    return docs, labels, {i: q for i, _, q in rows}


def plain(text, model, s):
    """Score by the mean of all feature vectors, one feature at a time."""
    words = text.encode().split()
    if not words:
        found = quality.subwords(b"", s)
    else:
        found = [b for w in words for b in quality.subwords(w, s)]
        h = np.array([zlib.crc32(w) for w in words], dtype=np.uint64)
        found += [int(quality.pair_buckets(h[i : i + 1], h[i + 1 : i + 2], s)[0]) for i in range(len(h) - 1)]
        for x, y in zip(words, words[1:]):
            for i, j in ((1, 1), (1, 2), (2, 1)):
                tail, head = (np.array([int.from_bytes(part, "big") + (len(part) << 40)], dtype=np.uint64) for part in (x[-i:], y[:j]))
                found.append(int(quality.pair_buckets(tail, head, s)[0]))
    return 1 / (1 + math.exp(-float(np.mean(model.odds[found])) - model.bias))


def test_held_out_accuracy_and_plain_scores(spark):
    docs, labels, truth = labelled(spark)
    odds = quality.train(docs, labels, SMALL)
    got = {r.doc_id: r.score for r in quality.score(docs, odds, SMALL).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(abs(got[i] - plain(texts[i], odds, SMALL)) < 1e-9 for i in texts)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.7) == truth[i] for i in held]) > 0.97


def test_held_out_labels_are_not_read(spark):
    docs, labels, _ = labelled(spark, 200)
    other = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality", "toxic")
    assert (quality.train(docs, labels, SMALL).odds == quality.train(docs, other, SMALL).odds).all()


def test_repeated_ids_and_partitions_change_no_model(spark):
    docs, labels, _ = labelled(spark, 120)
    more = docs.unionByName(docs.selectExpr("doc_id % 7 as doc_id", "concat(text, ' more') as text"))
    few = quality.Settings(buckets=4096, dim=6, epochs=2, sample=20)
    models = [quality.train(x, labels, few) for x in (more.repartition(3), more.repartition(8), more.coalesce(1))]
    assert all((m.odds == models[0].odds).all() and m.bias == models[0].bias for m in models)
    found = quality.labelled_sample(more, labels, few).collect()
    assert len(found) == len({r.doc_id for r in found}) == 20


def test_empty_texts_are_learned(spark):
    docs, labels, truth = labelled(spark, 200)
    blank = spark.range(1000, 1200).selectExpr("id as doc_id", "case id % 3 when 0 then '' when 1 then ' ' end as text")
    for q in (0, 1):
        model = quality.train(docs.unionByName(blank), labels.unionByName(blank.selectExpr("doc_id", f"{q} as quality", "0 as toxic")), SMALL)
        found = {r.score > 0.5 for r in quality.score(blank, model, SMALL).collect()}
        assert found == {bool(q)}


def test_the_fit_descends_the_loss(spark):
    """The fitted numbers reach a lower log loss on the training rows than none, and than the bias alone."""
    docs, labels, truth = labelled(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = quality.train(docs, labels, SMALL)
    rows = [i for i in truth if zlib.crc32(str(i).encode()) % 4 != 2]

    def loss(m):
        return -np.mean([math.log(p if truth[i] else 1 - p) for i in rows for p in [plain(texts[i], m, SMALL)]])

    share = np.mean([truth[i] for i in rows])
    flat = quality.Model(np.zeros_like(model.odds), math.log(share / (1 - share)))
    assert loss(model) < loss(flat) / 2


def test_few_rows_are_fitted_until_both_labels_are_told_apart():
    """Of 64 rows, one in eight of label 0 by its words alone: scores of the fitted rows lie on both sides of 0.7."""
    s, known = quality.Settings(), {}
    labels = [int(i % 8 > 0) for i in range(64)]
    texts = [t.encode() for t in invented(generator(9), 64)]
    model = quality.fit([quality.features(t, s, known) for t in texts], labels, s)
    assert ((quality.Scorer(model, s).score(texts) >= 0.7) == np.array(labels)).all()


def test_characters_across_a_space_are_features():
    known = {}
    one, two = (dict(zip(*map(list, quality.features(t, SMALL, known)), strict=True)) for t in (b"ab cd", b"ab"))
    ends = np.array([quality.ends_of(w) for w in (b"ab", b"cd")], dtype=np.uint64)
    spans = [int(x[0]) for x in quality.joint_buckets(ends, SMALL)]
    assert len(set(spans)) == 3 and all(x in one for x in spans) and not set(spans) <= set(two)


def test_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 1), (6, 0), (6, 0)], "doc_id long, quality int")
    odds = quality.train(docs, labels, SMALL)
    rows = quality.score(docs, odds, SMALL, keep=tuple(docs.columns), name="own").collect()
    assert len(rows) == docs.count() and all(0 <= r.own <= 1 for r in rows)
    assert len({r.own for r in rows if r.doc_id in (3, 4, 5)}) == 1
    with pytest.raises(ValueError):
        quality.score(docs, odds, SMALL, keep=tuple(docs.columns))
    assert quality.score(no_documents(spark), odds, SMALL).count() == 0
    none = quality.train(no_documents(spark), labels.limit(0), SMALL)
    assert {r.score for r in quality.score(docs, none, SMALL).collect()} == {0.5}


def test_features_reach_the_driver_once(spark, monkeypatch):
    texts = invented(generator(7), 2000)
    docs = spark.createDataFrame([(i, " ".join(texts[10 * i : 10 * i + 10])) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    sizes = []
    monkeypatch.setattr(quality, "fit", lambda pairs, marks, s: sizes.append((len(marks), sum(a.nbytes + b.nbytes for a, b in pairs))))
    tracemalloc.start()
    quality.train(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    n, size = sizes[0]
    assert n > 100 and size > 3_000_000 and peak < 1.3 * size, (n, size, peak)
