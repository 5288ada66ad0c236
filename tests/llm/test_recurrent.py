import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from readloom.llm import recurrent
from tests.llm.fixtures import generator, invented, no_documents, odd_documents

SMALL = recurrent.Settings(vocabulary=40, head=60, classes=6, hidden=8, window=5, lanes=8, warm=20, warm_epochs=2)


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def base(rows):
    counts = Counter(w for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 5 != 1 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return counts, n, lambda t: sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))


def check(rows, found):
    counts, n, score = base(rows)
    text = dict(rows)
    for r in found:
        t = text[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n)
        assert r.base_score == pytest.approx(score(t), abs=1e-6)
        assert np.isfinite(r.score) and r.score < 0


def test_counts_and_base_equal_brute_force(spark):
    texts = invented(generator(1), 150, words=200)
    rows = [(i, t.upper() if i % 7 == 0 else t) for i, t in enumerate(texts)]
    check(rows, recurrent.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), SMALL).collect())


def test_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark).where("doc_id is null or doc_id <> 2")
    found = recurrent.score_documents(docs, SMALL).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], found)
    assert len(found) == docs.count()
    twice = docs.unionAll(docs)
    assert recurrent.score_documents(twice, SMALL).count() == 2 * docs.count()
    assert recurrent.score_documents(no_documents(spark), SMALL).count() == 0
    held = docs.where("crc32(cast(doc_id as string)) % 5 = 1")
    assert all(r.train_tokens == 0 and abs(r.base_score) < 1e-9 for r in recurrent.score_documents(held, SMALL).collect())


def network(size=30, rate=0.12):
    edges = np.array([0, 3, 10, size - 1, size])
    return recurrent.Network(size, edges, recurrent.Settings(hidden=7, classes=4, window=4, lanes=3, rate=rate))


def test_probabilities_sum_to_one():
    net = network()
    h = generator(2).normal(size=(5, 7)).astype(np.float32)
    total = sum(np.exp(net.output(h, np.full(5, y))[0]) for y in range(30))
    assert np.allclose(total, 1, atol=1e-5)


def test_scores_carry_the_state_over_windows():
    net = network()
    rng = generator(3)
    texts = [np.append(rng.integers(0, 30, n), 0) for n in (0, 1, 5, 40, 200, 3)]
    for t, got in zip(texts, net.score(texts), strict=True):
        h, last, total = np.zeros((1, 7), dtype=np.float32), 0, 0.0
        for y in t:
            h = net.step(np.array([last]), h)[4]
            total += float(net.output(h, np.array([y]))[0][0])
            last = y
        assert got == pytest.approx(total, rel=1e-4)


def test_gradients_equal_differences():
    """Over one window, the update direction is that of the numeric gradient."""
    rng = generator(4)
    text = np.append(rng.integers(1, 30, 3), 0)
    net = network()
    start = {k: v.copy() for k, v in net.p.items()}
    seen = {}
    net.update = lambda name, grad, rows=None: seen.setdefault(name, (grad.copy(), rows))
    net.train([text])
    for name in ("u", "b", "c", "cb"):
        grad = seen[name][0] * np.sqrt(len(text))
        for at in list(np.ndindex(grad.shape))[::7]:
            values = []
            for step in (1e-2, -1e-2):
                net.p = {k: v.copy() for k, v in start.items()}
                net.p[name][at] += step
                values.append(-net.score([text])[0])
            assert grad[at] == pytest.approx((values[0] - values[1]) / 2e-2, abs=2e-2)


def test_training_beats_word_counts():
    rng = generator(5)
    texts = []
    for i in range(300):
        words = range(0, 14) if i % 2 else range(14, 28)
        texts.append(np.append(rng.choice(list(words), 30), 28))
    net = network(size=30)
    counts = np.bincount(np.concatenate(texts[:200]), minlength=30)
    net.start(counts.astype(float))
    before = net.score(texts[200:]).sum()
    for _ in range(4):
        net.train(texts[:200])
    assert net.score(texts[200:]).sum() > before * 0.9


def plain_score(model, counts, text):
    """log10 probability of a text by the equations, one token at a time, in double precision."""
    p = {k: v.astype(float) for k, v in model.parameters.items()}
    n, edges = model.settings.hidden, model.layout.edges
    place = {w: i for i, w in enumerate(model.layout.words)}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    known = set(place) | {None}
    others = [c for w, c in counts.items() if w not in known]
    end = place[""]
    h, last, total = np.zeros(n), end, 0.0
    for w in tokens(text):
        y = end if w is None else place.get(w, model.layout.other)
        a, r = p["x"][last] + p["b"], h @ p["u"]
        z, reset = sigmoid(a[:n] + r[:n]), sigmoid(a[n : 2 * n] + r[n : 2 * n])
        h = z * h + (1 - z) * np.tanh(a[2 * n :] + reset * r[2 * n :])
        k = int(np.searchsorted(edges, y, "right")) - 1
        cls, own = h @ p["c"] + p["cb"], h @ p["w"][edges[k] : edges[k + 1]].T + p["wb"][edges[k] : edges[k + 1]]
        total += cls[k] - np.log(np.exp(cls).sum()) + own[y - edges[k]] - np.log(np.exp(own).sum())
        if y == model.layout.other:
            total += np.log((counts.get(w, 0) + 0.5) / (sum(others) + 0.5 * (len(others) + 1)))
        last = y
    return total / np.log(10)


def test_scores_equal_the_plain_equations(spark):
    """The whole column, rare words of the joined tail and unseen words included."""
    texts = invented(generator(6), 120, words=300)
    rows = [(i, t.upper() if i % 9 == 0 else t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (500, None), (501, " "), (502, "never seen before")], "doc_id long, text string")
    words = recurrent.word_counts(recurrent.training(docs)).cache()
    model = recurrent.learn(recurrent.training(docs), words, SMALL)
    counts, _, _ = base([(r.doc_id, r.text) for r in docs.collect()])
    assert len(counts) > SMALL.head > SMALL.vocabulary
    found = {r.doc_id: r.score for r in recurrent.score(docs, model, words).collect()}
    for r in docs.collect():
        assert found[r.doc_id] == pytest.approx(plain_score(model, counts, r.text), rel=2e-4)


def test_tasks_learn_from_every_document(spark):
    texts = invented(generator(8), 80)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    for kept in (docs, docs.where("doc_id <> 79")):
        model = recurrent.learn(kept, recurrent.word_counts(docs), replace(SMALL, warm=0))
        assert model.gradients is None  # the first fit alone would have left its step sizes
        seen.append(model.parameters["u"])
    assert not np.array_equal(*seen)
