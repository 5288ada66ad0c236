import itertools
import random
import re
import time
from hashlib import sha256

import numpy as np
import pytest

from readloom.llm import pii
from tests.llm.fixtures import generator, no_documents, odd_documents

#: The contract's patterns as they stand.
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        total += sum(map(int, str(int(c) * 2))) if i % 2 else int(c)
    return total % 10 == 0


def plain(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")) or k == 2 and not (12 <= len(digits) <= 19 and plain_luhn(digits)) or k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda x: (x[0], x[2]))


def card(rng):
    digits = "".join(rng.choice("0123456789") for _ in range(15))
    return next(digits + c for c in "0123456789" if plain_luhn(digits + c))


def invented(rng, n):
    """Texts with personal data among words and numbers, and the spans of variants that patterns do not see."""
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    texts = []
    for _ in range(n):
        x = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        if rng.random() < 0.7:
            piece = rng.choice([
                f"{rng.choice(words)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)), card(rng),
                f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
            ])
            x.insert(rng.randrange(len(x)), piece)
        x.insert(rng.randrange(len(x)), str(rng.randrange(10 ** rng.randrange(1, 9))))
        texts.append(" ".join(x))
    return texts


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    texts = ["".join(rng.choice("0123456789.-+@ a_%()é٣\U0001f600") for _ in range(rng.randrange(0, 90))) for _ in range(6000)]
    texts += ["".join(rng.choice("012.") for _ in range(60)) for _ in range(300)] + ["a@b.c_d@e.f g@h@i.j.k", "1.2.3.4.5.6.7.8", "001.2.3.0255", "x" + "@" * 9 + "y.z", card(rng) + " " + card(rng)]
    texts += [t[:30] + card(rng)[:9] + "-" + card(rng) + t[30:] for t in texts[:500]]
    assert [pii.base_spans(t) for t in texts] == [plain(t) for t in texts]
    assert sum(map(len, map(plain, texts))) > 200


def test_base_spans_of_very_long_texts_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "a@" * 500_000, "1." * 500_000, "+1 " * 400_000, "1 " * 800_000):
        pii.base_spans(text)


def test_gradients_equal_differences():
    s = pii.Settings(hidden=3)
    net, rng = pii.Network(s), generator(0)
    for n in net.NAMES:
        setattr(net, n, getattr(net, n).astype(np.float64))
    ids, gold = rng.integers(1, pii.SYMBOLS, (7, 4)), np.zeros((7, 4), dtype=int)
    ids[5:, 1] = 0
    gold[2:4, 0], gold[4, 2], gold[0:2, 3] = (1, 2), 5, (7, 8)
    _, slope = net.loss(ids, gold)
    for n in net.NAMES:
        a = getattr(net, n)
        for _ in range(12):
            at = (int(rng.integers(2)), int(rng.integers(a.shape[1])), int(ids[rng.integers(5), 0])) if n == "table" else tuple(int(rng.integers(d)) for d in a.shape)
            old = a[at]
            a[at] = old + 1e-4
            hi, _ = net.loss(ids, gold)
            a[at] = old - 1e-4
            lo, _ = net.loss(ids, gold)
            a[at] = old
            assert abs((hi - lo) / 2e-4 - slope[n][at]) < 2e-4


def test_scores_leave_windows_that_have_ended_alone():
    """Scores equal those of a window by itself, and many short windows beside a long one cost little."""
    net, rng, lanes = pii.Network(pii.Settings()), generator(5), 400
    sizes = np.sort(rng.integers(1, 60, lanes))[::-1]
    sizes[0] = 600
    ids = rng.integers(1, pii.SYMBOLS, (600, lanes)).astype(np.intp)
    short = np.where(np.arange(600)[:, None] < sizes, ids, 0)
    got = net.scores(short)
    for x in (0, 1, 7, lanes - 1):
        alone = net.scores(np.ascontiguousarray(short[: sizes[x], x : x + 1]))
        assert np.allclose(got[: sizes[x], :, x], alone[:, :, 0], atol=1e-4)
    state = net.forward(short[:, 1:3])[0][60:]
    assert np.array_equal(state, np.broadcast_to(net.bias[:, None], state.shape))  # padding keeps the state at zero

    def seconds(x):
        start = time.process_time()
        net.scores(x)
        return time.process_time() - start

    assert min(seconds(short) for _ in range(3)) < 0.6 * min(seconds(ids) for _ in range(3))


def test_best_paths_equal_all_paths():
    """Every labelling of short windows, scored one by one."""
    s = pii.Settings(hidden=3, least=1, margin=0.0)
    rng, found = generator(3), 0
    for seed in range(6):
        net = pii.Network(pii.Settings(hidden=3, least=1, margin=0.0, seed=seed))
        net.bias[:] = rng.normal(0, 1, pii.LABELS)
        net.moves = rng.normal(0, 1, net.moves.shape).astype(np.float32)
        sizes = np.array([4, 3, 2])
        ids = rng.integers(1, pii.SYMBOLS, (4, 3)).astype(np.intp)
        for x, n in enumerate(sizes):
            ids[n:, x] = 0
        got, scores, moves = net.paths(ids, sizes), net.scores(ids), net.transitions()
        full, _ = net.forward(ids)
        assert np.allclose(full[:, 1:] - full[:, :1], scores, atol=1e-4)
        for x, n in enumerate(sizes):
            best, value = None, -np.inf
            for path in itertools.product(range(pii.LABELS), repeat=int(n)):
                last, total = 0, 0.0
                for i, k in enumerate(path):
                    total += moves[last, k] + (scores[i, k - 1, x] if k else 0)
                    last = k
                total += moves[last, 0]  # what follows a window counts as outside
                if total > value:
                    best, value = path, total
            want = [(i, k // 2) for i, k in enumerate(best) if k % 2]
            assert [(a, k) for a, _, k, _ in got[x]] == want
            found += len(want)
    assert found and s.margin == 0


@pytest.fixture(scope="module")
def trained(spark):
    texts = invented(random.Random(4), 1500)
    s = pii.Settings(sample=250, steps=200)
    return pii.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), s), s


def test_held_out_spans_are_found_by_the_model_alone(trained):
    net, s = trained
    held = invented(random.Random(77), 300)
    hit = miss = extra = 0
    for t, own in zip(held, pii.Finder(net, s).model_spans(held)):
        want, own = set(plain(t)), {x for x in own if pii.checked(t[x[0] : x[1]], x[2])}
        hit, miss, extra = hit + len(want & own), miss + len(want - own), extra + len(own - want)
    assert hit > 0.9 * (hit + miss) and extra < 0.1 * hit


def test_spans_that_patterns_miss_are_added_and_base_spans_stay(trained):
    net, s = trained
    rng = random.Random(8)
    texts, wanted = [], []
    for t in invented(rng, 200):
        t = re.sub(r"[0-9@+]", "", t)
        piece = f"({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
        texts.append(t[: len(t) // 2] + " " + piece + " " + t[len(t) // 2 :])
        wanted.append((texts[-1].index(piece), texts[-1].index(piece) + len(piece), 3))
    found = [every for _, every in pii.Finder(net, s).all_spans(texts)]
    met = [any(k == 3 and min(b, w[1]) - max(a, w[0]) >= 12 for a, b, k in f) for w, f in zip(wanted, found)]
    assert sum(met) > 80 and sum(map(len, found)) < 1.2 * sum(met)
    mixed = invented(rng, 200)
    for t, (base, every) in zip(mixed, pii.Finder(net, s).all_spans(mixed)):
        assert base == plain(t) and set(base) <= set(every)
        assert all(not (a < e and s0 < b) for s0, e, _ in base for a, b, _ in set(every) - set(base))


def test_windows_and_batches_do_not_change_spans(trained):
    """Long texts, windows at any place, and other texts beside them: the spans stay where they are."""
    net, s = trained
    rng = random.Random(6)
    long = " ".join(invented(rng, 150))
    short = pii.Settings(sample=s.sample, steps=s.steps, window=160, overlap=80, block=3000, lanes=16)
    one = pii.Finder(net, s)
    assert one.model_spans([long])[0] == one.model_spans(["x", long, "", long[:700]])[1]
    a, b = set(one.model_spans([long])[0]), set(pii.Finder(net, short).model_spans([long])[0])
    assert len(a & b) > 0.9 * len(a | b) > 20


def test_reconciliation_takes_the_best_set_of_spans():
    rng = random.Random(2)
    for _ in range(200):
        spans = [(a, a + rng.randrange(1, 9), rng.randrange(4), rng.random() + 0.1, False) for a in (rng.randrange(30) for _ in range(8))]
        spans = list({x[:3]: x for x in spans}.values())
        value = lambda some: sum(x[3] for x in some)
        apart = lambda some: all(x[1] <= y[0] or y[1] <= x[0] for x, y in itertools.combinations(some, 2))
        best = max((value(c) for n in range(len(spans) + 1) for c in itertools.combinations(spans, n) if apart(c)))
        got = pii.reconciled(spans)
        assert abs(value([x for x in spans if x[:3] in got]) - best) < 1e-9
    assert pii.reconciled([(5, 20, 1, 3.0, True), (5, 30, 1, 4.0, False), (40, 44, 0, 1.0, False), (40, 44, 0, 1.0, False)]) == [(5, 30, 1), (40, 44, 0)]


def test_odd_documents(spark, trained):
    net, s = trained
    docs = odd_documents(spark)
    got = pii.find(docs.repartition(2), net, s).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id in (3, 4, 5):
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans) == (0, 0, 0, 0, "") and r.base_sha256 == sha256(b"").hexdigest()
    text = "a@b.com +1 (743) 555-3824 ÿ 1.2.3.4"
    row = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), None).first()
    want = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in plain(text))
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone, row.spans) == (1, 1, 0, 1, want) and row.base_sha256 == sha256(want.encode()).hexdigest()
    assert pii.find(no_documents(spark), net, s).count() == 0 and pii.train(no_documents(spark), s) is None


def test_training_windows_do_not_depend_on_partitions(spark):
    texts = invented(random.Random(3), 300)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    s = pii.Settings(sample=20)
    a = pii.training_windows(df.repartition(5), s)
    assert a == pii.training_windows(df.coalesce(1), s) and sum(bool(x) for _, x in a) <= 80 and sum(not x for _, x in a) <= 40
    assert all(plain(t)[: len(x)] for t, x in a if x)
