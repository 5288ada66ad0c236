"""Chains of anchors against a plain dynamic programme and greedy extraction."""

import random

from readloom.operators import chaining as ch
from readloom.operators import mapping as mp

READS = "sample string, read_id long, seq string, qual string"


def plain(anchors, k, least):
    """One pair: every predecessor in turn; where chains part, the branch that reaches the higher score goes on (the first of equals)."""
    a = sorted(anchors)
    score, before = [k] * len(a), [-1] * len(a)
    for i, (t, q) in enumerate(a):
        for j in range(i):
            dt, dq = t - a[j][0], q - a[j][1]
            apart = abs(dt - dq)
            if 0 < dt <= ch.GAP and 0 < dq <= ch.GAP and apart <= ch.BAND:
                value = score[j] + min(dt, dq, k) - (ch.OPEN + apart // ch.EXTEND if apart else 0)
                if value > k and value >= score[i]:
                    score[i], before[i] = value, j
    below = {i: [j for j in range(len(a)) if before[j] == i] for i in range(len(a))}

    def reach(i):
        return max([score[i], *map(reach, below[i])])

    heir = {i: max(js, key=lambda j: (reach(j), -j)) for i, js in below.items() if js}
    chains = {}
    for i in range(len(a)):
        head = i
        while before[head] >= 0 and heir[before[head]] == head:
            head = before[head]
        chains.setdefault(head, []).append(a[i])
    best = max(range(len(a)), key=lambda i: score[i], default=None)
    if best is not None and sum(s == score[best] for s in score) == 1:  # the best end's chain is whole
        head = best
        while before[head] >= 0:
            head = before[head]
        assert a[best] in chains[head]
    out = [([x[1] for x in c], [x[0] for x in c]) for c in chains.values() if len(c) >= least]
    return sorted((min(q), max(q) + k, min(t), max(t) + k, len(q)) for q, t in out)


def test_chains_equal_the_plain_programme(spark):
    rng, rows, want = random.Random(1), [], {}
    for pair in range(60):
        n = rng.choice([1, 2, 3, 8, 40, 90])
        span = rng.choice([60, 600, 9000])
        anchors = set()
        for _ in range(rng.randrange(1, 4)):  # runs along diagonals, with shifts, and noise
            t, q = rng.randrange(span), rng.randrange(span)
            for _ in range(n):
                t, q = t + rng.randrange(1, 25), q + rng.randrange(1, 25) if rng.random() < 0.2 else q + 11
                anchors.add((t, q))
        anchors |= {(rng.randrange(span), rng.randrange(span)) for _ in range(n // 2)}
        rows += [("x", pair, q, t) for t, q in anchors]
        want[pair] = plain(anchors, 15, 3)
    df = spark.createDataFrame(rows, "sample string, pair int, qpos int, tpos int").repartition(5)
    got = {}
    for r in ch.chain_anchors(df, ["sample", "pair"], 15, 3).collect():
        got.setdefault(r.pair, []).append((r.qstart, r.qend, r.tstart, r.tend, r.n_anchors))
    assert {p: sorted(v) for p, v in got.items()} == {p: v for p, v in want.items() if v} and got
    assert ch.chain_anchors(df.limit(0), ["sample", "pair"], 15, 3).count() == 0


def test_a_read_with_indels_is_one_hit_wherever_it_lies(spark):
    """With bands of fixed width, a hit whose diagonal crosses their edge falls in two."""
    rng = random.Random(2)
    ref = "".join(rng.choice("ACGT") for _ in range(6000))
    rows = []
    for i in range(24):
        a = 200 + 41 * i
        x = ref[a : a + 1500] + "".join(rng.choice("ACGT") for _ in range(30 * (i % 3))) + ref[a + 1500 + 40 * (i % 2) : a + 3000]
        rows.append(("s", i, x, "I" * len(x)))
    hits = mp.map_reads(spark.createDataFrame(rows, READS), spark.createDataFrame([("r", ref)], "ref_id string, seq string")).collect()
    assert len(hits) == 24 and all(r.flag == 0 and r.qend - r.qstart > len(rows[r.read_id][2]) - 60 for r in hits)
    found = mp.overlap_pairs(spark.createDataFrame(rows, READS), 2000).collect()
    assert {(r.a, r.b) for r in found} == {(a, b) for a in range(24) for b in range(a + 1, 24) if 41 * (b - a) < 950}
