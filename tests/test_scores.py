"""Scores of reads by quality windows against plain sums."""

import numpy as np
import pytest

from readloom.functions import sequence as fn
from readloom.operators import reads as rd

READS = "sample string, read_id long, seq string, qual string"


def rows_of(rng, sizes):
    return [("s", i, "A" * int(n), "".join(chr(33 + int(q)) for q in rng.integers(0, 60, int(n)))) for i, n in enumerate(sizes)]


def plain(qual, window):
    q = [ord(c) - 33 for c in qual or ""]
    w = min(window, len(q))
    return sum(q), min((sum(q[i : i + w]) for i in range(len(q) - w + 1)), default=0) if w else 0, w


@pytest.mark.parametrize("held", [10, 1 << 22])
def test_profiles_equal_plain_sums(spark, monkeypatch, held):
    monkeypatch.setattr(fn, "PROFILE_BYTES", held)
    rng = np.random.default_rng(41)
    rows = rows_of(rng, [0, 1, 4, 5, 6, 0, 40, 0, 300]) + [("s", 99, "AC", None)]
    got = {r.read_id: tuple(r.p) for r in spark.createDataFrame(rows, READS).coalesce(1).withColumn("p", fn.quality_profile("qual", 5)).collect()}
    assert got == {i: plain(q, 5) for _, i, _, q in rows}


def test_expressions_see_length_mean_and_worst_window(spark):
    rng = np.random.default_rng(42)
    rows = rows_of(rng, [0, 3, 20, 70])
    df = spark.createDataFrame(rows, READS).withColumn("mean_quality", rd.F.lit("mine"))
    got = {r.read_id: r for r in rd.read_scores(df, "mean_quality + 2 * worst_window + length / length(seq)", 10).collect()}
    for _, i, seq, qual in rows[1:]:
        total, worst, width = plain(qual, 10)
        assert got[i].score == pytest.approx(total / len(seq) + 2 * worst / width + 1) and got[i].mean_quality == "mine"
    assert rd.read_scores(df.where("read_id = 0"), "worst_window").first().score is None
    assert rd.read_scores(df.where("read_id = 0")).first().score is None


@pytest.mark.parametrize("expr", ["worst_window", "nullif(worst_window, worst_window)", "length"])
def test_best_bases_by_an_expression(spark, expr):
    rng = np.random.default_rng(43)
    rows = rows_of(rng, rng.integers(5, 60, 60))
    keys = {"worst_window": lambda r: plain(r[3], 10)[1] / plain(r[3], 10)[2], "length": lambda r: len(r[2])}
    key = keys.get(expr, lambda r: 0)
    total, target, want = 0, sum(len(r[2]) for r in rows) // 2, set()
    for r in sorted(rows, key=lambda r: (-key(r), -len(r[2]), r[1])):
        if total < target:
            want.add(r[1])
        total += len(r[2])
    kept = rd.filter_best_bases(spark.createDataFrame(rows, READS), 1 << 40, 50, least=1, score_expr=expr, window=10)
    assert {r.read_id for r in kept.collect()} == want and kept.columns == ["sample", "read_id", "seq", "qual"]


def test_the_plan_decodes_qualities_once(spark):
    kept = rd.filter_best_bases(spark.createDataFrame(rows_of(np.random.default_rng(44), [600] * 4), READS), 1 << 40, score_expr="worst_window")
    assert "ArrowEvalPython" not in kept._jdf.queryExecution().toString()
