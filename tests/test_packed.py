"""K-mers as numbers, and runs of one minimizer, against texts."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readloom.operators import kmers as km
from readloom.operators import packed


def sequence(rng, n, letters="ACGT"):
    return "".join(rng.choice(letters) for _ in range(n))


def kmers_of(t, k):
    return [t[i : i + k] for i in range(len(t) - k + 1) if set(t[i : i + k]) <= set("ACGT")]


def number(x):
    return sum("ACGT".index(c) * 4**i for i, c in enumerate(reversed(x)))


@pytest.mark.parametrize("k", [1, 2, 3, 11, 16, 21, 31])
def test_numbers_of_all_kmers(k, monkeypatch):
    monkeypatch.setattr(packed, "PIECE", 37)
    assert packed.windows(np.array([0, 1, 2, 3] * 9), k)[0] == number("".join("ACGT" * 9)[:k])
    rng = random.Random(k)
    texts = [sequence(rng, rng.randrange(0, 90), "ACGTACGTACGTN") for _ in range(30)] + [None, "", "ACGT" * 40, "n" * 9]
    got = [[] for _ in texts]
    for at, row, x in packed.pieces(pa.array(["skipped", *texts]).slice(1), k):
        for r, v in zip(row, x, strict=True):
            got[r].append(int(v))
    assert got == [[number(x) for x in kmers_of(t or "", k)] for t in texts]


def test_least_of_neighbours():
    x = np.random.default_rng(1).integers(0, 99, 50)
    for w in range(1, 20):
        assert packed.least_in(x, w).tolist() == [min(x[i : i + w]) for i in range(50 - w + 1)]


def test_runs_hold_every_kmer_once_and_move_little(spark):
    rng = random.Random(4)
    texts = [sequence(rng, rng.randrange(0, 400)) for _ in range(60)] + ["A" * 300, sequence(rng, 80, "ACGTN"), None, ""] * 2
    df = spark.createDataFrame([(f"s{i % 3}", t) for i, t in enumerate(texts)], "sample string, seq string").repartition(4)
    for k in (5, 15, 31):
        want = Counter((f"s{i % 3}", x) for i, t in enumerate(texts) for x in kmers_of(t or "", k))
        counted = packed.run_kmers(df, k, ["sample"]).groupBy("sample", "minimizer", "kmer").agg(F.sum("n").alias("n"))
        assert {(r["sample"], r.kmer): r.n for r in counted.collect()} == want
    sizes = packed.runs(df, 31, []).agg(F.sum(F.length("run") + 24)).first()[0]
    assert sizes < (31 + 24) * sum(len(kmers_of(t or "", 31)) for t in texts) / 5


def test_counting_after_runs_needs_no_second_shuffle(spark):
    df = spark.createDataFrame([("a", "ACGT" * 30)], "sample string, seq string")
    for counted in (packed.run_kmers(df, 15, []).groupBy("minimizer", "kmer").agg(F.sum("n").alias("n")), packed.run_kmers(df, 15, ["sample"]).groupBy("minimizer", "kmer").agg(F.count_distinct("sample").alias("n"))):
        assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("large", [False, True])
def test_baits_by_set_and_by_filter(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(packed, "SET", 10)
    rng = random.Random(7)
    ref = sequence(rng, 700)
    rows = [("s", i, sequence(rng, 50) + (ref[i * 9 : i * 9 + 30 + i % 9] if i % 2 else "") + sequence(rng, 40)) for i in range(60)] + [("s", 99, None), ("t", 5, ref), ("t", 5, ref), ("t", 6, "ACN" * 30)]
    df = spark.createDataFrame(rows, "sample string, read_id long, seq string").repartition(3)
    baits = set(kmers_of(ref, 31))
    want = Counter()
    for s, i, t in rows:
        want[s, i] += sum(x in baits for x in kmers_of(t or "", 31))
    got = {(r["sample"], r.read_id): r.n_kmers for r in km.bait_kmers(df, spark.createDataFrame([(ref,), (ref[:90],)], "seq string"), 31).collect()}
    assert got == {x: n for x, n in want.items() if n} and len(got) > 10
    assert km.bait_kmers(df, spark.createDataFrame([("ACG",)], "seq string"), 31).count() == 0
