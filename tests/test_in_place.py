"""Steps that work on numbers where the reads lie: minimizers and mapping against plain forms, and what they shuffle."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readloom.functions import digests
from readloom.operators import assembly as asm
from readloom.operators import kmers as km
from readloom.operators import mapping as mp
from readloom.operators import packed

READS = "sample string, read_id long, seq string, qual string"


def head(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("k", [1, 3, 4, 15, 31, 55, 60])
def test_digests_equal_md5(k):
    text = "".join(random.Random(k).choice("ACGTN") for _ in range(400))
    data, _ = packed.flat(pa.array([text]))
    assert digests.window_heads(data, k).tolist() == [head(text[i : i + k]) for i in range(len(text) - k + 1)]
    assert digests.numbered_heads([b"m7|", b"m123|"], 1003).tolist() == [[head(p + str(i)) for i in range(1, 1004)] for p in ("m7|", "m123|")]


@pytest.mark.parametrize(("w", "k", "letters"), [(10, 15, "ACGT"), (10, 15, "ACGTN"), (5, 3, "AC"), (1, 16, "ACGT"), (7, 21, "ACG")])
def test_minimizers_of_any_letters_across_pieces(w, k, letters, monkeypatch):
    monkeypatch.setattr(packed, "PIECE", 64)
    rng = random.Random(k)
    seqs = ["".join(rng.choice(letters) for _ in range(n)) for n in (0, 300, k + w - 2, k + w - 1, 65, 130, 1)] + ["A" * 200, None]
    want = set()
    for r, x in enumerate(seqs):
        turn = [(head(x[i : i + k]), x[i : i + k], i) for i in range(len(x) - k + 1)] if x else []
        want |= {(r, min(turn[i : i + w])[2]) for i in range(len(turn) - w + 1)}
    data, offsets = packed.flat(pa.array(seqs))
    got = [(int(r), int(a - offsets[r])) for at, row in packed.minimizer_places(data, offsets, w, k) for a, r in zip(at, row, strict=True)]
    assert len(got) == len(set(got)) and set(got) == want


def test_mapping_shuffles_hits_only_and_equals_the_join(spark, monkeypatch):
    rng = random.Random(3)
    ref = "".join(rng.choice("ACGT") for _ in range(2500))
    turned = ref[500:1100][::-1].translate(str.maketrans("ACGT", "TGCA"))
    texts = [ref[100:700], turned, "".join(rng.choice("ACGT") for _ in range(600)), ref[300:500] + "N" + ref[500:900], ref[0:300] + ref[2000:2300], "", "ACGT"]
    df = spark.createDataFrame([("s", i, x, "I" * len(x)) for i, x in enumerate(texts)], READS)
    refs = spark.createDataFrame([("r", ref), ("q", ref[400:1600] + ref[1900:2500])], "ref_id string, seq string")
    rows = mp.map_reads(df, refs)
    assert shuffles(rows) == 1
    got = sorted(map(repr, rows.collect()))
    monkeypatch.setattr(mp, "SMALL_ROWS", 0)
    assert got == sorted(map(repr, mp.map_reads(df, refs).collect()))
    flags = {r.read_id: r.flag for r in rows.where(F.col("flag").bitwiseAND(256) == 0).collect()}
    assert flags == {0: 0, 1: 16, 2: 4, 3: 0, 4: 0, 5: 4, 6: 4}


def test_a_read_given_twice_is_mapped_once(spark):
    rng = random.Random(4)
    ref = "".join(rng.choice("ACGT") for _ in range(900))
    df = spark.createDataFrame([("s", 1, ref[100:700], "")] * 3 + [("s", 2, "A" * 100, "")] * 2, READS)
    got = mp.map_reads(df, spark.createDataFrame([("r", ref)], "ref_id string, seq string")).collect()
    assert sorted((r.read_id, r.flag) for r in got) == [(1, 0), (2, 4)]


def test_consensus_shuffles_tiles_not_kmers_and_equals_the_join(spark, monkeypatch):
    rng = random.Random(5)
    ref = "".join(rng.choice("ACGT") for _ in range(2000))
    swapped = lambda x, i: x[:i] + ("A" if x[i] != "A" else "C") + x[i + 1 :]
    cut = [(300, 900), (300, 900), (1900, 2000), (0, 60), (700, 1300)]
    texts = [swapped(ref[a:b], 30) for a, b in cut] + ["ACGT", "", ref[100:130] + "N" + ref[131:160]]
    df = spark.createDataFrame([("st"[i % 2], i, x, "") for i, x in enumerate(texts)], READS).repartition(3)
    t = spark.createDataFrame([(ref,)], "seq string")
    assert max(asm.pileup(df, t).groupBy("sample", "o").count().select("count").toPandas()["count"]) <= 3
    got = sorted(map(tuple, asm.pileup_consensus(df, t).collect()))
    monkeypatch.setattr(asm, "SMALL_ROWS", 0)
    assert got == sorted(map(tuple, asm.pileup_consensus(df, t).collect())) and [len(x[1]) for x in got] == [2000, 2000]
    assert [sum(a != b for a, b in zip(x[1], ref, strict=True)) for x in got] == [3, 2]


@pytest.mark.parametrize(("k", "most"), [(31, 2), (16, 1), (9, 2), (12, 0), (31, 1)])
def test_near_kmers_are_found_without_a_shuffle_of_kmers(spark, monkeypatch, k, most):
    rng = random.Random(k)
    ref = "".join(rng.choice("ACGT") for _ in range(400)) + "A" * 60
    texts = ["".join(rng.choice("ACGTN") if rng.random() < 0.06 else c for c in ref[a : a + 150]) for a in range(0, 300, 50)] + ["A" * 80, "", "ACG", "N" * 50]
    df = spark.createDataFrame([("s", i, x, "") for i, x in enumerate(texts)], READS)
    t = spark.createDataFrame([(ref,)], "seq string")
    baits = {ref[i : i + k] for i in range(len(ref) - k + 1)}
    near = lambda x: any(sum(a != b for a, b in zip(x, y, strict=True)) <= most for y in baits)
    want = {i: sum(near(x[j : j + k]) for j in range(len(x) - k + 1)) for i, x in enumerate(texts)}
    rows = km.bait_kmers_hamming(df, t, k, most)
    assert shuffles(rows) == 1
    assert {r.read_id: r.n_kmers for r in rows.collect()} == {i: n for i, n in want.items() if n}
    monkeypatch.setattr(km, "SMALL_ROWS", 0)
    assert {r.read_id: r.n_kmers for r in km.bait_kmers_hamming(df, t, k, most).collect()} == {i: n for i, n in want.items() if n}


def test_small_samples_overlap_without_a_shuffle_of_anchors(spark, monkeypatch):
    rng = random.Random(7)
    ref = "".join(rng.choice("ACGT") for _ in range(3000)) + "AC" * 60
    rows = [("xy"[i % 2], 100 - i, ref[a : a + 700], "") for i, a in enumerate(rng.randrange(2500) for _ in range(24))]
    rows += [rows[0], ("x", 7, "", ""), ("y", 8, ref[:700].replace("A", "N", 3), ""), ("z", 1, ref[:500], ""), (None, 1, ref[:500], ""), (None, 2, ref[:500], "")]
    df = spark.createDataFrame(rows, READS).repartition(3)
    found = mp.overlap_pairs(df, 200)
    assert shuffles(found) == 1
    got = sorted(map(tuple, found.collect()))
    for bound in (0, 1000):  # all samples, or all but the smallest, by the join
        monkeypatch.setattr(mp, "WHOLE", bound)
        assert got == sorted(map(tuple, mp.overlap_pairs(df, 200).collect())) and {r[0] for r in got} == {"x", "y"}


def test_kmer_counts_of_each_read_without_a_table_of_kmers(spark, monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice(x) for _ in range(n)) for x, n in (("ACGT", 90), ("AC", 60), ("A", 50), ("ACGTN", 70), ("ACGT", 9), ("ACGT", 8), ("", 0))]
    df = spark.createDataFrame([("s", i, x, "") for i, x in enumerate(texts)] + [("s", 0, texts[1], ""), (None, None, texts[0], "")], READS)
    made = []
    monkeypatch.setattr(km, "kmers", lambda df, *a, f=km.kmers: made.append({r.read_id for r in df.select("read_id").collect()}) or f(df, *a))
    got = {(r["sample"], r.read_id): (r.n, r.n_distinct, r.least) for r in km.kmer_counts(df, 9).collect()}
    own = {("s", i): [x[j : j + 9] for j in range(len(x) - 8)] for i, x in enumerate(texts)}
    own["s", 0] += own["s", 1]
    own[None, None] = [texts[0][j : j + 9] for j in range(82)]
    assert got == {i: (len(x), len(set(x)), min(x)) for i, x in own.items() if x}
    assert made == [{0, 3}]  # the read given twice and the one with another letter
