"""Small cases worked out by hand, properties, and brute-force comparisons of the sequence operators."""

import gzip
import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.functions import sequence as fn
from readloom.operators import adapters as ad
from readloom.operators import assembly as asm
from readloom.operators import kmers as km
from readloom.operators import logs as lg
from readloom.operators import mapping as mp
from readloom.operators import reads as rd
from readloom.operators import trees as tr
from readloom.operators import variants as va
from readloom.plans import pipeline
from readloom.sources import files
from readloom.sources.stages import forget_samples, materialize_samples, materialize_stage

READS = "sample string, read_id long, seq string, qual string"


def sequence(rng, n):
    return "".join(rng.choice(list("ACGT"), n))


def reads(spark, rows):
    return spark.createDataFrame([(s, i, x, "I" * len(x)) for s, i, x in rows], READS)


def test_names(spark):
    rows = spark.createDataFrame([("/a/s1_pass.r1.fastq.gz", "@x/1 y z"), ("b_filtered.fq", "@q")], "p string, h string")
    got = rows.select(fn.sample_name("p"), fn.read_id("h"), fn.stem("p"), fn.accepted_extension("p")).collect()
    assert [tuple(r) for r in got] == [("s1", "x/1", "s1_pass.r1.fastq", True), ("b", "q", "b_filtered", True)]


def test_reverse_complement_is_an_involution(spark):
    df = spark.createDataFrame([("ACCGT",), ("",)], "s string")
    assert [tuple(r) for r in df.select(fn.reverse_complement("s"), fn.reverse_complement(fn.reverse_complement("s"))).collect()] == [("ACGGT", "ACCGT"), ("", "")]


def test_phred_and_hamming(spark):
    df = spark.createDataFrame([("!I5", "ACG", "ATG"), ("", "", "")], "q string, a string, b string")
    got = df.select(fn.phred_sum("q"), fn.phred_sum("q", 30), fn.hamming(F.col("a"), F.col("b"))).collect()
    assert [tuple(r)[:2] for r in got] == [(60, 40), (0, 0)] and got[0][2] == 1


def test_n50(spark):
    r = reads(spark, [("s", i, "A" * n) for i, n in enumerate([2, 2, 2, 3, 3, 4, 8, 8])])
    assert tuple(rd.read_stats(r).first()) == ("s", 8, 32, 8, 2)


def test_best_bases_keep_the_crossing_read(spark):
    rng = np.random.default_rng(1)
    rows = [("s", i, "A" * int(n), "".join(chr(33 + int(q)) for q in rng.integers(1, 40, int(n)))) for i, n in enumerate(rng.integers(5, 60, 80))]
    df = spark.createDataFrame(rows, READS)
    score = lambda r: (-sum(ord(c) - 33 for c in r[3]) / len(r[2]), -len(r[2]), r[1])
    for percent, depth in ((95, 100), (50, 100), (95, 3)):
        target, total, want = min(sum(len(r[2]) for r in rows if len(r[2]) >= 10) * percent // 100, depth * 100), 0, set()
        for r in sorted((r for r in rows if len(r[2]) >= 10), key=score):
            if total < target:
                want.add(r[1])
            total += len(r[2])
        got = {r.read_id for r in rd.filter_best_bases(df, 100, percent, depth, 10).collect()}
        assert got == want


def test_kmers_and_minimizers_of_long_sequences(spark):
    rng = np.random.default_rng(2)
    texts = [sequence(rng, n) for n in (0, 3, 14, 15, 24, 255, 256, 257, 600, 40_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, seq string")
    want = {(i, p, t[p : p + 15]) for i, t in enumerate(texts) for p in range(len(t) - 14)}
    got = [tuple(r) for r in km.kmers(df, 15, ["id"]).collect()]
    assert len(got) == len(want) and set(got) == want
    least = set()
    for i, t in enumerate(texts):
        own = [(hashlib.md5(t[p : p + 15].encode()).hexdigest()[:8], t[p : p + 15], p) for p in range(len(t) - 14)]
        least |= {(i, p, k) for j in range(len(own) - 9) for _, k, p in [min(own[j : j + 10])]}
    assert {tuple(r) for r in km.minimizers(df, ["id"]).collect()} == least


def test_runs_of_one_base_are_no_common_minimizer(spark):
    rng = np.random.default_rng(13)
    texts = [sequence(rng, 200) + "A" * 15 + sequence(rng, 200) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, seq string")
    found = km.minimizers(df, ["id"]).where(F.col("kmer") == "A" * 15).select("id").distinct().count()
    assert found < 50  # by letters all hundred; by chance a quarter, as three quarters of digests are above this one's


def test_hamming_baits_equal_brute_force_and_grow(spark):
    rng = np.random.default_rng(3)
    ref = sequence(rng, 120)
    rows = []
    for i in range(25):
        a = int(rng.integers(0, 60))
        x = list(ref[a : a + 40])
        for j in rng.integers(0, 40, i % 6):
            x[j] = "ACGT"["ACGT".index(x[j]) - 1]
        rows.append(("s", i, "".join(x)))
    r, t = reads(spark, rows), spark.createDataFrame([(ref,)], "seq string")
    bait = {ref[p : p + 16] for p in range(len(ref) - 15)}
    last = {}
    for h in (0, 1, 2):
        want = {i: n for _, i, x in rows if (n := sum(any(sum(u != v for u, v in zip(x[p : p + 16], b, strict=True)) <= h for b in bait) for p in range(len(x) - 15)))}
        got = {r.read_id: r.n_kmers for r in km.bait_kmers_hamming(r, t, 16, h).collect()}
        assert got == want and set(last) <= set(got)
        last = got
    assert {r.read_id: r.n_kmers for r in km.bait_kmers(r, t, 16).collect()} == {r.read_id: r.n_kmers for r in km.bait_kmers_hamming(r, t, 16, 0).collect()}


def test_overlaps_of_a_deep_sample_are_all_found(spark):
    """Eighty reads over one place: every minimizer is in more than fifty of them."""
    rng = random.Random(9)
    ref = "".join(rng.choice("ACGT") for _ in range(760))
    starts = [2 * i for i in range(80)]
    found = mp.overlap_pairs(reads(spark, [("s", i, ref[x : x + 600]) for i, x in enumerate(starts)]), 300).collect()
    assert {(r.a, r.b) for r in found} == {(a, b) for a in range(80) for b in range(a + 1, 80)}
    assert all(r.overlap <= 600 - (starts[r.b] - starts[r.a]) for r in found)



def test_mapping_finds_place_and_strand(spark):
    rng = np.random.default_rng(4)
    ref = sequence(rng, 5000)
    flip = str.maketrans("ACGT", "TGCA")
    rows = [("s", 1, ref[700:1300]), ("s", 2, ref[2000:2600][::-1].translate(flip)), ("s", 3, sequence(rng, 600))]
    t = spark.createDataFrame([("r", ref)], "ref_id string, seq string")
    got = {r.read_id: r for r in rd.primary_only(mp.map_reads(reads(spark, rows), t)).collect()}
    assert (got[1].strand, got[1].tstart - got[1].qstart, got[1].flag) == ("+", 700, 0)
    assert (got[2].strand, got[2].flag, got[3].flag) == ("-", 16, 4)
    pairs = mp.overlap_pairs(reads(spark, [("s", 1, ref[0:900]), ("s", 2, ref[400:1300]), ("s", 3, ref[3000:3900])]), 300).collect()
    assert [(r.a, r.b) for r in pairs] == [(1, 2)] and 400 <= pairs[0].overlap <= 500


def test_adapters(spark):
    rng = np.random.default_rng(5)
    a = "ACGTTGCAAGTCCATGGTAC"
    b = a[:4] + "A" + a[5:]
    body = sequence(rng, 400)
    rows = [("s", 1, a + body), ("s", 2, body + b), ("s", 3, body), ("s", 4, body[:200] + a + body[200:]), ("s", 5, "AC"), ("s", 6, a)]
    r, t = reads(spark, rows), spark.createDataFrame([("x", a)], "name string, seq string")
    assert tuple(ad.detect_adapters(r, t).first()) == ("x", 3, 6, True)
    got = {r.read_id: (r.seq, len(r.qual)) for r in ad.trim_adapters(r, t).collect()}
    assert got == {1: (body, 400), 2: (body, 400), 3: (body, 400), 4: (body[:200] + a + body[200:], 420), 5: ("AC", 2)}
    parts = sorted((r.fragment_id, r.seq, len(r.qual)) for r in ad.split_chimeras(r, a).where("read_id = 4").collect())
    assert parts == [("4_1", body[:200], 200), ("4_2", body[200:], 200)]


def test_one_snp_genome(spark):
    rng = np.random.default_rng(6)
    ref = sequence(rng, 300)
    other = ref[:150] + ("A" if ref[150] != "A" else "C") + ref[151:]
    g = spark.createDataFrame([(1, ref), (2, other), (3, ref)], "sample int, seq string")
    t = spark.createDataFrame([(ref,)], "seq string")
    assert [tuple(r) for r in va.call_snps(g, t).collect()] == [(2, 150, ref[150], other[150])]
    sites = va.called_sites(g, t)
    core = va.core_sites(sites, g)
    # Sites within 12 bases of the change lose their flanks in one sample.
    assert core.count() == 300 - 24 - 24 and core.where("n_bases > 1").count() == 1
    p = va.site_patterns(sites, core)
    got = {(r.a, r.b): r.n_diff for r in va.snp_distance(p, g).collect()}
    assert got == {(1, 2): 1, (1, 3): 0, (2, 3): 1}
    assert {len(r.aligned) for r in va.core_alignment(sites, core).collect()} == {252}


def test_bootstrap_weights_sum_to_sites(spark):
    got = va.bootstrap_sites(spark, 37, 5).groupBy("rep").agg(F.sum("weight").alias("w")).collect()
    assert {(r.rep, r.w) for r in got} == {(i, 37) for i in range(6)}


def test_neighbour_joining_finds_an_additive_tree():
    names = list("abcde")
    d = np.array([[0, 5, 9, 9, 8], [5, 0, 10, 10, 9], [9, 10, 0, 8, 7], [9, 10, 8, 0, 3], [8, 9, 7, 3, 0]], float)
    splits = {frozenset(x + y) for x, y in tr.joined(names, d)}
    assert frozenset((0, 1)) in splits and (frozenset((3, 4)) in splits or frozenset((0, 1, 2)) in splits)


def test_clades_and_newick(spark):
    rows = [(rep, a, b, 1 if {a, b} in ({"a", "b"}, {"c", "d"}) else 9) for rep in range(4) for a, b in itertools.combinations("abcd", 2)]
    d = spark.createDataFrame(rows, "rep int, a string, b string, n_diff long")
    s = spark.createDataFrame([(x,) for x in "abcd"], "sample string")
    support = tr.clade_support(tr.nj_clades(d, s), 3)
    assert [tuple(r) for r in support.collect()] == [(["c", "d"], 3, 1.0)]
    assert tr.newick(support, s) == "(a,b,(c,d)1);"


def test_unitigs_give_a_repeat_free_sequence_back(spark):
    rng = np.random.default_rng(7)
    text = sequence(rng, 700)
    parts = [(i, text[i : i + 100]) for i in range(0, 601, 50)]
    df = spark.createDataFrame(parts, "id int, seq string")
    assert [tuple(r) for r in asm.unitigs(df, 21).collect()] == [(text, 680)]
    ring = sequence(rng, 90)
    cycle = asm.unitigs(spark.createDataFrame([(1, ring + ring[:20])], "id int, seq string"), 21).collect()
    assert len(cycle) == 1 and cycle[0].n_kmers == 90 and cycle[0].seq[:90] in ring + ring
    assert asm.unitigs(df.limit(0), 21).count() == 0


def test_consensus_takes_the_majority(spark):
    rng = np.random.default_rng(8)
    ref = sequence(rng, 200)
    x = ref[:100] + ("A" if ref[100] != "A" else "C") + ref[101:]
    r = reads(spark, [("s", 1, x), ("s", 2, x), ("s", 3, ref)])
    t = spark.createDataFrame([(ref,)], "seq string")
    got = asm.pileup_consensus(r, t).first()
    assert got.seq == x
    assert tuple(asm.assembly_stats(asm.pileup_consensus(r, t), r).first()) == ("s", 1, 200, 3.0)


def test_files(spark, tmp_path):
    d = tmp_path / "in"
    (d / "deep").mkdir(parents=True)
    record = "@r1 x\nACGT\n+\nIIII\n@r1 again\nAC\n+\n@@\n"
    (d / "a_pass.fastq").write_text(record)
    with gzip.open(d / "deep" / "b.fq.gz", "wt") as f:
        f.write(record)
    (d / "deep" / "a.fastq").write_text(record)
    (d / "empty.fq").write_text("")
    found = {r["sample"]: r["path"].rsplit("/", 1)[1] for r in files.discover_samples(spark, str(d)).collect()}
    assert found == {"a": "a.fastq", "b": "b.fq.gz"}
    rows = files.read_fastq(spark, [str(d / "a_pass.fastq"), str(d / "deep" / "b.fq.gz")]).collect()
    assert sorted((r["sample"], r.read_id, r.header, r.seq, r.qual) for r in rows) == [
        (s, "r1", h, x, q) for s in "ab" for h, x, q in (("@r1 again", "AC", "@@"), ("@r1 x", "ACGT", "IIII"))
    ]
    fasta = tmp_path / "ref.fasta"
    fasta.write_text(">one a>b c\nACG\nT\n>two\n>three\nGG\n")
    assert sorted((r["name"], r.seq) for r in files.read_fasta(spark, str(fasta)).collect()) == [("one", "ACGT"), ("three", "GG"), ("two", "")]
    assert rd.fasta_length(files.read_fasta(spark, str(fasta))).first().total_bases == 6
    files.validate_inputs(spark, str(d), str(fasta))
    (d / "notes.txt").write_text("x")
    with pytest.raises(ValueError):
        files.validate_inputs(spark, str(d), str(fasta))
    assert [r["sample"] for r in files.list_assemblies(spark, str(tmp_path)).collect()] == ["ref"]
    none = tmp_path / "none"
    none.mkdir()
    (none / "x.txt").write_text("x")
    with pytest.raises(ValueError):
        files.discover_samples(spark, str(none))


def test_xmfa_blocks_join_in_order(spark, tmp_path):
    (tmp_path / "a.xmfa").write_text("#FormatVersion\n>1:1-4 + s\nAC\nGT\n>2:1-4 + s\nA-GT\n=\n>1:9-10 + s\nTT\n>2:7-8 + s\nTA\n=\n")
    got = {r.entry: r.aligned for r in files.read_xmfa_blocks(spark, str(tmp_path / "a.xmfa")).collect()}
    assert got == {"1": "ACGTTT", "2": "A-GTTA"}


def test_logs(spark, tmp_path):
    for s in ("s1", "s2"):
        (tmp_path / s).mkdir()
    (tmp_path / "s1" / "flye.log").write_text("Total read length: 5\nTotal read length: 77\nReads N50/N90: 12 / 3\n\tTotal length:\t99\n\tFragments:\t4\n\tMean coverage:\t8\n")
    (tmp_path / "s2" / "flye.log").write_text("nothing\n")
    (tmp_path / "x_shasta_stdout.txt").write_text(
        "Total number of reads is 3.\nTotal number of raw bases is 50.\nN50 for read length is 20 bases.\nTotal length of assembled sequence is 44\nThe assembly graph has 6 vertices and\n"
    )
    assert sorted(tuple(r) for r in lg.flye_stats(files.read_log_lines(spark, str(tmp_path))).collect()) == [("s1", 77, 12, 99, 4, 8), ("s2", 0, 0, 0, 0, 0)]
    assert [tuple(r) for r in lg.shasta_stats(files.read_stdout_lines(spark, str(tmp_path))).collect()] == [("x", 3, 50, 20, 44, 6)]


def test_stages_run_once(spark, tmp_path):
    path = str(tmp_path / "stage")
    assert materialize_stage(spark, path, lambda: spark.range(3).toDF("x")).count() == 3
    assert materialize_stage(spark, path, lambda: spark.range(9).toDF("x")).count() == 3


def test_stages_by_sample_compute_what_is_open(spark, tmp_path):
    path, runs = str(tmp_path / "stage"), []
    table = lambda rows: spark.createDataFrame(rows, "sample string, x int")

    def total(own):
        runs.append(sorted((r.sample is not None, r.sample or "") for r in own.select("sample").distinct().collect()))
        return own.where("x > 0").groupBy("sample").agg(F.sum("x").alias("x"))

    use = lambda rows: {(r.sample, r.x) for r in materialize_samples(spark, path, table(rows), total).collect()}
    assert use([("007", 1), ("007", 2), ("b", 0), (None, 5)]) == {("007", 3), (None, 5)}
    assert use([("007", 9), ("b", 9), (None, 9), ("c", 4)]) == {("007", 3), (None, 5), ("c", 4)}  # b is finished without rows
    assert use([("c", 7)]) == {("c", 4)}
    forget_samples(table([("007", 0)]).select("sample"), path)
    assert use([("007", 8), ("c", 7)]) == {("007", 8), ("c", 4)}
    table([("c", 99)]).write.parquet(f"{path}/rows/run=rdead")  # a run that died before its entry
    assert use([("c", 7)]) == {("c", 4)}
    assert runs == [[(False, ""), (True, "007"), (True, "b")], [(True, "c")], [(True, "007")]]
    assert materialize_samples(spark, str(tmp_path / "none"), table([]), total).count() == 0


def test_adapters_of_each_sample(spark):
    a = "ACGTTGCAAGTCCATGGTAC"
    body = sequence(np.random.default_rng(12), 300)
    r = reads(spark, [("with", i, a + body) for i in range(5)] + [("without", i, body) for i in range(500)])
    known = spark.createDataFrame([("A", a)], "name string, seq string")
    assert {(x.sample, x.n_reads, x.present) for x in ad.detect_adapters(r, known, by_sample=True).collect()} == {("with", 5, True), ("without", 0, False)}
    assert ad.detect_adapters(r, known).first().present is False


def test_too_few_samples(spark):
    with pytest.raises(ValueError):
        rd.require_min_samples(reads(spark, [("a", 1, "A"), ("b", 2, "A")]))


def test_partition_count_changes_nothing(spark):
    rng = np.random.default_rng(9)
    r = reads(spark, [(f"s{i % 3}", i, sequence(rng, int(rng.integers(0, 200)))) for i in range(60)])
    want = sorted(map(tuple, rd.filter_best_bases(r, 50, least=20).collect()))
    assert sorted(map(tuple, rd.filter_best_bases(r.repartition(7), 50, least=20).collect())) == want


def test_whole_plan(spark, tmp_path):
    rng = np.random.default_rng(10)
    ref = sequence(rng, 2000)
    rows = []
    for s in range(4):
        g = list(ref)
        for p in (300 + 7 * s, 900, 1500 if s > 1 else 1501):
            g[p] = "ACGT"["ACGT".index(g[p]) - 1]
        g = "".join(g)
        rows += [(f"s{s}", s * 100 + i, g[a : a + 700]) for i, a in enumerate(range(0, 1301, 100))] + [(f"s{s}", s * 100 + 99, sequence(rng, 700))]
    t = spark.createDataFrame([(ref,)], "seq string")
    done = pipeline.run(spark, reads(spark, rows), t, str(tmp_path), spark.createDataFrame([], "name string, seq string"), reps=5)
    assert done["extracted"].where("read_id % 100 = 99").count() == 0
    assert done["assembled"].count() == 4 and done["stats"].count() == 4
    assert done["sites"].where("base <> ref_base").count() >= 8
    assert done["support"].count() >= 1
