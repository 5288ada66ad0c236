"""Variants in gaps between runs of unique k-mers against what was changed."""

import numpy as np

from readloom.operators import variants as va


def sequence(rng, n):
    return "".join(rng.choice(list("ACGT"), n))


def called(spark, ref, genomes, **how):
    g = spark.createDataFrame(genomes, "sample string, seq string")
    rows = va.gap_variants(g, spark.createDataFrame([(ref,)], "seq string"), **how).collect()
    return {s: sorted((r.pos, r.ref_text, r.text) for r in rows if r.sample == s) for s, _ in genomes}


def changed(ref, changes):
    out = ref
    for pos, old, new in sorted(changes, reverse=True):
        assert ref[pos : pos + len(old)] == old
        out = out[:pos] + new + out[pos + len(old) :]
    return out


def test_substitutions_closer_than_flanks_are_all_called(spark):
    rng = np.random.default_rng(31)
    ref = sequence(rng, 6000)
    want, genomes = {}, []
    for s in range(4):
        places = np.unique(rng.integers(30, 5960, 150))
        want[str(s)] = [(int(p), ref[p], "ACGT"["ACGT".index(ref[p]) - 1 - s % 3]) for p in places]
        genomes.append((str(s), changed(ref, want[str(s)])))
    assert (np.diff([p for p, *_ in want["0"]]) < 12).any()
    assert called(spark, ref, genomes) == want


def test_insertions_and_deletions_give_the_sample_back(spark):
    rng = np.random.default_rng(32)
    ref = sequence(rng, 5000)
    genomes = []
    for s in range(3):
        changes = []
        for p in range(60, 4900, 97):
            kind, n = rng.integers(0, 3), int(rng.integers(1, 30))
            changes.append((p, ref[p : p + n], "") if kind == 0 else (p, "", sequence(rng, n)) if kind == 1 else (p, ref[p], "ACGT"["ACGT".index(ref[p]) - 1]))
        genomes.append((f"s{s}", changed(ref, changes)))
    found = called(spark, ref, genomes)
    for s, g in genomes:
        assert changed(ref, found[s]) == g and len(found[s]) == len(range(60, 4900, 97))


def test_repeats_are_placed_left_and_long_gaps_are_none(spark):
    rng = np.random.default_rng(33)
    left, right = sequence(rng, 300) + "T", "G" + sequence(rng, 300)
    ref = left + "CACACA" + right
    got = called(spark, ref, [("less", left + "CACA" + right), ("more", left + "CACACACA" + right), ("same", ref), ("far", left + sequence(rng, 500) + right), ("none", None), ("short", "ACG")])
    assert got == {"less": [(301, "CA", "")], "more": [(301, "", "CA")], "same": [], "far": [], "none": [], "short": []}
    assert called(spark, ref, [("far", left + "A" * 300 + right)], longest=400)["far"] != []
