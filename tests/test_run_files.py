"""The plan from a folder of files to a tree, and its choices."""

import gzip
import random

import pytest

from readloom.plans import pipeline
from readloom.sources import files

A = "ACGTTGCAAGTCCATGGTAC"


def sequence(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_from_files_to_a_tree(spark, tmp_path):
    rng = random.Random(10)
    ref, d = sequence(rng, 2400), tmp_path / "in"
    d.mkdir()
    for s in range(5):
        g = list(ref)
        for p in (300 + 7 * s, 900, 1500 if s > 1 else 1501, 2000 if s < 2 else 2003):
            g[p] = "ACGT"["ACGT".index(g[p]) - 1]
        g, text = "".join(g), ""
        for i, a in enumerate(range(0, 1700, 100)):
            x = A + g[a : a + 350] + (A if i % 3 == 0 else "") + g[a + 350 : a + 1400]
            text += f"@r{i} of {s}\n{x}\n+\n{'I' * len(x)}\n"
            if i == 4:
                text += f"@copy{i}\n{x}\n+\n{'#' * len(x)}\n"
        text += f"@other\n{sequence(rng, 900)}\n+\n{'I' * 900}\n"
        with gzip.open(d / f"s{s}_pass.fastq.gz", "wt") as f:
            f.write(text)
    (d / "none.fastq").write_text(f"@x\n{sequence(rng, 800)}\n+\n{'I' * 800}\n")
    (tmp_path / "ref.fasta").write_text(f">one\n{ref[:1000]}\n{ref[1000:]}\n")
    out = str(tmp_path / "out")
    table = spark.createDataFrame([("a", A), ("b", sequence(rng, 20))], "name string, seq string")
    done = pipeline.run_files(spark, str(d), str(tmp_path / "ref.fasta"), out, adapters=table, reps=5, dedupe=True, min_size=100, assembler="unitigs")
    assert {r["sample"] for r in done["empty"].collect()} == {"none"}
    ids = {(r["sample"], r.read_id) for r in done["extracted"].collect()}
    assert not any(i in ("other", "copy4") for _, i in ids) and {("s0", "r4"), ("s4", "r16")} <= ids
    trimmed = done["trimmed"].collect()
    assert all(A not in r.seq and len(r.seq) == len(r.qual) for r in trimmed) and any(r.read_id.endswith("_2") for r in trimmed)
    assert done["assembled"].count() == 5 and done["outliers"].count() == 0
    assert {r["sample"] for r in done["unitigs"].collect()} == {f"s{i}" for i in range(5)}
    snps = done["sites"].where("base <> ref_base").groupBy("sample").count().collect()
    assert {r["sample"] for r in snps} == {f"s{i}" for i in range(5)}
    tree = (tmp_path / "out" / "files" / "tree.nwk").read_text()
    assert tree.endswith(";\n") and all(f"s{i}" in tree for i in range(5)) and "reference" in tree
    again = files.read_written(spark, f"{out}/files/reads")
    assert again.count() == done["filtered"].count() and {r["sample"] for r in again.select("sample").distinct().collect()} == {f"s{i}" for i in range(5)}
    assert files.read_fasta(spark, f"{out}/files/contigs").count() == done["unitigs"].count()
    assert files.read_stats_tsv(spark, f"{out}/files/stats", "sample string, n_contigs long, assembly_length long, mean_coverage double").count() == 5
    assert {r.entry for r in files.read_xmfa_blocks(spark, f"{out}/files/alignment").collect()} == {"reference", *(f"s{i}" for i in range(5))}


def test_wrong_inputs_and_choices_are_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x")
    (tmp_path / "ref.fasta").write_text(">r\nACGT\n")
    with pytest.raises(ValueError):
        pipeline.run_files(spark, str(tmp_path / "in"), str(tmp_path / "ref.fasta"), str(tmp_path / "out"))
    empty = spark.createDataFrame([], "sample string, read_id string, seq string, qual string")
    with pytest.raises(ValueError):
        pipeline.run(spark, empty, spark.createDataFrame([("ACGT",)], "seq string"), str(tmp_path / "out"), assembler="other")
