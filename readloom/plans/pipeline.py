"""Baiting, trimming, filtering, assembling and comparing as one chain of operators over tables of all samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions.sequence import phred_sum
from readloom.operators import adapters as ad
from readloom.operators import assembly as asm
from readloom.operators import kmers as km
from readloom.operators import mapping as mp
from readloom.operators import reads as rd
from readloom.operators import trees as tr
from readloom.operators import variants as va
from readloom.sources import files
from readloom.sources.stages import by_sample, materialize_samples, materialize_stage, stage_table


def bait(reads: DataFrame, ref: DataFrame, method: str = "minimizers", k: int = 99, hdist: int = 2, dedupe: bool = False) -> DataFrame:
    """Reads of interest, by ``minimizers`` or by shared ``kmers``; ``dedupe`` keeps the best of mapped reads with one start."""
    if method == "minimizers":
        hits = rd.primary_only(mp.map_reads(reads, ref.select(F.lit("ref").alias("ref_id"), "seq")))
        if dedupe:
            scores = reads.select("sample", "read_id", phred_sum("qual", 15).alias("score"))
            hits = mp.mark_duplicates(hits.join(scores, ["sample", "read_id"]), "score")
        return rd.extract_by_id(reads, mp.mapped_ids(hits))
    if method == "kmers":
        return rd.extract_by_id(reads, km.bait_kmers_hamming(reads, ref, k, hdist) if hdist else km.bait_kmers(reads, ref, k))
    raise ValueError("method is minimizers or kmers")


def bait_filter_stats(reads: DataFrame, ref: DataFrame, k: int = 31) -> DataFrame:
    """Exact k-mer baiting, length and quality filters, and statistics per sample."""
    n = rd.fasta_length(ref).first().total_bases
    kept = rd.filter_best_bases(bait(reads, ref, "kmers", k, 0), n)
    return rd.read_stats(kept)


def run(
    spark: SparkSession, reads: DataFrame, ref: DataFrame, out: str, adapters: DataFrame | None = None, method: str = "minimizers", size: int = 0, k: int = 99, min_size: int = 0,
    reps: int = 100, dedupe: bool = False, assembler: str = "consensus", least_covered: float = 0.1, score_expr: str = rd.MEAN_QUALITY,
) -> dict[str, DataFrame]:
    """All stages; what is finished is kept under ``out`` and not run again. ``size`` overrides the reference's length.

    The stages up to the assembly are kept by sample: with more samples in ``reads``, those alone are computed, and each
    sample's adapters are sought in its own reads. The comparison is of all samples, so it is kept under their number and a hash of their names.

    ``score_expr`` ranks reads for the filter, as ``read_scores`` takes it. Adapters that are found are trimmed, and reads are split where they hold one. ``assembler`` is ``consensus`` (one
    sequence per sample, which goes on to the comparison) or ``unitigs`` (these are kept beside it). Samples that cover less
    than ``least_covered`` of the reference are not compared; those of unusual length are listed. ``variants`` are the
    changes between runs of unique k-mers, ``sites`` those between unique flanks, which the comparison uses.
    """
    if assembler not in ("consensus", "unitigs"):
        raise ValueError("assembler is consensus or unitigs")
    n = size or rd.fasta_length(ref).first().total_bases
    done = {"extracted": materialize_samples(spark, f"{out}/1_extracted", reads, lambda own: bait(own, ref, method, k, dedupe=dedupe))}
    done["empty"] = rd.empty_samples(reads, done["extracted"])

    def trimmed(rows: DataFrame) -> DataFrame:
        if adapters is None:
            return rows
        found = ad.detect_adapters(rows, adapters, by_sample=True).where("present").groupBy("sample").agg(F.sort_array(F.collect_set("name")).alias("names"))
        found = stage_table(found, "adapters")
        out = by_sample(rows, found, "left_anti").select("sample", F.col("read_id").cast("string").alias("read_id"), "seq", "qual")
        for (names,) in found.select("names").distinct().collect():  # the sets of adapters that samples have; there are few adapters
            present = adapters.where(F.col("name").isin(names))
            own = ad.trim_adapters(by_sample(rows, found.where(F.col("names") == F.lit(names)), "left_semi"), present).select("sample", F.col("read_id").cast("string").alias("read_id"), "seq", "qual")
            for _, seq in ad.adapter_rows(present):
                own = ad.split_chimeras(own, seq).select("sample", F.col("fragment_id").alias("read_id"), "seq", "qual")
            out = out.unionByName(own)
        return out

    done["trimmed"] = materialize_samples(spark, f"{out}/2_trimmed", done["extracted"], trimmed)
    done["filtered"] = materialize_samples(spark, f"{out}/3_filtered", done["trimmed"], lambda own: rd.filter_best_bases(rd.min_length(own, min_size), n, score_expr=score_expr))
    done["assembled"] = materialize_samples(spark, f"{out}/4_assembled", done["filtered"], lambda own: asm.pileup_consensus(own, ref))
    if assembler == "unitigs":
        done["unitigs"] = materialize_samples(spark, f"{out}/4_unitigs", done["filtered"], unitigs_of)
    done["stats"] = asm.assembly_stats(done["assembled"], done["filtered"])
    done["outliers"] = rd.size_outliers(done["assembled"])
    rd.require_min_samples(done["assembled"])
    every = rd.add_reference(done["assembled"], ref)
    names = every.select("sample").distinct().agg(F.count("*"), F.sum(F.xxhash64("sample").cast("decimal(38,0)"))).first()
    compared = f"{out}/5_compared/{names[0]}_{names[1]}"
    called = materialize_stage(spark, f"{compared}/called", lambda: va.called_sites(every, ref))
    done["variants"] = materialize_stage(spark, f"{compared}/variants", lambda: va.gap_variants(done["assembled"], ref))
    covered = stage_table(va.coverage_cutoff(called, rd.fasta_length(ref).first().total_bases, least_covered), "covered").select("sample")
    genomes, sites = every.join(covered, "sample", "left_semi"), called.join(covered, "sample", "left_semi")
    core = va.core_sites(sites, genomes)
    done["sites"], done["alignment"] = sites, va.core_alignment(sites, core)
    boot = va.bootstrap_distance(va.bootstrap_patterns(sites, core, reps), genomes)
    done["support"] = materialize_stage(spark, f"{compared}/support", lambda: tr.clade_support(tr.nj_clades(boot, genomes), reps))
    done["samples"] = genomes.select("sample")
    return done


def unitigs_of(reads: DataFrame, k: int = 31, min_count: int = 2) -> DataFrame:
    """Rows (sample, seq, n_kmers): the unitigs of each sample's reads, k-mers seen once being errors."""
    samples = [r[0] for r in reads.select("sample").distinct().limit(tr.MOST_SAMPLES + 1).collect()]
    out = None
    for s in samples:
        own = asm.unitigs(reads.where(F.col("sample") == F.lit(s)), k, min_count).select(F.lit(s).alias("sample"), "seq", "n_kmers")
        out = own if out is None else out.unionByName(own)
    return out if out is not None else reads.select("sample", "seq", F.lit(0).cast("long").alias("n_kmers")).limit(0)


def run_files(spark: SparkSession, folder: str, reference: str, out: str, **choices) -> dict[str, DataFrame]:
    """``run`` from a folder of sequence files and a reference file; ``choices`` are those of ``run``.

    Beside the stages, ``out`` gets files: the filtered reads and the contigs per sample, statistics as tab-separated
    text, the alignment as XMFA, samples without reads of interest, and the tree with its support as Newick text.
    """
    files.validate_inputs(spark, folder, reference)
    found = files.discover_samples(spark, folder)
    paths = [r.path for r in found.select("path").orderBy("path").collect()]  # one row per file
    reads = files.read_fastq(spark, paths)
    ref = stage_table(files.read_fasta(spark, reference).agg(F.array_join(F.sort_array(F.collect_list(F.struct("name", "seq")))["seq"], "").alias("seq")), "reference")
    done = run(spark, reads, ref, out, **choices)
    files.write_reads(done["filtered"], f"{out}/files/reads", "read_id")
    contigs = done.get("unitigs", done["assembled"]).withColumn("contig_no", F.col("seq"))
    files.write_contigs(asm.renumber_contigs(contigs), f"{out}/files/contigs")
    files.write_stats_tsv(done["stats"], f"{out}/files/stats")
    files.write_stats_tsv(done["empty"], f"{out}/files/empty")
    files.write_xmfa(done["alignment"], f"{out}/files/alignment")
    tree = tr.newick(done["support"], done["samples"])
    files.write_texts(spark.createDataFrame([("tree.nwk", tree + "\n")], "name string, text string"), f"{out}/files")
    return done
