"""Filters, ranks and statistics of reads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.functions.sequence import phred_sum, quality_profile
from readloom.sources.stages import stage_table

#: The score of a read where no other is given.
MEAN_QUALITY = "mean_quality"


def read_metrics(reads: DataFrame) -> DataFrame:
    """Rows (sample, read_id, length, phred_sum, mean_phred)."""
    rows = reads.select("sample", "read_id", F.length("seq").cast("long").alias("length"), phred_sum("qual").alias("phred_sum"))
    return rows.withColumn("mean_phred", F.when(F.col("length") > 0, F.round(F.col("phred_sum") / F.col("length"), 6)).otherwise(0.0))


def min_length(reads: DataFrame, least: int = 500) -> DataFrame:
    """Reads of ``least`` bases or more; 0 keeps all."""
    return reads.where(F.length("seq") >= least)


def mapped_only(alignments: DataFrame) -> DataFrame:
    return alignments.where(F.col("flag").bitwiseAND(4) == 0)


def primary_only(alignments: DataFrame) -> DataFrame:
    return alignments.where(F.col("flag").bitwiseAND(256) == 0)


def require_min_samples(df: DataFrame, least: int = 3) -> DataFrame:
    """``df``, or ValueError where it has fewer samples."""
    found = df.select("sample").distinct().limit(least).count()
    if found < least:
        raise ValueError(f"a comparison needs {least} samples or more, there are {found}")
    return df


def fasta_length(ref: DataFrame) -> DataFrame:
    """One row: total bases over all records."""
    return ref.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).cast("long").alias("total_bases"))


def nx(reads: DataFrame, shares: tuple[int, ...] = (50, 90), group: str = "sample") -> DataFrame:
    """Rows (group, n50, n90, ...): the length at which lengths in falling order first reach the share of all bases."""
    return read_stats(reads, shares, group).drop("n_reads", "total_bases")


def read_stats(reads: DataFrame, shares: tuple[int, ...] = (50, 90), group: str = "sample") -> DataFrame:
    """Rows (group, n_reads, total_bases, n50, n90, ...).

    All from one histogram of lengths: the reads are read once, and a large sample is as many rows as it has lengths.
    """
    h = reads.groupBy(group, F.length("seq").cast("long").alias("len")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(group)
    h = h.withColumn("cum", F.sum(F.col("len") * F.col("n")).over(w.orderBy(F.desc("len")))).withColumn("total", F.sum(F.col("len") * F.col("n")).over(w))
    return h.groupBy(group).agg(
        F.sum("n").alias("n_reads"), F.sum(F.col("len") * F.col("n")).alias("total_bases"), *[F.max(F.when(F.col("cum") * 100 >= F.col("total") * x, F.col("len"))).alias(f"n{x}") for x in shares]
    )


def file_order(reads: DataFrame) -> list[str]:
    """The columns that give the reads' order in their files, or the read_id for reads that are from no file."""
    return ["path", "offset"] if {"path", "offset"} <= set(reads.columns) else ["read_id"]


def first_reads(reads: DataFrame, n: int = 1000, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` reads of each sample, in file order if no other is given; Spark pushes the rank's bound below the shuffle."""
    w = Window.partitionBy("sample").orderBy(*(order or file_order(reads)))
    return reads.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n)


def read_scores(reads: DataFrame, score_expr: str = MEAN_QUALITY, window: int = 250, name: str = "score") -> DataFrame:
    """``reads`` with a score: an SQL expression over ``length``, ``mean_quality`` and ``worst_window``.

    ``worst_window`` is the least mean quality of ``window`` neighbouring bases, of the whole read if it is shorter. Each
    quality text is decoded once. Reads without bases score null; columns of ``reads`` with those names are hidden from the expression.
    """
    if score_expr == MEAN_QUALITY:
        return reads.withColumn(name, phred_sum("qual") / F.nullif(F.length("seq"), F.lit(0)))
    length, total, worst, width = (f"_{c}_of_read" for c in ("length", "total", "worst", "width"))
    rows = reads.withColumn("_profile", quality_profile("qual", window)).withColumn(length, F.length("seq").cast("long"))
    rows = rows.select("*", *[F.col(f"_profile.{c.split('_')[1]}").alias(c) for c in (total, worst, width)]).drop("_profile")
    known = {"length": length, "mean_quality": f"({total} / nullif({length}, 0))", "worst_window": f"({worst} / nullif({width}, 0))"}
    text = re.sub(r"\b(length|mean_quality|worst_window)\b(?!\s*\()", lambda m: known[m[1]], score_expr)
    return rows.withColumn(name, F.expr(text).cast("double")).drop(length, total, worst, width)


def filter_best_bases(
    reads: DataFrame, ref_len: int, keep_percent: int = 95, depth: int = 100, least: int = 500, score_expr: str = MEAN_QUALITY, window: int = 250, step: float = 0.005
) -> DataFrame:
    """Each sample's best reads up to ``keep_percent`` of its bases or ``depth`` times the reference, the crossing read included.

    Score: as ``read_scores`` has it, then length, then read_id; a null score is the worst. Reads are bucketed by score, in
    steps of ``step``; only sums per bucket are added up in order, and each bucket ranks its own reads, so that no sample is one
    sorted group. Scored reads are a stage table, as sums and ranks both read them.
    """
    rows = read_scores(min_length(reads, least), score_expr, window, "_score").withColumn("_len", F.length("seq").cast("long"))
    rows = stage_table(rows.withColumn("_score", F.coalesce("_score", F.lit(float("-inf")))).withColumn("_bucket", F.floor(F.col("_score") / step)), "scored")
    h = rows.groupBy("sample", "_bucket").agg(F.sum("_len").alias("_sum"))
    w = Window.partitionBy("sample")
    h = h.withColumn("_ahead", F.coalesce(F.sum("_sum").over(w.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    h = h.withColumn("_target", F.least(F.floor(F.sum("_sum").over(w) * keep_percent / 100), F.lit(depth * ref_len).cast("long")))
    inside = Window.partitionBy("sample", "_bucket").orderBy(F.desc("_score"), F.desc("_len"), "read_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(h.where(F.col("_ahead") < F.col("_target")), ["sample", "_bucket"])
    rows = rows.withColumn("_prior", F.col("_ahead") + F.coalesce(F.sum("_len").over(inside), F.lit(0)))
    return rows.where(F.col("_prior") < F.col("_target")).select(*reads.columns)


def best_of_group(df: DataFrame, group: list[str], order: list) -> DataFrame:
    """The first row of each group in the given order."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def extract_by_id(reads: DataFrame, ids: DataFrame) -> DataFrame:
    """Reads whose (sample, read_id) is listed; repeated reads all stay."""
    return reads.join(ids.select("sample", "read_id"), ["sample", "read_id"], "left_semi")


def empty_samples(samples: DataFrame, found: DataFrame) -> DataFrame:
    """Samples without any row in ``found``."""
    return samples.select("sample").distinct().join(found.select("sample"), "sample", "left_anti")


def union_stats(*parts: DataFrame) -> DataFrame:
    """Statistics of several methods under one header; what a method lacks is null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def add_reference(genomes: DataFrame, ref: DataFrame, name: str = "reference") -> DataFrame:
    """The reference as one more sample."""
    return genomes.select(F.col("sample").cast("string").alias("sample"), "seq").unionByName(ref.select(F.lit(name).alias("sample"), "seq"))


def size_outliers(genomes: DataFrame, low: float = 0.5, high: float = 1.5) -> DataFrame:
    """Samples whose length is below ``low`` or above ``high`` times the median."""
    sizes = genomes.groupBy("sample").agg(F.sum(F.length("seq")).alias("length"))
    median = sizes.agg(F.expr("percentile(length, 0.5)").alias("median"))
    rows = sizes.crossJoin(F.broadcast(median)).withColumn("ratio", F.round(F.col("length") / F.col("median"), 6))  # one row
    return rows.where((F.col("ratio") < low) | (F.col("ratio") > high)).select("sample", "length", "ratio")
