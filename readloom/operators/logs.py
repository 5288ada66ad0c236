"""Statistics tables from assemblers' log lines: one row per sample, the last matching line wins, 0 where none matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def token(n: int) -> Column:
    """The n-th word of the line from its end, without a dot behind it."""
    return F.rtrim(F.element_at(F.split(F.trim("line"), r"\s+"), -n), F.lit("."))


def last_value(mark: str, value: Column) -> Column:
    hit = F.col("line").contains(mark)
    return F.max_by(F.when(hit, value), F.when(hit, F.col("line_no")))


def flye_stats(lines: DataFrame) -> DataFrame:
    """Rows (Sample, TotalBases, ReadsN50, AssemblyLength, Contigs, Coverage) from rows (sample, line_no, line)."""
    after = lambda mark: F.trim(F.split_part(F.col("line"), F.lit(mark), F.lit(2)))
    n50 = F.trim(F.split_part(F.element_at(F.split("line", ":"), -1), F.lit("/"), F.lit(1)))
    found = lines.groupBy(F.col("sample").alias("Sample")).agg(
        last_value("Total read length:", token(1)).alias("TotalBases"),
        last_value("N50/N90", n50).alias("ReadsN50"),
        last_value("Total length:\t", after("Total length:\t")).alias("AssemblyLength"),
        last_value("Fragments:\t", after("Fragments:\t")).alias("Contigs"),
        last_value("Mean coverage:\t", after("Mean coverage:\t")).alias("Coverage"),
    )
    return found.select("Sample", *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in found.columns[1:]])


def shasta_stats(lines: DataFrame) -> DataFrame:
    """Rows (Sample, ReadNumber, TotalBases, ReadsN50, AssemblyLength, Contigs) from rows (sample, line_no, line)."""
    found = lines.groupBy(F.col("sample").alias("Sample")).agg(
        last_value("Total number of reads is", token(1)).alias("ReadNumber"),
        last_value("Total number of raw bases is", token(1)).alias("TotalBases"),
        last_value("N50 for read length is", token(2)).alias("ReadsN50"),
        last_value("Total length of assembled sequence is", token(1)).alias("AssemblyLength"),
        last_value("The assembly graph has", token(3)).alias("Contigs"),
    )
    return found.select("Sample", *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in found.columns[1:]])
