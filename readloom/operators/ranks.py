"""Ranks within groups of any size: ranges of the order, counts per range, offsets, and ranks inside the ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.sources.stages import stage_table


def ranked(df: DataFrame, group: list[str], order: list[str | Column], name: str) -> DataFrame:
    """``df`` with each row's 1-based place in its group's order as ``name``; rows that tie take places in any order.

    Spark cuts (group, order) into ranges, so that a large group is as many tasks as it needs. Row numbers that grow
    within a range are kept in a stage table; a group's places in a range begin behind the number of its rows in the
    ranges before. Only those numbers, a row for each group in each range, are added up in order. Nulls come first.
    """
    keys = [*group, *order]
    at = F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_row")
    rows = stage_table(df.repartitionByRange(*keys).sortWithinPartitions(*keys).select("*", *at), "ranked")
    counts = rows.groupBy(*group, "_range").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    ahead = F.sum("_n").over(Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    # A table of its own: its groups are as many as they are, but a group has no more rows in it than there are ranges.
    counts = counts.select(*[F.col(c).alias(f"_{c}") for c in group], F.col("_range").alias("_in"), (F.coalesce(ahead, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group] + [F.col("_range") == F.col("_in")]
    return rows.join(counts, same).select(*df.columns, (F.col("_row") + F.col("_shift")).cast("long").alias(name))
