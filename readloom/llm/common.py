"""Helpers shared by the corpus operators: stage tables, folds, word counts and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from tempfile import mkdtemp

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves a local session; on a cluster no executor would see it, so that raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: str | Column, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; -1 where doc_id is null."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % parts, F.lit(-1))


def word_count(text: str) -> Column:
    """Number of words of a text; 0 where it is null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def fresh(name: str, *columns: Iterable[str]) -> str:
    """``name``, with underscores behind it until none of ``columns`` has it, in whatever case."""
    taken = {c.lower() for some in columns for c in some}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def finite(vector: str) -> Column:
    """True where a vector is there and all its components are finite numbers; an empty vector is."""
    c = F.col(vector)
    return c.isNotNull() & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def join_back(rows: DataFrame, groups: DataFrame, key: list[str], size: str, total: int, share: int = 10_000) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` has one row per key, nulls being equal, and its number of rows ``size``.

    Groups with more than one ``share``-th of all ``total`` rows are fewer than ``share``, so they are broadcast; no key
    of the shuffled join has more rows than that.
    """
    named = groups.select(*[F.col(c).alias(f"_{c}") for c in key], *[c for c in groups.columns if c not in key])
    same = lambda: [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    large = F.col(size) * share > total
    hot, cold = named.where(large), named.where(~large)
    few = rows.join(F.broadcast(hot), same())
    rest = rows.join(F.broadcast(hot.select(*[f"_{c}" for c in key])), same(), "left_anti").join(cold.hint("merge"), same())
    return few.unionByName(rest).drop(*[f"_{c}" for c in key], size)


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node on an edge that is not itself its component's smallest node.

    Alternates large-star and small-star steps: each round links every node's larger neighbours, then its smaller
    ones, to the smallest node around it, until only stars are left. Each round is a stage table, so no plan grows and
    no round is lost with an executor. Links never reach the driver; it sees whether a node is left that belongs to no star.
    """
    star = stage_table(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    for _ in range(max_rounds):
        if only_stars(star):
            return star.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = star.select("u", "v").unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # A node and its smaller neighbour both go to the smallest one; links that repeat go in the one shuffle of distinct().
        ends = F.explode(F.array("u", "v")).alias("u")
        star = stage_table(large.join(low, "u").select(ends, F.col("m").alias("v")).where("u <> v").distinct(), "star")
    raise RuntimeError(f"components still change after {max_rounds} rounds")


def only_stars(links: DataFrame) -> bool:
    """True where every node of the distinct ``links`` (u, v), u > v, has one smaller neighbour and no larger one, or larger ones alone."""
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("down")))).alias("end"))
    nodes = ends.groupBy("end.node").agg(F.sum("end.down").alias("down"), F.count("*").alias("n"))
    return nodes.where("down > 0 AND n > 1").agg(F.count("*")).first()[0] == 0
