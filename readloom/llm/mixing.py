"""Mixing sources to target weights: hash-random order within each source, prefix sums of words, exact cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.llm.common import stage_table, word_count

#: Bits of the hash-random key.
KEY_BITS = 60


def random_key(doc_id: str, seed: int) -> Column:
    """The leading 60 bits of ``md5(seed|doc_id)``: uniform, and the same in every run."""
    text = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, most: int = 3, weights: int = 3) -> DataFrame:
    """Targets from one row per source (src_null, src, source_size); one row per source is all that this step holds.

    Sources in code point order, null last, weigh 1, 2, ... ``weights``, repeating, and share the sum of all sizes. A
    target stops at ``most`` times its source's size. With the sources sorted by the level at which they stop, the
    excess reshared by weight is one prefix sum: the first source that the level does not reach fixes the level of all
    later ones.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy("src_null", "src")
    by_stop = everything.orderBy("stop", "rank")
    before, after = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(0, Window.unboundedFollowing)
    t = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    t = t.withColumn("weight", (F.col("rank") % weights + 1).cast("long")).withColumn("cap", F.col("source_size") * most)
    t = t.withColumn("stop", F.col("cap").cast("double") / F.col("weight"))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    t = t.withColumn("level", left.cast("double") / F.sum("weight").over(after))
    free = F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "rank", "level"))).over(everything)
    t = t.withColumn("free", free)
    met = F.struct("stop", "rank") < F.struct("free.stop", "free.rank")
    target = F.when(F.col("free").isNull() | met, F.col("cap").cast("double")).otherwise(F.col("free.level") * F.col("weight"))
    return t.select("src_null", "src", "source_size", target.alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7, buckets: int | None = None) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken, copies) for every row of ``docs``.

    Every row gets a hash-random key; keys are uniform, so equal key ranges split each source, however large, into
    equal buckets that sort on their own. Word sums of the buckets are added up within the source, which gives each
    bucket its offset, and a running sum inside the bucket gives the words ahead of each row. A source takes
    ``floor(target)`` words: whole epochs first, then the rows in key order up to exactly the rest, so that the row on
    the cut gives some of its words. ``taken`` counts words with repeats; ``copies`` is the number of epochs that reach
    the row, for mixes of whole documents. ``buckets`` (default: four per shuffle partition) changes no result.

    A null or blank text has size 0 and takes nothing; a null source is one source, the last. Rows with the same
    doc_id share a key and are ordered by size. An empty table gives an empty result. Other columns of ``docs`` are
    not read. Only DataFrame functions run here.
    """
    spark = docs.sparkSession
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (n - 1).bit_length())
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).isNull().alias("src_null"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
        word_count(text).alias("size"),
        random_key(doc_id, seed).alias("key"),
    )
    rows = stage_table(rows, "mix-sizes").withColumn("bucket", F.shiftright("key", KEY_BITS - bits))
    group = ["src_null", "src", "bucket"]
    sums = rows.groupBy(*group).agg(F.sum("size").alias("bucket_size"))
    ahead = Window.partitionBy("src_null", "src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0))).drop("bucket_size")
    targets = source_targets(sums.groupBy("src_null", "src").agg(F.sum("bucket_size").alias("source_size")))
    plan = offsets.join(targets, ["src_null", "src"])
    inside = Window.partitionBy(*group).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size")
    return (
        rows.join(plan, group)
        .withColumn("prior", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("epochs", epochs)
        .withColumn("rest", rest)
        .select(
            "doc_id",
            F.when(~F.col("src_null"), F.col("src")).alias("source"),
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("prior")))).cast("long").alias("taken"),
            (F.col("epochs") + (F.col("prior") < F.col("rest")).cast("long")).alias("copies"),
        )
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('7|' || COALESCE(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
s AS (SELECT source, SUM(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s),
w AS (SELECT *, rank % 3 + 1 AS weight, 3 * source_size AS cap FROM r),
p AS (SELECT *, cap::DOUBLE / weight AS stop FROM w),
l AS (
  SELECT *, (SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (ORDER BY stop, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (SUM(weight) OVER (ORDER BY stop, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level,
         row_number() OVER (ORDER BY stop, rank) AS place FROM p),
f AS (SELECT min(place) AS place, arg_min(level, place) AS level FROM l WHERE level <= stop),
t AS (
  SELECT l.source, source_size, CASE WHEN f.place IS NULL OR l.place < f.place THEN cap::DOUBLE ELSE f.level * weight END AS target
  FROM l LEFT JOIN f ON TRUE),
x AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
         COALESCE(SUM(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS prior
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM x)
SELECT doc_id, size, source_size, target,
       (epochs * size + GREATEST(0, LEAST(size, budget - epochs * source_size - prior)))::BIGINT AS taken
FROM e
"""
