"""SimHash near-dedup by meet-in-the-middle ball hashing: fingerprints meet at variants within half the radius."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import connected_components, stage_table
from readloom.llm.likeness import SEED, classes_of, described, frequency_levels, majority, prefix_pairs, prefix_stars, prefixes, shared_keys, verified


def text_fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[: len(words) - shingle])]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=True)], dtype="<u8"))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Rows (doc_id, fp): the SimHash of every whole text, as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            found = [text_fingerprint(t.as_py(), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(parts: int = 3) -> list[tuple[int, int, int]]:
    """(part, bits kept, bit flipped or 0): every fingerprint's variants.

    A pair at distance 3 has no meeting point within a distance of 1 from both. But one of ``parts`` parts of the bits
    holds one of the three bits, and with that part left out the pair is at distance 2 at most. So each fingerprint,
    with each part left out in turn, emits itself and all its one-bit changes.
    """
    out = []
    edge = [round(64 * i / parts) for i in range(parts + 1)]
    for p in range(parts):
        keep = [j for j in range(64) if not edge[p] <= j < edge[p + 1]]
        kept = sum(1 << j for j in keep)
        out += [(p, signed(kept), 0), *((p, signed(kept), signed(1 << j)) for j in keep)]
    return out


def meetings(classes: DataFrame, radius: int = 3) -> DataFrame:
    """Rows (variant, fp, head): the distinct ``fp`` of ``classes`` at each variant where two or more meet, ``head`` being the least.

    The shuffle key is a hash of part and variant; a chance collision fails the exact check that follows.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the variants reach pairs at distance 3 and less")
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ways = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(k).alias("keep"), F.lit(f).alias("flip")) for p, k, f in variants()])
    emitted = classes.repartition(parts, "fp").select("fp", F.explode(ways).alias("w"))
    emitted = emitted.select("fp", F.xxhash64("w.part", F.col("fp").bitwiseAND(F.col("w.keep")).bitwiseXOR(F.col("w.flip"))).alias("variant"))
    emitted = emitted.repartition(parts, "variant")  # the groups and their members come out of one shuffle
    heads = emitted.groupBy("variant").agg(F.min("fp").alias("head"), F.max("fp").alias("last")).where("head <> last").drop("last")
    # The members are many times the size that Spark expects of them: never a broadcast.
    return stage_table(emitted.hint("merge").join(heads, "variant").select("variant", "fp", "head"), "meetings")


def apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def components(classes: DataFrame, radius: int = 3) -> DataFrame:
    """Rows (node, component): fingerprints ``fp`` of ``classes`` linked by others within ``radius`` (3 or less) bits, as ``connected_components``.

    First each fingerprint is compared with the head of each group that it meets others in, so a dense group becomes one
    component by one link per row. Then pairs are compared only where a group still holds two components, and of all
    links between two components one goes on. No link is lost: two fingerprints within the radius meet somewhere.
    """
    met = meetings(classes, radius)
    links = met.where((F.col("fp") != F.col("head")) & (apart("fp", "head") <= radius)).select(F.col("fp").alias("a"), F.col("head").alias("b")).distinct()
    first = connected_components(links, "a", "b")
    named = met.join(first.withColumnRenamed("node", "fp"), "fp", "left").select("variant", "fp", F.coalesce("component", "fp").alias("part"))
    named = stage_table(named, "named-meetings")
    open_groups = named.groupBy("variant").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("variant")
    rest = stage_table(named.join(open_groups, "variant", "left_semi"), "open-meetings")
    a, b = (rest.select(F.col("variant").alias(f"variant_{x}"), F.col("fp").alias(x), F.col("part").alias(f"part_{x}")) for x in "ab")
    near = (F.col("variant_a") == F.col("variant_b")) & (F.col("part_a") < F.col("part_b")) & (apart("a", "b") <= radius)
    between = a.hint("merge").join(b, near).select(F.col("part_a").alias("a"), F.col("part_b").alias("b")).distinct()
    return connected_components(stage_table(between, "links").unionByName(first.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """Rows (doc_id, fp, component_id): every row with its fingerprint and the smallest doc_id that links reach.

    Rows with equal fingerprints are one class, however many; links are sought between classes only, and followed to
    connected components. A null, empty or blank text has fingerprint 0 and links as any other. Repeated rows stay,
    each with its component; a null doc_id is never a component's name unless all its rows are null. An empty table
    gives an empty result. Only doc_id and text are read.
    """
    rows = stage_table(fingerprints(docs, shingle), "simhash")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    star = components(classes.select("fp"), radius)
    named = classes.join(star.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows.join(named.join(least, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def ball_candidates(classes: DataFrame, radius: int = 3) -> DataFrame:
    """Rows (a, b): classes ``cls`` of equal or near fingerprints ``fp``, one per class and per meeting at most."""
    heads = classes.groupBy("fp").agg(F.min("cls").alias("first"))
    equal = classes.join(heads, "fp").where("cls <> first").select(F.col("cls").alias("a"), F.col("first").alias("b"))
    met = meetings(heads.select("fp"), radius).where((F.col("fp") != F.col("head")) & (apart("fp", "head") <= radius)).select("fp", "head").distinct()
    near = met.join(heads.select("fp", F.col("first").alias("a")), "fp").join(heads.select(F.col("fp").alias("head"), F.col("first").alias("b")), "head")
    return equal.unionByName(near.select("a", "b"))


def near_copies(docs: DataFrame, shingle: int = 5, radius: int = 3) -> DataFrame:
    """Rows (doc_id, component_id): every row with the smallest doc_id that links reach.

    Two texts link where the Jaccard likeness of their sets of ``shingle``-word shingles is ``LEAST`` or more, computed
    from the whole sets; links are followed to connected components. Rows with equal sets are one class, however many.
    Pairs that sizes and parities of the sets already show to be less alike are not computed.

    Candidates come from the fingerprints' balls: classes of equal SimHash, and those that meet within ``radius`` bits. At
    the threshold two texts differ in some ten of 64 bits, and no ball of variants reaches that far. So the pairs out of
    reach come from shingles that both texts have among their rarest, which no pair at the threshold lacks. There, too,
    each class is first compared with some few others, the least by four orders of the classes; then all pairs that
    share such a shingle and are not in one component yet.

    Texts without words are all alike. A null doc_id is never a component's name unless all its rows are null. An empty
    table gives an empty result. Only doc_id and text are read.
    """
    rows = stage_table(described(docs, shingle), "shingles")
    classes = stage_table(classes_of(rows), "classes")
    keys = shared_keys(prefixes(docs, frequency_levels(rows), shingle))
    stars = ball_candidates(classes.select("cls", "fp"), radius).unionByName(prefix_stars(keys)).distinct()
    first = connected_components(verified(stars, classes, docs, shingle), "a", "b")
    more = verified(prefix_pairs(keys, first), classes, docs, shingle)
    last = connected_components(more.unionByName(first.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b")
    named = classes.select("cls", "first").join(last.withColumnRenamed("node", "cls"), "cls", "left").withColumn("whole", F.coalesce("component", "cls"))
    least = named.groupBy("whole").agg(F.min("first").alias("component_id"))
    return rows.where("block IS NULL").select("doc_id", "cls").join(named.join(least, "whole").select("cls", "component_id"), "cls").select("doc_id", "component_id")
