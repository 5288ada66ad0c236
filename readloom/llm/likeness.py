"""What SimHash near-dedup checks candidates with: shingle sets, their exact Jaccard likeness, and the pairs beyond its radius."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import stage_table

#: Seed of the shingles' XXH64.
SEED = 42
#: Pairs link from a likeness of LEAST[0] / LEAST[1] on.
LEAST = (4, 5)
#: Classes in candidate pairs up to which their numbers are broadcast to the scan of the sets.
FEW = 1_000_000
#: Cells of the shingles' frequency sketch, and how many of them travel in one row.
CELLS, BLOCK = 1 << 20, 1 << 15


def shingle_set(text: bytes | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; a text of fewer words is one shingle, one without words none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    joined = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[: max(0, len(words) - shingle)])]
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :] or ends[-1:], strict=True)]
    return np.unique(np.array(found, dtype=np.uint64).view(np.int64))


def majority(h: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half of ``h``."""
    if not len(h):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(h), 65_280):  # a bit's count in a block of 255 rows fits a byte, and so sums fast
        part = np.unpackbits(h[lo : lo + 65_280].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int32)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *parts])))


def parity(s: np.ndarray) -> bytes:
    """One bit per cell, about one cell per shingle: set where an odd number of the set's hashes fall in the cell."""
    cells = max(64, 1 << max(0, len(s) - 1).bit_length())
    return np.packbits((np.bincount(s & (cells - 1), minlength=cells) & 1).astype(np.uint8), bitorder="little").tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """A number of shingles by which two sets of these parities differ at least; the longer one is folded to the shorter's cells."""
    if len(a) < len(b):
        a, b = b, a
    x, cells = int.from_bytes(a, "little"), 8 * len(a)
    while cells > 8 * len(b):
        cells //= 2
        x = (x >> cells) ^ (x & ((1 << cells) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def described(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """Rows (doc_id, text_key, cls, fp, n, parity) of every text: a hash of it, and of its shingle set a hash, SimHash, size and parity.

    The same pass counts the shingles per cell of a sketch; each task adds its counts as rows (block, counts), all else null.
    """
    names = ["doc_id", "text_key", "cls", "fp", "n", "parity", "block", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, dtype=np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                sets = [shingle_set(t.as_py(), shingle) for t in part.column(2).cast(pa.binary())]
                for s in sets:
                    np.add.at(cells, s & (CELLS - 1), 1)
                own = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
                fps = np.array([majority(s.view(np.uint64)) for s in sets], dtype=np.uint64).view(np.int64)
                found = [pa.array(own), pa.array(fps), pa.array([len(s) for s in sets], pa.int32()), pa.array([parity(s) for s in sets], pa.binary())]
                none = [pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *found, *none], names=names)
        parts = [c.astype(np.min_scalar_type(int(c.max()))) for c in cells.reshape(-1, BLOCK)]
        none = [pa.nulls(len(parts), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())]
        counts = pa.array([c.tobytes() for c in parts], pa.binary())
        yield pa.RecordBatch.from_arrays([*none, pa.array(range(len(parts)), pa.int32()), counts], names=names)

    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return texts.mapInArrow(run, "doc_id long, text_key long, cls long, fp long, n int, parity binary, block int, counts binary")


def classes_of(rows: DataFrame) -> DataFrame:
    """Rows (cls, first, text_key, fp, n, parity): the distinct shingle sets, each with its smallest doc_id and one of its texts."""
    same = [F.first(c).alias(c) for c in ("fp", "n", "parity")]
    return rows.where("block IS NULL").groupBy("cls").agg(F.min("doc_id").alias("first"), F.min("text_key").alias("text_key"), *same)


def frequency_levels(rows: DataFrame) -> np.ndarray:
    """Per cell of the sketch the power of two of the number of shingles that fall in it. Only these levels reach the driver, a byte per cell."""

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for rows in parts:
            for block, n in zip(rows.block, rows.counts, strict=True):
                found = np.frombuffer(n, dtype=f"<u{len(n) // BLOCK}").astype(np.int64)
                total[block] = total[block] + found if block in total else found
        yield pd.DataFrame({"block": list(total), "counts": [t.tobytes() for t in total.values()]})

    def log(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in add(parts):
            yield pd.DataFrame({"block": rows.block, "levels": [np.log2(np.frombuffer(n, dtype=np.int64) + 1).astype(np.uint8).tobytes() for n in rows.counts]})

    counts = rows.where("block IS NOT NULL").select("block", "counts").mapInPandas(add, "block int, counts binary")  # one row a block and task
    levels = np.zeros(CELLS, dtype=np.uint8)
    for r in counts.repartition(CELLS // BLOCK, "block").mapInPandas(log, "block int, levels binary").collect():
        levels[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.levels, dtype=np.uint8)
    return levels


def prefixes(docs: DataFrame, levels: np.ndarray, shingle: int = 5) -> DataFrame:
    """Rows (cls, n, prefix): one per distinct set, with the shingles of which a near copy shares one at least.

    Two sets at the threshold share so many shingles that, all being sorted by one order, the first n - ceil(n * least) + 1
    of each have one in common. That holds for any order; this one puts shingles of full sketch cells last, so that
    a passage that many texts share is in the prefix of none but its copies. The sketch decides what is compared in vain, not
    what is found. The sets are made from the texts again: stored, they would be twice the texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    p, q = LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                own, sizes, parts = [], [], []
                for t in b.column(0).slice(lo, 1024).cast(pa.binary()):
                    s = shingle_set(t.as_py(), shingle)
                    own.append(xxhash.xxh64_intdigest(s.tobytes(), SEED))
                    sizes.append(len(s))
                    order = np.argsort(shared.value[s & (CELLS - 1)], kind="stable")  # sets are sorted by hash within a level
                    parts.append(s[order[: len(s) - -(-len(s) * p // q) + 1]])
                columns = [pa.array(np.array(own, dtype=np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), lists(parts)]
                yield pa.RecordBatch.from_arrays(columns, names=["cls", "n", "prefix"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "cls long, n int, prefix array<long>").dropDuplicates(["cls"])


def shingle_sets(texts: DataFrame, shingle: int = 5) -> DataFrame:
    """Rows (cls, shingles): the distinct shingle sets of the column text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                sets = [shingle_set(t.as_py(), shingle) for t in b.column(0).slice(lo, 1024).cast(pa.binary())]
                own = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own), lists(sets)], names=["cls", "shingles"])

    return texts.select("text").mapInArrow(run, "cls long, shingles array<long>").dropDuplicates(["cls"])


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows (a, b) of ``pairs`` but those that sizes and parities show to be below LEAST."""
    p, q = LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy(zero_copy_only=False) + b.column(3).to_numpy(zero_copy_only=False)
            apart = [least_apart(x.as_py(), y.as_py()) for x, y in zip(b.column(4), b.column(5), strict=True)]
            keep = pa.array((p + q) * np.array(apart, dtype=np.int64) <= (q - p) * n)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    a, b = (classes.select(F.col("cls").alias(c), F.col("n").cast("long").alias(f"n_{c}"), F.col("parity").alias(f"parity_{c}")) for c in "ab")
    met = pairs.join(a, "a").join(b, "b").where(sizes_fit())
    return met.select("a", "b", "n_a", "n_b", "parity_a", "parity_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int = 5) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose sets' likeness is LEAST or more, computed from the whole sets of the pairs that are plausible."""
    p, q = LEAST
    pairs = stage_table(plausible(pairs, classes), "pairs")
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    keys = stage_table(classes.join(wanted, "cls", "left_semi").select("text_key").distinct(), "pair-texts")
    if keys.count() <= FEW:  # some 10 MB; else the texts are shuffled
        keys = F.broadcast(keys)
    texts = docs.select(F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text")).join(keys, "text_key", "left_semi")
    own = stage_table(shingle_sets(texts, shingle), "pair-sets")
    a, b = (own.select(F.col("cls").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(a, "a").join(b, "b").where((p + q) * both >= p * (F.size("sa") + F.size("sb"))).select("a", "b")


def sizes_fit(a: str = "n_a", b: str = "n_b") -> Column:
    """Sets of so different sizes that they cannot be near copies need no comparison."""
    p, q = LEAST
    return (F.col(a) * q >= F.col(b) * p) & (F.col(b) * q >= F.col(a) * p)


def shared_keys(found: DataFrame) -> DataFrame:
    """Rows (key, cls, n, at, to, n_to, at_to): the prefix shingles of ``found`` that two classes or more share, with the least of those classes by one of four orders."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = found.select("cls", "n", F.posexplode("prefix").alias("at", "key")).repartition(parts, "key")  # groups and members come out of one shuffle
    turn = F.xxhash64("cls", F.pmod("key", F.lit(4)))
    stars = keys.groupBy("key").agg(F.count("*").alias("rows"), F.min(F.struct(turn.alias("turn"), "cls", "n", "at")).alias("least")).where("rows > 1")
    # Nearly all keys are one class's own, but the plan does not know: never a broadcast of the members.
    met = keys.hint("merge").join(stars, "key")
    return stage_table(met.select("key", "cls", "n", "at", F.col("least.cls").alias("to"), F.col("least.n").alias("n_to"), F.col("least.at").alias("at_to")), "shared-prefixes")


def prefix_stars(keys: DataFrame) -> DataFrame:
    """Rows (a, b): each class of ``keys`` and the one that each of its keys names, where the shingles still to come may suffice."""
    p, q = LEAST
    enough = (p + q) * F.least(F.col("n") - F.col("at"), F.col("n_to") - F.col("at_to")) >= p * (F.col("n") + F.col("n_to"))
    met = keys.where("cls <> to").where(sizes_fit("n", "n_to") & enough)
    return met.select(F.least("cls", "to").alias("a"), F.greatest("cls", "to").alias("b"))


def prefix_pairs(keys: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (a, b): classes of ``keys`` that share a key and are in different components of ``parts`` (node, component)."""
    p, q = LEAST
    named = keys.join(parts.withColumnRenamed("node", "cls"), "cls", "left").select("key", "cls", "n", "at", F.coalesce("component", "cls").alias("part"))
    named = stage_table(named, "named-prefixes")
    open_keys = named.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("key")
    rest = stage_table(named.join(open_keys, "key", "left_semi"), "open-prefixes")
    a, b = (rest.select(F.col("key").alias(f"key_{x}"), F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("at").alias(f"at_{x}"), F.col("part").alias(f"part_{x}")) for x in "ab")
    # Where a pair first meets, the shingles still to come in either set must suffice for the threshold.
    enough = (p + q) * F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= p * (F.col("n_a") + F.col("n_b"))
    meet = (F.col("key_a") == F.col("key_b")) & (F.col("a") < F.col("b")) & (F.col("part_a") != F.col("part_b")) & sizes_fit() & enough
    return a.hint("merge").join(b, meet).select("a", "b").distinct()
