"""K-mer tables, minimizers, baiting, shared k-mers, the choice of k, and reference-free variants."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.functions.sequence import hamming, reverse_complement
from readloom.operators import packed
from readloom.sources.stages import stage_table

#: Rows up to which a k-mer table is offered for broadcast; a row is some 100 bytes.
SMALL_ROWS = 500_000


def tiles(df: DataFrame, keep: list[str], least: int, overlap: int, seq: str = "seq", tile: int = 256, chunk: int = 16_384) -> DataFrame:
    """Rows (keep, o, t): texts of ``tile`` starts each, ``overlap`` characters longer, so that no substring starts far in.

    Cut in two steps, as a substring is found by walking from the text's start.
    """
    cut = lambda text, size, start: F.transform(
        F.sequence(F.lit(0), F.length(text) - least, F.lit(size)), lambda o: F.struct((start + o).alias("o"), F.substr(text, o + 1, F.lit(size + overlap)).alias("t"))
    )
    rows = df.where(F.length(seq) >= least).select(*keep, F.explode(cut(F.col(seq), chunk, F.lit(0))).alias("c"))
    rows = rows.where(F.length("c.t") >= least).select(*keep, F.explode(cut(F.col("c.t"), tile, F.col("c.o"))).alias("c"))
    # A chunk's overlap belongs to the next one, but for the last.
    return rows.select(*keep, F.col("c.o").alias("o"), F.col("c.t").alias("t")).where(F.length("t") >= least)


def kmers(df: DataFrame, k: int, keep: list[str], seq: str = "seq") -> DataFrame:
    """Rows (keep, pos, kmer): all k-mers with their 0-based place. Shorter sequences give none."""
    t = tiles(df, keep, k, k - 1, seq)
    own = F.transform(F.sequence(F.lit(1), F.length("t") - (k - 1)), lambda j: F.substr(F.col("t"), j, F.lit(k)))
    return t.select(*keep, "o", F.posexplode(own).alias("i", "kmer")).select(*keep, (F.col("o") + F.col("i")).alias("pos"), "kmer")


def kmer_counts(reads: DataFrame, k: int = 31) -> DataFrame:
    """Rows (sample, read_id, n, n_distinct, least): k-mers of each read, the number of different ones, and the least.

    Reads are counted where they lie, as numbers. Only reads with letters beyond A, C, G and T and read_ids that have
    several rows go through a table of k-mers.
    """
    text = lambda df: kmers(df, k, ["sample", "read_id"]).groupBy("sample", "read_id").agg(F.count("*").alias("n"), F.count_distinct("kmer").alias("n_distinct"), F.min("kmer").alias("least"))
    if k > 31:
        return text(reads)

    @F.arrow_udf("struct<n: bigint, n_distinct: bigint, least: bigint, plain: boolean>")
    def counted(seqs: pa.Array) -> pa.Array:
        data, ends = packed.flat(seqs)
        bad = np.concatenate([[0], np.cumsum(packed.CODE[data] > 3)])
        n, distinct, first = (np.zeros(len(seqs), dtype=np.int64) for _ in range(3))
        lo = 0
        while lo < len(seqs):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + packed.PIECE, side="right")) - 1)
            found = [(row, x) for _, row, x in packed.pieces(seqs.slice(lo, hi - lo), k)]
            if found:
                row, x = (np.concatenate(c) for c in zip(*found, strict=True))
                order = np.lexsort((x, row))
                row, x = row[order], x[order]
                new = np.append(True, (row[1:] != row[:-1]) | (x[1:] != x[:-1]))[: len(row)]
                n[lo:hi], distinct[lo:hi] = np.bincount(row, minlength=hi - lo), np.bincount(row[new], minlength=hi - lo)
                own = np.flatnonzero(np.append(True, np.diff(row) != 0)[: len(row)])
                first[lo + row[own]] = x[own].astype(np.int64)
            lo = hi
        columns = {"n": n, "n_distinct": distinct, "least": first, "plain": bad[ends[1:]] == bad[ends[:-1]]}
        return pa.StructArray.from_arrays([pa.array(c) for c in columns.values()], names=[*columns])

    ids = ["sample", "read_id"]
    rows = reads.where(F.length("seq") >= k).select(*ids, counted(F.col("seq").cast("string")).alias("c")).select(*ids, "c.*")
    rows = rows.groupBy(*ids).agg(F.count("*").alias("rows"), *[F.min(c).alias(c) for c in ("n", "n_distinct", "least", "plain")])
    rows = stage_table(rows, "kmer-counts")
    whole = rows.where("rows = 1 AND plain").select(*ids, "n", "n_distinct", packed.text_of("least", k).alias("least"))
    rest = rows.where("NOT (rows = 1 AND plain)").select(*[F.col(c).alias(f"_{c}") for c in ids])
    if rest.isEmpty():
        return whole
    return whole.unionByName(text(reads.join(rest, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ids], "left_semi")))


def minimizers(df: DataFrame, keep: list[str], w: int = 10, k: int = 15, seq: str = "seq") -> DataFrame:
    """Rows (keep, pos, kmer): of each ``w`` neighbouring k-mers the one with the least md5, then least and leftmost on ties; each place once.

    The order by digest is as good as chance: by letters, all sequences with a run of one base would share its k-mer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = packed.flat(b.column(seq))
            for at, row in packed.minimizer_places(data, offsets, w, k):
                pos = pa.array((at - offsets[row]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(row)) for c in keep), pos, packed.texts_at(data, at, k)], names=[*keep, "pos", "kmer"])

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return df.select(*keep, F.col(seq).cast("string").alias(seq)).mapInArrow(run, f"{kinds}pos int, kmer string").distinct()


def broadcast_if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows that it has few rows; else the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def both_strands(ref: DataFrame, seq: str = "seq") -> DataFrame:
    return ref.unionByName(ref.withColumn(seq, reverse_complement(seq)))


def bait_kmers(reads: DataFrame, ref: DataFrame, k: int = 31, revcomp: bool = False) -> DataFrame:
    """Rows (sample, read_id, n_kmers): reads that share a k-mer with the reference, and how many of their k-mers do.

    Up to 31 bases k-mers are numbers, looked up where the reads lie; longer ones are texts and joined.
    """
    source = both_strands(ref.select("seq")) if revcomp else ref.select("seq")
    if k <= 31:
        baits = stage_table(source.select(F.explode(packed.numbers("seq", k)).alias("code")).distinct(), "baits")
        return packed.shared_counts(reads, baits, k)
    bait = broadcast_if_small(kmers(source, k, []).select("kmer").distinct())
    hits = kmers(reads, k, ["sample", "read_id"]).join(bait, "kmer", "left_semi")
    return hits.groupBy("sample", "read_id").agg(F.count("*").alias("n_kmers"))


def part_bounds(k: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of the parts of a k-mer, longer ones first."""
    out, at = [], 0
    for i in range(parts):
        size = k // parts + (i < k % parts)
        out.append((at, size))
        at += size
    return out


def bait_kmers_hamming(reads: DataFrame, ref: DataFrame, k: int = 31, hdist: int = 2, revcomp: bool = False) -> DataFrame:
    """As ``bait_kmers`` with up to ``hdist`` substitutions: one of ``hdist + 1`` parts must be equal, then all are compared.

    Where the reference has few k-mers, of 31 bases at most, reads are compared where they lie; else k-mers are joined by
    their parts, equal ones of the reads once.
    """
    source = both_strands(ref.select("seq")) if revcomp else ref.select("seq")
    bounds = part_bounds(k, hdist + 1)
    if k <= 31:
        baits = stage_table(source.select(F.explode(packed.numbers("seq", k)).alias("code")).distinct(), "baits")
        if baits.count() <= SMALL_ROWS:
            return packed.near_counts(reads, baits, k, bounds, hdist)
    parts = lambda c: F.array(*[F.struct(F.lit(i).alias("p"), F.substring(c, a + 1, n).alias("part")) for i, (a, n) in enumerate(bounds)])
    bait = kmers(source, k, []).select(F.col("kmer").alias("bait")).distinct()
    bait = broadcast_if_small(bait.select("bait", F.explode(parts("bait")).alias("x")).select("bait", "x.p", "x.part"))
    own = kmers(reads, k, ["sample", "read_id"]).groupBy("sample", "read_id", "kmer").agg(F.count("*").alias("n"))
    distinct = own.select("kmer").distinct()
    near = distinct.select("kmer", F.explode(parts("kmer")).alias("x")).select("kmer", "x.p", "x.part").join(bait, ["p", "part"])
    near = near.where(hamming(F.col("kmer"), F.col("bait")) <= hdist).select("kmer").distinct()
    return own.join(near, "kmer").groupBy("sample", "read_id").agg(F.sum("n").alias("n_kmers"))


def shared_kmers(seqs: DataFrame, k: int, sample: str = "sample") -> DataFrame:
    """K-mers that every sample has: an intersection as one aggregate."""
    n = seqs.select(sample).distinct().agg(F.count("*").alias("n_samples"))
    if k <= 31:
        own = packed.run_kmers(seqs, k, [sample]).groupBy("minimizer", "kmer").agg(F.count_distinct(sample).alias("n"))
    else:
        own = kmers(seqs, k, [sample]).select(sample, "kmer").distinct().groupBy("kmer").agg(F.count("*").alias("n"))
    return own.join(F.broadcast(n), F.col("n") == F.col("n_samples")).select("kmer")  # n: one row


def choose_k(seqs: DataFrame, ks: list[int], share: float = 0.99, sample: str = "sample") -> DataFrame:
    """Rows (k, n_kmers, n_once, unique_share, chosen) for the sample of median length; the least k with enough k-mers that occur once is chosen."""
    sizes = seqs.groupBy(sample).agg(F.sum(F.length("seq")).alias("len"))
    half = sizes.agg(F.expr("percentile_disc(0.5) within group (order by len)").alias("len"))
    median = sizes.join(F.broadcast(half), "len").agg(F.min(sample).alias(sample))
    own = seqs.join(F.broadcast(median), sample, "left_semi")
    counted = None
    for k in ks:
        one = packed.run_kmers(own, k, []).groupBy("minimizer", "kmer").agg(F.sum("n").alias("c")).agg(F.lit(k).alias("k"), F.count("*").alias("n_kmers"), F.count(F.when(F.col("c") == 1, 1)).alias("n_once"))
        counted = one if counted is None else counted.unionByName(one)
    counted = counted.withColumn("unique_share", F.round(F.col("n_once") / F.col("n_kmers"), 6))
    chosen = F.min(F.when(F.col("n_once") >= share * F.col("n_kmers"), F.col("k"))).over(Window.partitionBy())  # one row per k
    return counted.withColumn("chosen", F.coalesce(F.col("k") == chosen, F.lit(False)))


def kmer_pan_snps(seqs: DataFrame, k: int = 25, sample: str = "sample") -> DataFrame:
    """Rows (left, right, n_bases, n_samples, core): equal flanks of odd k-mers with different centres between samples.

    A flank pair that a sample has with two centres says nothing there and is left out of it.
    """
    h = k // 2
    # A k-mer without its centre: the numbers of its flanks side by side.
    low = F.col("code").bitwiseAND(4**h - 1)
    flanks = F.shiftright("code", 2 * h + 2) * 4**h + low
    own = seqs.select(sample, F.explode(packed.numbers("seq", k)).alias("code"))
    own = own.select(sample, flanks.alias("flanks"), F.shiftright("code", 2 * h).bitwiseAND(3).cast("int").alias("base"))
    own = own.groupBy("flanks", sample).agg(F.count_distinct("base").alias("n"), F.min("base").alias("base")).where("n = 1")
    total = F.broadcast(seqs.select(sample).distinct().agg(F.count("*").alias("total")))
    sites = own.groupBy("flanks").agg(F.count_distinct("base").alias("n_bases"), F.count("*").alias("n_samples")).where("n_bases > 1")
    sites = sites.withColumn("both", packed.text_of("flanks", 2 * h))
    return sites.crossJoin(total).select(F.substring("both", 1, h).alias("left"), F.substring("both", h + 1, h).alias("right"), "n_bases", "n_samples", (F.col("n_samples") == F.col("total")).alias("core"))
