"""Consensus and unitig sequences, contig names, and statistics of assemblies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.operators import packed
from readloom.operators.kmers import SMALL_ROWS, broadcast_if_small, kmers
from readloom.operators.packed import run_kmers
from readloom.operators.ranks import ranked
from readloom.operators.variants import unique_flanks
from readloom.sources.stages import stage_table


#: Bases of the reference that are settled together, and rows of so many bases at once.
TILE, TILES = 256, 1 << 10
#: Bits of an entry's count of reads; above them are its place in its tile and its base.
COUNT = 40


def pileup(reads: DataFrame, ref: DataFrame, h: int = 12) -> DataFrame:
    """Rows (sample, o, calls): bases that reads have between flanks that are unique in the reference, counted, for each tile from ``o``.

    A call is a number: place in the tile, base, count of reads. A tile has one row for each part of a batch that met it.
    Where the reference has up to ``SMALL_ROWS`` flanks, they are sent to the tasks and reads are looked up where they lie;
    else k-mers are joined. A base that is none of A, C, G and T is no call, there as here.
    """
    anchors = stage_table(unique_flanks(ref.select("seq"), [], h).select("flanks", "pos"), "flanks")
    if h <= 15 and anchors.count() <= SMALL_ROWS:
        return calls_in_place(reads, anchors, h)
    own = kmers(reads, 2 * h + 1, ["sample"]).select("sample", F.concat(F.substring("kmer", 1, h), F.substring("kmer", h + 2, h)).alias("flanks"), F.substring("kmer", h + 1, 1).alias("base"))
    own = own.where("base in ('A', 'C', 'G', 'T')").groupBy("sample", "flanks", "base").agg(F.count("*").alias("n")).join(anchors, "flanks")
    place = (F.col("pos") % TILE) * 4 + F.instr(F.lit("ACGT"), F.col("base")) - 1
    call = F.shiftleft(place.cast("long"), COUNT) + F.col("n")
    return own.groupBy("sample", (F.col("pos") - F.col("pos") % TILE).cast("int").alias("o")).agg(F.collect_list(call).alias("calls"))


def calls_in_place(reads: DataFrame, anchors: DataFrame, h: int) -> DataFrame:
    """As ``pileup``; ``anchors`` has rows (flanks, pos), few enough for every task."""
    table = anchors.toArrow()
    letters = np.frombuffer("".join(table["flanks"].to_pylist()).encode(), dtype=np.uint8).reshape(-1, 2 * h)
    codes = packed.CODE[letters]
    known = (codes < 4).all(axis=1)
    number = (codes[known].astype(np.uint64) << (np.uint64(2) * np.arange(2 * h - 1, -1, -1, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)
    order = np.argsort(number)
    shared = reads.sparkSession.sparkContext.broadcast((number[order], table["pos"].to_numpy().astype(np.int64)[known][order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flanks, pos = shared.value
        for b in (x for whole in batches for x in packed.slices(whole)):
            named = b.column("sample").dictionary_encode(null_encoding="encode")
            own = named.indices.to_numpy()
            for _, row, x in packed.pieces(b.column("seq"), 2 * h + 1):
                if not len(flanks) or not len(x):
                    continue
                base = (x >> np.uint64(2 * h)) & np.uint64(3)
                x = ((x >> np.uint64(2 * h + 2)) << np.uint64(2 * h)) | (x & np.uint64(4**h - 1))
                at = np.minimum(np.searchsorted(flanks, x), len(flanks) - 1)
                hit = flanks[at] == x
                # Sample, site and base in one number; sites are fewer than the reference's bases.
                key = (own[row[hit]].astype(np.int64) << 40) | (pos[at[hit]] * 4 + base[hit].astype(np.int64))
                key, n = np.unique(key, return_counts=True)
                tile = key // (4 * TILE)
                first = np.flatnonzero(np.append(True, tile[1:] != tile[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
                calls = pa.ListArray.from_arrays(pa.array(np.append(first, len(key)).astype(np.int32)), pa.array(((key % (4 * TILE)) << COUNT) | n))
                sample = named.dictionary.take(pa.array(key[first] >> 40))
                o = (key[first] & ((1 << 40) - 1)) // (4 * TILE) * TILE
                yield pa.RecordBatch.from_arrays([sample, pa.array(o.astype(np.int32)), calls], names=["sample", "o", "calls"])

    return reads.select("sample", F.col("seq").cast("string").alias("seq")).mapInArrow(run, f"sample {reads.schema['sample'].dataType.simpleString()}, o int, calls array<bigint>")


def settled(text: str, calls: str, min_depth: int) -> Column:
    """A struct (t, n): the tile's text with each called site's most frequent base, and how many sites are called."""

    @F.arrow_udf("struct<t: string, n: int>")
    def settle(texts: pa.Array, calls: pa.Array) -> pa.Array:
        data, ends = packed.flat(texts)
        data, entries, sizes = data.copy(), calls.flatten().to_numpy(zero_copy_only=False), calls.value_lengths().to_numpy()
        bounds, called = np.concatenate([[0], np.cumsum(sizes)]), np.zeros(len(sizes), dtype=np.int32)
        for lo in range(0, len(sizes), TILES):
            hi = min(lo + TILES, len(sizes))
            x = entries[bounds[lo] : bounds[hi]]
            place = np.repeat(np.arange(hi - lo), sizes[lo:hi]) * (4 * TILE) + (x >> COUNT)
            depth = np.bincount(place, weights=x & ((1 << COUNT) - 1), minlength=(hi - lo) * 4 * TILE).reshape(-1, TILE, 4)
            row, site = np.nonzero(depth.sum(axis=2) >= max(min_depth, 1))
            data[ends[lo + row] + site] = BASES[3 - depth[row, site, ::-1].argmax(axis=1)]  # the larger of equals
            called[lo:hi] = np.bincount(row, minlength=hi - lo)
        text = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
        return pa.StructArray.from_arrays([text, pa.array(called)], names=["t", "n"])

    return settle(F.col(text), F.col(calls))


BASES = np.frombuffer(b"ACGT", dtype=np.uint8)


def pileup_consensus(reads: DataFrame, ref: DataFrame, min_depth: int = 1, h: int = 12) -> DataFrame:
    """Rows (sample, seq, n_called): the reference with each anchored site's most frequent read base.

    Ties go to the larger base; sites with fewer than ``min_depth`` reads keep the reference's. ``ref`` has one row. Only
    tiles with calls are made; between them the reference is put in as it is, cut as bytes, so that no cut walks the text.
    """
    ref = ref.where("seq <> ''").select("seq")
    offsets = F.sequence(F.lit(0), F.length("seq") - 1, F.lit(TILE))
    cut = ref.select(F.explode(F.transform(offsets, lambda o: F.struct(o.alias("o"), F.substr(F.col("seq"), o + 1, F.lit(TILE)).alias("t")))).alias("x")).select("x.o", "x.t")
    calls = pileup(reads, ref, h).groupBy("sample", "o").agg(F.flatten(F.collect_list("calls")).alias("calls"))
    rows = calls.join(broadcast_if_small(cut), "o").select("sample", "o", settled("t", "calls", min_depth).alias("x")).where("x.n > 0")
    rows = rows.groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("o", "x.t"))).alias("a"), F.sum("x.n").cast("long").alias("n_called"))
    rows = rows.crossJoin(F.broadcast(ref.select(F.col("seq").cast("binary").alias("_ref"))))  # one row
    end = f"if(i = 0, 0, a[i - 1].o + {TILE})"
    seq = f"""concat(array_join(transform(a, (x, i) -> concat(cast(substring(_ref, {end} + 1, x.o - {end}) as string), x.t)), ''),
        cast(substring(_ref, a[size(a) - 1].o + {TILE + 1}, length(_ref)) as string))"""
    return rows.select("sample", F.expr(seq).alias("seq"), "n_called")


def assembly_stats(contigs: DataFrame, reads: DataFrame) -> DataFrame:
    """Rows (sample, n_contigs, assembly_length, mean_coverage): coverage is read bases over assembly length."""
    c = contigs.groupBy("sample").agg(F.count("*").alias("n_contigs"), F.sum(F.length("seq")).alias("assembly_length"))
    r = reads.groupBy("sample").agg(F.sum(F.length("seq")).alias("bases"))
    rate = F.when(F.col("assembly_length") > 0, F.round(F.coalesce("bases", F.lit(0)) / F.col("assembly_length"), 6)).otherwise(0.0)
    return c.join(r, "sample", "left").select("sample", "n_contigs", "assembly_length", rate.alias("mean_coverage"))


def renumber_contigs(contigs: DataFrame, order: str = "contig_no") -> DataFrame:
    """Contigs named ``{sample}_{n}`` in file order."""
    rows = ranked(contigs, ["sample"], [order], "_place")
    return rows.withColumn("contig_id", F.concat_ws("_", F.col("sample").cast("string"), F.col("_place").cast("string"))).drop("_place")


def unitigs(seqs: DataFrame, k: int = 31, min_count: int = 1, max_rounds: int = 40) -> DataFrame:
    """Rows (seq, n_kmers): maximal paths without branches in the graph of solid k-mers.

    Nodes are (k-1)-mers, edges are k-mers seen ``min_count`` times or more. An edge follows another where their common
    node has one way in and one way out. Each edge points to its predecessor; pointers double their reach each round, so
    a path of n edges takes log2(n) rounds, each a stage table. A cycle without branches is cut at its smallest k-mer.
    """
    solid = run_kmers(seqs, k, []).groupBy("minimizer", "kmer").agg(F.sum("n").alias("n")) if k <= 31 else kmers(seqs, k, []).groupBy("kmer").agg(F.count("*").alias("n"))
    edges = solid.where(F.col("n") >= min_count)
    edges = stage_table(edges.select("kmer", F.substring("kmer", 1, k - 1).alias("src"), F.substring("kmer", 2, k - 1).alias("dst")), "edges")
    ins = edges.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("n_in"), F.min("kmer").alias("prev"))
    outs = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("n_out"))
    through = ins.join(outs, "node").where("n_in = 1 and n_out = 1").select(F.col("node").alias("src"), "prev")
    # ptr: the edge ``step`` places before, or null at a path's start; low: the least k-mer passed so far.
    links = stage_table(edges.join(through, "src", "left").select("kmer", F.col("prev").alias("ptr"), F.when(F.col("prev").isNotNull(), 1).otherwise(0).cast("long").alias("dist"), F.least("kmer", F.coalesce("prev", "kmer")).alias("low"), F.coalesce("prev", "kmer").alias("head")), "links")
    size = links.count()
    reach = 1
    for _ in range(max_rounds):
        if reach > size or links.where("ptr is not null").isEmpty():
            break
        other = links.select(F.col("kmer").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("dist").alias("dist2"), F.col("low").alias("low2"), F.col("head").alias("head2"))
        links = stage_table(
            links.join(other, "ptr", "left").select(
                "kmer", F.col("ptr2").alias("ptr"), (F.col("dist") + F.coalesce("dist2", F.lit(0))).alias("dist"), F.least("low", F.coalesce("low2", "low")).alias("low"), F.coalesce("head2", "head").alias("head")
            ),
            "links",
        )
        reach *= 2
    # What still points somewhere lies on a cycle; its smallest k-mer becomes the start.
    paths = links.where("ptr is null").select("kmer", "head", "dist")
    cycle = links.where("ptr is not null").select("kmer", F.col("low").alias("head"))
    if not cycle.isEmpty():
        paths = paths.unionByName(cycle_order(cycle, edges, k))
    text = F.array_sort(F.collect_list(F.struct("dist", F.substring("kmer", k, 1).alias("last"))))
    rows = paths.groupBy("head").agg(text.alias("a"))
    return rows.select(F.concat(F.substring("head", 1, k - 1), F.array_join(F.transform("a", lambda x: x["last"]), "")).alias("seq"), F.size("a").cast("long").alias("n_kmers"))


def cycle_order(cycle: DataFrame, edges: DataFrame, k: int) -> DataFrame:
    """Rows (kmer, head, dist): the edges of branchless cycles, counted from the smallest, again by doubling pointers."""
    own = cycle.join(edges, "kmer")
    prev = own.select(F.col("dst").alias("src"), F.col("kmer").alias("prev"))
    start = F.col("kmer") == F.col("head")
    links = stage_table(own.join(prev, "src").select("kmer", "head", F.when(~start, F.col("prev")).alias("ptr"), F.when(start, 0).otherwise(1).cast("long").alias("dist")), "cycle")
    while not links.where("ptr is not null").isEmpty():
        other = links.select(F.col("kmer").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("dist").alias("dist2"))
        links = stage_table(links.join(other, "ptr", "left").select("kmer", "head", F.col("ptr2").alias("ptr"), (F.col("dist") + F.coalesce("dist2", F.lit(0))).alias("dist")), "cycle")
    return links.select("kmer", "head", "dist")
