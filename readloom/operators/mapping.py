"""Approximate mapping by minimizers, overlaps between reads, duplicates, and coordinate order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.functions.sequence import reverse_complement
from readloom.operators import packed
from readloom.operators.chaining import NAMES, chain_anchors, chains_of
from readloom.operators.kmers import SMALL_ROWS, minimizers
from readloom.operators.ranks import ranked
from readloom.operators.reads import best_of_group
from readloom.sources.stages import stage_table

#: Anchors that are sorted at once.
ANCHORS = 1 << 21
#: Bases of a sample up to which one task compares all its reads.
WHOLE = 1 << 19


def map_reads(reads: DataFrame, refs: DataFrame, w: int = 10, k: int = 15, least: int = 3, revcomp: bool = True) -> DataFrame:
    """Rows (sample, read_id, ref_id, strand, qstart, qend, tstart, tend, n_anchors, flag): hits of every read, or one row without.

    Equal minimizers of read and reference are anchors; a colinear chain of ``least`` of them is a hit, whatever small
    insertions and deletions lie between. Strand ``-`` counts on the reverse complement of the reference. Flag: 4 without hit, 16 on strand ``-``, and
    256 for any hit but the best (most anchors, then ref_id, strand, start).

    Where the reference has up to ``SMALL_ROWS`` minimizers, they are sent to the tasks and reads are chained where they lie, so
    that only hits are shuffled; else anchors come from a join. There, rows of one read_id are one read; here, each row is.
    """
    targets = refs.select("ref_id", F.lit("+").alias("strand"), "seq")
    if revcomp:
        targets = targets.unionByName(refs.select("ref_id", F.lit("-").alias("strand"), reverse_complement("seq").alias("seq")))
    t = stage_table(minimizers(targets, ["ref_id", "strand"], w, k).withColumnRenamed("pos", "tpos"), "targets")
    if t.count() <= SMALL_ROWS:
        rows = hits_in_place(reads, t, w, k, least)
    else:
        q = minimizers(reads, ["sample", "read_id"], w, k).withColumnRenamed("pos", "qpos")
        rows = chain_anchors(q.join(t, "kmer"), ["sample", "read_id", "ref_id", "strand"], k, least)
        rows = rows.unionByName(reads.select("sample", "read_id"), allowMissingColumns=True)
    # A row without a hit is the last of its read; it stays where it is the only one.
    best = Window.partitionBy("sample", "read_id").orderBy(F.desc("n_anchors"), "ref_id", "strand", "tstart", "qstart", "qend")
    rows = rows.repartition("sample", "read_id").distinct().withColumn("nth", F.row_number().over(best)).where("nth = 1 OR ref_id IS NOT NULL")
    flag = F.when(F.col("ref_id").isNull(), 4).otherwise(F.when(F.col("strand") == "-", 16).otherwise(0) + F.when(F.col("nth") > 1, 256).otherwise(0))
    return rows.withColumn("flag", flag.cast("int")).drop("nth")


def hits_in_place(reads: DataFrame, targets: DataFrame, w: int, k: int, least: int) -> DataFrame:
    """Rows (sample, read_id, ref_id, strand, qstart, qend, tstart, tend, n_anchors): the chains of each read, or one row of nulls.

    ``targets`` has rows (ref_id, strand, tpos, kmer), few enough for every task.
    """
    table = targets.toArrow().combine_chunks().sort_by([("kmer", "ascending"), ("tpos", "ascending")])
    named = table.select(["ref_id", "strand"]).group_by(["ref_id", "strand"]).aggregate([]).combine_chunks()
    number = {x: i for i, x in enumerate(zip(named["ref_id"].to_pylist(), named["strand"].to_pylist(), strict=True))}
    target = np.array([number[x] for x in zip(table["ref_id"].to_pylist(), table["strand"].to_pylist(), strict=True)], dtype=np.int64)
    known = pc.unique(table["kmer"])
    ends = np.cumsum(np.bincount(pc.index_in(table["kmer"], value_set=known).to_numpy(), minlength=len(known)))
    shared = reads.sparkSession.sparkContext.broadcast((known, np.append(0, ends), target, table["tpos"].to_numpy().astype(np.int64), named))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bounds, target, tpos, named = shared.value
        name = [pa.concat_arrays(named[c].chunks) if named.num_rows else pa.nulls(0, named[c].type) for c in ("ref_id", "strand")]
        for b in (x for whole in batches for x in packed.slices(whole)):
            data, offsets = packed.flat(b.column("seq"))
            met = np.zeros(b.num_rows, dtype=bool)
            found = [p for p in packed.minimizer_places(data, offsets, w, k)]
            at, row = (np.concatenate([p[i] for p in found]) if found else np.zeros(0, dtype=np.int64) for i in (0, 1))
            own = pc.index_in(packed.texts_at(data, at, k), value_set=known)
            here = own.is_valid().to_numpy(zero_copy_only=False)
            at, row, own = at[here], row[here], own.drop_null().to_numpy().astype(np.int64)
            many = bounds[own + 1] - bounds[own]
            per_row = np.concatenate([[0], np.cumsum(np.bincount(row, weights=many, minlength=b.num_rows).astype(np.int64))])
            lo = 0
            while lo < b.num_rows:  # whole reads, of so many anchors at once where one alone has no more
                hi = max(lo + 1, int(np.searchsorted(per_row, per_row[lo] + ANCHORS, side="right")) - 1)
                x, y = np.searchsorted(row, [lo, hi])
                n = many[x:y]
                anchor = np.repeat(bounds[own[x:y]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                q, pair = np.repeat(at[x:y] - offsets[row[x:y]], n), np.repeat(row[x:y], n) * len(name[0]) + target[anchor]
                t = tpos[anchor]
                order = np.lexsort((q, t, pair))
                q, t, pair = q[order], t[order], pair[order]
                ids, size = np.unique(pair, return_counts=True)
                enough = size >= least
                inside = np.repeat(enough, size)
                for chain, ends in chains_of(size[enough], t[inside], q[inside], k, least):
                    mine = ids[enough][chain]
                    met[mine // len(name[0])] = True
                    source = pa.array(mine // len(name[0]))
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c).take(source) for c in ("sample", "read_id")), *(c.take(pa.array(mine % len(name[0]))) for c in name), *map(pa.array, ends)], names=["sample", "read_id", "ref_id", "strand", *NAMES]
                    )
                lo = hi
            rest = pa.array(np.flatnonzero(~met))
            nulls = [*(pa.nulls(len(rest), c.type) for c in name), *(pa.nulls(len(rest), pa.int64()) for _ in NAMES)]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(rest) for c in ("sample", "read_id")), *nulls], names=["sample", "read_id", "ref_id", "strand", *NAMES])

    kinds = ", ".join(f"{c} {d.schema[c].dataType.simpleString()}" for d, c in ((reads, "sample"), (reads, "read_id"), (targets, "ref_id"), (targets, "strand")))
    return reads.select("sample", "read_id", F.col("seq").cast("string").alias("seq")).mapInArrow(run, f"{kinds}, " + ", ".join(f"{c} long" for c in NAMES))


def mapped_ids(alignments: DataFrame) -> DataFrame:
    """Distinct reads with a hit."""
    return alignments.where(F.col("flag").bitwiseAND(4) == 0).select("sample", "read_id").distinct()


def mark_duplicates(alignments: DataFrame, score: str) -> DataFrame:
    """Of mapped reads that start at one place of the reference, the one with the highest score, then the smallest read_id."""
    rows = alignments.where(F.col("flag").bitwiseAND(4) == 0).withColumn("_start", F.col("tstart") - F.col("qstart"))
    return best_of_group(rows, ["sample", "ref_id", "strand", "_start"], [F.desc(score), "read_id"]).drop("_start")


def coordinate_sort(alignments: DataFrame) -> DataFrame:
    """Mapped reads with their place in each sample's coordinate order: by reference, start, then read_id."""
    return ranked(alignments.where(F.col("flag").bitwiseAND(4) == 0), ["sample"], ["ref_id", "tstart", "read_id"], "place")


def overlap_pairs(reads: DataFrame, least: int = 3000, w: int = 10, k: int = 15) -> DataFrame:
    """Rows (sample, a, b, overlap), a < b: reads of a sample with a chain of shared minimizers that spans ``least`` bases.

    Every minimizer that two reads or more share counts, however many share it, so that deep samples lose no overlap. A
    sample of up to ``WHOLE`` bases is compared in one task; those of more by a join, whose frequent keys Spark splits and
    which minimizers of one read leave before. The overlap is the longest chain's shorter side.
    """
    reads = reads.where("sample IS NOT NULL AND read_id IS NOT NULL").select("sample", "read_id", F.col("seq").cast("string").alias("seq"))
    sizes = reads.groupBy("sample").agg(F.sum(F.length("seq")).alias("bases"))
    deep = stage_table(sizes.where(F.col("bases") > WHOLE).select("sample"), "deep-samples")
    n = deep.limit(SMALL_ROWS + 1).count()
    if not n:
        return overlaps_in_place(reads, least, w, k)
    deep = F.broadcast(deep) if n <= SMALL_ROWS else deep
    chains = joined_chains(reads.join(deep, "sample", "left_semi"), w, k)
    spans = chains.groupBy("sample", "a", "b").agg(F.max(F.least(F.col("qend") - F.col("qstart"), F.col("tend") - F.col("tstart"))).alias("overlap"))
    return overlaps_in_place(reads.join(deep, "sample", "left_anti"), least, w, k).unionByName(spans.where(F.col("overlap") >= least))


def joined_chains(reads: DataFrame, w: int, k: int) -> DataFrame:
    m = minimizers(reads, ["sample", "read_id"], w, k)
    shared = m.groupBy("sample", "kmer").agg(F.min("read_id").alias("low"), F.max("read_id").alias("high")).where("low <> high")
    usable = m.join(shared.select("sample", "kmer"), ["sample", "kmer"])
    a = usable.select("sample", "kmer", F.col("read_id").alias("a"), F.col("pos").alias("qpos"))
    b = usable.select("sample", "kmer", F.col("read_id").alias("b"), F.col("pos").alias("tpos"))
    return chain_anchors(a.join(b, ["sample", "kmer"]).where("a < b"), ["sample", "a", "b"], k, 1)


def overlaps_in_place(reads: DataFrame, least: int, w: int, k: int) -> DataFrame:
    """As ``overlap_pairs``, each sample in one task: only reads are shuffled."""
    kinds = {c: reads.schema[c].dataType.simpleString() for c in ("sample", "read_id")}

    def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        sample = table["sample"].slice(0, 1).combine_chunks()
        ids = table["read_id"].combine_chunks()
        rank = pc.rank(ids, tiebreaker="dense").to_numpy().astype(np.int64) - 1
        name = ids.take(pa.array(np.unique(rank, return_index=True)[1]))
        seqs = table["seq"].combine_chunks()
        data, offsets = packed.flat(seqs)
        found = list(packed.minimizer_places(data, offsets, w, k))
        at, row = (np.concatenate([p[i] for p in found]) if found else np.zeros(0, dtype=np.int64) for i in (0, 1))
        # Equal k-mers get one number; entries lie by k-mer, read and place, each once.
        kmer = packed.texts_at(data, at, k).dictionary_encode().indices.to_numpy().astype(np.int64)
        kmer, read, pos = kmer, rank[row], at - offsets[row]
        order = np.lexsort((pos, read, kmer))
        kmer, read, pos = kmer[order], read[order], pos[order]
        new = np.append(True, (np.diff(kmer) != 0) | (np.diff(read) != 0) | (np.diff(pos) != 0))[: len(kmer)]
        kmer, read, pos = kmer[new], read[new], pos[new]
        # A read's partners at a place are what lies between its own entries of the k-mer and the k-mer's end.
        own = np.flatnonzero(np.append(True, (np.diff(kmer) != 0) | (np.diff(read) != 0))[: len(kmer)])
        first = np.repeat(np.append(own[1:], len(kmer))[: len(own)], np.diff(np.append(own, len(kmer))))
        last = np.searchsorted(kmer, kmer, side="right")
        by = np.argsort(read, kind="stable")
        first, many, read_of, pos_of = first[by], (last - first)[by], read[by], pos[by]
        per_read = np.concatenate([[0], np.cumsum(np.bincount(read_of, weights=many, minlength=len(name)).astype(np.int64))])
        lo = 0
        while lo < len(name):  # whole reads, of so many anchors at once where one alone has no more
            hi = max(lo + 1, int(np.searchsorted(per_read, per_read[lo] + ANCHORS, side="right")) - 1)
            x, y = np.searchsorted(read_of, [lo, hi])
            n = many[x:y]
            other = np.repeat(first[x:y] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            q, t, pair = np.repeat(pos_of[x:y], n), pos[other], np.repeat(read_of[x:y], n) * len(name) + read[other]
            order = np.lexsort((q, t, pair))
            q, t, pair = q[order], t[order], pair[order]
            ids_of, size = np.unique(pair, return_counts=True)
            anchors = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array((t << 32) | q))
            yield pa.RecordBatch.from_arrays([sample.take(pa.array(np.zeros(len(ids_of), dtype=np.int64))), name.take(pa.array(ids_of // len(name))), name.take(pa.array(ids_of % len(name))), anchors], names=["sample", "a", "b", "anchors"])
            lo = hi

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, span = b.column("anchors"), np.zeros(b.num_rows, dtype=np.int64)
            x = lists.flatten().to_numpy()
            for chain, (qs, qe, ts, te, _) in chains_of(lists.value_lengths().to_numpy(), x >> 32, x & ((1 << 32) - 1), k, 1):
                np.maximum.at(span, chain, np.minimum(qe - qs, te - ts))
            keep = pa.array(np.flatnonzero(span >= least))
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(keep) for c in ("sample", "a", "b")), pa.array(span).take(keep)], names=["sample", "a", "b", "overlap"])

    keys = f"sample {kinds['sample']}, a {kinds['read_id']}, b {kinds['read_id']}"
    # Pairs of many samples are chained side by side; they do not move in between.
    return reads.groupBy("sample").applyInArrow(anchors_of, f"{keys}, anchors array<bigint>").mapInArrow(spans, f"{keys}, overlap long")
