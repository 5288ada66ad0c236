"""Adapters within so many edits: detection in the first reads, trimming of both ends, and splitting of chimeras."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.operators.reads import first_reads

#: Places of a chunk in which long reads are searched side by side.
CHUNK = 512


def matrix(texts: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each text in a row of its own, behind them zeros, and the texts' lengths; null is empty."""
    texts = (texts.fill_null("") if pa.types.is_string(texts.type) else texts).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    sizes = np.diff(offsets)
    at = np.arange(width if width is not None else sizes.max(initial=0))
    inside = at < sizes[:, None]
    out = np.zeros(inside.shape, dtype=np.uint8)
    out[inside] = data[(offsets[:-1, None] + at)[inside]]
    return out, sizes


def edits(rows: np.ndarray, adapter: bytes) -> np.ndarray:
    """For every place of every row the least number of edits between the adapter and a text that ends there.

    Myers' bit vectors, one 64-bit word per row: a column of the table of edit distances is two words of differences.
    """
    m = len(adapter)
    if not 0 < m <= 64:
        raise ValueError("an adapter has 1 to 64 bases")
    equal = np.zeros(256, dtype=np.uint64)
    for i, c in enumerate(adapter):
        equal[c] |= np.uint64(1 << i)
    one, top = np.uint64(1), np.uint64(1 << (m - 1))
    plus, minus = np.full(len(rows), 2**64 - 1, dtype=np.uint64), np.zeros(len(rows), dtype=np.uint64)
    score, out = np.full(len(rows), m, dtype=np.int16), np.zeros(rows.shape, dtype=np.int16)
    for j, column in enumerate(np.ascontiguousarray(rows.T)):
        eq = equal[column]
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(xh | plus), plus & xh
        score += (up & top) != 0
        score -= (down & top) != 0
        up, down = up << one, down << one
        plus, minus = down | ~(xv | up), up & xv
        out[:, j] = score
    return out


def best_places(distance: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """True where a distance is ``most`` or less, and no place within ``most`` is better, or as good and earlier."""
    padded = np.pad(np.where(np.arange(distance.shape[1]) < sizes[:, None], distance, 99), ((0, 0), (most, most)), constant_values=99)
    n = distance.shape[1]
    found = padded[:, most : most + n] <= most
    for shift in range(1, most + 1):
        found &= (padded[:, most : most + n] < padded[:, most - shift : most - shift + n]) & (padded[:, most : most + n] <= padded[:, most + shift : most + shift + n])
    return found


def whole_edits(a: bytes, b: bytes) -> int:
    """Edit distance of two short texts."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def adapter_rows(adapters: DataFrame, most: int = 1000) -> list[tuple[str, str]]:
    """The adapter table's rows (name, seq): a parameter list, refused beyond ``most`` rows."""
    rows = [(r["name"], r["seq"]) for r in adapters.select("name", "seq").orderBy("name", "seq").limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {most} adapters")
    return rows


def windows(window: int) -> tuple[Column, Column]:
    """The first and the last ``window`` bases of a read: no more of it goes to Python."""
    return F.substr(F.col("seq"), F.lit(1), F.lit(window)), F.substr(F.col("seq"), F.greatest(F.length("seq") - window + 1, F.lit(1)), F.lit(window))


def detect_adapters(reads: DataFrame, adapters: DataFrame, check: int = 1000, window: int = 150, most: int = 2, share: float = 0.01, by_sample: bool = False) -> DataFrame:
    """Rows (name, n_reads, n_checked, present): how many of each sample's first ``check`` reads have the adapter at an end.

    With ``by_sample`` rows (sample, name, ...), each sample being judged by its own reads. It is there where a window's part is within ``most`` edits of it: substitutions, insertions and deletions.
    """
    known = adapter_rows(adapters)
    keys = ["sample"] if by_sample else []
    rows = first_reads(reads, check).select(*keys, "seq")
    if not known:
        return rows.select(*keys, F.lit("").alias("name"), F.lit(0).cast("long").alias("n_reads"), F.lit(0).cast("long").alias("n_checked"), F.lit(False).alias("present")).limit(0)

    @F.arrow_udf("array<boolean>")
    def found(head: pa.Array, tail: pa.Array) -> pa.Array:
        sides = [matrix(head), matrix(tail)]
        hits = []
        for _, seq in known:
            some = [(np.where(np.arange(x.shape[1]) < n[:, None], edits(x, seq.encode()), 99) <= most).any(axis=1) for x, n in sides]
            hits.append(some[0] | some[1])
        return pa.array(np.stack(hits, axis=1).tolist(), pa.list_(pa.bool_()))

    names = F.array(*[F.lit(name) for name, _ in known])
    hits = rows.select(*keys, F.explode(F.arrays_zip(names.alias("name"), found(*windows(window)).alias("hit"))).alias("f"))
    hits = hits.groupBy(*keys, "f.name").agg(F.sum(F.col("f.hit").cast("long")).alias("n_reads"), F.count("*").alias("n_checked"))
    return hits.withColumn("present", F.col("n_reads") >= share * F.col("n_checked"))


def trim_adapters(reads: DataFrame, adapters: DataFrame, window: int = 150, most: int = 2) -> DataFrame:
    """Reads cut behind the last adapter of the start window and before the first one of the end window, quality alike; empty reads go.

    An adapter lies where a part is within ``most`` edits of it; its end, and at the read's end its start, is the best
    place of those so near to each other, the outer one if several are equally good.
    """
    known = [seq.encode() for _, seq in adapter_rows(adapters)]

    @F.arrow_udf("struct<head: int, tail: int>")
    def cuts(head: pa.Array, tail: pa.Array) -> pa.Array:
        (x, n), (y, m) = matrix(head), matrix(tail)
        # The end window runs from the read's end: shifted to the right it is the same text read backwards.
        width = y.shape[1]
        at = m[:, None] - 1 - np.arange(width)
        y = np.where(at >= 0, np.take_along_axis(y, np.maximum(at, 0), axis=1), 0).astype(np.uint8)
        out = []
        for rows, sizes, turned in ((x, n, False), (y, m, True)):
            last = np.zeros(len(rows), dtype=np.int32)
            for seq in known:
                place = best_places(edits(rows, seq[::-1] if turned else seq), sizes, most)
                last = np.maximum(last, np.where(place, np.arange(1, rows.shape[1] + 1), 0).max(axis=1, initial=0))
            out.append(pa.array(last.astype(np.int32)))
        return pa.StructArray.from_arrays(out, names=["head", "tail"])

    rows = reads.withColumn("_cuts", cuts(*windows(window)))
    rows = rows.withColumn("_size", F.greatest(F.length("seq") - F.col("_cuts.head") - F.col("_cuts.tail"), F.lit(0)))
    cut = lambda c: F.substr(F.col(c), F.col("_cuts.head") + 1, F.col("_size")).alias(c)
    return rows.where("_size > 0").select(*[cut(c) if c in ("seq", "qual") else F.col(c) for c in reads.columns])


def places_in(seqs: pa.Array, adapter: bytes, most: int) -> list[list[tuple[int, int]]]:
    """For each whole sequence the (start, end) of the adapter's best places, in order.

    Sequences are cut into chunks that overlap by what a match may be long, all chunks being searched side by side. The
    start of a match is that of the text with least edits that ends there; of those the nearest to the adapter's length,
    then the shorter.
    """
    m, ahead = len(adapter), len(adapter) + 2 * most
    texts = [t.encode() for t in seqs.fill_null("").to_pylist()]
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    chunks = [(i, o) for i, t in enumerate(texts) for o in range(0, len(t), CHUNK)]
    for lo in range(0, len(chunks), 4096):
        some = chunks[lo : lo + 4096]
        # Each chunk with what lies before it, for matches that begin there, and ``most`` places behind it to compare with.
        starts = [max(0, o - ahead) for _, o in some]
        rows, sizes = matrix(pa.array([texts[i][a : o + CHUNK + most] for (i, o), a in zip(some, starts, strict=True)], pa.binary()))
        for r, e in zip(*np.nonzero(best_places(edits(rows, adapter), sizes, most)), strict=True):
            (i, o), end = some[r], starts[r] + int(e) + 1
            if o < end <= o + CHUNK:
                ways = [(whole_edits(texts[i][end - n : end], adapter), abs(n - m), n) for n in range(max(0, m - most), min(end, m + most) + 1)]
                out[i].append((end - min(ways)[2], end))
    return out


def split_chimeras(reads: DataFrame, adapter: str, most: int = 2) -> DataFrame:
    """Rows (sample, read_id, fragment_id, seq, qual): reads cut where they hold the adapter within ``most`` edits; empty parts go."""

    @F.arrow_udf("array<struct<a: int, b: int>>")
    def found(seqs: pa.Array) -> pa.Array:
        places = [[{"a": a, "b": b} for a, b in own] for own in places_in(seqs, adapter.encode(), most)]
        return pa.array(places, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))

    rows = reads.withColumn("_hits", found("seq"))
    none = F.array(F.struct(F.length("seq").alias("a"), F.length("seq").alias("b")))
    # A part lies between the furthest end so far and the next hit's start.
    ends = F.concat(F.array(F.lit(0)), F.transform("_hits", lambda x: x["b"]))
    parts = F.zip_with(F.transform(ends, lambda x, i: F.array_max(F.slice(ends, F.lit(1), i + 1))), F.concat("_hits", none), lambda lo, hit: F.struct(lo.alias("lo"), hit["a"].alias("hi")))
    rows = rows.select("sample", "read_id", "seq", "qual", F.posexplode(parts).alias("_i", "p")).where("p.hi > p.lo")
    cut = lambda c: F.substr(F.col(c), F.col("p.lo") + 1, F.col("p.hi") - F.col("p.lo")).alias(c)
    return rows.select("sample", "read_id", F.concat_ws("_", F.col("read_id").cast("string"), (F.col("_i") + 1).cast("string")).alias("fragment_id"), cut("seq"), cut("qual"))
