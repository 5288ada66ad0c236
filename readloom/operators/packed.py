"""K-mers as numbers of two bits a base: look-ups in a set or filter, and runs of one minimizer that travel whole.

K-mers of at most 31 bases; those with a letter other than A, C, G and T are none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.digests import window_heads

#: Bases that are packed at once; k-mers of a set that is sent whole; bits of a filter in its place, and per k-mer.
PIECE, SET, FILTER_BITS, BITS_EACH = 1 << 21, 1 << 21, 1 << 27, 10
#: Length of the minimizers that name runs.
M = 11
CODE = np.full(256, 4, dtype=np.uint8)
CODE[[ord(c) for c in "ACGT"]] = range(4)


def flat(seqs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bases of all sequences behind each other as 0 to 3, other letters 4, and where each sequence begins and ends."""
    seqs = seqs.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(seqs.buffers()[1], dtype=np.int64)[seqs.offset : seqs.offset + len(seqs) + 1]
    data = np.frombuffer(seqs.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]] if len(seqs) else data[:0], offsets - offsets[0]


def windows(codes: np.ndarray, k: int) -> np.ndarray:
    """The number of the ``k`` bases from each place on, joined from numbers of half as many."""
    out, size, known = None, 0, codes.astype(np.uint64)
    step = 1
    while True:
        if k & step:
            out = known if out is None else (out[: len(known) - size] << np.uint64(2 * step)) | known[size : size + len(out)][: len(known) - size]
            size += step
        if 2 * step > k:
            return out
        known = (known[:-step] << np.uint64(2 * step)) | known[step:]
        step *= 2


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def pieces(seqs: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (places, sequences, numbers) of all k-mers, ``PIECE`` bases at once; places count through all sequences."""
    if not 0 < k <= 31:
        raise ValueError("k is 1 to 31")
    data, offsets = flat(seqs)
    for lo in range(0, len(data), PIECE):
        codes = CODE[data[lo : lo + PIECE + k - 1]]
        if len(codes) < k:
            return
        bad = np.concatenate([[0], np.cumsum(codes > 3)])
        at = np.flatnonzero(bad[k:] == bad[:-k])
        row = np.searchsorted(offsets, lo + at, side="right") - 1
        inside = lo + at + k <= offsets[row + 1]
        at, row = at[inside], row[inside]
        yield lo + at, row, windows(codes & 3, k)[at]


def text_of(code: str | Column, k: int) -> Column:
    """The bases of a number."""

    @F.arrow_udf("string")
    def spelled(codes: pa.Array) -> pa.Array:
        x = codes.to_numpy(zero_copy_only=False).astype(np.uint64)
        bases = np.frombuffer(b"ACGT", dtype=np.uint8)[((x[:, None] >> (np.uint64(2) * np.arange(k - 1, -1, -1, dtype=np.uint64))) & np.uint64(3)).astype(np.int64)]
        return pa.array(np.ascontiguousarray(bases).view(f"S{k}").ravel().astype(str), pa.string())

    return spelled(F.col(code) if isinstance(code, str) else code)


def numbers(seq: str, k: int) -> Column:
    """The distinct k-mers of each sequence, as numbers."""

    @F.arrow_udf("array<bigint>")
    def found(seqs: pa.Array) -> pa.Array:
        parts = [(row, x) for _, row, x in pieces(seqs, k)]
        if not parts:
            return pa.array([[]] * len(seqs), pa.list_(pa.int64()))
        row, x = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.lexsort((x, row))
        row, x = row[order], x[order]
        new = np.append(True, (row[1:] != row[:-1]) | (x[1:] != x[:-1]))
        ends = np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(seqs)))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x[new].astype(np.int64)))

    return found(F.col(seq))


# --- look-ups ------------------------------------------------------------------------------------------------------------


class Lookup:
    """Which k-mers are in a set: exactly, by a table of bits and the sorted set; or by the bits of a filter alone, which lets some others pass."""

    def __init__(self, known: np.ndarray | None, bits: np.ndarray | None = None):
        self.known = known
        if known is not None:
            size = 1 << max(16, int(8 * max(len(known), 1)).bit_length())
            bits = np.zeros(size, dtype=bool)
            bits[mixed(known) & np.uint64(size - 1)] = True
        self.bits = bits

    def passing(self, x: np.ndarray) -> np.ndarray:
        h, size = mixed(x), np.uint64(len(self.bits) - 1)
        if self.known is None:
            return np.flatnonzero(self.bits[h & size] & self.bits[(h >> np.uint64(32)) & size])
        at = np.flatnonzero(self.bits[h & size])
        place = np.searchsorted(self.known, x[at])
        return at[(place < len(self.known)) & (self.known[np.minimum(place, len(self.known) - 1)] == x[at])] if len(self.known) else at


def lookup(baits: DataFrame, n: int) -> Lookup:
    """A set of ``n`` rows (code) as it is where it is small; else a filter that tasks fill, sized by the number.

    The driver gets the set's numbers, ``SET`` at most, or words of a filter of ``FILTER_BITS`` bits at most: beyond ten
    bits a k-mer it lets more pass, which the exact join then drops.
    """
    if n <= SET:
        return Lookup(np.sort(np.array([r.code for r in baits.collect()], dtype=np.int64).astype(np.uint64)))
    size = min(FILTER_BITS, 1 << (BITS_EACH * n).bit_length())

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, dtype=bool)
        for b in batches:
            h = mixed(b.column("code").to_numpy().astype(np.uint64))
            for x in (h, h >> np.uint64(32)):
                bits[x & np.uint64(size - 1)] = True
        words = np.packbits(bits).view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], names=["word", "bits"])

    words = baits.mapInArrow(fill, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(size // 64, dtype=np.int64)
    for r in words.toLocalIterator():
        out[r.word] = r.bits
    return Lookup(None, np.unpackbits(out.view(np.uint8)).astype(bool))


def shared_counts(reads: DataFrame, baits: DataFrame, k: int) -> DataFrame:
    """Rows (sample, read_id, n_kmers): how many k-mers of each read are among the distinct ``baits`` (code).

    Reads are looked up where they lie. A small set decides alone; of a large one only k-mers that pass its filter are
    joined, so that reads without a bait never reach a shuffle.
    """
    known = lookup(baits, baits.count())
    shared = reads.sparkSession.sparkContext.broadcast(known)
    exact = known.known is not None

    @F.arrow_udf("bigint" if exact else "array<bigint>")
    def hits(seqs: pa.Array) -> pa.Array:
        count, passed = np.zeros(len(seqs), dtype=np.int64), []
        for _, row, x in pieces(seqs, k):
            at = shared.value.passing(x)
            count += np.bincount(row[at], minlength=len(seqs))
            passed.append(x[at])
        if exact:
            return pa.array(count)
        x = np.concatenate([*passed, np.zeros(0, dtype=np.uint64)]).astype(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(x))

    rows = reads.select("sample", "read_id", hits("seq").alias("hits"))
    if exact:
        rows = rows.where("hits > 0")
        return rows.groupBy("sample", "read_id").agg(F.sum("hits").alias("n_kmers"))
    rows = rows.where(F.size("hits") > 0).select("sample", "read_id", F.explode("hits").alias("code"))
    return rows.join(baits.hint("merge"), "code", "left_semi").groupBy("sample", "read_id").agg(F.count("*").alias("n_kmers"))


class Near:
    """Which k-mers lie within ``most`` substitutions of a set: one of ``bounds``' parts must be equal, then all bases are compared."""

    def __init__(self, known: np.ndarray, k: int, bounds: list[tuple[int, int]], most: int):
        self.exact, self.most, self.parts = Lookup(known), most, []
        for start, size in bounds:
            shift, mask = np.uint64(2 * (k - start - size)), np.uint64(4**size - 1)
            part = (known >> shift) & mask
            order = np.argsort(part, kind="stable")
            part = part[order]
            direct = np.searchsorted(part, np.arange(4**size + 1, dtype=np.uint64)).astype(np.int32) if size <= 11 else None
            self.parts.append((shift, mask, part, direct, known[order]))

    def passing(self, x: np.ndarray, other: np.ndarray | None = None) -> np.ndarray:
        """The places of such k-mers; ``other`` has a bit for each base of ``x`` that is a letter without a number, and differs from all."""
        found = np.zeros(len(x), dtype=bool)
        found[self.exact.passing(x)] = True
        if other is not None:
            found &= other == 0
        for shift, mask, part, direct, known in self.parts if self.most else ():
            open_ = np.flatnonzero(~found)
            own = (x[open_] >> shift) & mask
            lo, hi = (direct[own], direct[own + np.uint64(1)]) if direct is not None else (np.searchsorted(part, own, side=s) for s in ("left", "right"))
            n = (hi - lo).astype(np.int64)
            open_, lo, n = open_[n > 0], lo[n > 0].astype(np.int64), n[n > 0]
            total, first = np.concatenate([[0], np.cumsum(n)]), 0
            while first < len(open_):
                last = max(first + 1, int(np.searchsorted(total, total[first] + PIECE, side="right")) - 1)
                m = n[first:last]
                at = np.repeat(lo[first:last] - (total[first:last] - total[first]), m) + np.arange(m.sum())
                owner = np.repeat(open_[first:last], m)
                apart = known[at] ^ x[owner]
                apart = (apart | (apart >> np.uint64(1))) & np.uint64(0x5555555555555555)
                if other is not None:
                    apart |= other[owner]
                found[owner[np.bitwise_count(apart) <= self.most]] = True
                first = last
        return np.flatnonzero(found)


def near_counts(reads: DataFrame, baits: DataFrame, k: int, bounds: list[tuple[int, int]], most: int) -> DataFrame:
    """As ``shared_counts`` with up to ``most`` substitutions, for at most ``SET`` distinct ``baits`` (code); a read's letter beyond A, C, G and T is one."""
    known = np.sort(np.array([r.code for r in baits.collect()], dtype=np.int64).astype(np.uint64))
    shared = reads.sparkSession.sparkContext.broadcast(Near(known, k, bounds, most))

    @F.arrow_udf("bigint")
    def hits(seqs: pa.Array) -> pa.Array:
        data, ends = flat(seqs)
        count = np.zeros(len(seqs), dtype=np.int64)
        for lo in range(0, len(data), PIECE):
            codes = CODE[data[lo : lo + PIECE + k - 1]]
            if len(codes) < k:
                break
            places = len(codes) - k + 1
            row = np.repeat(np.arange(len(seqs)), np.diff(np.clip(ends, lo, lo + places)))
            inside = lo + np.arange(places) + k <= ends[row + 1]
            other = windows((codes > 3).astype(np.uint8), k)[inside] if (codes > 3).any() else None
            at = shared.value.passing(windows(codes & 3, k)[inside], other)
            count += np.bincount(row[inside][at], minlength=len(seqs))
        return pa.array(count)

    rows = reads.select("sample", "read_id", hits(F.col("seq").cast("string")).alias("hits")).where("hits > 0")
    return rows.groupBy("sample", "read_id").agg(F.sum("hits").alias("n_kmers"))


# --- runs of one minimizer -------------------------------------------------------------------------------------------------


def least_in(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbours."""
    size = 1
    while 2 * size <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def runs(df: DataFrame, k: int, keep: list[str], seq: str = "seq") -> DataFrame:
    """Rows (keep, minimizer, run, n): all k-mers as runs of neighbours with one minimizer, their bases as text.

    The minimizer is the least hash of a k-mer's ``M``-mers, so equal k-mers are in runs of one minimizer. Equal runs of
    a batch are one row with their number ``n``.
    """
    m = min(M, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, _ = flat(b.column(seq))
            for at, row, _ in pieces(b.column(seq), k):
                if not len(at):
                    continue
                lo = int(at[0])
                own = data[lo : int(at[-1]) + k]
                least = least_in(mixed(windows(CODE[own] & 3, m)), k - m + 1)[at - lo]
                first = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (row[1:] != row[:-1]) | (least[1:] != least[:-1])))
                last = np.append(first[1:], len(at)) - 1
                size = at[last] - at[first] + k
                ends = np.concatenate([[0], np.cumsum(size)])
                text = own[np.repeat(at[first] - lo - ends[:-1], size) + np.arange(ends[-1])]
                text = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text)])
                t = pa.Table.from_arrays([*(b.column(c).take(pa.array(row[first])) for c in keep), pa.array(least[first].astype(np.int64)), text], names=[*keep, "minimizer", "run"])
                t = t.group_by(t.column_names).aggregate([([], "count_all")])
                yield from t.rename_columns([*keep, "minimizer", "run", "n"]).combine_chunks().to_batches()

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return df.select(*keep, F.col(seq).cast("string").alias(seq)).mapInArrow(run, f"{kinds}minimizer long, run string, n long")


def run_kmers(df: DataFrame, k: int, keep: list[str], seq: str = "seq") -> DataFrame:
    """Rows (keep, minimizer, kmer, n): all k-mers with their numbers, in partitions by minimizer.

    Only runs cross the shuffle; they are cut into k-mers behind it, in the JVM, so that Spark knows how rows lie and
    groups by (minimizer, kmer), and more, without another one.
    """
    own = F.transform(F.sequence(F.lit(1), F.length("run") - (k - 1)), lambda j: F.substr(F.col("run"), j, F.lit(k)))
    # A run has one k-mer or more; a plain explode would have Spark cut it on both sides of the shuffle, to test for that.
    return runs(df, k, keep, seq).repartition("minimizer").select(*keep, "minimizer", "n", F.explode_outer(own).alias("kmer"))


# --- minimizers ------------------------------------------------------------------------------------------------------------


def turn_keys(data: np.ndarray, k: int) -> np.ndarray:
    """Numbers in the order of (md5, letters) of the ``k`` bytes from each place on."""
    turn = window_heads(data, k).astype(np.uint64)
    codes = CODE[data]
    if k <= 16 and (codes < 4).all():
        return (turn << np.uint64(32)) | windows(codes, k)
    # Other letters, or more than fit: dense ranks by the md5, then by the bytes, eight at once.
    wide = -(-k // 8) * 8
    x = np.concatenate([data, np.zeros(wide, dtype=np.uint8)]).astype(np.uint64)
    words = []
    for lo in range(0, k, 8):
        word = np.zeros(len(turn), dtype=np.uint64)
        for i in range(lo, lo + 8):
            word = (word << np.uint64(8)) | (x[i : i + len(turn)] if i < k else np.uint64(0))
        words.append(word)
    order = np.lexsort([*reversed(words), turn])
    new = np.zeros(len(order), dtype=np.uint64)
    for column in (turn, *words):
        new[1:] |= column[order[1:]] != column[order[:-1]]
    out = np.empty(len(order), dtype=np.uint64)
    out[order] = np.cumsum(new)
    return out


def least_places(key: np.ndarray, w: int) -> np.ndarray:
    """The place of the least, and leftmost of equals, of each ``w`` neighbours."""
    at = np.arange(len(key))

    def meet(key: np.ndarray, at: np.ndarray, by: int) -> tuple[np.ndarray, np.ndarray]:
        later = key[by:] < key[:-by]
        return np.where(later, key[by:], key[:-by]), np.where(later, at[by:], at[:-by])

    size = 1
    while 2 * size <= w:
        key, at = meet(key, at, size)
        size *= 2
    return meet(key, at, w - size)[1] if w > size else at


def minimizer_places(data: np.ndarray, offsets: np.ndarray, w: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (places, sequences) of the minimizers of all sequences, each once, ``PIECE`` windows at once.

    Windows that follow each other have minimizers that never go back, so a place that is met again is the one before.
    """
    span, before = k + w - 1, -1
    for lo in range(0, len(data), PIECE):
        own = data[lo : lo + PIECE + span - 1]
        if len(own) < span:
            return
        at = lo + least_places(turn_keys(own, k), w)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.clip(offsets, lo, lo + len(at))))
        inside = lo + np.arange(len(at)) + span <= offsets[row + 1]
        at, row = at[inside], row[inside]
        new = np.append(at[:1] != before, at[1:] != at[:-1])
        if len(at):
            before = at[-1]
            yield at[new], row[new]


def texts_at(data: np.ndarray, at: np.ndarray, k: int) -> pa.Array:
    """The ``k`` letters from each place on."""
    text = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, k)[at]) if len(at) else data[:0]
    return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.arange(len(at) + 1, dtype=np.int32) * np.int32(k)), pa.py_buffer(text)])


def slices(b: pa.RecordBatch, seq: str = "seq") -> Iterator[pa.RecordBatch]:
    """The batch in parts of whole rows, of ``PIECE`` bases at most where a row alone has no more."""
    _, offsets = flat(b.column(seq))
    lo = 0
    while lo < b.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, side="right")) - 1)
        yield b.slice(lo, hi - lo)
        lo = hi
