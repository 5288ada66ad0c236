"""Column functions on sequences, qualities and names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: quality characters start at this code.
PHRED_OFFSET = 33
#: Quality characters whose sums are held at once.
PROFILE_BYTES = 1 << 22
#: Suffixes of input files.
EXTENSIONS = (".fq", ".fq.gz", ".fastq", ".fastq.gz", ".fasta", ".fasta.gz", ".fa", ".fa.gz", ".fna", ".fna.gz")


def base_name(path: str) -> Column:
    return F.element_at(F.split(F.col(path), "/"), -1)


def sample_name(path: str) -> Column:
    """The file name up to its first dot, without ``_pass`` and ``_filtered``."""
    first = F.split_part(base_name(path), F.lit("."), F.lit(1))
    return F.replace(F.replace(first, F.lit("_pass"), F.lit("")), F.lit("_filtered"), F.lit(""))


def read_id(header: str) -> Column:
    """The first word of a FASTQ header without its ``@``."""
    return F.regexp_extract(F.col(header), r"^@(\S+)", 1)


def stem(path: str) -> Column:
    """The file name without its last extension."""
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def accepted_extension(path: str) -> Column:
    found = F.lit(False)
    for e in EXTENSIONS:
        found |= F.col(path).endswith(e)
    return found


def reverse_complement(seq: str | Column) -> Column:
    return F.translate(F.reverse(F.col(seq) if isinstance(seq, str) else seq), "ACGT", "TGCA")


def phred_sum(qual: str, least: int = 0) -> Column:
    """Sum of the quality values that are ``least`` or more; 0 without quality. A batch's qualities are one array of bytes."""

    @F.arrow_udf("bigint")
    def total(quals: pa.Array) -> pa.Array:
        quals = quals.fill_null("").cast(pa.large_binary())
        ends = np.frombuffer(quals.buffers()[1], dtype=np.int64)[quals.offset : quals.offset + len(quals) + 1]
        out = np.zeros(len(quals), dtype=np.int64)
        data = np.frombuffer(quals.buffers()[2] or b"", dtype=np.uint8)
        full = np.flatnonzero(np.diff(ends))  # reduceat takes no empty parts
        if len(full):
            value = data[ends[0] : ends[-1]].astype(np.int16) - PHRED_OFFSET
            value[value < least] = 0
            out[full] = np.add.reduceat(value, ends[full] - ends[0], dtype=np.int64)
        return pa.array(out)

    return total(F.col(qual).cast("string"))


def quality_profile(qual: str, window: int = 250) -> Column:
    """A struct (total, worst, width): the sum of a read's quality values, the least sum of ``width`` neighbouring ones, and that width.

    The width is ``window``, or the read's length where that is less. Without quality all are 0. Values are added up once per
    slice of a batch, so that memory follows the longest read, not the batch.
    """

    @F.arrow_udf("struct<total: bigint, worst: bigint, width: int>")
    def profile(quals: pa.Array) -> pa.Array:
        quals = quals.fill_null("").cast(pa.large_binary())
        ends = np.frombuffer(quals.buffers()[1], dtype=np.int64)[quals.offset : quals.offset + len(quals) + 1]
        data = np.frombuffer(quals.buffers()[2] or b"", dtype=np.uint8)
        size = np.diff(ends)
        width = np.minimum(size, window)
        total, worst = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
        lo = 0
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PROFILE_BYTES, side="right")) - 1)
            full = lo + np.flatnonzero(size[lo:hi])  # reduceat takes no empty parts
            if len(full):
                first = ends[full] - ends[lo]
                sums = np.concatenate([[0], np.cumsum(data[ends[lo] : ends[hi]].astype(np.int64) - PHRED_OFFSET)])
                total[full] = sums[first + size[full]] - sums[first]
                at, own = np.arange(len(sums) - 1), np.repeat(width[full], size[full])
                whole = at + own <= np.repeat(first + size[full], size[full])  # the last starts of a read have no whole window
                around = np.where(whole, sums[np.minimum(at + own, len(sums) - 1)] - sums[:-1], np.iinfo(np.int64).max)
                worst[full] = np.minimum.reduceat(around, first)
            lo = hi
        return pa.StructArray.from_arrays([pa.array(total), pa.array(worst), pa.array(width.astype(np.int32))], names=["total", "worst", "width"])

    return profile(F.col(qual).cast("string"))


def hamming(a: Column, b: Column) -> Column:
    """Number of places in which two texts of one length differ."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)


def draw(*parts: Column | str | int) -> Column:
    """A number of 32 bits drawn from the parts' text by md5; the same in any engine."""
    text = F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
