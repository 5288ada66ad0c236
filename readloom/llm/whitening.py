"""Embedding whitening: equal vectors are one row with a count, whose weighted covariance gives the axes of all."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import finite, join_back, stage_table

#: Fixed values of the contract: steps of a unit, and what is added to their number.
SCALE, SHIFT = 64, 1_000_000
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
#: An eigenvalue below this share of the trace cannot be told from zero.
FLAT = 1e-12


def rows_of(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def summed(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], kind: str) -> np.ndarray:
    """The sum of a matrix per batch: tasks add up their own, Spark adds the tasks' cells, the driver gets one matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                total = part(b) if total is None else total + part(b)
        if total is not None:
            values = pa.list_(pa.int64() if kind == "long" else pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total.tolist(), values)], names=["i", "v"])

    cells = rows.mapInArrow(run, f"i int, v array<{kind}>").select("i", F.posexplode("v").alias("j", "v"))
    cells = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((1 + max(c.i for c in cells), 1 + max(c.j for c in cells)), dtype=np.int64 if kind == "long" else np.float64)
    for c in cells:
        out[c.i, c.j] = c.v
    return out


def exact(values: np.ndarray, most: float) -> np.ndarray:
    """``values``, or OverflowError where numbers up to ``most`` do not fit 64 bits."""
    if most >= 2.0**62:
        raise OverflowError("the sums of these vectors do not fit 64 bits")
    return values


def largest(x: np.ndarray) -> float:
    return float(np.abs(x.astype(np.float64)).max(initial=0))


def distinct(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, h1, h2) and their groups (h1, h2, x, size): equal vectors once, as a stage table."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    rows = vectors.where(finite("embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    keys = [F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2")]
    groups = rows.groupBy("x").agg(F.count("*").alias("size")).select(*keys, "x", "size")
    return rows.select("vec_id", *keys), stage_table(groups, "whitening-groups")


def whiten(vectors: DataFrame, most: int = 32, weight: str = "count") -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), ``most`` components a vector at most.

    Each component c of a vector becomes x = floor(64 c) + 1000000. Equal x-vectors are one row of the fit, weighted by
    their ``count`` or by ``one``; n is the sum of weights. Means come from exact sums, the covariance from centred
    vectors, tasks multiplying their own; the driver gets one matrix of dim x dim. Each distinct vector is whitened once
    and joined back to its rows.

    Vectors that are null or hold null or non-finite components go. Rows that repeat a vec_id are rows like any others, a
    null vec_id too. The length that most rows have is fitted (ties: the shorter); vectors of other lengths, empty ones
    too, have no component and so no row. A component whose eigenvalue is zero, as with a single distinct vector, has
    whitened 0 and explained 0 and is left out of identity_error. Numbers that do not fit 64 bits raise OverflowError.
    Extra columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows, groups = distinct(vectors)
    lengths = groups.groupBy(F.size("x").alias("dim")).agg(F.sum("size").alias("rows"), F.count("*").alias("groups")).where("dim > 0")
    fitted = lengths.orderBy(F.desc("rows"), "dim").first()
    if fitted is None:
        return spark.createDataFrame([], SCHEMA)
    groups = groups.where(F.size("x") == fitted.dim)
    n = fitted.rows if weight == "count" else fitted.groups

    def weights(b: pa.RecordBatch) -> np.ndarray:
        w = b.column("size").to_numpy()
        return w if weight == "count" else np.ones_like(w)

    def sums(b: pa.RecordBatch) -> np.ndarray:
        x, w = rows_of(b, "x") - SHIFT, weights(b)
        return exact((x * w[:, None]).sum(axis=0, keepdims=True), largest(x) * float(w.sum()))

    total = summed(groups.select("x", "size"), sums, "long")[0]

    def deviations(b: pa.RecordBatch) -> np.ndarray:
        """n x - S: the shift cancels out."""
        x = rows_of(b, "x") - SHIFT
        return exact(n * x - total, n * largest(x) + largest(total))

    def products(b: pa.RecordBatch) -> np.ndarray:
        d = deviations(b) / n
        return (d * weights(b)[:, None]).T @ d

    covariance = summed(groups.select("x", "size"), products, "double") / n
    value, axes = np.linalg.eigh(covariance)
    value, axes = np.maximum(value[::-1][:most], 0), axes[:, ::-1][:, :most]
    trace = float(np.trace(covariance))
    real = value > FLAT * trace
    value = np.where(real, value, 0)
    scaled = axes / np.where(real, np.sqrt(np.where(real, value, 1)), np.inf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = deviations(b)
            square = exact((d * d).sum(axis=1), largest(d) ** 2 * d.shape[1]) if len(d) else np.zeros(0, dtype=np.int64)
            w = (d / n) @ scaled
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("h1", "h2", "size")), pa.array(square), pa.array(w.tolist(), pa.list_(pa.float64()))], names=["h1", "h2", "size", "deviation", "w"])

    white = stage_table(groups.select("h1", "h2", "size", "x").mapInArrow(run, "h1 long, h2 long, size long, deviation long, w array<double>"), "whitened")
    mean = summed(white.select("w", "size"), lambda b: (rows_of(b, "w") * weights(b)[:, None]).sum(axis=0, keepdims=True), "double")[0] / n

    def spread(b: pa.RecordBatch) -> np.ndarray:
        d = rows_of(b, "w") - mean
        return (d * weights(b)[:, None]).T @ d

    error = np.abs(summed(white.select("w", "size"), spread, "double") / n - np.eye(len(value)))[np.ix_(real, real)].max(initial=0)
    back = join_back(rows, white, ["h1", "h2"], "size", fitted.rows)
    share = F.array(*[F.lit(float(v / trace) if trace > 0 else 0.0) for v in value])
    back = back.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    return back.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(int(n)).cast("long").alias("n"), "deviation", "whitened", share[F.col("i")].alias("explained"), F.lit(float(error)).alias("identity_error")
    )
