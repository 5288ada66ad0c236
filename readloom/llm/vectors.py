"""Embedding near-dedup by a subspace pigeonhole join: rotated blocks, range joins, exact verification, counts by tiles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import connected_components, stage_table

#: Dimensions of a block, and how many of them the grid cuts into cells.
BLOCK, GRID = 8, 3
#: Signs of random projections that make a bucket of the first links, and how many sets of them are tried.
SIGNS, SETS = 20, 16
#: Classes of a component that are compared at once when links are counted.
TILE = 256
#: Cosines so near to the threshold are computed by one formula wherever they are compared with it.
EDGE = 1e-9
#: Room for rounding in the block budgets; verification is exact.
SLACK = 1e-5


def usable(embedding: str = "embedding") -> Column:
    """True where a vector has components, all of them finite, and not all of them zero."""
    c = F.col(embedding)
    return F.coalesce(
        (F.size(c) > 0) & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(c, lambda x: x != 0),
        F.lit(False),
    )


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column of equal lengths, as unit vectors in double precision."""
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_dim(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """The batch's rows by the length of their vector: length, row numbers, rows."""
    lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield int(dim), at, batch.take(pa.array(at))


def rotations(classes: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each vector length the principal axes and the variance along each, most first.

    Tasks add up outer products of their unit vectors; the driver gets one ``dim x dim`` sum per vector length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for dim, _, rows in by_dim(b, "v"):
                x = matrix(rows.column("v"), dim)
                sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([s.ravel().tolist()], pa.list_(pa.float64()))], names=["dim", "s"])

    parts = classes.select("v").mapInArrow(run, "dim int, s array<double>").select("dim", F.posexplode("s").alias("i", "x"))
    sums = parts.groupBy("dim", "i").agg(F.sum("x").alias("x")).groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s"))
    out = {}
    for r in sums.collect():
        value, axes = np.linalg.eigh(np.array([y.x for y in r.s]).reshape(r.dim, r.dim))
        out[r.dim] = (axes[:, ::-1], np.maximum(value[::-1], 0))
    return out


def blocks_of(dim: int, variance: np.ndarray, budget: float) -> list[tuple[list[int], float]]:
    """Axes of each block and its share of the squared-distance budget, in proportion to the block's variance.

    Axes are dealt in turn, so that each block's first ones, which the grid cuts, vary most.
    """
    n = -(-dim // BLOCK)
    dealt = [list(range(b, dim, n)) for b in range(n)]
    share = np.array([variance[d].sum() for d in dealt])
    share = (share + 1e-3 * share.sum() / n + 1e-12) / (share + 1e-3 * share.sum() / n + 1e-12).sum()
    return [(d, float(budget * s) + SLACK) for d, s in zip(dealt, share, strict=True)]


def block_rows(classes: DataFrame, rotated: dict[int, tuple[np.ndarray, np.ndarray]], budget: float) -> DataFrame:
    """Rows (cid, label, dim, block, room, cell, q): a vector's part in each block, and the grid cell that it lies in."""
    plans = {dim: (axes, blocks_of(dim, variance, budget)) for dim, (axes, variance) in rotated.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, _, rows in by_dim(b, "v"):
                axes, blocks = plans[dim]
                y = matrix(rows.column("v"), dim) @ axes
                n = len(y)
                for k, (at, room) in enumerate(blocks):
                    q = np.zeros((n, BLOCK))
                    q[:, : len(at)] = y[:, at]
                    cell = np.floor(q[:, :GRID] / (np.sqrt(room) * (1 + 1e-6))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("cid"), rows.column("label"), pa.array(np.full(n, dim, dtype=np.int32)), pa.array(np.full(n, k, dtype=np.int32)), pa.array(np.full(n, room)),
                            pa.array(cell.tolist(), pa.list_(pa.int32())), pa.array(q.astype(np.float32).tolist(), pa.list_(pa.float32())),
                        ],
                        names=["cid", "label", "dim", "block", "room", "cell", "q"],
                    )

    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("cid", "label", "v").mapInArrow(run, f"cid long, label {kind}, dim int, block int, room double, cell array<int>, q array<float>")


def first_links(classes: DataFrame) -> DataFrame:
    """Rows (a, b): every class with the first one that has the same signs of random projections, in each of some sets of them.

    One row per class and set at most, however dense a group is. Nothing is decided here but what is compared first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            for dim, _, rows in by_dim(b, "v"):
                if dim not in planes:
                    planes[dim] = np.random.default_rng(dim).normal(size=(dim, SETS * SIGNS))
                signs = (matrix(rows.column("v"), dim) @ planes[dim] > 0).reshape(-1, SETS, SIGNS)
                key = signs @ (1 << np.arange(SIGNS, dtype=np.int64)) + (np.arange(SETS, dtype=np.int64) << SIGNS)
                n = len(key)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c).take(pa.array(np.repeat(np.arange(n), SETS))) for c in ("cid", "label")), pa.array(np.full(n * SETS, dim, dtype=np.int32)), pa.array(key.ravel())],
                    names=["cid", "label", "dim", "key"],
                )

    kind = classes.schema["label"].dataType.simpleString()
    rows = classes.select("cid", "label", "v").mapInArrow(run, f"cid long, label {kind}, dim int, key long")
    heads = rows.groupBy("label", "dim", "key").agg(F.min("cid").alias("b"), F.count("*").alias("n")).where("n > 1")
    return rows.join(heads, ["label", "dim", "key"]).where("cid <> b").select(F.col("cid").alias("a"), "b").distinct()


def candidates(classes: DataFrame, budget: float) -> DataFrame:
    """Rows (a, b), a < b: pairs of equal label but unequal ``part`` that are near in one block at least.

    If two vectors are within the budget, some block is within its share of it: the shares add up to the budget. In
    each block a range join finds those pairs: a vector goes to its own grid cell and to the half of the neighbouring
    cells that looks one way, cells being as wide as the block's radius, and the block's squared distance is checked in
    the join. Spark splits a cell that is frequent.
    """
    rows = block_rows(classes, rotations(classes), budget).join(classes.select("cid", "part"), "cid")
    rows = stage_table(rows, "blocks")
    half = [o for o in product((-1, 0, 1), repeat=GRID) if o >= (0,) * GRID]
    offsets = F.array(*[F.array(*[F.lit(x) for x in o]) for o in half])
    sent = rows.withColumn("o", F.explode(offsets))
    cell = lambda moved: F.xxhash64("label", "dim", "block", *[F.col("cell")[i] + (F.col("o")[i] if moved else 0) for i in range(GRID)])
    left = sent.select(cell(True).alias("key"), F.col("cid").alias("x"), F.col("part").alias("part_x"), F.col("q").alias("p"), "room", F.forall("o", lambda i: i == 0).alias("same"))
    right = rows.select(cell(False).alias("key_r"), F.col("cid").alias("y"), F.col("part").alias("part_y"), F.col("q").alias("r"))
    apart = sum((F.col("p")[i].cast("double") - F.col("r")[i].cast("double")) * (F.col("p")[i].cast("double") - F.col("r")[i].cast("double")) for i in range(BLOCK))
    near = (~F.col("same") | (F.col("x") < F.col("y"))) & (F.col("part_x") != F.col("part_y")) & (apart <= F.col("room"))
    pairs = left.hint("merge").join(right, (F.col("key") == F.col("key_r")) & near)  # never a broadcast: left is many times its estimate
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def scaled(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        return x / np.abs(x).max(axis=1, keepdims=True)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cosine of each row of ``x`` with the same row of ``y``: the one formula that decides a link."""
    return np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


def verified(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The pairs of equal label whose cosine in double precision is ``cosine`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, _, rows in by_dim(b, "va"):
                x, y = (scaled(np.asarray(rows.column(c).flatten(), dtype=np.float64).reshape(-1, dim)) for c in ("va", "vb"))
                keep = rows.filter(pa.array(cosines(x, y) >= cosine))
                yield pa.RecordBatch.from_arrays([keep.column("a"), keep.column("b")], names=["a", "b"])

    side = lambda k: classes.select(F.col("cid").alias(k), F.col("v").alias(f"v{k}"), F.col("label").alias(f"l{k}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").where((F.col("la") == F.col("lb")) & (F.size("va") == F.size("vb")))
    return rows.select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def link_counts(classes: DataFrame, cosine: float) -> DataFrame:
    """Rows (cid, others): of every class the rows of other classes that link to it, without a row per pair.

    All links of a vector lie in its component ``part``. A component's classes are dealt to tiles of some ``TILE`` each;
    every two tiles meet in one group, which multiplies their vectors and gives one number per vector.
    """

    def count(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        u, v = (z / np.sqrt(np.einsum("ij,ij->i", z, z))[:, None] for z in (x, y))
        found = u @ v.T
        linked = found >= cosine
        # A product of matrices rounds otherwise; at the threshold the formula of ``verified`` decides, in either order.
        a, b = np.nonzero(np.abs(found - cosine) < EDGE)
        linked[a, b] = cosines(x[a], y[b]) >= cosine
        return linked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(rows: pa.RecordBatch, key: np.ndarray, ends: list[int]) -> pa.RecordBatch:
            cid, size, tile = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "size", "tile"))
            at = rows.column("v").offsets.to_numpy()
            flat = np.asarray(rows.column("v").values, dtype=np.float64)
            out = np.zeros(ends[-1] if ends else 0, dtype=np.int64)
            lo = 0
            for hi in ends:
                x = scaled(flat[at[lo] : at[hi]].reshape(hi - lo, -1))
                a = np.flatnonzero(tile[lo:hi] == key[lo, 1])
                b = np.flatnonzero(tile[lo:hi] == key[lo, 2])
                linked = count(x[a], x[b])
                if key[lo, 1] == key[lo, 2]:
                    np.fill_diagonal(linked, False)
                    out[lo + a] = linked @ size[lo:hi][b]
                else:
                    out[lo + a], out[lo + b] = linked @ size[lo:hi][b], linked.T @ size[lo:hi][a]
                lo = hi
            return pa.RecordBatch.from_arrays([pa.array(cid[:lo]), pa.array(out)], names=["cid", "others"])

        def take(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            rows = table.to_batches()[0] if table.num_rows else None
            held.clear()
            if rows is not None:
                key = np.stack([rows.column(c).to_numpy(zero_copy_only=False) for c in ("part", "lo", "hi")], axis=1)
                ends = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist() + [len(key)] * last
                if ends:
                    yield groups(rows, key, ends)
                if not last:  # the last group may go on in the next batch
                    held.append(rows.slice(ends[-1] if ends else 0))

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= TILE:
                yield from take(False)
        if held:
            yield from take(True)

    tiles = classes.groupBy("part").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = classes.join(tiles, "part").select("part", "cid", "size", "v", "tiles", F.pmod(F.xxhash64("cid"), F.col("tiles")).cast("int").alias("tile"))
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = met.select("part", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "cid", "size", "tile", "v")
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(parts, "part", "lo", "hi").sortWithinPartitions("part", "lo", "hi")
    found = met.mapInArrow(run, "cid long, others long")
    return found.groupBy("cid").agg(F.sum("others").alias("others"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row: links to vectors of equal label at ``cosine`` or more.

    Equal vectors of a label are one class, which links its own rows; links between classes count once per row of the
    other class. ``component_id`` is the smallest vec_id that links reach; ``kept`` is true for rows that bear it. Rows
    that repeat a vec_id with other vectors are rows like any others. Vectors that are null, empty, zero or hold a null
    or non-finite component, and rows with a null label or vec_id, link with nothing; a row without vec_id has no
    component_id and is kept. Vectors of different lengths never link. Extra columns are not read. An empty table gives an
    empty result.

    First some links of every class make most components; then the pigeonhole join finds all pairs between components.
    At last each component's links are counted. No step makes a row per pair inside a dense group.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), "label",
        (usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).alias("ok"),
    ).withColumns({"h1": F.when(F.col("ok"), F.xxhash64("label", "v")), "h2": F.when(F.col("ok"), F.xxhash64(F.lit(1), "label", "v"))})
    classes = rows.where("ok").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("first"), F.count("*").alias("size"), F.first("v").alias("v"))
    classes = stage_table(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    star = stage_table(connected_components(verified(first_links(classes), classes, cosine), "a", "b"), "vector-parts")
    parted = lambda star: classes.join(star.withColumnRenamed("node", "cid"), "cid", "left").withColumn("part", F.coalesce("component", "cid")).drop("component")
    pairs = verified(candidates(parted(star), 2 - 2 * cosine + SLACK), classes, cosine)
    # The links between components, and those from the first components' classes to their names.
    star = stage_table(connected_components(stage_table(pairs, "vector-links").unionByName(star.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b"), "vector-components")
    named = parted(star)
    least = named.groupBy("part").agg(F.min("first").alias("component_id"))
    named = named.join(link_counts(named, cosine), "cid", "left").join(least, "part")
    named = named.select("h1", "h2", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
