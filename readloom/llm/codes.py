"""Vector code compression: product codes from codebooks refined in rounds, nearest entries by Orchard's search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import finite, join_back, stage_table

#: Fixed value of the contract: steps of a unit.
SCALE = 1024
#: Neighbours of the current entry that are compared at once, and vectors that are searched at once.
STEP, BLOCK = 32, 32_768
SCHEMA = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


@dataclass(frozen=True)
class Settings:
    parts: int = 4
    entries: int = 256
    rounds: int = 4


class Book:
    """A part's codebook with, for every entry, all entries sorted by their distance from it (ties: lower index)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.float64)  # whole numbers; see ``bounded``
        apart = ((self.entries[:, None, :] - self.entries[None, :, :]) ** 2).sum(axis=2)
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, axis=1)
        self.squares = (self.entries**2).sum(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row's nearest entry, the lower index on ties.

        Orchard's search, for all rows side by side: a row goes down the list of its current entry. A nearer entry becomes
        the current one, and its list is begun; entries met before are marked and not compared again. By the triangle
        inequality no entry beyond twice the row's distance from its current entry can be nearer, so there a row stops.
        Rows at one place of one list are compared by one product of matrices. Whole numbers in doubles keep it exact.
        """
        k, n = len(self.entries), len(x)
        squares = (x**2).sum(axis=1)
        current, at = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        # Distance and index in one number: the least is the nearest entry with the lowest index.
        best = (squares + self.squares[0] - 2 * (x @ self.entries[0])) * k
        seen = np.zeros((n, k), dtype=bool)
        seen[:, 0] = True
        active = np.arange(n)
        while len(active):
            place = current[active] * k + at[active]
            order = np.argsort(place, kind="stable")
            active, place = active[order], place[order]
            ends = np.flatnonzero(np.append(place[1:] != place[:-1], True)) + 1
            going, lo = np.ones(len(active), dtype=bool), 0
            for hi in ends:
                rows = active[lo:hi]
                c, p = divmod(int(place[lo]), k)
                ids, apart = self.lists[c, p : p + STEP], self.apart[c, p : p + STEP]
                found = (squares[rows, None] + self.squares[ids] - 2 * (x[rows] @ self.entries[ids].T)) * k + ids
                marks = seen[rows[:, None], ids]
                found[marks] = np.inf
                seen[rows[:, None], ids] = True
                least = found.argmin(axis=1)
                value = found[np.arange(len(rows)), least]
                nearer = value < best[rows]
                moved = rows[nearer]
                best[moved], current[moved] = value[nearer], ids[least[nearer]]
                at[rows] = np.where(nearer, 0, p + len(ids))
                # A row that found nothing nearer stops at the list's end, or where the list is beyond twice its distance.
                going[lo:hi] = nearer | ((p + len(ids) < k) & (apart[-1] <= 4 * np.floor(best[rows] / k)))
                lo = hi
            active = active[going]
        return current, np.floor(best / k).astype(np.int64)


def bounded(x: np.ndarray, entries: int) -> np.ndarray:
    """``x`` as doubles, or OverflowError where distances, with an index behind them, are not whole doubles."""
    x = x.astype(np.float64)
    if x.size and 4 * np.abs(x).max() ** 2 * x.shape[1] * entries >= 2.0**53:
        raise OverflowError("the components of these vectors are too large for exact codes")
    return x


def cuts(dim: int, parts: int) -> list[int]:
    """Ends of consecutive parts, equal where ``parts`` divides the length; else the first ones are longer by one."""
    return np.cumsum([dim // parts + (i < dim % parts) for i in range(parts)]).tolist()


def blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The tasks' rows in tables of some ``BLOCK`` rows, with their vectors as a matrix."""
    held: list[pa.RecordBatch] = []

    def table() -> tuple[pa.Table, np.ndarray]:
        t = pa.Table.from_batches(held)
        held.clear()
        return t, t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, dim)

    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.num_rows for x in held) >= BLOCK:
            yield table()
    if held:
        yield table()


def refined(rows: DataFrame, books: list[np.ndarray], dim: int, s: Settings) -> list[np.ndarray]:
    """The codebooks after one round: every entry the floor of the mean of the parts nearest to it; unused entries stay.

    Each task adds up its own parts per entry; the sums, of which there are no more than the codebooks have numbers,
    are added by Spark.
    """
    ends = cuts(dim, s.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Book(b) for b in books]
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        sums = [np.zeros(b.shape, dtype=np.int64) for b in books]
        for _, x in blocks(batches, dim):
            x = bounded(x, s.entries)
            for p, part in enumerate(np.split(x, ends[:-1], axis=1)):
                code, _ = own[p].nearest(part)
                counts[p] += np.bincount(code, minlength=len(books[p]))
                for i in range(part.shape[1]):
                    sums[p][:, i] += np.bincount(code, weights=part[:, i], minlength=len(books[p])).astype(np.int64)
        for p in range(s.parts):
            used = np.flatnonzero(counts[p])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, dtype=np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[p][used]), pa.array(sums[p][used].tolist(), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "sums"],
            )

    found = rows.select("x").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    found = found.select("part", "entry", "n", F.posexplode("sums").alias("i", "v")).groupBy("part", "entry", "i").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    out = [b.copy() for b in books]
    for r in found.collect():
        out[r.part][r.entry, r.i] = r.v // r.n
    return out


def encode(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows (vec_id, code, error, label_error, codebooks_sha256), one per vector that is kept.

    Components become floor(1024 c), vectors are cut into equal consecutive parts, each with a codebook that starts as the
    parts of the smallest kept vec_ids and is refined in rounds over all rows. ``code`` has two hex digits per part,
    ``error`` the squared distances; ``label_error`` is the sum of errors of all rows with the row's label.

    Vectors that are null or hold null or non-finite components go. Rows that repeat a vec_id are rows like any others; the
    codebooks begin with rows in order of vec_id, then of their components. A null vec_id comes last, null labels are one
    label. The vectors' length is that of the first row that has any component; rows of other lengths, empty ones too,
    stay with a null code and error, and add nothing to their label's error, which is null if all are such. A length
    that the number of parts does not divide gives longer first parts. Components too large for exact
    arithmetic raise OverflowError. Extra columns are not read. An empty table gives an empty result.
    """
    s, spark = settings, vectors.sparkSession
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    rows = stage_table(vectors.where(finite("embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), "label", x.alias("x")), "code-vectors")
    ordered = rows.where(F.size("x") > 0).orderBy(F.asc_nulls_last("vec_id"), "x")
    first = ordered.select(F.size("x").alias("dim")).first()
    if first is None:
        dim, books = 0, []
    else:
        dim = first.dim
        # As many rows as a codebook has entries.
        start = np.array([r.x for r in ordered.where(F.size("x") == dim).select("x").limit(s.entries).collect()], dtype=np.int64)
        books = np.split(start, cuts(dim, s.parts)[:-1], axis=1)
    fitting = rows.where(F.size("x") == dim)
    for _ in range(s.rounds if dim else 0):
        books = refined(fitting, books, dim, s)
    digest = sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    ends = cuts(dim, s.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Book(b) for b in books]
        for t, x in blocks(batches, dim):
            x = bounded(x, s.entries)
            code, error = np.zeros((len(x), s.parts), dtype=np.uint8), np.zeros(len(x), dtype=np.int64)
            for p, part in enumerate(np.split(x, ends[:-1], axis=1)):
                code[:, p], apart = own[p].nearest(part)
                error += apart
            text = code.tobytes().hex()
            text = [text[i : i + 2 * s.parts] for i in range(0, len(text), 2 * s.parts)]
            yield from pa.Table.from_arrays([t.column("vec_id"), t.column("label"), pa.array(text, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"]).to_batches()

    kind = rows.schema["label"].dataType.simpleString()
    coded = rows.where(F.size("x") != dim).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if dim:
        coded = coded.unionByName(fitting.mapInArrow(run, f"vec_id long, label {kind}, code string, error long"))
    coded = stage_table(coded, "codes")
    labels = stage_table(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")), "code-labels")
    total = labels.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    back = join_back(coded, labels, ["label"], "rows", total)
    return back.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(settings: Settings = Settings(), dim: int = 64) -> str:
    """DuckDB SQL for ``encode`` over ``embeddings`` of one length: every round compares all parts with all entries."""
    s, size = settings, dim // settings.parts
    apart = "list_sum(list_transform(range(1, len(r.x) + 1), lambda i: (r.x[i] - b.x[i]) * (r.x[i] - b.x[i])))::BIGINT"

    def nearest(books: str) -> str:
        return f"SELECT r.id, r.p, arg_min(b.e, {{'d': {apart}, 'e': b.e}}) AS e, min({apart}) AS d FROM part_rows r JOIN {books} b USING (p) GROUP BY r.id, r.p"

    steps = []
    for i in range(s.rounds):
        steps.append(f"near{i} AS MATERIALIZED ({nearest(f'book{i}')})")
        steps.append(f"""mean{i} AS MATERIALIZED (SELECT p, e, list(v ORDER BY i) AS x FROM (
            SELECT n.p, n.e, i, floor(sum(r.x[i])::DOUBLE / count(*))::BIGINT AS v FROM near{i} n JOIN part_rows r USING (id, p), range(1, {size + 1}) t(i) GROUP BY n.p, n.e, i) GROUP BY p, e)""")
        steps.append(f"book{i + 1} AS MATERIALIZED (SELECT b.p, b.e, COALESCE(m.x, b.x) AS x FROM book{i} b LEFT JOIN mean{i} m USING (p, e))")
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda c: floor(c::DOUBLE * {SCALE})::BIGINT) AS x,
        row_number() OVER (ORDER BY vec_id NULLS LAST, list_transform(embedding, lambda c: floor(c::DOUBLE * {SCALE})::BIGINT)) AS id
        FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))),
      part_rows AS MATERIALIZED (SELECT id, p, x[p * {size} + 1 : p * {size} + {size}] AS x FROM kept, range({s.parts}) t(p)),
      book0 AS MATERIALIZED (SELECT p, (id - 1)::INT AS e, x FROM part_rows WHERE id <= {s.entries}), {", ".join(steps)},
      final AS MATERIALIZED ({nearest(f'book{s.rounds}')}),
      coded AS (SELECT id, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM final GROUP BY id),
      digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{s.rounds})
      SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (id), digest"""


ORACLE = oracle()
