"""Colinear chains of anchors between two sequences, by dynamic programming with gap costs, many pairs side by side."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most bases between neighbouring anchors of a chain, and most by which their distances on both sides may differ.
GAP, BAND = 5000, 500
#: Cost of a difference: so much, and one more for every so many bases.
OPEN, EXTEND = 2, 8
#: Cells of the table of anchors that are chained side by side.
CELLS = 1 << 18


def linked(t: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best score of a chain that ends at each anchor, and the anchor before it or -1; rows are pairs of sequences.

    Anchors are sorted by t, then q; rows are padded behind by anchors too far to link. An anchor is worth the new bases
    it covers, ``k`` at most; of equally good predecessors the nearest is taken, so that a chain passes over no
    anchor on its way, and none where none gains.
    """
    pairs, n = t.shape
    score, before = np.full((pairs, n), k, dtype=np.int64), np.full((pairs, n), -1, dtype=np.int64)
    row, lo = np.arange(pairs), 0
    for i in range(1, n):
        while (t[:, i] - t[:, lo] > GAP).all():
            lo += 1
            if lo == i:
                break
        if lo == i:
            continue
        dt, dq = t[:, i, None] - t[:, lo:i], q[:, i, None] - q[:, lo:i]
        apart = np.abs(dt - dq)
        value = score[:, lo:i] + np.minimum(np.minimum(dt, dq), k) - np.where(apart > 0, OPEN + apart // EXTEND, 0)
        value[(dt <= 0) | (dq <= 0) | (dt > GAP) | (dq > GAP) | (apart > BAND)] = -1
        best = i - lo - 1 - value[:, ::-1].argmax(axis=1)
        found = value[row, best]
        better = found > k
        score[better, i], before[better, i] = found[better], lo + best[better]
    return score, before


def labelled(score: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The first anchor of each anchor's chain: chains are taken from the best end on, each anchor once.

    So where chains part, the one that reaches the higher score keeps the common beginning, and the other begins anew.
    """
    pairs, n = score.shape
    reach, heir, best = score.copy(), np.full((pairs, n), -1, dtype=np.int64), np.full((pairs, n), -1, dtype=np.int64)
    for i in reversed(range(n)):
        rows = np.flatnonzero(before[:, i] >= 0)
        p = before[rows, i]
        reach[rows, p] = np.maximum(reach[rows, p], reach[rows, i])
        take = reach[rows, i] >= best[rows, p]  # the first of equals, as the last one that is met
        best[rows[take], p[take]], heir[rows[take], p[take]] = reach[rows[take], i], i
    chain = np.tile(np.arange(n), (pairs, 1))
    for i in range(n):
        rows = np.flatnonzero(before[:, i] >= 0)
        rows = rows[heir[rows, before[rows, i]] == i]
        chain[rows, i] = chain[rows, before[rows, i]]
    return chain


def chains_of(sizes: np.ndarray, all_t: np.ndarray, all_q: np.ndarray, k: int, least: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """The pair of each chain of ``least`` anchors or more, and its ``NAMES``; pairs have ``sizes`` anchors, one behind the other, each sorted by t, then q."""
    starts = np.cumsum(sizes) - sizes
    order, lo = np.argsort(sizes, kind="stable"), 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * int(sizes[order[hi]]) <= CELLS and sizes[order[hi]] <= 1.3 * sizes[order[lo]] + 4:
            hi += 1
        rows = order[lo:hi]
        n = int(sizes[rows].max())
        t, q = np.zeros((2, len(rows), n), dtype=np.int64)
        place = np.arange(n) < sizes[rows][:, None]
        t[:], q[:] = 1 << 40, -(1 << 40)
        at = (starts[rows][:, None] + np.arange(n))[place]
        t[place], q[place] = all_t[at], all_q[at]
        chain = labelled(*linked(t, q, k))
        pair = np.broadcast_to(np.arange(len(rows))[:, None], place.shape)[place]
        ids, own = np.unique(pair * n + chain[place], return_inverse=True)
        count = np.bincount(own, minlength=len(ids))
        ends = [np.full(len(ids), v, dtype=np.int64) for v in (1 << 60, -(1 << 60), 1 << 60, -(1 << 60))]
        for f, out, x in zip((np.minimum, np.maximum) * 2, ends, (q, q, t, t), strict=True):
            f.at(out, own, x[place])
        keep = np.flatnonzero(count >= least)
        yield rows[ids[keep] // n], [ends[0][keep], ends[1][keep] + k, ends[2][keep], ends[3][keep] + k, count[keep]]
        lo = hi


def chain_anchors(anchors: DataFrame, keys: list[str], k: int, least: int) -> DataFrame:
    """Rows (keys, qstart, qend, tstart, tend, n_anchors): all chains of ``least`` anchors or more.

    ``anchors`` has rows (keys, qpos, tpos). The anchors of one pair of sequences are one row, sorted; pairs with fewer
    than ``least`` never leave the JVM.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("anchors")
            values = lists.flatten()
            all_t, all_q = (values.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            for pair, found in chains_of(lists.value_lengths().to_numpy(), all_t, all_q, k, least):
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(pair)) for c in keys), *map(pa.array, found)], names=[*keys, *NAMES])

    together = anchors.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("tpos", "qpos"))).alias("anchors")).where(F.size("anchors") >= least)
    kinds = ", ".join(f"`{c}` {anchors.schema[c].dataType.simpleString()}" for c in keys)
    return together.mapInArrow(run, f"{kinds}, " + ", ".join(f"{c} long" for c in NAMES))


NAMES = ("qstart", "qend", "tstart", "tend", "n_anchors")
