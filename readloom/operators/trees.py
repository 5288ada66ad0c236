"""Neighbour-joining trees per bootstrap replicate, clades, and their support. These are not maximum-likelihood trees."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A replicate's matrix is one task's; more samples are refused.
MOST_SAMPLES = 3000


def joined(names: list[str], d: np.ndarray) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """The pairs of clusters, as sample numbers, in the order in which neighbour joining joins them; ties by the first names."""
    d = d.astype(float).copy()
    clusters = [(i,) for i in range(len(names))]
    out = []
    while len(clusters) > 2:
        n = len(clusters)
        r = d.sum(axis=1)
        q = np.round((n - 2) * d - r[:, None] - r[None, :], 9)
        np.fill_diagonal(q, np.inf)
        i, j = divmod(int(q.argmin()), n)
        i, j = min(i, j), max(i, j)
        new = (d[i] + d[j] - d[i, j]) / 2
        out.append((clusters[i], clusters[j]))
        keep = [k for k in range(n) if k != j]
        d[i], d[:, i] = new, new
        d[i, i] = 0
        d = d[np.ix_(keep, keep)]
        clusters[i] = tuple(sorted(clusters[i] + clusters[j]))
        clusters = [clusters[k] for k in keep]
    if len(clusters) == 2:
        out.append((clusters[0], clusters[1]))
    return out


def nj_clades(distances: DataFrame, samples: DataFrame) -> DataFrame:
    """Rows (rep, clade): for each replicate the tree's splits, each as the side without the first sample, of two samples or more.

    ``distances`` has rows (rep, a, b, n_diff); pairs that are missing have distance 0.
    """
    names = [r[0] for r in samples.select(F.col("sample").cast("string")).distinct().orderBy("sample").limit(MOST_SAMPLES + 1).collect()]
    if len(names) > MOST_SAMPLES:
        raise ValueError(f"more than {MOST_SAMPLES} samples")
    at = {x: i for i, x in enumerate(names)}

    def tree(rows: pd.DataFrame) -> pd.DataFrame:
        d = np.zeros((len(names), len(names)))
        for a, b, n in zip(rows.a, rows.b, rows.n_diff, strict=True):
            d[at[a], at[b]] = d[at[b], at[a]] = n
        clades = set()
        for x, y in joined(names, d):
            own = set(x) | set(y)
            side = own if 0 not in own else set(range(len(names))) - own
            if 2 <= len(side) <= len(names) - 2:
                clades.add(tuple(sorted(names[i] for i in side)))
        return pd.DataFrame({"rep": [rows.rep.iloc[0]] * len(clades), "clade": [list(c) for c in sorted(clades)]})

    rows = distances.select("rep", F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), F.col("n_diff").cast("double").alias("n_diff"))
    return rows.groupBy("rep").applyInPandas(tree, "rep int, clade array<string>")


def clade_support(clades: DataFrame, reps: int) -> DataFrame:
    """Rows (clade, n_reps, support): the share of replicates 1 to ``reps`` that have each clade of replicate 0."""
    main = clades.where("rep = 0").select("clade")
    hits = clades.where("rep > 0").join(main, "clade", "left_semi").groupBy("clade").agg(F.count("*").alias("n"))
    rows = main.join(hits, "clade", "left").withColumn("n_reps", F.coalesce("n", F.lit(0)))
    return rows.select("clade", "n_reps", F.round(F.col("n_reps") / reps, 6).alias("support"))


def newick(support: DataFrame, samples: DataFrame) -> str:
    """The main tree as Newick text, nested by its clades, with support as labels; one clade per sample at most."""
    names = [r[0] for r in samples.select(F.col("sample").cast("string")).distinct().orderBy("sample").limit(MOST_SAMPLES + 1).collect()]
    clades = sorted(((frozenset(r.clade), r.support) for r in support.limit(MOST_SAMPLES).collect()), key=lambda x: (len(x[0]), sorted(x[0])))
    parts: dict[frozenset, str] = {frozenset([x]): x for x in names}
    for own, share in [*clades, (frozenset(names), None)]:
        inside = sorted((k for k in parts if k <= own), key=lambda k: sorted(k)[0])
        text = "(" + ",".join(parts.pop(k) for k in inside) + ")"
        parts[own] = text if share is None else f"{text}{share:g}"
    return "".join(parts.values()) + ";"
