"""Neighbour joining on the query's own distances, against the textbook's form of it."""

import os

import pytest

from readloom.operators import trees as tr
from readloom.plans import queries as q


def plain_clades(names, distance):
    """Clusters as sets in a dictionary of distances; ties by the cluster that comes first, as names are sorted."""
    nodes = [frozenset([x]) for x in names]
    d = {(a, b): float(distance.get((min(*a, *b), max(*a, *b)), 0)) for a in nodes for b in nodes if a != b}
    out = set()
    while len(nodes) > 1:
        if len(nodes) == 2:
            best = (nodes[0], nodes[1])
        else:
            total = {a: sum(d[a, b] for b in nodes if b != a) for a in nodes}
            cost = lambda a, b: round((len(nodes) - 2) * d[a, b] - total[a] - total[b], 9)
            best = min(((a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :]), key=lambda p: (cost(*p), nodes.index(p[0]), nodes.index(p[1])))
        a, b = best
        new = a | b
        for c in nodes:
            if c not in (a, b):
                d[new, c] = d[c, new] = (d[a, c] + d[b, c] - d[a, b]) / 2
        nodes = [new if c == a else c for c in nodes if c != b]
        side = new if names[0] not in new else frozenset(names) - new
        if 2 <= len(side) <= len(names) - 2:
            out.add(tuple(sorted(side)))
    return out


def test_clades_and_support_of_the_query(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    genomes = q.fx.genomes(spark, sf)
    boot = q.boot(spark, sf).where("rep <= 12").cache()
    names = [str(x) for x in sorted(r["sample"] for r in genomes.select("sample").collect())]
    names.sort(key=int)
    distances = {}
    for r in boot.collect():
        distances.setdefault(r.rep, {})[min(str(r.a), str(r.b)), max(str(r.a), str(r.b))] = r.n_diff
    order = [r[0] for r in genomes.selectExpr("cast(sample as string) as sample").distinct().orderBy("sample").collect()]
    want = {(rep, c) for rep, d in distances.items() for c in plain_clades(order, d)}
    clades = tr.nj_clades(boot, genomes).cache()
    assert {(r.rep, tuple(r.clade)) for r in clades.collect()} == want and len(want) > 50
    support = {tuple(r.clade): (r.n_reps, r.support) for r in tr.clade_support(clades, 12).collect()}
    main = {c for rep, c in want if rep == 0}
    assert support == {c: (n := sum((rep, c) in want for rep in range(1, 13)), round(n / 12, 6)) for c in main}
