from collections import defaultdict

import pytest

from readloom.llm import mixing
from tests.llm.fixtures import no_documents, odd_documents


def docs(spark, sizes):
    rows = [(i, " ".join(["w"] * n) if n is not None else None, s) for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def water(sizes, weights, most=3):
    """Targets by handing out the excess again and again."""
    total, target, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    rest = float(total)
    while free:
        w = sum(weights[i] for i in free)
        over = {i for i in free if rest * weights[i] / w > most * sizes[i] + 1e-9}
        if not over:
            for i in free:
                target[i] = rest * weights[i] / w
            break
        for i in over:
            target[i] = float(most * sizes[i])
            rest -= target[i]
        free -= over
    return target


def test_targets_and_exact_cuts(spark):
    sizes = [("a", 3)] * 5 + [("b", 7)] * 40 + [("c", 1)] * 9 + [("d", 90)] * 30 + [(None, 4)] * 11 + [("a", None), ("b", 0)]
    rows = mixing.mix(docs(spark, sizes)).collect()
    assert len(rows) == len(sizes)
    own = defaultdict(int)
    for s, n in sizes:
        own[s] += n or 0
    names = ["a", "b", "c", "d", None]
    want = dict(zip(names, water([own[n] for n in names], [1, 2, 3, 1, 2]), strict=True))
    taken = defaultdict(int)
    for r in rows:
        assert r.target == pytest.approx(want[r.source])
        assert r.source_size == own[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for n in names:
        assert taken[n] == int(want[n] + 1e-9)


def test_partitions_and_buckets_change_nothing(spark):
    sizes = [(f"s{i % 4}", i % 23) for i in range(400)]
    d = docs(spark, sizes)
    want = sorted(mixing.mix(d).collect())
    assert sorted(mixing.mix(d.repartition(7), buckets=1).collect()) == want
    assert sorted(mixing.mix(d.coalesce(1), buckets=300).collect()) == want


def test_odd_rows_and_empty_tables(spark):
    rows = mixing.mix(odd_documents(spark)).collect()
    assert len(rows) == odd_documents(spark).count()
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mix(no_documents(spark)).count() == 0
    blank = mixing.mix(docs(spark, [("a", None), ("b", 0)])).collect()
    assert [(r.size, r.taken, r.target) for r in blank] == [(0, 0, 0.0)] * 2


def test_no_python_on_the_path(spark):
    plan = mixing.mix(docs(spark, [("a", 2)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
