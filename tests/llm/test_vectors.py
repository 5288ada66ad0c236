import math

import numpy as np

from readloom.llm import vectors
from tests.llm.fixtures import generator

KIND = "vec_id long, embedding array<float>, label int, rep long, v int"


def plain(rows, cosine=0.98):
    ok = {i: np.array(v, dtype=np.float32).astype(float) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    label = {i: lab for i, _, lab in rows}
    links = {i: [j for j in ok if j != i and label[i] == label[j] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= cosine] for i in ok}
    out = {}
    for i, *_ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links.get(i, [])), min(seen), i == min(seen))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, v, lab, 1, 2) for i, v, lab in rows], KIND)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect()}
    assert got == plain(rows)
    return got


def near(rng, x, cosine):
    """A vector at exactly about the given cosine from x."""
    x = x / np.linalg.norm(x)
    o = rng.normal(size=len(x))
    o -= o @ x * x
    return cosine * x + math.sqrt(1 - cosine**2) * o / np.linalg.norm(o)


def test_equals_brute_force(spark):
    rng = generator(3)
    rows = []
    for c in range(40):
        x = rng.normal(size=64)
        for k in range(6):
            y = near(rng, x, float(rng.choice([0.999, 0.985, 0.9805, 0.9795, 0.97, 1.0]))) * rng.uniform(0.1, 9)
            rows.append((len(rows) * 7 % 1009, [float(z) for z in np.float32(y)], c % 3))
    got = check(spark, rows)
    assert any(n for n, *_ in got.values()) and not all(k for *_, k in got.values())


def test_odd_rows(spark):
    base = [1.0, 2.0, 3.0]
    rows = [
        (1, base, 0), (2, base, 0), (3, [2.0, 4.0, 6.0], 0), (4, base, 1), (5, base, None), (6, None, 0), (7, [], 0), (8, [0.0, 0.0, 0.0], 0),
        (9, [1.0, None, 3.0], 0), (10, [1.0, float("nan"), 3.0], 0), (11, [1.0, float("inf"), 3.0], 0), (12, [1.0, 2.0, 3.0, 0.0], 0),
        (13, [1e-30, 2e-30, 3e-30], 0), (14, [1e30, 2e30, 3e30], 0), (15, [-1.0, -2.0, -3.0], 0), (16, [float(i % 5) for i in range(70)], 2), (17, [float(i % 5) for i in range(70)], 2),
    ]
    check(spark, rows)


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], 0, 1, 2), (1, [1.0, 2.0], 0, 1, 2), (1, [1.0, 2.0], 0, 1, 2)], KIND)
    got = sorted(tuple(r) for r in vectors.near_duplicates(df).where("vec_id is not null").collect())
    assert got == [(1, 1, 1, True)] * 2
    assert tuple(vectors.near_duplicates(df).where("vec_id is null").first()) == (None, 0, None, True)
    assert vectors.near_duplicates(df).where("vec_id is null").first().n_links == 0
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_repeated_ids_with_other_vectors_are_rows_of_their_own(spark):
    """Brute force over rows: 1 stands twice, with orthogonal vectors; 2 is near the first, 3 near the second."""
    rng = generator(5)
    x, y = np.eye(16)[0], np.eye(16)[1]
    rows = [(1, x), (1, y), (2, near(rng, x, 0.99)), (3, near(rng, y, 0.99)), (3, near(rng, y, 0.999)), (0, near(rng, x, 0.985)), (7, np.eye(16)[5])]
    rows = [(i, [float(z) for z in np.float32(v)], 0) for i, v in rows]
    df = spark.createDataFrame([(i, v, lab, 1, 2) for i, v, lab in rows], KIND)
    got = sorted(tuple(r) for r in vectors.near_duplicates(df).collect())
    renamed = plain([(k, v, lab) for k, (_, v, lab) in enumerate(rows)])
    name = [i for i, *_ in rows]
    least = {}
    for k, (_, c, _) in renamed.items():
        least[c] = min(least.get(c, name[k]), name[k])
    assert got == sorted((name[k], n, least[c], name[k] == least[c]) for k, (n, c, _) in renamed.items())


def test_groups_larger_than_a_tile(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 16)
    rng = generator(11)
    rows = []
    for c, n in enumerate((100, 40, 3, 1)):
        x = rng.normal(size=24)
        rows += [(1000 * c + i, [float(z) for z in np.float32(near(rng, x, float(rng.choice([0.999, 0.992, 0.99]))))], c % 2) for i in range(n)]
    check(spark, rows + [(5000 + i, v, lab) for i, (_, v, lab) in enumerate(rows[:20])])


def test_a_dense_group_keeps_all_links(spark):
    rng = generator(9)
    x = rng.normal(size=32)
    rows = [(i, [float(z) for z in np.float32(near(rng, x, 0.996))], 0) for i in range(150)]
    check(spark, rows)


def test_links_at_the_edge_agree_with_components(spark):
    """Pairs whose cosine is the threshold but for rounding: whoever has a link shares a component, and the other way round."""
    rng = generator(21)
    rows = []
    for c in range(300):
        x = rng.normal(size=48)
        for y in (x, near(rng, x, 0.98)):
            rows.append((len(rows), [float(z) for z in y], c % 2))
    df = spark.createDataFrame([(i, v, lab) for i, v, lab in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect()}
    both = 0
    for i in range(0, len(rows), 2):
        together = got[i][1] == got[i + 1][1]
        assert got[i][0] == got[i + 1][0] == int(together)
        both += together
    assert 20 < both < 280
