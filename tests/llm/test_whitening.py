import numpy as np
import pytest

from readloom.llm import whitening
from tests.llm.fixtures import generator

KIND = "vec_id long, embedding array<float>, label int, n int, size int, w string, x int, component int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "a", 4, 5) for i, v in rows], KIND).repartition(3)


def plain(rows, most=32):
    x = np.array([np.floor(64 * np.float32(v).astype(float)) + 1_000_000 for _, v in rows])
    n, total = len(x), x.sum(axis=0)
    value, axes = np.linalg.eigh((x - total / n).T @ (x - total / n) / n)
    value, axes = value[::-1], axes[:, ::-1]
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, total)) for r in x]
    return n, exact, (x - total / n) @ axes[:, :most] / np.sqrt(value[:most]), value[:most] / value.sum()


@pytest.mark.parametrize("dim", [3, 40])
def test_equals_plain_whitening(spark, dim):
    rng = generator(2)
    mixing = rng.normal(size=(dim, dim))
    vectors = rng.normal(size=(300, dim)) @ mixing
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(1, rows[9][1])]  # copies, and a repeated id
    n, exact, want, share = plain(rows)
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == len(rows) * min(dim, 32) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    assert len({r.identity_error for r in got}) == 1
    for c in range(min(dim, 32)):
        own = [r for r in got if r.component == c + 1]
        assert sorted((r.vec_id, r.deviation) for r in own) == sorted((i, e) for (i, _), e in zip(rows, exact))
        assert abs(own[0].explained - share[c]) < 1e-9
        mine = np.array([r.whitened for r in sorted(own, key=lambda r: (r.vec_id, r.deviation))])
        other = np.array([want[k, c] for k in sorted(range(len(rows)), key=lambda k: (rows[k][0], exact[k]))])
        assert min(np.abs(mine - other).max(), np.abs(mine + other).max()) < 1e-6


def test_weight_one_fits_each_distinct_vector_once(spark):
    rng = generator(6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(np.float32(rng.normal(size=(50, 4)) * 3))]
    once = {(r.vec_id, r.component): abs(r.whitened) for r in whitening.whiten(table(spark, rows)).collect()}
    more = rows + [(100 + i, rows[3][1]) for i in range(60)]
    got = whitening.whiten(table(spark, more), weight="one").collect()
    assert len(got) == 110 * 4 and all(abs(abs(r.whitened) - once[(r.vec_id if r.vec_id < 100 else 3, r.component)]) < 1e-9 for r in got)


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (None, [0.0, 5.0]), (4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("-inf"), 1.0]), (8, []), (9, [1.0, 2.0, 3.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in got) == sorted((i, c, 3) for i in ("1", "2", "None") for c in (1, 2))
    assert whitening.whiten(table(spark, [])).collect() == [] and whitening.whiten(table(spark, [(1, None)])).columns == whitening.whiten(table(spark, rows)).columns


def test_equal_vectors_have_no_spread(spark):
    got = whitening.whiten(table(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect()
    assert len(got) == 10 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, 0.0, 0.0, 0.0)}
    flat = whitening.whiten(table(spark, [(i, [float(i), 2.0]) for i in range(5)])).collect()
    assert {r.whitened for r in flat if r.component == 2} == {0.0} and max(r.identity_error for r in flat) < 1e-9


def test_numbers_too_large_raise(spark):
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(table(spark, [(1, [1e17, 1.0]), (2, [-1e17, 1.0]), (3, [1.0, 1e17])])).collect()
