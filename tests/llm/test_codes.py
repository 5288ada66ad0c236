import hashlib
import os

import duckdb
import numpy as np
import pytest

from readloom.llm import codes
from tests.llm.fixtures import generator

KIND = "vec_id long, embedding array<float>, label int, code string, error int, x int, rows int"


def plain(rows, s, dim):
    """Every part against every entry, in whole numbers."""
    kept = [(i, [int(np.floor(1024 * float(np.float32(c)))) for c in v], lab) for i, v, lab in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ends = codes.cuts(dim, s.parts)
    part = lambda v: [v[a:b] for a, b in zip([0, *ends], ends)]
    books = [[part(v)[p] for _, v, _ in kept[: s.entries]] for p in range(s.parts)]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(books[p]))
    for _ in range(s.rounds):
        hits = [[[] for _ in b] for b in books]
        for _, v, _ in kept:
            for p, x in enumerate(part(v)):
                hits[p][near(x, p)[1]].append(x)
        books = [[[sum(c) // len(h) for c in zip(*h)] if h else e for e, h in zip(books[p], hits[p])] for p in range(s.parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for i, v, lab in kept:
        found = [near(x, p) for p, x in enumerate(part(v))]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), lab))
        by_label[lab] = by_label.get(lab, 0) + out[-1][2]
    return sorted((str(i), c, e, by_label[lab], digest) for i, c, e, lab in out)


def found(spark, rows, s=codes.Settings()):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], KIND).repartition(3)
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.encode(df, s).collect())


@pytest.mark.parametrize("dim, entries", [(8, 16), (10, 7), (3, 5)])
def test_equals_brute_force_with_ties_and_repeats(spark, dim, entries):
    rng = generator(4)
    vectors = np.round(rng.normal(size=(90, dim)), 1) / 8  # coarse: many ties
    rows = [(i // 2 if i % 7 == 0 else i, [float(x) for x in v], [None, 1, 2][i % 3]) for i, v in enumerate(vectors)]
    rows += [rows[5]] * 40 + [(None, rows[6][1], 1)]
    s = codes.Settings(entries=entries)
    assert found(spark, rows, s) == plain(rows, s, dim)


def test_search_equals_comparison_with_all_entries():
    rng = generator(5)
    entries, x = rng.integers(-40, 40, (256, 6)), rng.integers(-60, 60, (3000, 6)).astype(float)
    entries[200:] = entries[:56]  # equal entries: the lower index
    apart = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    at, d = codes.Book(entries).nearest(x)
    assert (at == apart.argmin(axis=1)).all() and (d == apart.min(axis=1)).all()


def test_odd_rows(spark):
    good = [0.5, -0.25, 0.125, 1.0]
    rows = [(1, good, 1), (2, None, 1), (3, [1.0, None, 0.0, 0.0], 1), (4, [float("nan")] * 4, 1), (5, [float("inf"), 0.0, 0.0, 0.0], 1), (6, [], 1), (7, [1.0], 9), (8, [0.0] * 4, None)]
    got = {r[0]: r[1:4] for r in found(spark, rows)}
    assert set(got) == {"1", "6", "7", "8"} and got["1"] == ("00000000", 0, 0) and got["6"] == (None, None, 0) and got["7"] == (None, None, None) and got["8"] == ("01010101", 0, 0)
    assert found(spark, []) == [] and found(spark, [(1, None, 1)]) == []
    with pytest.raises(Exception, match="too large"):
        found(spark, [(1, [1e9] * 4, 1), (2, [-1e9] * 4, 1)])


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(db.sql(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({codes.ORACLE})").fetchall())
    got = codes.encode(spark.read.parquet(f"{sf}/embeddings.parquet"))
    assert sorted(tuple(r) for r in got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()) == want
