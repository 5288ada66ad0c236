"""Every registered sequence query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from readloom.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "nation documents benchmark".split()
#: The slower ones share their operators with faster ones here; all run in the driver's comparison.
FAST = [n for n in ORACLES if n.split("_")[0] not in ("a3", "c4", "c5", "c8", "f2", "a6", "o1", "j1", "j5")]


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(want.columns, want.fetchall())


def test_every_query_but_trees_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"c6_nj_clades", "c7_clade_support"}
