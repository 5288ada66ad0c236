import random

from pyspark.sql import functions as F

from readloom.operators.ranks import ranked


def test_places_equal_a_plain_sort(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["big"] * 8 + ["a", "b", None]), i * 7919 % 3001, rng.choice([1, 2, None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, x long, y int").repartition(6)
    got = ranked(df, ["g"], ["y", "x"], "place").collect()
    assert len(got) == 3000
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[2] is not None, r[2] or 0, r[1]))
        assert [(r.g, r.x, r.y) for r in sorted((r for r in got if r.g == g), key=lambda r: r.place)] == own
        assert sorted(r.place for r in got if r.g == g) == list(range(1, len(own) + 1))


def test_no_group_ties_and_empty_tables(spark):
    df = spark.range(50).select((F.col("id") % 5).alias("x"))
    got = ranked(df, [], ["x"], "n").collect()
    assert sorted(r.n for r in got) == list(range(1, 51)) and all((r.n - 1) // 10 == r.x for r in got)
    assert ranked(df.limit(0), [], ["x"], "n").count() == 0


def test_no_window_holds_a_group(spark):
    """The only window runs over counts per range."""
    df = spark.range(1000).select(F.lit("one").alias("g"), F.col("id").alias("x"))
    plan = ranked(df, ["g"], ["x"], "n")._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Window", 1)
    assert "Window" not in below and "Aggregate [g" in below
