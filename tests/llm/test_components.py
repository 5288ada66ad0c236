from readloom.llm import common
from tests.llm.fixtures import generator


def plain(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root if find(x) != x}


def rounds(spark, edges, monkeypatch):
    """The components, and the names of the tables that were written."""
    names, write = [], common.stage_table
    monkeypatch.setattr(common, "stage_table", lambda df, name: names.append(name) or write(df, name))
    found = common.connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    monkeypatch.undo()
    assert len(found) == len({r.node for r in found})
    return {r.node: r.component for r in found}, names


def test_components_equal_plain_ones(spark, monkeypatch):
    rng = generator(3)
    chance = [tuple(map(int, rng.integers(-60, 60, 2))) for _ in range(70)]
    path = [(i, i + 1) for i in range(100, 140)]
    ring = [(i, 200 + (i - 199) % 9) for i in range(200, 209)]
    for edges in ([], [(1, 1)], chance, path, ring, [(5, 3), (3, 5), (5, 3), (9, 5), (9, 9)], chance + path + ring):
        assert rounds(spark, edges, monkeypatch)[0] == plain(edges)


def test_stars_take_no_round_and_others_none_without_a_change(spark, monkeypatch):
    stars = [(0, i) for i in range(1, 30)] + [(50, 51)]
    found, names = rounds(spark, stars, monkeypatch)
    assert found == plain(stars) and names == ["edges"]
    found, names = rounds(spark, [(1, 2), (2, 3)], monkeypatch)
    assert found == {2: 1, 3: 1} and names == ["edges", "star"]
