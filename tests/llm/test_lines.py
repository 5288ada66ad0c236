from collections import defaultdict

from pyspark.sql import functions as F

from readloom.llm import lines
from tests.llm.fixtures import generator, no_documents, odd_documents


def need(line, thresholds):
    return [k for least, k in thresholds if len(line.encode().split()) >= least][-1]


def plain(rows, thresholds):
    sites, texts, first = defaultdict(set), defaultdict(set), {}
    for d, t, s in sorted(rows, key=lambda r: r[0]):
        for i, x in enumerate(t.split("\n")):
            x = x.strip(lines.BLANKS)
            if x:
                sites[x].add(s)
                texts[x].add(t)
                first.setdefault(x, (d, i))

    def stays(x, d, i):
        x = x.strip(lines.BLANKS)
        return not x or min(len(sites[x]), len(texts[x])) < need(x, thresholds) or first[x] == (d, i)

    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if stays(x, d, i)) for d, t, _ in rows}


def test_equals_brute_force_around_the_threshold(spark):
    rng = generator(8)
    common = [f"shared line {i}" for i in range(40)]
    rows = []
    for d in range(600):
        site = int(rng.integers(0, 26))
        body = [f"own {d} {k}" for k in range(int(rng.integers(0, 4)))]
        body += [c for i, c in enumerate(common) if site <= i and rng.random() < 0.4] + ["", " hot line "] * (d % 3 == 0)
        rows.append((d, "\n".join(body), f"site{site}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for threshold in (((0, 2),), ((0, 10),), ((0, 15),), ((0, 10), (3, 4))):
        got = {r.doc_id: r.text for r in lines.remove_boilerplate(docs, threshold).collect()}
        assert got == plain(rows, threshold)


def test_long_passages_on_few_sites_go_and_whole_copies_stay(spark):
    long = " ".join(f"w{i}" for i in range(60))
    mid = "one two three four five six seven eight nine"
    rows = [(1, f"a\n{long}\nx", "s1"), (2, f"b\n{long} \t\ny", "s2"), (3, f"{mid}\nc", "s1"), (4, f"{mid}\nd", "s2"), (5, f"e\n\t{mid}\r", "s3"), (6, "short line\nf", "s1")]
    rows += [(10 + i, f"a copy of it all\n{long} end", f"s{i}") for i in range(5)] + [(20 + i, f"short line\n{i}", f"s{i}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in lines.remove_boilerplate(docs).collect()}
    assert got == plain(rows, lines.THRESHOLDS)
    assert got[2] == "b\ny" and got[4] == "d" and got[5] == "e" and got[6] == "short line\nf" and got[14].endswith(" end")


def test_sketches_decide_far_from_the_threshold(spark):
    rows = [(i, "everywhere\nown %d" % i, f"s{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in lines.remove_boilerplate(docs, ((0, 100),)).collect()}
    assert got == plain(rows, ((0, 100),))


def test_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    for name in ("_drop", "_id", "_hash", "row", "places", "of", "own_id", "l1", "first"):
        docs = docs.withColumn(name, F.lit(5))
    got = lines.remove_boilerplate(docs, ((0, 2),)).collect()
    assert len(got) == docs.count()
    assert set(docs.columns) | {"n_lines", "n_removed"} == set(got[0].asDict())
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[1][0].text == "The cat sat on the mat today" and by[1][0].n_removed == 0
    # One text on two sources is a copy, and keeps its line.
    assert sorted(r.text for r in by[2]) == ["The cat sat on the mat today"] * 2 + ["other text, same id"]
    assert by[3][0].text is None and by[3][0].n_lines == 0
    assert by[4][0].text == "" and by[4][0].n_lines == 1
    assert by[8][0].text == "ein\nzwei\n\ndrei"
    assert lines.remove_boilerplate(no_documents(spark)).count() == 0
