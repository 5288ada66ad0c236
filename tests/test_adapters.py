"""Adapters within edits, against plain tables of edit distances."""

import random

import numpy as np
import pyarrow as pa
import pytest

from readloom.operators import adapters as ad

READS = "sample string, read_id long, seq string, qual string"
A = "ACGTTGCAAGTCCATGGTAC"


def least_edits(text, adapter):
    """Edits of the best part that ends at each place, by the whole table."""
    column, out = list(range(len(adapter) + 1)), []
    for c in text:
        new = [0]
        for i, a in enumerate(adapter, 1):
            new.append(min(column[i - 1] + (a != c), column[i] + 1, new[i - 1] + 1))
        column = new
        out.append(column[-1])
    return out


def edited(rng, text, n):
    x = list(text)
    for _ in range(n):
        i, way = rng.randrange(1, len(x) - 1), rng.randrange(3)
        x[i : i + 1] = [[rng.choice("ACGT")], [], [x[i], rng.choice("ACGT")]][way]
    return "".join(x)


def sequence(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


@pytest.mark.parametrize("adapter", [A, "A", "AC" * 32, "ACG" * 11])
def test_bit_vectors_equal_the_table_of_edits(adapter):
    rng = random.Random(len(adapter))
    texts = [sequence(rng, rng.randrange(0, 120)) for _ in range(60)] + [sequence(rng, 10) + edited(rng, adapter * 6, 3)[: len(adapter)] + sequence(rng, 9) for _ in range(40)] + [""]
    rows, sizes = ad.matrix(pa.array(texts))
    got = ad.edits(rows, adapter.encode())
    for t, n, d in zip(texts, sizes, got, strict=True):
        assert n == len(t) and d[:n].tolist() == least_edits(t, adapter)


def test_matrix_of_slices_and_nulls():
    rows, sizes = ad.matrix(pa.array(["xx", "abc", None, "d"]).slice(1))
    assert sizes.tolist() == [3, 0, 1] and bytes(rows[0]) == b"abc" and rows[1].tolist() == [0, 0, 0]


def test_too_long_adapters_are_refused():
    with pytest.raises(ValueError):
        ad.edits(np.zeros((1, 3), dtype=np.uint8), b"A" * 65)


def test_long_reads_are_searched_as_whole(spark):
    """Places do not depend on where chunks end."""
    rng = random.Random(5)
    text = "".join(sequence(rng, rng.randrange(0, 700)) + edited(rng, A, rng.randrange(3)) for _ in range(40)) + sequence(rng, 200)
    rows, sizes = ad.matrix(pa.array([text]))
    want = [int(e) + 1 for e in np.flatnonzero(ad.best_places(ad.edits(rows, A.encode()), sizes, 2)[0])]
    got = ad.places_in(pa.array([text, None, ""]), A.encode(), 2)
    assert [b for _, b in got[0]] == want and len(want) >= 38 and got[1:] == [[], []]
    for a, b in got[0]:
        assert ad.whole_edits(text[a:b].encode(), A.encode()) == least_edits(text, A)[b - 1] <= 2


def test_trimming_and_splitting_at_adapters_with_indels(spark):
    rng = random.Random(3)
    rows, bodies = [], {}
    for i in range(60):
        body = sequence(rng, 400)
        left, right = edited(rng, A, i % 3), edited(rng, A, i % 2)
        x = sequence(rng, i % 5) + left + body + right + sequence(rng, i % 4)
        rows.append(("s", i, x, "".join(chr(40 + j % 40) for j in range(len(x)))))
        bodies[i] = body
    df = spark.createDataFrame(rows + [("s", 99, A, "I" * 20), ("s", 100, "", ""), ("s", 101, "ACG", "III")], READS).repartition(3)
    table = spark.createDataFrame([("a", A)], "name string, seq string")
    got = {r.read_id: r for r in ad.trim_adapters(df, table).collect()}
    assert 99 not in got and 100 not in got and got[101].seq == "ACG"
    # An edit at the adapter's edge may leave or take a base or two; the exact ones are cut exactly.
    for i, x in bodies.items():
        assert got[i].seq == x if i % 6 == 0 else abs(len(got[i].seq) - 400) <= 4
        whole = rows[i][2].index(got[i].seq)
        assert got[i].qual == rows[i][3][whole : whole + len(got[i].seq)]
    parts = {}
    for r in ad.split_chimeras(df, A).collect():
        parts.setdefault(r.read_id, []).append((int(r.fragment_id.split("_")[1]), r.seq, r.qual))
    for i, x in bodies.items():
        assert any(abs(len(s) - 400) <= 4 and len(s) == len(q) for _, s, q in parts[i]) and (i % 6 or any(s == x for _, s, _ in parts[i]))
    assert 99 not in parts and parts[101] == [(1, "ACG", "III")]
    found = ad.detect_adapters(df, spark.createDataFrame([("a", A), ("b", "TTTTTTTTTTTTGGGGGGGG")], "name string, seq string")).collect()
    assert {r["name"]: (r.n_reads, r.n_checked, r.present) for r in found} == {"a": (61, 63, True), "b": (0, 63, False)}
