import re

import pytest
import xxhash

from readloom.llm import simhash
from tests.llm.fixtures import generator, invented, no_documents, odd_documents


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def plain_components(rows):
    """Smallest doc_id that links of at most 3 bits reach, by brute force."""
    fps = sorted({fp for _, fp in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(b)] = find(a)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f, least.get(find(f))) for d, f in rows]


def unsigned(x):
    return x % (1 << 64)


def as_key(r):
    return tuple((x is None, x or 0) for x in r)


def test_fingerprints_equal_the_plain_definition(spark):
    docs = odd_documents(spark)
    want = sorted([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()], key=as_key)
    got = sorted([(r.doc_id, unsigned(r.fp)) for r in simhash.fingerprints(docs).collect()], key=as_key)
    assert got == want


def test_components_equal_brute_force(spark):
    rng = generator()
    texts = invented(rng, 60)
    for t in texts[:25]:
        words = t.split()
        for _ in range(4):
            words = list(words)
            words[rng.integers(len(words))] = "changed"
            texts.append(" ".join(words))
    rows = [(int(i), t) for i, t in enumerate(rng.permutation(texts))]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    assert sorted((r.doc_id, unsigned(r.fp), r.component_id) for r in got) == sorted(want)
    assert len({w[2] for w in want}) < len(want)


def test_every_distance_up_to_three_is_found(spark):
    rng = generator(4)
    base = [int(x) for x in rng.integers(0, 1 << 62, 8)]
    fps = set(base)
    for b in base:
        for _ in range(120):
            fps.add(b ^ sum(1 << int(j) for j in rng.choice(63, rng.integers(1, 6), replace=False)))
    fps = sorted(fps)
    classes = spark.createDataFrame([(f,) for f in fps], "fp long")
    at = {}
    for r in simhash.meetings(classes).collect():
        at.setdefault(r.fp, set()).add(r.variant)
    near = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 3]
    assert near and all(at[a] & at[b] for a, b in near)
    want = {f: c for f, _, c in plain_components([(f, f) for f in fps])}
    got = {r.node: r.component for r in simhash.components(classes).collect()}
    assert {f: got.get(f, f) for f in fps} == want


def test_a_dense_group_makes_rows_in_proportion(spark):
    """All fingerprints within one bit of one, and some of two: their links would be nearly all pairs."""
    fps = [0] + [1 << i for i in range(62)] + [3 << i for i in range(60)]
    classes = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.component for r in simhash.components(classes).collect()}
    assert {got.get(f, f) for f in fps} == {0}
    assert simhash.meetings(classes).count() <= len(fps) * len(simhash.variants())


def test_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    got = [(r.doc_id, unsigned(r.fp), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()])
    assert sorted(got, key=as_key) == sorted(want, key=as_key)
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_radius_is_checked(spark):
    with pytest.raises(ValueError):
        simhash.meetings(spark.createDataFrame([(1,)], "fp long"), radius=4)
