import hashlib
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from readloom.llm import fingerprint
from tests.llm.fixtures import generator, invented, no_documents, odd_documents


def jaccard(a, b):
    x, y = Counter(a.encode().split()), Counter(b.encode().split())
    top = sum((x | y).values())
    return sum((x & y).values()) / top if top else 1.0


def plain(rows, settings=fingerprint.Settings()):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        cut = len(t) // 3
        e = t[: len(t) - cut] + following[:cut]
        sampler = fingerprint.Sampler(settings)
        sampler.add({w for x in (t, e, following) for w in x.encode().split()})
        a, b, c = (sampler.signature(Counter(x.encode().split())) for x in (t, e, following))
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), a.astype(">u2").tobytes().hex(), b.astype(">u2").tobytes().hex(), float((a == b).mean()), float((a == c).mean()))
    return out


def test_rows_equal_the_plain_definition(spark):
    rng = generator(2)
    rows = [(int(i) * 3 - 20, t) for i, t in enumerate(invented(rng, 90))] + [(-100, ""), (1000, "é日本 \U0001f600" * 50)]
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == plain(rows)
    assert len(got) == len(rows)


def test_a_frequent_id_is_cut_by_the_texts_hash(spark):
    texts = [f"{t} {i}" for i, t in enumerate(invented(generator(12), 200))]
    docs = spark.createDataFrame([(None if i % 2 else i // 50, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    spread = fingerprint.spread_by_id(docs).where("not extra")
    assert spread.where("doc_id is null").select("bucket").distinct().count() >= 2
    order = docs.withColumn("turn", F.xxhash64("text")).orderBy(F.desc_nulls_last("doc_id"), F.desc("turn")).collect()
    want = sorted(hashlib.sha256(fingerprint.edited(r.text, order[(i + 1) % len(order)].text).encode()).hexdigest() for i, r in enumerate(order))
    assert sorted(r.edited_sha256 for r in fingerprint.fingerprints(docs).collect()) == want


def test_the_cache_changes_nothing():
    texts = invented(generator(3), 30)
    small, large = (fingerprint.Sampler(fingerprint.Settings(cached=n)) for n in (40, 10**6))
    for t in texts:
        counts = Counter(t.encode().split())
        small.add(counts.keys())
        large.add(counts.keys())
        assert (small.signature(counts) == large.signature(counts)).all()


def test_collision_rate_is_generalised_jaccard():
    s = fingerprint.Settings(samples=4000)
    sampler = fingerprint.Sampler(s)
    rng = generator(6)
    for t in invented(rng, 12, words=60):
        words = t.split()
        other = " ".join(words[: len(words) // 2] * 2 + list(rng.choice(words, 5)) + ["new"] * 3)
        for x in (t, other):
            sampler.add(Counter(x.encode().split()).keys())
        a, b = (sampler.signature(Counter(x.encode().split())) for x in (t, other))
        assert abs((a == b).mean() - jaccard(t, other)) < 0.04


def test_odd_rows_and_empty_tables(spark):
    got = fingerprint.fingerprints(odd_documents(spark)).collect()
    assert len(got) == odd_documents(spark).count()
    assert {r.fingerprint for r in got if r.doc_id in (3, 4, 5)} == {"f" * 4 * fingerprint.Settings().samples}
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint.fingerprints(no_documents(spark)).count() == 0
    one = odd_documents(spark).where("doc_id = 1")
    assert fingerprint.fingerprints(one).first().near_next == 1.0


def test_edited_text_counts_code_points():
    assert fingerprint.edited("abcdef", "XYZ") == "abcdXY"
    assert fingerprint.edited("abcdefghi", "X") == "abcdefX"
    assert fingerprint.edited("ab", "XYZ") == "ab"
    assert np.isclose(jaccard("a a b", "a b b"), 0.5)


def test_a_likeness_has_the_error_of_128_samples():
    assert fingerprint.Settings().samples == 128
    sampler = fingerprint.Sampler(fingerprint.Settings())
    sampler.add({b"one", b"two"})
    assert len(hexed := fingerprint.hexed(sampler.signature(Counter([b"one", b"two"])))) == 512 and set(hexed) <= set("0123456789abcdef")


def test_slices_change_nothing_and_bound_memory():
    texts = invented(generator(8), 20, words=400)
    narrow, wide = (fingerprint.Sampler(fingerprint.Settings(slice=n)) for n in (7, 10**6))
    for t in texts:
        counts = Counter((t + " " + t[: len(t) // 2]).encode().split())
        assert (narrow.signature(counts) == wide.signature(counts)).all()
    many = Counter({b"%d" % i: 1 + i % 3 for i in range(300_000)})
    sampler = fingerprint.Sampler(fingerprint.Settings(samples=16))
    tracemalloc.start()
    sampler.signature(many)
    assert tracemalloc.get_traced_memory()[1] < 50_000_000  # all draws at once would take 250 MB and more
    tracemalloc.stop()
