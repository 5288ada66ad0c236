import corpus_pipeline
from readloom.llm import simhash
from tests.llm.fixtures import generator, invented, no_documents, odd_documents


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows):
    """Smallest doc_id that links of a likeness of 0.8 reach, by brute force."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, least[find(i)]) for i, (d, _) in enumerate(rows)]


def copies(rng, text, times, step):
    """Chains of copies: each changes one more word than the one before, so that the last ones link to the first by others only."""
    words, out = text.split(), []
    for i in range(times):
        words = list(words)
        for _ in range(step):
            words[int(rng.integers(len(words)))] = f"new{i}"
        out.append(" ".join(words))
    return out


def rows_of(rng):
    texts = invented(rng, 40, words=120)
    shared = " ".join(texts[0].split()[:40])
    texts += [f"{shared} {t}" for t in invented(rng, 30, words=60)]  # a common passage, no near copies
    for t in texts[:15]:
        texts += copies(rng, t, 6, 1) + copies(rng, t, 3, 4)
    texts += ["", " ", "one two", "One  two", "one two three"]
    return [(int(i), t) for i, t in enumerate(rng.permutation(texts))]


def test_components_equal_brute_force(spark):
    rows = rows_of(generator(11))
    got = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = plain_components(rows)
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert len({c for _, c in want}) < len(want)


def test_the_stage_takes_out_copies_beyond_three_bits(spark):
    rng = generator(5)
    texts = invented(rng, 20, words=200)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    for i, t in enumerate(texts):
        words = t.split()
        words[10 : 10 + 8] = [f"other{i}{k}" for k in range(8)]
        rows.append((100 + i, " ".join(words), "en", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = {d for d, c in plain_components([r[:2] for r in rows]) if d == c}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates_stage(spark, docs, "").collect()} == want
    assert len(want) < len(rows)


def test_odd_rows_and_empty_tables(spark):
    got = simhash.near_copies(odd_documents(spark)).collect()
    assert len(got) == odd_documents(spark).count()
    assert simhash.near_copies(no_documents(spark)).count() == 0
