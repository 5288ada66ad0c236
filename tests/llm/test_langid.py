import zlib

import numpy as np

from readloom.llm import langid
from tests.llm.fixtures import generator, no_documents, odd_documents

SMALL = langid.Settings(dim=512)


def texts(n=300):
    rng = generator(11)
    parts = {"xx": ["ka", "to", "ri", "mu"], "yy": ["ßen", "är", "lich", "un"], "zz": ["日本", "語の", "テス"]}
    rows = []
    for i in range(n):
        lang = ["xx", "yy", "zz"][i % 3]
        rows.append((i, " ".join("".join(rng.choice(parts[lang], 3)) for _ in range(int(rng.integers(3, 40)))), lang))
    return rows


def vector(text, s):
    """The bundle of a text, one n-gram at a time."""
    c, base = langid.classes_of(text, langid.class_table()), langid.letters(s).astype(float)
    total = np.zeros(s.dim)
    for i in range(len(c) - s.n + 1):
        v = np.ones(s.dim)
        for k in range(s.n):
            v *= np.roll(base[c[i + k]], s.n - 1 - k)
        total += v
    return total


def test_predictions_equal_the_plain_bundles(spark):
    rows = texts(90)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    learned = langid.learn(docs, SMALL)
    want = {k: sum(vector(t, SMALL) for d, t, lang in rows if lang == k and zlib.crc32(str(d).encode()) % 4 != 2) for k in ("xx", "yy", "zz")}
    for k, v in want.items():
        assert np.allclose(learned[k], v)
    got = {r.doc_id: r for r in langid.predict(docs, learned, SMALL).collect()}
    for d, t, _ in rows:
        x = vector(t, SMALL)
        cos = {k: x @ v / np.linalg.norm(x) / np.linalg.norm(v) for k, v in want.items()}
        assert got[d].lang_pred == max(cos, key=cos.get) and abs(got[d].score - max(0, max(cos.values()))) < 1e-4


def test_held_out_accuracy(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.learn(docs, SMALL), SMALL).collect()}
    held = [(d, lang) for d, _, lang in rows if zlib.crc32(str(d).encode()) % 4 == 2]
    assert np.mean([got[d] == lang for d, lang in held]) > 0.97


def test_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    learned = langid.learn(docs, SMALL)
    assert set(learned) <= {"en", "fr", "de"}
    rows = langid.predict(docs, learned, SMALL).collect()
    assert len(rows) == docs.count()
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (3, 4, 5, 10)} == {("und", 0.0)}
    assert all(r.lang_pred in learned for r in rows if r.doc_id in (1, 6, 9, 11, None))
    assert langid.learn(no_documents(spark), SMALL) == {}
    assert langid.predict(no_documents(spark), learned, SMALL).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, {}, SMALL).collect()} == {"und"}


def test_many_languages_in_one_task(spark):
    rows = [(i, f"wort{i % 40} text", f"l{i % 40:02d}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    learned = langid.learn(docs, SMALL)
    assert len(learned) == 40
    want = sum(vector(t, SMALL) for d, t, lang in rows if lang == "l07" and zlib.crc32(str(d).encode()) % 4 != 2)
    assert np.allclose(learned["l07"], want)


def test_blocks_change_nothing():
    table, base = langid.class_table(), langid.letters(SMALL)
    own = [t for _, t, _ in texts(60)]
    unit = np.array([vector(t, SMALL) for t in own[:3]], dtype=np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    whole = langid.predict_texts(own, ["a", "b", "c"], unit, base, table, 3)
    single = [langid.predict_texts([t], ["a", "b", "c"], unit, base, table, 3)[0] for t in own]
    assert [a for a, _ in whole] == [a for a, _ in single]
