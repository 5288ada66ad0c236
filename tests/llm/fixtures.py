"""Small tables with the awkward rows that every operator must take."""

import numpy as np

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, bucket int"


def odd_documents(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, columns with clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, "The cat sat on the mat today", "en", "a"),
        (2, "The cat sat on the mat today", "en", "b"),
        (2, "The cat sat on the mat today", "en", "b"),
        (3, None, None, None),
        (4, "", "en", "a"),
        (5, " \t\n\x0b ", "fr", "a"),
        (6, long, "en", None),
        (7, long + " end", "fr", "c"),
        (8, "ein\nzwei\n\ndrei", "de", "c"),
        (9, "Ça va bien, 日本語 \U0001f600", "fr", ""),
        (None, "no id here", "en", "a"),
        (2, "other text, same id", None, "b"),
        (10, "12345 --- !!!", "en", "a"),
        (11, "x", "en", "d"),
    ]
    return spark.createDataFrame([(*r, None, 7, 0.5, 3) for r in rows], DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def invented(rng, n, words=4000):
    """``n`` texts of invented words."""
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 8))) for _ in range(words)]
    return [" ".join(rng.choice(vocabulary, rng.integers(1, 120))) for _ in range(n)]


def generator(seed=1):
    return np.random.default_rng(seed)
