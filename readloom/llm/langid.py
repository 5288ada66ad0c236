"""Language ID by hyperdimensional profiles: letter vectors bound into n-gram vectors, bundled, compared by cosine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import fold

#: Letter classes: 0 is every non-letter, 1-26 are a-z. All other letters have classes by script, shared by remainder
#: within it: rows of first code point, first class and number of classes.
CLASSES = 160
SCRIPTS = np.array(
    [
        [0x0000, 27, 40],  # Latin beyond a-z
        [0x0370, 67, 40],  # Greek, Cyrillic
        [0x0530, 107, 20],  # Armenian to the scripts of South Asia and beyond
        [0x3040, 127, 12],  # Kana
        [0x3100, 139, 13],  # Han
        [0xAC00, 152, 8],  # Hangul
        [0xD7B0, 139, 13],  # the rest, most of it Han
    ]
)
#: Texts that are worked on at once, by characters and by number (a text takes 16 KB of counts).
BLOCK, TEXTS = 400_000, 512


#: Languages whose n-grams a task counts at once; the counts of a language are some 16 MB.
COUNTED = 8


@dataclass(frozen=True)
class Settings:
    dim: int = 1024
    n: int = 3
    seed: int = 5


def letter_classes(points: np.ndarray) -> np.ndarray:
    """Class of each code point, in lower case."""
    low = [chr(cp).lower()[0] for cp in points.tolist()]
    cp = np.array([ord(c) if c.isalpha() else 0 for c in low], dtype=np.int64)
    start, first, size = SCRIPTS[np.searchsorted(SCRIPTS[:, 0], cp, "right") - 1].T
    latin = (cp >= ord("a")) & (cp <= ord("z"))
    return np.where(cp == 0, 0, np.where(latin, cp - 96, first + (cp - start) % size))


def class_table() -> np.ndarray:
    """Classes of the code points below 0x2000; others are looked up as they come."""
    return letter_classes(np.arange(0x2000))


def classes_of(text: str, table: np.ndarray) -> np.ndarray:
    """The letter classes of a text, with one 0 around and between runs of letters."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = table[np.minimum(cp, len(table) - 1)]
    far = np.flatnonzero(cp >= len(table))
    if len(far):
        points, at = np.unique(cp[far], return_inverse=True)
        out[far] = letter_classes(points)[at]
    out = np.concatenate([[0], out, [0]])
    return out[np.concatenate([[True], (out[1:] != 0) | (out[:-1] != 0)])]


def codes_of(classes: np.ndarray, n: int) -> np.ndarray:
    """One number per n-gram of classes."""
    m = len(classes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.int64)
    code = np.zeros(m, dtype=np.int64)
    for k in range(n):
        code = code * CLASSES + classes[k : k + m]
    return code


def letters(s: Settings) -> np.ndarray:
    """A random vector of +1 and -1 per class."""
    return np.random.default_rng(s.seed).choice(np.array([-1, 1], dtype=np.int8), (CLASSES, s.dim))


def gram_vectors(codes: np.ndarray, base: np.ndarray, n: int) -> np.ndarray:
    """The n-grams' vectors: the letters' vectors, each rotated by its place, multiplied."""
    out = np.ones((len(codes), base.shape[1]), dtype=np.int8)
    for k in range(n):
        out *= np.roll(base, n - 1 - k, axis=1)[(codes // CLASSES ** (n - 1 - k)) % CLASSES]
    return out


def profile(counts: tuple[np.ndarray, np.ndarray], base: np.ndarray, n: int) -> np.ndarray:
    """The bundle of counted n-grams, in blocks."""
    codes, weight = counts
    total = np.zeros(base.shape[1])
    for lo in range(0, len(codes), 4096):
        total += weight[lo : lo + 4096].astype(np.float64) @ gram_vectors(codes[lo : lo + 4096], base, n).astype(np.float64)
    return total


def learn(docs: DataFrame, settings: Settings = Settings(), held: int = 2) -> dict[str, np.ndarray]:
    """One prototype per language: the bundle of all n-grams of all training texts.

    Learns from every row with a language whose fold is not ``held``. Each task bundles its own rows by language; the
    bundles, one of ``dim`` numbers per language and task, are added up in a shuffle. The driver gets one per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, base = class_table(), letters(settings)
        bundles: dict[str, np.ndarray] = {}
        counts: dict[str, np.ndarray] = {}
        size = CLASSES**settings.n

        def bundle() -> None:
            for lang, c in counts.items():
                seen = np.flatnonzero(c)
                bundles[lang] = bundles.get(lang, 0) + profile((seen, c[seen]), base, settings.n)
            counts.clear()

        for b in batches:
            langs = b.column(0).to_pylist()
            for i in sorted(range(len(langs)), key=langs.__getitem__):  # a language's texts together
                if langs[i] not in counts:
                    if len(counts) == COUNTED:
                        bundle()
                    counts[langs[i]] = np.zeros(size, dtype=np.int32)
                add_counts(counts[langs[i]], codes_of(classes_of(b.column(1)[i].as_py(), table), settings.n))
        bundle()
        for lang, v in bundles.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([v.tolist()], pa.list_(pa.float64()))], names=["lang", "v"])

    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", 4) != held)).select("lang", "text")
    parts = rows.mapInArrow(run, "lang string, v array<double>").select("lang", F.posexplode("v").alias("i", "x"))
    sums = parts.groupBy("lang", "i").agg(F.sum("x").alias("x"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).collect()
    return {r.lang: np.array([y.x for y in r.v]) for r in sorted(found, key=lambda r: r.lang)}


def add_counts(counts: np.ndarray, code: np.ndarray) -> None:
    seen, n = np.unique(code, return_counts=True)
    counts[seen] += n.astype(np.int32)


def predict_texts(texts: list[str | None], names: list[str], unit: np.ndarray, base: np.ndarray, table: np.ndarray, n: int) -> list[tuple[str, float]]:
    """Language and cosine of each text. Texts are bundled as one product of n-gram counts and n-gram vectors."""
    found = [("und", 0.0)] * len(texts)
    codes = [codes_of(c, n) if t and (c := classes_of(t, table)).any() else None for t in texts]
    use = [i for i, c in enumerate(codes) if c is not None and len(c)]
    if not use or not names:
        return found
    every = np.concatenate([codes[i] for i in use])
    seen, at = np.unique(every, return_inverse=True)
    owner = np.repeat(np.arange(len(use)), [len(codes[i]) for i in use])
    sums = np.zeros((len(use), base.shape[1]), dtype=np.float32)
    for lo in range(0, len(seen), 4096):
        inside = (at >= lo) & (at < lo + 4096) if len(seen) > 4096 else slice(None)
        width = min(4096, len(seen) - lo)
        counts = np.bincount(owner[inside] * width + (at[inside] - lo), minlength=len(use) * width).reshape(len(use), width)
        sums += counts.astype(np.float32) @ gram_vectors(seen[lo : lo + width], base, n).astype(np.float32)
    cosine = (sums @ unit.T) / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    best = cosine.argmax(axis=1)
    for k, i in enumerate(use):
        found[i] = (names[best[k]], float(min(1.0, max(0.0, cosine[k, best[k]]))))
    return found


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], settings: Settings = Settings()) -> DataFrame:
    """Rows (doc_id, lang_pred, score): the language whose prototype has the largest cosine with the text's bundle.

    The score is that cosine, at least 0. A text that is null or has no letter gets ``und`` and 0; so does every text
    when no language was learned. Whole texts are read; of ties the first language in code point order wins. Only
    doc_id and text are read.
    """
    names = sorted(prototypes)
    rows = np.array([prototypes[k] for k in names]) if names else np.zeros((0, settings.dim))
    unit = (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, base = class_table(), letters(settings)
        for b in batches:
            found: list[tuple[str, float]] = []
            block: list[str | None] = []
            size = 0
            for x in b.column(1):
                block.append(t := x.as_py())
                size += len(t or "")
                if size > BLOCK or len(block) == TEXTS:
                    found += predict_texts(block, names, unit, base, table, settings.n)
                    block, size = [], 0
            found += predict_texts(block, names, unit, base, table, settings.n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
