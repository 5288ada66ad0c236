"""Quality classifier: hashed word and n-gram vectors averaged per document, softmax output, numpy SGD."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import fold, fresh


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows that are fitted; all rows are scored. The rest are the model's sizes.

    Few rows are passed more than ``epochs`` times, until ``least_steps`` steps are done: with fewer steps the fit stops near
    the share of label 1, on whose one side all scores then lie.
    """

    sample: int = 3000
    buckets: int = 1 << 17
    dim: int = 12
    shortest: int = 2
    longest: int = 4
    epochs: int = 8
    least_steps: int = 8000
    rate: float = 2.0
    bias_rate: float = 0.02
    seed: int = 11
    word_cache: int = 400_000
    block_bytes: int = 2_000_000


@dataclass(frozen=True)
class Model:
    """Each bucket's log-odds contribution to label 1, and the bias."""

    odds: np.ndarray
    bias: float


def words_of(text: bytes | None) -> list[bytes]:
    """The text's words; a text without any is one empty word, which has subwords as any other and is in no word n-gram."""
    return (text or b"").split() or [b""]


def subwords(word: bytes, s: Settings) -> list[int]:
    """Buckets of the word itself and of its n-grams, with ``<`` and ``>`` as its ends."""
    w = b"<" + word + b">"
    grams = [w[i : i + n] for n in range(s.shortest, s.longest + 1) for i in range(len(w) - n + 1)]
    return [crc32(g) % s.buckets for g in (w + b"w", *grams)]


def pair_buckets(first: np.ndarray, second: np.ndarray, s: Settings) -> np.ndarray:
    """Buckets of pairs of neighbouring words, from the words' hashes."""
    x = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    return ((x >> np.uint64(32)) % np.uint64(s.buckets)).astype(np.int64)


def ends_of(word: bytes) -> tuple[int, int, int, int]:
    """The word's last and first one and two bytes as numbers that no word's hash equals."""
    parts = (word[-1:], word[-2:], word[:1], word[:2])
    return tuple(int.from_bytes(x, "big") | len(x) << 40 for x in parts)


def joint_buckets(ends: np.ndarray, s: Settings) -> tuple[np.ndarray, ...]:
    """Buckets of the character n-grams that span the space between neighbouring words, of three characters and twice of four."""
    last, first = ends[:-1], ends[1:]
    return tuple(pair_buckets(last[:, i], first[:, j], s) for i, j in ((0, 2), (0, 3), (1, 2)))


def features(text: bytes | None, s: Settings, known: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of each among all its features."""
    words = words_of(text)
    for w in words:
        if w not in known:
            known[w] = np.array(subwords(w, s), dtype=np.int64)
    hashes = np.fromiter(map(crc32, words), np.uint64, len(words))
    ends = np.array([ends_of(w) for w in words], dtype=np.uint64)
    every = np.concatenate([*(known[w] for w in words), pair_buckets(hashes[:-1], hashes[1:], s), *joint_buckets(ends, s)])
    ids, counts = np.unique(every, return_counts=True)
    return ids.astype(np.int32), (counts / len(every)).astype(np.float32)


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: list[int], s: Settings) -> Model:
    """Stochastic gradient descent over the documents' features, one document a step.

    A document's vector is the mean of its feature vectors and its output the softmax of ``mean @ out + bias``. As the
    output is linear in that mean, one number per bucket, ``vectors @ (out[:, 1] - out[:, 0])``, holds all that scoring
    needs. Without labelled rows, all numbers are 0 and every score 0.5.
    """
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.dim, 1 / s.dim, (s.buckets, s.dim)).astype(np.float32)
    out, bias = np.zeros((s.dim, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    epochs = max(s.epochs, -(-s.least_steps // max(1, len(docs))))
    steps, done = max(1, len(docs) * epochs), 0
    for _ in range(epochs if docs else 0):
        for i in rng.permutation(len(docs)):
            ids, share = docs[i]
            rest, done = 1 - done / steps, done + 1
            mean = share @ vectors[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            bias -= s.bias_rate * rest * p
            out -= s.rate * rest * np.outer(mean, p)
            vectors[ids] -= s.rate * rest * share[:, None] * back
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


class Scorer:
    """Scores texts block by block; of each word that it meets it keeps the sum over its features, their number, the word's hash and its ends."""

    def __init__(self, model: Model, s: Settings):
        self.model, self.s = model, s
        self.known: dict[bytes, int] = {}
        self.sums, self.sizes, self.hashes = np.zeros(1024), np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.uint64)
        self.ends = np.zeros((1024, 4), dtype=np.uint64)

    def place(self, word: bytes) -> int:
        at = self.known.get(word)
        if at is None:
            at = self.known[word] = len(self.known)
            if at == len(self.sums):
                self.sums, self.sizes, self.hashes, self.ends = (np.concatenate([x, np.zeros_like(x)]) for x in (self.sums, self.sizes, self.hashes, self.ends))
            ids = subwords(word, self.s)
            self.sums[at], self.sizes[at], self.hashes[at] = self.model.odds[ids].sum(), len(ids), crc32(word)
            self.ends[at] = ends_of(word)
        return at

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """Probability of label 1 per text."""
        if not texts:
            return np.zeros(0)
        if len(self.known) > self.s.word_cache:
            self.known.clear()
        words = [words_of(t) for t in texts]
        n = np.array([len(w) for w in words])
        starts = np.cumsum(n) - n
        at = np.fromiter(map(self.place, chain.from_iterable(words)), np.int64, int(n.sum()))
        pairs = np.zeros(len(at))
        hashes = self.hashes[at]
        pairs[:-1] = self.model.odds[pair_buckets(hashes[:-1], hashes[1:], self.s)]
        for found in joint_buckets(self.ends[at], self.s):
            pairs[:-1] += self.model.odds[found]
        pairs[starts + n - 1] = 0  # the last word of a text has no neighbour
        total = np.add.reduceat(self.sums[at] + pairs, starts)
        return 1 / (1 + np.exp(-total / (np.add.reduceat(self.sizes[at], starts) + 4 * (n - 1)) - self.model.bias))


def labelled_sample(docs: DataFrame, labels: DataFrame, keep: Settings, held: int = 2) -> DataFrame:
    """At most ``keep.sample`` training rows (doc_id, quality, text): the doc_ids with the smallest hash.

    A document marked both 0 and 1 counts as 0; of rows that repeat a doc_id the text with the smallest hash is taken.
    So the sample does not depend on how the tables are partitioned.
    """
    training = F.col("doc_id").isNotNull() & (fold("doc_id", 4) != held)
    ids = labels.where(F.col("quality").isNotNull() & training).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = docs.where(training).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = ids.join(rows.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id", F.lit(keep.seed)), "doc_id").limit(keep.sample)
    rows = rows.join(F.broadcast(ids), "doc_id")  # ids: at most keep.sample rows
    return rows.groupBy("doc_id", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on the labelled sample.

    Tasks turn its texts into features, at most one per bucket; the driver fits those of ``settings.sample`` rows at most,
    from one Arrow table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                found = []
                for t in part.column(2).cast(pa.binary()):
                    found.append(features(t.as_py(), settings, known))
                    if len(known) > settings.word_cache // 8:
                        known.clear()
                parts = [pa.array([x[i].tobytes() for x in found], pa.binary()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *parts], names=["doc_id", "label", "ids", "share"])

    rows = labelled_sample(docs, labels, settings).select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") != 0).cast("int").alias("label"), "text")
    found = rows.mapInArrow(run, "doc_id long, label int, ids binary, share binary").toArrow()
    order = np.argsort(found["doc_id"].to_numpy())
    # Arrays over the table's own bytes: rows of Python objects would hold all features in the JVM and here several times over.
    ids, share = (found[c] for c in ("ids", "share"))
    pairs = [(np.frombuffer(ids[i].as_buffer(), dtype=np.int32), np.frombuffer(share[i].as_buffer(), dtype=np.float32)) for i in order.tolist()]
    return fit(pairs, found["label"].to_numpy()[order].tolist(), settings)


def score(docs: DataFrame, model: Model, settings: Settings = Settings(), keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The ``keep`` columns and ``name`` (probability of label 1) of every row.

    Every whole text is scored; a null, empty or blank text is one empty word. Only ``text`` and the ``keep`` columns are
    read; ``name`` may be none of them. Repeated rows score alike. An empty table gives an empty result.
    """
    if name.lower() in map(str.lower, keep):
        raise ValueError(f"{name} is a kept column")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket: settings.buckets * 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, settings)
        for b in batches:
            texts = b.column(text).cast(pa.binary())
            found, block, size = [], [], 0
            for x in texts:
                block.append(t := x.as_py())
                size += len(t or b"")
                if size > settings.block_bytes:
                    found.append(scorer.score(block))
                    block, size = [], 0
            found.append(scorer.score(block))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(np.concatenate(found), pa.float64())], names=[*names, name])

    names, n = list(keep), len(keep)
    # The text crosses to Python once, as one of the kept columns or behind them.
    text = fresh("text", keep)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias(text))
    if "text" in keep:
        rows, text = rows.drop(text), "text"
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:n])
    return rows.mapInArrow(run, f"{kinds}, `{name}` double")
