"""Document fingerprints by consistent weighted sampling: signatures that collide as generalised Jaccard likeness."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import islice
from sys import byteorder

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Key of a row without doc_id in the descending order: behind all others.
LOWEST = -(2**63)


@dataclass(frozen=True)
class Settings:
    """``samples`` per signature; ``cached`` bounds the words whose draws a task keeps (12 bytes per word and sample).

    A text's words are drawn and compared ``slice`` at a time, so that memory does not grow with their number.
    """

    samples: int = 128
    seed: int = 3
    cached: int = 50_000
    slice: int = 2_048


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: a uniform value per input."""
    y = x >> np.uint64(30)
    y ^= x
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(27)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


class Sampler:
    """Draws per word: r and c from Gamma(2, 1), b uniform, as functions of the word's hash and the sample's number."""

    def __init__(self, s: Settings):
        self.s = s
        step = np.arange(1, s.samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.steps = [mixed(step + np.uint64(s.seed * 3 + i)) for i in range(3)]
        self.places: dict[bytes, int] = {}
        self.width = max(1, min(s.slice, s.cached))
        self.room = 0
        self.grow(1024)

    def grow(self, room: int) -> None:
        """Tables of ``room`` rows, with the rows that are there."""
        old, self.room, n = self.places and (self.hashes, self.r, self.b, self.first), room, len(self.places)
        self.hashes = np.zeros(room, dtype=np.uint64)
        self.r, self.b, self.first = (np.zeros((room, self.s.samples), dtype=np.float32) for _ in range(3))
        for new, kept in zip((self.hashes, self.r, self.b, self.first), old or (), strict=False):
            new[:n] = kept[:n]

    def draw(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """r, b and the value ``ln c + r b - r`` that a word of weight 1 takes; three 64-bit numbers give five uniform ones."""
        half, unit = np.float32(0.5), np.float32(2.0**-32)

        def uniform(x: np.ndarray, part: int) -> np.ndarray:
            """The low or high half of 64-bit numbers, as a number above 0 and up to 1."""
            u = x.view(np.uint32)[:, (part ^ (byteorder == "big")) :: 2].astype(np.float32)
            u += half
            u *= unit
            return u

        x, y, z = (mixed(hashes[:, None] ^ steps) for steps in self.steps)
        r, c = (-np.log(uniform(v, 1) * uniform(v, 0)) for v in (x, y))
        b = np.minimum(uniform(z, 1), np.float32(1 - 2**-24))
        return r, b, np.log(c) + r * b - r

    def add(self, words: Collection[bytes]) -> None:
        """Keeps the draws of the words that it does not have yet; words as they were drawn give the same again."""
        words = list(words)
        for lo in range(0, len(words), self.width):
            self.look_up(words[lo : lo + self.width])

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """Rows of the tables that hold the draws of at most ``width`` words; those not there yet are drawn."""
        found = list(map(self.places.get, words))
        if None in found:
            new = [w for w, at in zip(words, found, strict=True) if at is None]
            if len(self.places) + len(new) > self.s.cached:
                self.places.clear()
                new = words
            lo, hi = len(self.places), len(self.places) + len(new)
            if hi > self.room:
                self.grow(max(hi, min(2 * self.room, self.s.cached)))
            self.places.update(zip(new, range(lo, hi), strict=True))
            self.hashes[lo:hi] = [xxhash.xxh64_intdigest(w, self.s.seed) for w in new]
            for at in range(lo, hi, 256):  # temporaries of a draw stay in the processor's cache
                part = slice(at, min(at + 256, hi))
                self.r[part], self.b[part], self.first[part] = self.draw(self.hashes[part])
            found = list(map(self.places.__getitem__, words))
        return np.array(found, dtype=np.int64)

    def least(self, words: list[bytes], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of a slice of words, per sample: the least draw, and the hash of the word and quantised weight that give it."""
        at = self.look_up(words)
        value = self.first[at]
        heavy = np.flatnonzero(weight > 1)
        level = None
        if len(heavy):
            r, b = self.r[at[heavy]], self.b[at[heavy]]
            level = np.floor(np.log(weight[heavy])[:, None] / r + b)
            value[heavy] -= r * level  # ln y = r (t - b)
        best = value.argmin(axis=0)
        t = np.zeros(self.s.samples, dtype=np.uint64)
        if level is not None:
            place = np.full(len(at), -1)
            place[heavy] = np.arange(len(heavy))
            k = np.flatnonzero(place[best] >= 0)
            t[k] = level[place[best[k]], k].astype(np.int64).astype(np.uint64)
        return value[best, np.arange(self.s.samples)], mixed(self.hashes[at[best]] ^ (t * np.uint64(0x9E3779B97F4A7C15)))

    def signature(self, counts: Counter) -> np.ndarray:
        """For each sample the word, and its quantised weight, whose draw is least: 16 bits of their hash.

        The words go slice by slice; a running minimum keeps the least draw so far, of equal ones the first.
        """
        if not counts:
            return np.full(self.s.samples, 0xFFFF, dtype=np.uint16)
        rest, weights = iter(counts), iter(counts.values())
        least = found = None
        while words := list(islice(rest, self.width)):
            value, hashed = self.least(words, np.fromiter(islice(weights, self.width), np.float32, len(words)))
            if least is None:
                least, found = value, hashed
            else:
                better = value < least
                least[better], found[better] = value[better], hashed[better]
        return (found >> np.uint64(48)).astype(np.uint16)


def edited(text: str, following: str) -> str:
    """The last third of the text's code points, rounded down, replaced by the first as many (or all) of the next text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def hexed(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def spread_by_id(docs: DataFrame) -> DataFrame:
    """Rows (bucket, extra, doc_id, text) so that each bucket holds a run of the descending order and what follows it.

    The order is by doc_id, then a hash of the text. Quantiles of doc_id cut it into some one bucket per shuffle
    partition, so that texts move once and no bucket is large; a doc_id that several quantiles fall on, such as null
    in a table with few ids, is cut further by the hash. Each bucket also gets, as ``extra``, the row that follows its
    last one: the first of the next bucket that has rows, and for the last bucket the first of all. Only cut points and
    the head of each bucket pass the driver.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("key"), F.xxhash64(text).alias("turn"), "doc_id", text.alias("text"))
    cuts = Counter(rows.agg(F.percentile_approx(F.col("key").cast("double"), [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or [0.0])
    # Ranges of keys from ``low`` on, and how many buckets each is cut into; a frequent key is a range of its own.
    pieces = {-float("inf"): 1}
    for cut, times in sorted(cuts.items()):
        pieces[cut] = times
        if times > 1:
            pieces.setdefault(float(np.nextafter(cut, np.inf)), 1)
    pieces |= {cut: times for cut, times in cuts.items()}
    low = sorted(pieces)
    first = np.cumsum([0, *(pieces[x] for x in low)]).tolist()
    ranges = Bucketizer(splits=[*low, float("inf")], inputCol="key_d", outputCol="range_d")
    numbered = ranges.transform(rows.withColumn("key_d", F.col("key").cast("double"))).withColumn("range", F.col("range_d").cast("int"))
    of = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("range") + 1)
    share = F.col("turn").cast("double") / 2.0**64 + 0.5
    inner = F.least(F.floor(share * of(pieces[x] for x in low)), of(pieces[x] for x in low) - 1).cast("int")
    numbered = numbered.withColumn("bucket", of(first[:-1]) + inner)
    heads = sorted((r.bucket, r.head.key, r.head.turn) for r in numbered.groupBy("bucket").agg(F.max(F.struct("key", "turn")).alias("head")).collect())
    # A bucket's first row also goes to the bucket above it, the top bucket's to the lowest.
    also = [(key, turn, heads[(i + 1) % len(heads)][0], True) for i, (_, key, turn) in enumerate(heads)]
    extra = spark.createDataFrame(also, "key long, turn long, bucket int, extra boolean")
    extra = numbered.drop("bucket").join(F.broadcast(extra), ["key", "turn"])  # one row per bucket
    extra = extra.groupBy("bucket", "extra", "key", "turn", "doc_id").agg(F.min("text").alias("text"))  # of equal heads one
    columns = ["bucket", "extra", "key", "turn", "doc_id", "text"]
    both = numbered.withColumn("extra", F.lit(False)).select(*columns).unionByName(extra.select(*columns))
    return both.repartitionById(first[-1], F.col("bucket")).sortWithinPartitions("bucket", "extra", F.desc("key"), F.desc("turn"), "text")


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses, as ``doc_id, n_chars, edited_sha256, ...``.

    Terms are words (runs without ASCII white space), their weights the numbers of times they occur. Consistent
    weighted sampling picks, per sample, the term with the least ``c / (y e^r)``, y being its weight rounded down to a
    power grid of random step and phase; two texts agree on a sample with probability sum of least over sum of greatest
    weights. A fingerprint is 16 bits per sample in hex; likeness is the share of equal samples.

    The next document is the one behind in descending doc_id, after the last the first. A null text counts as empty; a
    text without words has all bits set, and so equals other such texts. A null doc_id comes last. Rows that repeat a
    doc_id are ordered by a hash of their text; a single row is its own next. Empty tables give empty results. Only
    doc_id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(settings)
        held = None  # the row before: bucket, doc_id, text, word counts, signature
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for b in batches:
            out: list[tuple] = []
            for bucket, extra, doc_id, text in zip(*(b.column(i) for i in range(4)), strict=True):
                bucket, extra, doc_id, text = bucket.as_py(), extra.as_py(), doc_id.as_py(), text.as_py()
                if held is not None and held[0] != bucket:
                    held = None
                if held is None and extra:
                    continue
                counts = Counter(text.encode().split())
                own = sampler.signature(counts)
                if held is not None:
                    changed = edited(held[2], text)
                    raw = changed.encode()
                    words = Counter(raw.split())
                    other = sampler.signature(words)
                    out.append((held[1], len(held[2]), sha256(raw).hexdigest(), hexed(held[3]), hexed(other), float((held[3] == other).mean()), float((held[3] == own).mean())))
                held = None if extra else (bucket, doc_id, text, own)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    if docs.isEmpty():
        rows = docs.select(F.lit(0).alias("bucket"), F.lit(True).alias("extra"), "doc_id", "text").limit(0)
    else:
        rows = spread_by_id(docs).select("bucket", "extra", F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
