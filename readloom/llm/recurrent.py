"""LM scoring by a gated recurrent language model in numpy, with a class-factored output and corpus-wide word counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import fold, stage_table

#: The word that stands for a document's end; no word of a text is empty.
END = ""


@dataclass(frozen=True)
class Settings:
    """Sizes of the model and of its training.

    ``vocabulary`` words, by corpus count, are symbols of the network; all others share the symbol "other" and divide
    its probability by their own corpus counts. ``head`` bounds the counts that are broadcast; the rest is joined.
    ``warm`` documents of at most ``warm_tokens`` tokens are the first, common fit, on the driver. After it every
    task trains on all of its documents. Word counts and all that is derived from them cover every document.
    """

    vocabulary: int = 2047
    head: int = 200_000
    classes: int = 32
    hidden: int = 16
    window: int = 16
    lanes: int = 1024
    warm: int = 300
    warm_tokens: int = 4_000
    warm_epochs: int = 3
    rate: float = 0.12
    seed: int = 17


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (word, c) over all tokens of ``docs``: tasks count their own words, a shuffle adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
            counts.clear()
            return out

        for b in batches:
            texts = b.column(0).cast(pa.binary())
            for t in texts:
                counts.update(words_of(t.as_py()))
            if len(texts):
                counts[END.encode()] += len(texts)
            if len(counts) > 1_000_000:
                yield flush()
        yield flush()

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Layout:
    """Words of the network by falling count, and the output classes: runs of symbols with like sums of square roots of counts."""

    words: list[str]
    edges: np.ndarray

    @property
    def size(self) -> int:
        return len(self.words) + 1

    @property
    def other(self) -> int:
        return len(self.words)


def layout_of(words: list[str], counts: list[int], others: int, s: Settings) -> Layout:
    """Symbol ``len(words)``, "other", is a class of its own; the rest is cut into the remaining classes."""
    mass = np.sqrt(np.maximum(np.array(counts, dtype=float), 1))
    n = min(s.classes - 1, max(1, len(words)))
    cuts = np.searchsorted(np.cumsum(mass), mass.sum() * np.arange(1, n) / n, "left") + 1 if len(words) else np.zeros(0, dtype=int)
    edges = np.unique(np.concatenate([[0], cuts, [len(words), len(words) + 1]]))
    return Layout(words, edges.astype(np.int64))


def exponentials(z: np.ndarray, bias: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the logits ``z + bias`` their exponentials, the ``picked`` one of each row, and the rows' sums. Overwrites ``z``.

    Logits stay far below the 88 at which single precision overflows: states lie in -1..1 and biases are logs of counts.
    """
    z += bias
    np.minimum(z, 80, out=z)
    own = z[np.arange(len(z)), picked]
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], dtype=np.float32)
    return z, own, np.maximum(total, np.float32(1e-37))


class Network:
    """Gated recurrent network. A symbol's probability is its class's times its own within the class."""

    def __init__(self, size: int, edges: np.ndarray, s: Settings):
        rng = np.random.default_rng(s.seed)
        h, k = s.hidden, len(edges) - 1
        self.s, self.size, self.edges = s, size, edges
        self.class_of = (np.searchsorted(edges, np.arange(size), "right") - 1).astype(np.int64)
        f = lambda *shape: (rng.normal(size=shape) / np.sqrt(h)).astype(np.float32)
        z = lambda *shape: np.zeros(shape, dtype=np.float32)
        self.p = {"x": f(size, 3 * h) * 0.3, "u": f(h, 3 * h), "b": z(3 * h), "c": f(h, k) * 0.1, "cb": z(k), "w": f(size, h) * 0.1, "wb": z(size)}
        self.g = {name: np.full(v.shape[:1] if name in ("x", "w", "wb") else v.shape, 1e-6, dtype=np.float32) for name, v in self.p.items()}

    def start(self, counts: np.ndarray) -> None:
        """Output biases at the symbols' corpus frequencies, so that training starts from the unigram model."""
        c = counts + 0.5
        self.p["wb"] = np.log(c).astype(np.float32)
        self.p["cb"] = np.log(np.add.reduceat(c, self.edges[:-1])).astype(np.float32)

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        n = self.s.hidden
        a, r = self.p["x"][x], h @ self.p["u"]
        a += self.p["b"]
        gates = a[:, : 2 * n] + r[:, : 2 * n]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, reset = gates[:, :n], gates[:, n:]
        new = reset * r[:, 2 * n :]
        new += a[:, 2 * n :]
        np.tanh(new, out=new)
        return z, reset, new, r[:, 2 * n :], new + z * (h - new)

    def output(self, h: np.ndarray, y: np.ndarray, learn: bool = False) -> tuple[np.ndarray, np.ndarray | None, dict]:
        """Natural log probabilities of symbols ``y`` after states ``h``; with ``learn`` also gradients of their negative sum."""
        cls = self.class_of[y]
        logp = np.empty(len(y), dtype=np.float32)
        dh = np.empty_like(h) if learn else None
        grads: dict = {}
        for lo in range(0, len(y), 2048):  # blocks that stay in the processor's cache
            part, own = h[lo : lo + 2048], cls[lo : lo + 2048]
            e, picked, total = exponentials(part @ self.p["c"], self.p["cb"], own)
            logp[lo : lo + 2048] = picked - np.log(total)
            if learn:
                every = np.arange(len(own))
                e /= total[:, None]
                e[every, own] -= 1
                grads["c"] = grads.get("c", 0) + part.T @ e
                grads["cb"] = grads.get("cb", 0) + e.sum(axis=0)
                dh[lo : lo + 2048] = e @ self.p["c"].T
        if learn:
            grads["w"], grads["wb"], grads["rows"] = [], [], []
        order = np.argsort(cls.astype(np.uint16), kind="stable")
        cuts = np.searchsorted(cls[order], np.arange(len(self.edges)))
        for k in np.flatnonzero(np.diff(cuts)):
            lo, hi = self.edges[k], self.edges[k + 1]
            if hi - lo == 1:
                continue
            at = order[cuts[k] : cuts[k + 1]]
            own = h[at]
            t = y[at] - lo
            d, picked, total = exponentials(own @ self.p["w"][lo:hi].T, self.p["wb"][lo:hi], t)
            logp[at] += picked - np.log(total)
            if learn:
                d /= total[:, None]
                d[np.arange(len(at)), t] -= 1
                grads["w"].append(d.T @ own)
                grads["wb"].append(d.sum(axis=0))
                grads["rows"].append(np.arange(lo, hi))
                dh[at] += d @ self.p["w"][lo:hi]
        return logp, dh, grads

    def update(self, name: str, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Adagrad; rows of the large tables share one rate each."""
        np.clip(grad, -5, 5, out=grad)
        if rows is None:
            self.g[name] += grad * grad
            self.p[name] -= self.s.rate * grad / np.sqrt(self.g[name])
        elif grad.ndim == 1:
            self.g[name][rows] += grad * grad
            self.p[name][rows] -= self.s.rate * grad / np.sqrt(self.g[name][rows])
        else:
            self.g[name][rows] += (grad * grad).mean(axis=1)
            self.p[name][rows] -= self.s.rate * grad / np.sqrt(self.g[name][rows])[:, None]

    def train(self, texts: list[np.ndarray]) -> int:
        """One pass of backpropagation, truncated to ``window`` steps, over texts that end with symbol END.

        Lanes run side by side, each through its own texts in random order; the state is carried from window to window
        and set to zero where a text begins. A text far longer than the others' share of a lane is learned in pieces, so
        that all lanes end together and no text alone drives the last steps.
        """
        n = self.s.hidden
        total = sum(len(t) for t in texts)
        if not total:
            return 0
        count = int(np.clip(total // 2000, min(16, len(texts)), self.s.lanes))
        longest = max(4 * self.s.window, total // (4 * count))
        pieces = [(t, lo) for t in texts for lo in range(0, len(t), longest)]
        lanes: list[list[tuple[np.ndarray, int]]] = [[] for _ in range(count)]
        load = np.zeros(count, dtype=np.int64)
        for i in np.random.default_rng(self.s.seed).permutation(len(pieces)):
            k = int(load.argmin())
            lanes[k].append(pieces[i])
            load[k] += min(longest, len(pieces[i][0]) - pieces[i][1])
        steps = int(load.max())
        y = np.full((steps, count), -1, dtype=np.int32)
        x = np.zeros((steps, count), dtype=np.int32)
        begin = np.zeros((steps, count), dtype=bool)
        for k, own in enumerate(lanes):
            at = 0
            for t, lo in own:
                part = t[lo : lo + longest]
                y[at : at + len(part), k] = part
                x[at + 1 : at + len(part), k] = part[:-1]
                x[at, k] = t[lo - 1]  # the end before a text's first symbol
                begin[at, k] = True
                at += len(part)
        h = np.zeros((count, n), dtype=np.float32)
        live = np.arange(count)
        whole = x, y, begin
        for lo in range(0, steps, self.s.window):
            hi = min(steps, lo + self.s.window)
            on = whole[1][lo, live] >= 0
            if not on.all():
                live, h = live[on], h[on]
            x, y, begin = (z[lo:hi] if len(live) == count else z[lo:hi, live] for z in whole)
            saved, states = [], []
            for t in range(hi - lo):
                h = h * ~begin[t][:, None]
                now = self.step(np.maximum(x[t], 0), h)
                saved.append((h, *now[:4]))
                h = now[4]
                states.append(h)
            states = np.stack(states)
            use = y >= 0
            full = use.all()
            _, dh, grads = self.output(states.reshape(-1, n) if full else states[use], y.ravel() if full else y[use], learn=True)
            scale = np.float32(1 / max(1, use.sum()) ** 0.5)
            if full:
                back = dh.reshape(states.shape)
            else:
                back = np.zeros_like(states)
                back[use] = dh
            carry = np.zeros_like(h)
            dx = np.empty((hi - lo, y.shape[1], 3 * n), dtype=np.float32)
            inner = np.empty_like(dx)
            for t in range(hi - lo - 1, -1, -1):
                before, z, reset, new, r = saved[t]
                d = carry + back[t]
                rest = 1 - z
                dn = d * rest
                dn *= 1 - new * new
                g, own = dx[t], inner[t]
                rest *= z
                rest *= before - new
                np.multiply(d, rest, out=g[:, :n])
                r = r * dn
                r *= reset
                np.multiply(r, 1 - reset, out=g[:, n : 2 * n])
                g[:, 2 * n :] = dn
                own[:, : 2 * n] = g[:, : 2 * n]
                np.multiply(dn, reset, out=own[:, 2 * n :])
                d *= z
                d += own @ self.p["u"].T
                d *= ~begin[t][:, None]
                carry = d
            du = np.stack([s[0] for s in saved]).reshape(-1, n).T @ inner.reshape(-1, 3 * n)
            rows = np.maximum(x, 0).ravel()
            flat = dx.reshape(-1, 3 * n)
            order = np.argsort(rows.astype(np.uint16) if self.size <= 1 << 16 else rows, kind="stable")  # of 16 bits by radix
            seen, first = np.unique(rows[order], return_index=True)
            self.update("x", np.add.reduceat(flat[order], first, axis=0) * scale, seen)
            self.update("u", du * scale)
            self.update("b", flat.sum(axis=0) * scale)
            self.update("c", grads["c"] * scale)
            self.update("cb", grads["cb"] * scale)
            if grads["rows"]:
                rows = np.concatenate(grads["rows"])
                self.update("w", np.concatenate(grads["w"]) * scale, rows)
                self.update("wb", np.concatenate(grads["wb"]) * scale, rows)
        return int(load.sum())

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each whole text; its state runs from its first symbol to its END."""
        out = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for lo in range(0, len(order), 2048):
            part = order[lo : lo + 2048]
            size = np.array([len(texts[i]) for i in part])
            end = texts[part[0]][-1] if len(texts[part[0]]) else 0
            h = np.zeros((len(part), self.s.hidden), dtype=np.float32)
            last = np.full(len(part), end, dtype=np.int64)
            for at in range(0, int(size[0]), 16):
                live = int(np.searchsorted(-size, -at, "left"))  # texts longer than ``at`` come first
                h, last = h[:live], last[:live]
                states, wanted, owner = [], [], []
                for t in range(at, min(at + 16, int(size[0]))):
                    m = int(np.searchsorted(-size, -t, "left"))
                    if m == 0:
                        break
                    now = self.step(last[:m], h[:m])[4]
                    h[:m] = now
                    last[:m] = [texts[i][t] for i in part[:m]] if m < 8 else self._column(texts, part, t, m)
                    states.append(now)
                    wanted.append(last[:m].copy())
                    owner.append(np.arange(m))
                logp, _, _ = self.output(np.concatenate(states), np.concatenate(wanted))
                out[part] += np.bincount(np.concatenate(owner), weights=logp, minlength=len(part))
        return out

    def _column(self, texts: list[np.ndarray], part: list[int], t: int, m: int) -> np.ndarray:
        """Symbol ``t`` of the first ``m`` texts of a part, from one flat copy of the part."""
        if getattr(self, "_flat_of", None) is not part:
            self._flat_of = part
            self._flat = np.concatenate([texts[i] for i in part])
            self._heads = np.cumsum([0, *(len(texts[i]) for i in part[:-1])])
        return self._flat[self._heads[:m] + t]


class Head(dict):
    """Places of words; -1 for all others."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Model:
    """What scoring needs: counts of the head's words, the network's layout and parameters, and corpus sums."""

    head: Head
    counts: np.ndarray
    layout: Layout
    settings: Settings
    tokens: int
    distinct: int
    parameters: dict[str, np.ndarray] | None = None
    gradients: dict[str, np.ndarray] | None = None

    def network(self) -> Network:
        net = Network(self.layout.size, self.layout.edges, self.settings)
        if self.parameters is None:
            own = self.counts[: len(self.layout.words)]
            net.start(np.concatenate([own, [max(0, self.tokens - own.sum())]]))
        else:
            net.p = {k: v.copy() for k, v in self.parameters.items()}
        if self.gradients is not None:  # the steps that the first fit had come down to
            net.g = {k: v.copy() for k, v in self.gradients.items()}
        return net

    @property
    def base_scale(self) -> float:
        return float(np.log10(self.tokens + 0.5 * (self.distinct + 1)))

    @property
    def other_scale(self) -> float:
        """Log of what the words outside the network's vocabulary divide among them."""
        n = len(self.layout.words)
        return float(np.log10(self.tokens - self.counts[:n].sum() + 0.5 * (self.distinct - n + 1)))

    def places(self, text: bytes | None) -> tuple[list[bytes], np.ndarray]:
        """The tokens, of which the last is the end, and each one's place in the head, or -1."""
        words = words_of(text)
        words.append(END.encode())
        return words, np.fromiter(map(self.head.__getitem__, words), np.int64, len(words))

    @property
    def kind(self) -> np.dtype:
        """How symbols are stored."""
        return np.dtype("<u2" if self.layout.size <= 1 << 16 else "<u4")

    def symbols(self, places: np.ndarray) -> np.ndarray:
        return np.where((places >= 0) & (places < len(self.layout.words)), places, self.layout.other).astype(self.kind)

    def stored(self, column: pa.Array) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), dtype=self.kind) for x in column]


def frequent(counts: DataFrame, most: int) -> list:
    """The most frequent words, at most ``most``, in falling order of count.

    A histogram over sixteenths of powers of two, some hundred rows, gives the count from which words are few enough; so
    tasks send no more than that to the driver, however many they are.
    """
    level = F.floor(F.log2("c") * 16)
    n, least = 0, None
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r.level):
        if n + r.n > most:
            break
        n, least = n + r.n, r.level
    if least is None:  # no word, or too many of one level
        return counts.orderBy(F.desc("c"), "word").limit(most).collect()
    return sorted(counts.where(level >= least).collect(), key=lambda r: (-r.c, r.word))


def training(docs: DataFrame, held: int = 1) -> DataFrame:
    return docs.where(fold("doc_id", 5) != held)


def described(counts: DataFrame, settings: Settings = Settings()) -> Model:
    """A model without parameters: what the word counts ``counts`` fix."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = frequent(counts, settings.head)
    words = [r.word for r in top[: settings.vocabulary]]
    if top and END not in words:  # the end is always a symbol
        end = next((r for r in top if r.word == END), None) or counts.where(F.col("word") == END).first()
        top = [r for r in top if r.word != END]
        top.insert(settings.vocabulary - 1, end)
        words = [r.word for r in top[: settings.vocabulary]]
    numbers = np.array([r.c for r in top], dtype=np.int64)
    layout = layout_of(words, [r.c for r in top[: len(words)]], int(total.n) - int(numbers[: len(words)].sum()), settings)
    return Model(Head((r.word.encode(), i) for i, r in enumerate(top)), numbers, layout, settings, int(total.n), int(total.v))


def tokenised(docs: DataFrame, model: Model) -> DataFrame:
    """One stored row per row of ``docs``: its symbols, the sums that its frequent words make, and its rare words with their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        logs = np.log10(m.counts + 0.5)
        n = len(m.layout.words)
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                rows, kept, words_of_all, times = [], [], [], []
                for t in part.column(2).cast(pa.binary()).to_pylist():
                    words, at = m.places(t)
                    rare = Counter(map(words.__getitem__, np.flatnonzero(at < 0).tolist()))
                    known = at[at >= 0]
                    other = known[known >= n]
                    rows.append((len(at), len(known), logs[known].sum(), logs[other].sum(), len(at) - len(known) + len(other), len(rare)))
                    kept.append(m.symbols(at).tobytes())
                    words_of_all += rare
                    times += rare.values()
                sums = np.array(rows).T
                ends = pa.array(np.concatenate([[0], np.cumsum(sums[5])]).astype(np.int32))
                columns = [pa.array(x if 1 < i < 4 else x.astype(np.int64)) for i, x in enumerate(sums[:5])]
                columns += [pa.ListArray.from_arrays(ends, x) for x in (pa.array(words_of_all, pa.binary()).cast(pa.string()), pa.array(times, pa.int32()))]
                columns.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=["row", "doc_id", "n_tokens", "known", "logs", "other_logs", "others", "words", "times", "symbols"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "row long, doc_id long, n_tokens long, known long, logs double, other_logs double, others long, words array<string>, times array<int>, symbols binary"
    return stage_table(rows.mapInArrow(run, kinds), "lm-rows")


def learn(docs: DataFrame, counts: DataFrame, settings: Settings = Settings()) -> Model:
    """The model of the training documents ``docs`` with word counts ``counts``."""
    model = described(counts, settings)
    return fitted(tokenised(docs, model), model)


def fitted(rows: DataFrame, model: Model) -> Model:
    """``model`` with parameters learned from the tokenised ``rows``.

    A first fit on at most ``warm`` documents gives all tasks one start. Each task then passes once over all of its own
    documents, and the parameters are averaged, weighted by tokens, in a shuffle by blocks of parameters. So the model,
    and with it ``score``, depends on how the table is partitioned; word counts and base scores do not.
    """
    spark, settings = rows.sparkSession, model.settings
    if not len(model.counts):
        return model
    # A share of the hashes gives some twice as many rows as are wanted, from all tasks together.
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 30))
    share = min(1 << 30, (2 * settings.warm << 30) // max(1, rows.count()))
    warm = rows.where((F.col("n_tokens") <= settings.warm_tokens) & (drawn <= share)).orderBy(drawn, "doc_id", F.xxhash64("symbols")).select("symbols").limit(settings.warm).collect()
    net = model.network()
    for _ in range(settings.warm_epochs):
        net.train([np.frombuffer(bytes(r.symbols), dtype=model.kind) for r in warm])
    model.parameters, model.gradients = net.p, net.g
    shared = spark.sparkContext.broadcast(model)
    shapes = {k: v.shape for k, v in net.p.items()}
    block = 1 << 12

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        own = m.network()
        seen = 0
        for b in batches:
            seen += own.train(m.stored(b.column(0)))
        if seen:  # a task without documents has no say
            flat = np.concatenate([own.p[k].ravel() for k in shapes])
            parts = [flat[lo : lo + block].tobytes() for lo in range(0, len(flat), block)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([float(seen)] * len(parts)), pa.array(parts, pa.binary())], names=["block", "weight", "p"])

    def average(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(w * np.frombuffer(p, dtype=np.float32).astype(float) for w, p in zip(rows.weight, rows.p, strict=True))
        return pd.DataFrame({"block": rows.block[:1], "p": [(total / rows.weight.sum()).astype(np.float32).tobytes()]})

    parts = rows.select("symbols").mapInArrow(run, "block int, weight double, p binary")
    found = parts.groupBy("block").applyInPandas(average, "block int, p binary").collect()  # one set of parameters
    if not found:
        return model
    flat = np.concatenate([np.frombuffer(bytes(r.p), dtype=np.float32) for r in sorted(found, key=lambda r: r.block)])
    at = 0
    model.parameters, model.gradients = {}, None
    for k, shape in shapes.items():
        n = int(np.prod(shape))
        model.parameters[k] = flat[at : at + n].reshape(shape).copy()
        at += n
    return model


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Rows (doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``, from its whole text.

    The network reads a document from its first token to its end, in windows between which the state is carried. A token
    outside its vocabulary has the probability of "other" times the word's share among the other words, (c + 0.5) over
    their sum with 0.5 for each distinct word and one unseen. Counts of rare words come by a join, so no table of all
    words is broadcast. A null or empty text is its end alone. With no training tokens every base is 0. Rows that
    repeat are scored alike. Only doc_id and text are read.
    """
    return scored(tokenised(docs, model), model, counts)


def scored(rows: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``score`` of the tokenised ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        net = m.network()
        for b in batches:
            for lo in range(0, b.num_rows, 8192):
                part = b.slice(lo, 8192)
                p = net.score(m.stored(part.column(n))) / np.log(10)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n)), pa.array(p)], names=[*names, "p"])

    names = ["row", "doc_id", "n_tokens", "known", "logs", "other_logs", "others"]
    n = len(names)
    found = rows.select(*names, "symbols").mapInArrow(run, "row long, doc_id long, n_tokens long, known long, logs double, other_logs double, others long, p double")
    rare = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    rare = rare.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    rare = rare.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("rare_logs"))
    zero = F.lit(0)
    logs = F.coalesce("rare_logs", F.lit(0.0))
    return found.join(rare, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", zero)).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * F.lit(model.base_scale)).alias("base_score"),
        (F.col("p") + F.col("other_logs") + logs - F.col("others") * F.lit(model.other_scale)).alias("score"),
    )


def score_documents(docs: DataFrame, settings: Settings = Settings(), held: int = 1) -> DataFrame:
    """Scores of all rows by a model of those whose fold is not ``held``. Texts are cut into tokens once for the counts and once for both passes."""
    counts = stage_table(word_counts(training(docs, held)), "word-counts")
    model = described(counts, settings)
    rows = tokenised(docs, model)
    return scored(rows, fitted(training(rows, held), model), counts)
