"""Personal data: spans by pattern, and more by a bidirectional character LSTM with CRF transitions, trained from them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed values of the contract: kinds in order.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match cannot begin inside a run of digits whose start does not match, so starts there are passed over.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
Span = tuple[int, int, int]


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the training windows of ``length`` characters per kind, and those without a span to twice that.

    ``window`` and ``overlap`` are characters; a task holds the windows of some ``block`` characters, ``lanes`` at once.
    A span of the model needs ``margin`` in log odds over no span, ``least`` characters or more.
    """

    sample: int = 600
    length: int = 96
    hidden: int = 12
    steps: int = 320
    batch: int = 64
    rate: float = 0.02
    seed: int = 5
    window: int = 512
    overlap: int = 64
    block: int = 1_000_000
    lanes: int = 512
    margin: float = 4.0
    least: int = 6


# --- patterns ---------------------------------------------------------------------------------------------------------


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their ``@``: the local part is all that may stand before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        if at > end and text[at - 1] in LOCAL and (m := DOMAIN.match(text, at + 1)):
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            end = m.end()
            yield start, end
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) << (i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def number_places(text: str, piece: int = 1 << 20) -> Iterator[tuple[int, int, int]]:
    """Rows (start, end, digits): stretches of digits with at most one other character between two of them."""
    parts = []
    for lo in range(0, len(text), piece):
        own = text[lo : lo + piece]
        x = np.frombuffer(own.encode(), dtype=np.uint8) if own.isascii() else np.frombuffer(own.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        parts.append(lo + np.flatnonzero((x >= 48) & (x <= 57)))
    at = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    if len(at):
        first = np.flatnonzero(np.append(True, np.diff(at) > 2))
        last = np.append(first[1:], len(at)) - 1
        yield from zip(at[first].tolist(), (at[last] + 1).tolist(), (last - first + 1).tolist(), strict=True)


def passes(kind: int, text: str) -> bool:
    """The kind's check of a text's numbers, whatever stands between them."""
    numbers = re.findall("[0-9]+", text)
    digits = "".join(numbers)
    if kind == 1:
        return len(numbers) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in numbers)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 if kind == 3 else True


def candidates(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """Rows (start, end, kind, passed) of every kind's leftmost non-overlapping matches, but for numbers too short to pass.

    Addresses and cards lie within stretches of digits, so nothing else is searched for them.
    """
    for s, e in emails(text):
        yield s, e, 0, True
    for lo, hi, n in number_places(text):
        if n >= 4:
            for m in ADDRESS.finditer(text, lo, hi):
                yield m.start(), m.end(), 1, passes(1, m[0])
        if n >= 12:
            for m in DIGITS.finditer(text, lo, hi):
                yield m.start(), m.end(), 2, passes(2, m[0])
    if "+" in text:
        for m in CALL.finditer(text):
            yield m.start(), m.end(), 3, passes(3, m[0])


def base_spans(text: str) -> list[Span]:
    """Spans (start, end, kind) by start, then kind."""
    return sorted(((s, e, k) for s, e, k, passed in candidates(text) if passed), key=lambda x: (x[0], x[2]))


def listed(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


# --- characters and labels ----------------------------------------------------------------------------------------------


def character_classes() -> np.ndarray:
    """A class per code point below 2^16: ASCII marks and letters by themselves, digits as one, the rest by its nature."""
    out = np.full(1 << 16, 3, dtype=np.uint8)  # 0 is padding
    for c in range(1 << 16):
        x = chr(c)
        if x.isspace():
            out[c] = 1
        elif x.isalpha():
            out[c] = 2
    at = 5
    for c in range(33, 127):
        if chr(c).isdigit():
            out[c] = 4
        else:
            out[c], at = at, at + 1
    out[32] = at
    return out


CLASSES = character_classes()
SYMBOLS = int(CLASSES.max()) + 1
#: Labels: 0 outside, 1 + 2k the first character of kind k, 2 + 2k a further one.
LABELS = 1 + 2 * len(KINDS)
FORBIDDEN = np.array([[j > 0 and j % 2 == 0 and i not in (j - 1, j) for j in range(LABELS)] for i in range(LABELS)])
NEVER = np.float32(-1e4)


def encoded(text: str) -> np.ndarray:
    if text.isascii():
        return CLASSES[np.frombuffer(text.encode(), dtype=np.uint8)]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return CLASSES[np.minimum(points, 0xFFFF)]


def labels_of(spans: Iterable[Span], n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    for s, e, k in spans:
        out[s:e] = 2 + 2 * k
        out[s] = 1 + 2 * k
    return out


# --- the network -------------------------------------------------------------------------------------------------------


def squash(x: np.ndarray) -> np.ndarray:
    """From -1 to 1, in place of tanh: one division, which costs a fraction of it and rounds alike on all machines."""
    return x / (1 + np.abs(x))


def squash_slope(y: np.ndarray) -> np.ndarray:
    """The slope where ``squash`` is ``y``."""
    return (1 - np.abs(y)) ** 2


class Network:
    """Two LSTMs, forward and backward, over character classes; a linear layer gives label scores, a matrix the transitions.

    Cells and gates are squashed by ``squash``; a gate of x is (squash(x / 2) + 1) / 2. Arrays are (direction, gate, lane) with gates in the order input, forget, output, cell. Padding has inputs that keep
    the state at zero, so a window's result does not depend on the windows beside it.
    """

    NAMES = ("table", "inner", "out", "bias", "moves")

    def __init__(self, s: Settings):
        self.s, h = s, s.hidden
        rng = np.random.default_rng(s.seed)
        self.table = rng.normal(0, 0.3, (2, 4 * h, SYMBOLS)).astype(np.float32)
        self.table[:, h : 2 * h] += 1
        self.inner = rng.normal(0, 0.25, (2, 4 * h, h)).astype(np.float32)
        self.out = rng.normal(0, 0.2, (LABELS, 2 * h)).astype(np.float32)
        self.bias = np.zeros(LABELS, dtype=np.float32)
        self.bias[0] = 2
        self.moves = np.zeros((LABELS, LABELS), dtype=np.float32)

    def inputs(self) -> np.ndarray:
        table, h = self.table.copy(), self.s.hidden
        table[:, : 2 * h, 0] = -1e12  # 1 + 1e12 is 1e12 in single precision, so these gates are zero
        return table

    def transitions(self) -> np.ndarray:
        return np.where(FORBIDDEN, NEVER, self.moves)

    # Training: every step keeps its gates.

    def forward(self, ids: np.ndarray) -> tuple[np.ndarray, list]:
        """Label scores (time, label, lane) of ids (time, lane), and what the way back needs."""
        t, lanes, h = *ids.shape, self.s.hidden
        table = self.inputs()
        both = np.stack([ids, ids[::-1]])
        state, cell = (np.zeros((2, h, lanes), dtype=np.float32) for _ in range(2))
        kept, hidden = [], np.zeros((t, 2, h, lanes), dtype=np.float32)
        for i in range(t):
            g = np.stack([table[d][:, both[d, i]] for d in (0, 1)]) + self.inner @ state
            gates, new = 0.5 * squash(0.5 * g[:, : 3 * h]) + 0.5, squash(g[:, 3 * h :])
            old, before = cell, state
            cell = gates[:, h : 2 * h] * cell + gates[:, :h] * new
            flat = squash(cell)
            state = gates[:, 2 * h :] * flat
            hidden[i] = state
            kept.append((gates, new, old, before, flat))
        seen = np.concatenate([hidden[:, 0], hidden[::-1, 1]], axis=1)
        return self.out @ seen + self.bias[:, None], [both, kept, seen]

    def backward(self, slope: np.ndarray, kept: list) -> dict[str, np.ndarray]:
        """Gradients from those of the label scores."""
        both, steps, seen = kept
        h, t = self.s.hidden, len(steps)
        found = {"out": np.einsum("tkl,thl->kh", slope, seen), "bias": slope.sum(axis=(0, 2))}
        down = self.out.T @ slope
        down = np.stack([down[:, :h], down[::-1, h:]], axis=1)
        gates_slope = np.zeros((t, 2, 4 * h, both.shape[2]), dtype=np.float32)
        inner = np.zeros_like(self.inner)
        state, cell = np.zeros_like(down[0]), np.zeros_like(down[0])
        for i in reversed(range(t)):
            gates, new, old, before, flat = steps[i]
            own = down[i] + state
            cell = cell + own * gates[:, 2 * h :] * squash_slope(flat)
            g = gates_slope[i]
            g[:, :h], g[:, h : 2 * h], g[:, 2 * h : 3 * h] = cell * new, cell * old, own * flat
            g[:, : 3 * h] *= 0.25 * squash_slope(2 * gates - 1)
            g[:, 3 * h :] = cell * gates[:, :h] * squash_slope(new)
            cell = cell * gates[:, h : 2 * h]
            inner += g @ before.transpose(0, 2, 1)
            state = self.inner.transpose(0, 2, 1) @ g
        table = np.zeros_like(self.table)
        for d in (0, 1):
            one = np.zeros((both[d].size, SYMBOLS), dtype=np.float32)
            one[np.arange(both[d].size), both[d].ravel()] = 1
            table[d] = gates_slope[:, d].transpose(1, 0, 2).reshape(4 * h, -1) @ one
        table[:, : 2 * h, 0] = 0
        return found | {"table": table, "inner": inner}

    def loss(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the gold labels (time, lane), by the CRF, and its gradients."""
        scores, kept = self.forward(ids)
        t, k, lanes = scores.shape
        moves = self.transitions()

        def total(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis=axis, keepdims=True)
            return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

        first = moves[0][:, None]  # what precedes a window counts as outside
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[0] = first + scores[0]
        for i in range(1, t):
            alpha[i] = total(alpha[i - 1][:, None, :] + moves[:, :, None], 0) + scores[i]
        for i in reversed(range(t - 1)):
            beta[i] = total(moves[:, :, None] + (scores[i + 1] + beta[i + 1])[None], 1)
        z = total(alpha[-1], 0)
        slope = np.exp(alpha + beta - z)
        pairs = np.zeros_like(moves)
        for i in range(1, t):
            pairs += np.exp(alpha[i - 1][:, None, :] + moves[:, :, None] + (scores[i] + beta[i] - z)[None]).sum(axis=2)
        pairs[0] += slope[0].sum(axis=1)
        lane = np.arange(lanes)
        value = z.sum() - scores[np.arange(t)[:, None], gold, lane].sum() - moves[0, gold[0]].sum() - moves[gold[:-1], gold[1:]].sum()
        slope[np.arange(t)[:, None], gold, lane] -= 1
        np.add.at(pairs, (gold[:-1].ravel(), gold[1:].ravel()), -1)
        np.add.at(pairs, (0, gold[0]), -1)
        found = self.backward(slope / np.float32(lanes), kept)
        return float(value) / lanes, found | {"moves": np.where(FORBIDDEN, 0, pairs / np.float32(lanes))}

    # Application: a lean forward pass, and a search only where some label may beat "outside".

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Label scores less that of "outside" (time, label - 1, lane), of ids (time, lane) padded behind."""
        t, lanes, h = *ids.shape, self.s.hidden
        half = np.ones((4 * h, 1), dtype=np.float32)
        half[: 3 * h] = 0.5
        table, inner = self.inputs() * half, self.inner * half * np.float32(0.5)  # for states of twice their value
        used = ids > 0
        active = np.where(used.any(axis=1), lanes - np.argmax(used[:, ::-1], axis=1), 0).tolist()  # behind are only windows that have ended
        seen = np.zeros((t, 2 * h, lanes), dtype=np.float32)
        for d in (0, 1):
            n, cells, state = -1, np.zeros((h, lanes), dtype=np.float32), np.zeros((h, lanes), dtype=np.float32)
            for i in range(t) if d == 0 else reversed(range(t)):
                if active[i] != n:
                    n = active[i]
                    g, more = (np.empty((4 * h, n), dtype=np.float32) for _ in range(2))
                    cell, new = cells[:, :n], np.empty((h, n), dtype=np.float32)
                table[d].take(ids[i, :n], axis=1, out=g, mode="clip")
                np.matmul(inner[d], state[:, :n], out=more)
                g += more
                np.abs(g, out=more)
                more += 1
                g /= more
                g[: 3 * h] += 1
                cell *= g[h : 2 * h]
                np.multiply(g[:h], g[3 * h :], out=new)
                cell += new
                cell *= 0.5
                np.abs(cell, out=new)
                new += 1
                np.divide(cell, new, out=new)
                state = seen[i, d * h : (d + 1) * h]
                np.multiply(new, g[2 * h : 3 * h], out=state[:, :n])
        out, bias = 0.5 * (self.out[1:] - self.out[0]), self.bias[1:] - self.bias[0]
        found = np.matmul(out, seen)
        found += bias[:, None]
        return found

    def runs(self, scores: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lane, start and end of all stretches of characters that some path worth more than "outside" may label.

        A labelled stretch is worth at most the sum of its characters' hopes, their best label and the best move into it,
        and the best way back. A character of whose surroundings no sum is above zero stays outside in every best path.
        Stretches shorter than the spans that are wanted, or of which no part is worth the margin, are left out.
        """
        moves = self.transitions()
        stay = moves[0, 0]
        into, home = moves[:, 1:].max(axis=0) - stay, max(0.0, float(moves[:, 0].max() - stay))
        hope = (scores + into[:, None]).max(axis=1)
        hope[np.arange(len(hope))[:, None] >= sizes] = NEVER
        most = hope.copy()  # the best sum over stretches that begin at a character, then over those that hold it
        ahead = np.zeros_like(hope[0])
        for i in reversed(range(len(hope))):
            most[i] += ahead
            np.maximum(most[i], 0, out=ahead)
        ahead = np.zeros_like(hope[0])
        for i in range(len(hope)):
            most[i] += ahead
            ahead += hope[i]
            np.maximum(ahead, 0, out=ahead)
        some = np.zeros((hope.shape[1], len(hope) + 2), dtype=np.int8)
        some[:, 1:-1] = (most + home > 0).T
        steps = np.diff(some, axis=1)
        (lane, start), end = np.nonzero(steps == 1), np.nonzero(steps == -1)[1]
        if not len(lane):
            return lane, start, end
        flat = np.append(most.T.ravel(), NEVER)  # lane by lane
        peak = np.maximum.reduceat(flat, np.stack([lane * len(hope) + start, lane * len(hope) + end], axis=1).ravel())[::2]
        wanted = (end - start >= self.s.least) & (peak + home >= self.s.margin)
        return lane[wanted], start[wanted], end[wanted]

    def paths(self, ids: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        """Spans (start, end, kind, log odds) of each lane's best labels; only its ``runs`` need a search."""
        out: list[list[tuple[int, int, int, float]]] = [[] for _ in range(ids.shape[1])]
        scores = self.scores(ids)
        lane, start, end = self.runs(scores, sizes)
        order, lo = np.argsort(end - start, kind="stable"), 0
        sizes = (end - start)[order]
        while lo < len(order):  # stretches of like lengths
            hi = min(lo + self.s.lanes, int(np.searchsorted(sizes, sizes[lo] * 1.5, side="right")))
            self.search(scores, lane[order[lo:hi]], start[order[lo:hi]], end[order[lo:hi]], out)
            lo = hi
        return out

    def search(self, scores: np.ndarray, lanes: np.ndarray, start: np.ndarray, end: np.ndarray, out: list[list]) -> None:
        """Adds the spans of the best labels of stretches of lanes, which lie between characters outside."""
        moves, n = self.transitions() - self.moves[0, 0], len(lanes)
        sizes = end - start
        longest, lane = int(sizes.max()), np.arange(len(lanes))
        at = start + np.arange(longest)[:, None]
        own = np.full((longest + 1, LABELS, n), NEVER, dtype=np.float32)
        own[:, 0] = 0
        inside = at < end
        own[:-1, 1:] = np.where(inside[:, None, :], scores[np.minimum(at, len(scores) - 1), :, lanes].transpose(0, 2, 1), NEVER)
        best, back = moves[0][:, None] + own[0], np.zeros((longest + 1, LABELS, n), dtype=np.int8)
        for i in range(1, longest + 1):
            way = best[:, None] + moves[:, :, None]
            back[i] = way.argmax(axis=0)
            best = way.max(axis=0) + own[i]
        labels = np.zeros((longest + 1, n), dtype=np.int64)
        for i in reversed(range(1, longest + 1)):  # outside at last
            labels[i - 1] = back[i, labels[i], lane]
        for x in np.flatnonzero((labels > 0).any(axis=0)):
            mine = labels[:, x]
            gain = own[np.arange(longest + 1), mine, x] + moves[np.concatenate([[0], mine[:-1]]), mine]
            for s in np.flatnonzero(mine % 2 == 1):
                e = s + 1
                while mine[e] == mine[s] + 1:
                    e += 1
                out[lanes[x]].append((int(start[x] + s), int(start[x] + e), int(mine[s]) // 2, float(gain[s:e].sum() + moves[mine[e - 1], mine[e]])))


def varied(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """A training window with other digits and letters, and some spans as people write them who evade patterns."""
    out, at, moved = [], 0, []
    size = 0

    def add(piece: str) -> None:
        nonlocal size
        out.append(piece)
        size += len(piece)

    def redrawn(piece: str) -> str:
        lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
        return "".join(lower[rng.integers(26)] if c in lower and rng.random() < 0.5 else digits[rng.integers(10)] if c in digits else c for c in piece)

    for s, e, k in spans:
        if s < at:
            continue
        add(text[at:s])
        piece, way = redrawn(text[s:e]) if rng.random() < 0.7 else text[s:e], rng.random()
        if k == 0 and way < 0.2:
            piece = piece.replace("@", (" (at) ", "(at)", "[at]")[rng.integers(3)])
            piece = piece.replace(".", (".", "(dot)", "[dot]")[rng.integers(3)])
        elif k == 1 and way < 0.2:
            piece = piece.replace(".", "[.]")
        elif k == 2 and way < 0.5:
            digits = re.sub("[^0-9]", "", piece)
            piece = "-. "[rng.integers(3)].join(digits[i : i + 4] for i in range(0, len(digits), 4))
        elif k == 3 and way < 0.5:
            digits = re.sub("[^0-9]", "", piece)[-10:]
            mark = "-. "[rng.integers(3)]
            piece = (f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", mark.join((digits[:3], digits[3:6], digits[6:])))[rng.integers(2)]
        moved.append((size, size + len(piece), k))
        add(piece)
        at = e
    add(text[at:])
    return "".join(out), moved


def fit(windows: list[tuple[str, list[Span]]], s: Settings) -> Network:
    """Adam over batches of windows, half of each batch drawn from those with a span."""
    net, rng = Network(s), np.random.default_rng(s.seed)
    known = [w for w in windows if w[1]], [w for w in windows if not w[1]]
    known = tuple(x for x in known if x)
    first = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
    second = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
    for step in range(1, s.steps + 1):
        ids, gold = np.zeros((s.length, s.batch), dtype=np.uint8), np.zeros((s.length, s.batch), dtype=np.int64)
        for lane in range(s.batch):
            group = known[lane % len(known)]
            text, spans = varied(*group[rng.integers(len(group))], rng)
            x = encoded(text)[: s.length]
            ids[: len(x), lane] = x
            gold[:, lane] = labels_of([(a, min(b, s.length), k) for a, b, k in spans if a < s.length], s.length)
        _, slope = net.loss(ids, gold)
        norm = np.sqrt(sum(float((g**2).sum()) for g in slope.values()))
        rate = s.rate * min(1.0, 4 * (1 - step / (s.steps + 1)))
        for n, g in slope.items():
            g = g * min(1.0, 5 / (norm + 1e-9))
            first[n] = 0.9 * first[n] + 0.1 * g
            second[n] = 0.99 * second[n] + 0.01 * g**2
            value = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-6)
            setattr(net, n, (getattr(net, n) - rate * value).astype(np.float32))
    return net


# --- whole texts ---------------------------------------------------------------------------------------------------------


def reconciled(found: list[tuple[int, int, int, float, bool]]) -> list[Span]:
    """Spans of a whole text from those of its windows, rows (start, end, kind, log odds, at an inner edge).

    What two windows both see is one span; what a window's edge cuts grows together with the overlapping span of its kind.
    Of spans that still overlap those stay whose log odds add up to most.
    """
    merged: list[list] = []
    for s, e, k, w, cut in sorted(found):
        other = next((m for m in reversed(merged[-8:]) if m[2] == k and m[1] >= s and (m[0] == s and m[1] == e or cut or m[4])), None)
        if other is None:
            merged.append([s, e, k, w, cut])
        else:
            other[1], other[3], other[4] = max(other[1], e), max(other[3], w), other[4] and cut
    merged.sort(key=lambda m: (m[1], m[0], m[2]))
    ends = [m[1] for m in merged]
    best: list[tuple[float, int, int]] = [(0.0, 0, -1)]  # total, number of spans before, the span taken
    for i, (s, _, _, w, _) in enumerate(merged):
        before = int(np.searchsorted(ends, s, side="right")) if s else 0
        before = min(before, i)
        took = best[before][0] + w
        best.append((took, before, i) if took > best[i][0] else (best[i][0], i, -1))
    out, i = [], len(merged)
    while i:
        _, before, taken = best[i]
        if taken >= 0:
            out.append(tuple(merged[taken][:3]))
        i = before
    return sorted(out)


def checked(text: str, kind: int) -> bool:
    """True where a span that the model found holds what its kind must hold: numbers that pass, or an at sign in some writing."""
    if kind == 0:
        return "@" in text or "(at)" in text or "[at]" in text
    return passes(kind, text) and not any(c.isalpha() for c in text)


class Finder:
    """Base spans and the model's additions of many texts."""

    def __init__(self, net: Network | None, s: Settings):
        self.net, self.s = net, s

    def windows(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, bool]]:
        """Rows (text, start, classes, last): windows that overlap, the last one at the text's end."""
        step = self.s.window - self.s.overlap
        for i, text in enumerate(texts):
            for lo in range(0, len(text), 1024 * step):  # a long text is encoded in pieces
                x = encoded(text[lo : lo + 1024 * step + self.s.overlap])
                for a in range(0, min(len(x), 1024 * step), step):
                    if lo + a and lo + a + self.s.overlap >= len(text):
                        break
                    yield i, lo + a, x[a : a + self.s.window], lo + a + self.s.window >= len(text)

    def model_spans(self, texts: list[str]) -> list[list[Span]]:
        """The model's spans of every text."""
        found: list[list] = [[] for _ in texts]
        held: list[tuple[int, int, np.ndarray, bool]] = []

        def flush() -> None:
            held.sort(key=lambda w: -len(w[2]))
            for lo in range(0, len(held), self.s.lanes):
                group = held[lo : lo + self.s.lanes]
                sizes = np.array([len(w[2]) for w in group])
                ids = np.zeros((len(group), sizes[0]), dtype=np.intp)
                for row, w in zip(ids, group, strict=True):
                    row[: len(w[2])] = w[2]
                for (i, at, x, last), spans in zip(group, self.net.paths(np.ascontiguousarray(ids.T), sizes), strict=True):
                    for s, e, k, w in spans:
                        cut = (s == 0 and at > 0) or (e == len(x) and not last)
                        found[i].append((at + s, at + e, k, w, cut))
            held.clear()

        size = 0
        for w in self.windows(texts):
            held.append(w)
            size += len(w[2])
            if size >= self.s.block:
                flush()
                size = 0
        if held:
            flush()
        return [reconciled([x for x in own if x[3] >= self.s.margin and x[1] - x[0] >= self.s.least]) if own else [] for own in found]

    def all_spans(self, texts: list[str]) -> Iterator[tuple[list[Span], list[Span]]]:
        """For each text the base spans, and these with the model's.

        The model's spans pass the checks that base matches pass. None is added where it meets a base span, or a match that
        was refused.
        """
        more = self.model_spans(texts) if self.net else [[] for _ in texts]
        for text, extra in zip(texts, more, strict=True):
            known = list(candidates(text))
            base = sorted(((s, e, k) for s, e, k, passed in known if passed), key=lambda x: (x[0], x[2]))
            added = [x for x in extra if checked(text[x[0] : x[1]], x[2]) and not any(x[0] < e and s < x[1] for s, e, _, _ in known)]
            yield base, sorted(base + added, key=lambda x: (x[0], x[2]))


def training_windows(docs: DataFrame, s: Settings) -> list[tuple[str, list[Span]]]:
    """At most ``sample`` windows per kind of base span, and twice as many without a span, from all documents.

    Tasks cut a window around every base span, and one from every text; equal ones count once. Those with the smallest
    hashes are taken, so that the sample does not depend on how the table is partitioned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for cell in b.column(0):
                text = cell.as_py() or ""
                if not text:
                    continue
                spans = base_spans(text)
                places = [(k, max(0, s0 - (s0 * 7919 + k) % max(1, s.length - min(e - s0, s.length - 1)))) for s0, e, k in spans]
                places.append((len(KINDS), xxhash.xxh64_intdigest(text[:4096].encode("utf-8", "surrogatepass")) % max(1, len(text) - s.length)))
                for k, at in places:
                    own = [(a - at, e - at, x) for a, e, x in spans if a >= at and e <= at + s.length]
                    cut = any(a < at < e or a < at + s.length < e for a, e, _ in spans)
                    if cut or bool(own) != (k < len(KINDS)):
                        continue
                    piece = text[at : at + s.length]
                    rows.append((k, piece, [v for x in own for v in x]))
            key = [xxhash.xxh64_intdigest(f"{p}{v}".encode("utf-8", "surrogatepass"), s.seed) >> 1 for _, p, v in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array(key, pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.list_(pa.int32()))],
                names=["kind", "key", "text", "spans"],
            )

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "kind int, key long, text string, spans array<int>").distinct()
    nth = F.row_number().over(Window.partitionBy("kind").orderBy("key", "text"))
    rows = rows.withColumn("nth", nth).where(F.col("nth") <= 2 * s.sample)  # a plain bound, which Spark applies before the shuffle
    rows = rows.where(F.col("nth") <= F.when(F.col("kind") < len(KINDS), s.sample).otherwise(2 * s.sample))
    rows = sorted((r.kind, r.key, r.text, r.spans) for r in rows.collect())  # bounded by ``sample``
    return [(t, [(v[i], v[i + 1], v[i + 2]) for i in range(0, len(v), 3)]) for _, _, t, v in rows]


def train(docs: DataFrame, settings: Settings = Settings()) -> Network | None:
    """A network fitted on labelled windows of the documents; None where they have no base span to learn from."""
    windows = training_windows(docs, settings)
    return fit(windows, settings) if any(spans for _, spans in windows) else None


def find(docs: DataFrame, net: Network | None, settings: Settings = Settings()) -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): personal data in every whole text.

    The numbers and the digest are those of the base spans; ``spans`` lists these and the model's. A null text is an empty
    one: no spans, the digest of nothing. Repeated rows, and a null doc_id, give rows like any others. Only doc_id and text
    are read. Without a network the base spans stand alone. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some ten thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value, settings)

        def rows(ids: list, texts: list[str]) -> pa.RecordBatch:
            counts, digests, spans = [], [], []
            for base, every in finder.all_spans(texts):
                counts.append(np.bincount([k for _, _, k in base], minlength=len(KINDS)))
                digests.append(sha256(listed(base).encode()).hexdigest())
                spans.append(listed(every))
            counts = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *[pa.array(counts[:, k]) for k in range(len(KINDS))], pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0), b.column(1)):
                ids.append(i.as_py())
                texts.append(t.as_py() or "")
                size += len(texts[-1])
                if size >= settings.block:
                    yield rows(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield rows(ids, texts)

    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id long, {kinds}, base_sha256 string, spans string")
