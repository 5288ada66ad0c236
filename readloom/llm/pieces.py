"""SentencePiece encoding and decoding by suffix-array matching of all pieces against a batch's distinct segments."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from hashlib import sha256
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The public BPE vocabulary with byte fallback that the registered query uses.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The mark that stands for a space.
SPACE = "▁"
#: Characters of distinct segments that are indexed at once, characters of the texts that they come from, and the
#: segment length from which its merges are queued by rank.
INDEXED, READ, LONG = 1_000_000, 1_000_000, 64
#: A segment longer than this is encoded alone and indexed in overlapping chunks of so many characters.
WIDE = 1 << 16


@dataclass
class Vocabulary:
    """Pieces by id. ``scores`` rank the merges; ``kinds`` are n (normal), b (byte), c (control) and u (unknown)."""

    pieces: list[str]
    scores: list[float]
    kinds: str
    unknown: int = 0
    deepest: int = field(init=False)

    def __post_init__(self) -> None:
        normal = [i for i, k in enumerate(self.kinds) if k == "n"]
        self.single = {self.pieces[i]: i for i in normal if len(self.pieces[i]) == 1}
        self.multi = [i for i in normal if len(self.pieces[i]) > 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", self.pieces[i]) for i in self.multi):
            raise ValueError("a piece spans two words; segments would cut it")
        self.deepest = max([len(self.pieces[i]) for i in self.multi], default=1)
        chars = sorted({c for i in self.multi for c in self.pieces[i]})
        self.symbols = {c: k + 1 for k, c in enumerate(chars)}
        if len(chars) + 1 >= 1 << 15:
            raise ValueError("the longer pieces have too many characters for the index")
        self.bytes_at = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == "b"}
        # Characters in no longer piece always stand alone: segments end there, which makes them fewer.
        alone = "".join(c for c in "\t\n\x0b\x0c\r" if c not in self.symbols)
        self.cut = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        self.raw = [bytes([int(p[3:5], 16)]) if k == "b" else p.replace(SPACE, " ").encode() if k == "n" else b"" for p, k in zip(self.pieces, self.kinds, strict=True)]

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the longer pieces in sorted order: lower and upper search keys, lengths, ids, merge ranks."""
        order = {s: k for k, s in enumerate(sorted({self.scores[i] for i in self.multi}, reverse=True))}
        rows = np.zeros((len(self.multi), self.deepest), dtype=">u2")
        for k, i in enumerate(self.multi):
            rows[k, : len(self.pieces[i])] = [self.symbols[c] for c in self.pieces[i]]
        low = as_keys(rows)
        length = np.array([len(self.pieces[i]) for i in self.multi])
        rows[np.arange(self.deepest)[None] >= length[:, None]] = 0xFFFF
        return low, as_keys(rows), length, np.array(self.multi), np.array([order[self.scores[i]] for i in self.multi], dtype=np.int64)

    @cached_property
    def prefixes(self) -> np.ndarray:
        """Per longer piece (row of ``table``) and length: the row of the piece that is its prefix of that length, or -1."""
        row = {self.pieces[i]: k for k, i in enumerate(self.multi)}
        found = np.full((len(self.multi), self.deepest + 1), -1, dtype=np.int32)
        for k, i in enumerate(self.multi):
            p = self.pieces[i]
            for n in range(2, len(p) + 1):
                found[k, n] = row.get(p[:n], -1)
        return found

    @cached_property
    def by_point(self) -> tuple[np.ndarray, np.ndarray]:
        """By code point: its symbol in the index (the last one if no longer piece has it), and its own piece or -1."""
        symbol = np.full(0x110000, len(self.symbols) + 1, dtype=np.int32)
        single = np.full(0x110000, -1, dtype=np.int32)
        for table, known in ((symbol, self.symbols), (single, self.single)):
            table[[ord(c) for c in known]] = list(known.values())
        return symbol, single

    def segments(self, text: str) -> list[str]:
        """The text, spaces marked and one put in front, cut where no piece can span."""
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def runs(self, text: str) -> Iterator[list[str]]:
        """The text's segments, those of a long text in runs of some ``READ`` characters, so that not all are held at once."""
        if len(text) <= READ:
            yield self.segments(text)
            return
        run, size = [], 0
        for m in self.cut.finditer(SPACE + text.replace(" ", SPACE)):
            run.append(m[0])
            size += len(m[0])
            if size >= READ:
                yield run
                run, size = [], 0
        yield run

    def of_char(self, c: str) -> list[int]:
        """Ids of a character that no longer piece covers: its own piece, or its UTF-8 bytes, or the unknown piece."""
        if c in self.single:
            return [self.single[c]]
        return [self.bytes_at[b] for b in c.encode()] if self.bytes_at else [self.unknown]

    def decode(self, ids: np.ndarray) -> str:
        parts = [b"".join(map(self.raw.__getitem__, ids[lo : lo + WIDE].tolist())) for lo in range(0, len(ids), WIDE)]
        text = b"".join(parts).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def load(path: str = MODEL) -> Vocabulary:
    """Reads a BPE model without normalisation; the driver reads it, executors get the pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = range(sp.get_piece_size())
    kinds = "".join("b" if sp.is_byte(i) else "u" if sp.is_unknown(i) else "c" if sp.is_control(i) else "x" if sp.is_unused(i) else "n" for i in n)
    return Vocabulary([sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n], kinds, sp.unk_id())


def as_keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian symbols as byte strings, which compare in the order of the symbols."""
    return np.array(rows, order="C").view(f"S{rows.shape[1] * 2}").ravel()


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Start positions in the order of the suffixes' first ``depth`` symbols, by doubling ranks.

    Symbols are below 2**15, so the first ranks are those of four symbols in one number.
    """
    ahead = np.concatenate([symbols, np.zeros(3, dtype=symbols.dtype)]).astype(np.int64)
    n = len(symbols)
    key = (ahead[:n] << 45) | (ahead[1 : n + 1] << 30) | (ahead[2 : n + 2] << 15) | ahead[3:]
    span = 4
    while True:
        order = np.argsort(key)
        if span >= depth:
            return order
        found = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], found[1:] != found[:-1]]))
        far = np.zeros_like(rank)
        far[:-span] = rank[span:]
        key = rank * (n + 1) + far
        span *= 2


def occurrences(symbols: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of the longer pieces, by position: start, row of the vocabulary's table."""
    low, high, *_ = vocabulary.table
    order = suffix_array(symbols, vocabulary.deepest)
    padded = np.concatenate([symbols, np.zeros(vocabulary.deepest, dtype=symbols.dtype)]).astype(">u2")
    keys = as_keys(np.lib.stride_tricks.sliding_window_view(padded, vocabulary.deepest)[order])
    first, last = np.searchsorted(keys, low, "left"), np.searchsorted(keys, high, "right")
    n = last - first
    piece = np.repeat(np.arange(len(n)), n)
    start = order[np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
    by_place = np.argsort(start)
    return start[by_place], piece[by_place]


def longest_at(start: np.ndarray, row: np.ndarray, vocabulary: Vocabulary, out: np.ndarray) -> None:
    """Notes in ``out`` the row of the longest piece that begins at each start; all others there are its prefixes."""
    by_length = np.argsort(vocabulary.table[2][row], kind="stable")
    out[start[by_length]] = row[by_length]


def relax(owner: np.ndarray, start: np.ndarray, end: np.ndarray, ids: np.ndarray, rank: np.ndarray, bound: np.ndarray, token: np.ndarray) -> None:
    """Merges in every segment at once: each round takes each segment's best edge that joins two neighbouring symbols.

    ``bound`` marks the symbols' starts, ``token`` has the id at each start. An edge whose ends are both bounds, with one
    bound between them, is a merge of two neighbours; the best one has the least rank, then the leftmost start. An edge
    with an end inside a symbol never fits again.
    """
    while len(start):
        fits = bound[start] & bound[end]
        owner, start, end, ids, rank = (x[fits] for x in (owner, start, end, ids, rank))
        if not len(start):
            return
        count = np.cumsum(bound)
        inner = count[end - 1] - count[start]
        ready = inner == 1
        key = np.where(ready, rank * (len(bound) + 1) + start, np.iinfo(np.int64).max)
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        best = np.minimum.reduceat(key, heads)
        wide = np.repeat(best, np.diff(np.concatenate([heads, [len(owner)]])))
        take = ready & (key == wide)
        s, e = start[take], end[take]
        middle = np.searchsorted(count, count[s] + 1)  # the next bound behind s
        bound[middle] = False
        token[s] = ids[take]
        alive = (inner >= 1) & ~take & (wide != np.iinfo(np.int64).max)
        owner, start, end, ids, rank = (x[alive] for x in (owner, start, end, ids, rank))


class Merges:
    """Offered merges in the order of rank, then start; starts of one rank wait in an array, so that millions take little room."""

    def __init__(self, rank: np.ndarray, start: np.ndarray):
        order = np.argsort(rank, kind="stable")  # starts ascend
        rank, start = rank[order], start[order].astype(np.int32)
        heads = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(rank) else []
        self.waiting = {int(rank[a]): array("i", start[a:b].tobytes()) for a, b in pairwise([*heads, len(rank)])}
        self.ranks = sorted(self.waiting)  # a heap
        self.rank, self.at, self.now = -1, 0, array("i")
        self.early: list[tuple[int, int]] = []  # offers up to the rank at hand

    def add(self, rank: int, start: int) -> None:
        if rank <= self.rank:
            heappush(self.early, (rank, start))
        elif (found := self.waiting.get(rank)) is not None:
            found.append(start)
        else:
            self.waiting[rank] = array("i", [start])
            heappush(self.ranks, rank)

    def take(self) -> tuple[int, int] | None:
        """The next rank and start, None at the end."""
        while True:
            more = self.at < len(self.now)
            if self.early and (not more or self.early[0] < (self.rank, self.now[self.at])):
                return heappop(self.early)
            if more:
                self.at += 1
                return self.rank, self.now[self.at - 1]
            if not self.ranks:
                return None
            self.rank, self.at = heappop(self.ranks), 0
            self.now = array("i", np.sort(np.frombuffer(self.waiting.pop(self.rank), dtype=np.int32)).tobytes())


def relax_long(longest: np.ndarray, vocabulary: Vocabulary, bound: np.ndarray, token: np.ndarray) -> None:
    """The same for one long segment, given the longest piece that begins at each of its characters.

    Of two neighbouring symbols s..m and m..e an edge joins them if a piece of length e - s begins at s, which the
    prefixes of the longest piece there tell. An offer whose symbols have merged otherwise meanwhile has another rank,
    or none, when its turn comes.
    """
    n, deepest = len(longest), vocabulary.deepest
    prefixes, ids, ranks = vocabulary.prefixes, vocabulary.table[3], vocabulary.table[4]
    known = np.flatnonzero(longest >= 0)
    pair = prefixes[longest[known], 2]
    offers = Merges(ranks[pair[pair >= 0]], known[pair >= 0])
    after, before = (memoryview(np.arange(n + 1, dtype=np.int32) + k) for k in (1, -1))
    # The C buffers of the arrays: single items are read as plain numbers.
    longest_of, prefix_of = memoryview(longest), memoryview(prefixes).cast("B").cast("i")
    ids_of, ranks_of = memoryview(ids.astype(np.int32)), memoryview(ranks.astype(np.int32))
    bounds, tokens = memoryview(bound.view(np.uint8)), memoryview(token)

    def joined(s: int, e: int) -> int:
        """Row of the piece from s to e, or -1."""
        return prefix_of[longest_of[s] * (deepest + 1) + e - s] if longest_of[s] >= 0 and e - s <= deepest else -1

    while (best := offers.take()) is not None:
        rank, s = best
        m = after[s]
        if not bounds[s] or m >= n:
            continue
        e = after[m]
        row = joined(s, e)
        if row < 0 or ranks_of[row] != rank:
            continue
        bounds[m], tokens[s] = 0, ids_of[row]
        after[s] = e
        if e < n:
            before[e] = s
            if (row := joined(s, after[e])) >= 0:
                offers.add(ranks_of[row], s)
        if s > 0 and (row := joined(before[s], e)) >= 0:
            offers.add(ranks_of[row], before[s])


def encode_segments(segments: list[str], vocabulary: Vocabulary, step: int | None = None) -> list[bytes]:
    """Ids of each segment, as little-endian 32-bit numbers.

    All segments are indexed as one text, with a symbol that no piece has between them; in chunks of ``step`` characters
    and what a piece may reach beyond, if it is given.
    """
    points = np.frombuffer(("\0".join(segments) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(s) + 1 for s in segments])
    heads = np.cumsum(sizes) - sizes
    symbol_of, single_of = vocabulary.by_point
    symbols, token = symbol_of[points], single_of[points]
    symbols[heads + sizes - 1] = 0
    _, _, length, piece_ids, ranks = vocabulary.table
    bound = np.ones(len(points) + 1, dtype=bool)
    long = sizes > LONG
    longest = np.full(len(points), -1, dtype=np.int32) if long.any() else None
    step = step or len(points)
    short = []
    for lo in range(0, len(points), step):
        start, row = occurrences(symbols[lo : lo + step + vocabulary.deepest - 1], vocabulary)
        own = start < step  # later ones are the next chunk's
        start, row = start[own] + lo, row[own]
        owner = np.searchsorted(heads, start, "right") - 1
        if longest is not None:
            far = long[owner]
            longest_at(start[far], row[far], vocabulary, longest)
            start, row, owner = start[~far], row[~far], owner[~far]
        short.append((owner, start, row))
    owner, start, row = (np.concatenate([x[i] for x in short]) for i in range(3))
    relax(owner, start, start + length[row], piece_ids[row], ranks[row], bound, token)
    for k in np.flatnonzero(long):
        a, b = int(heads[k]), int(heads[k] + sizes[k] - 1)
        relax_long(longest[a:b], vocabulary, bound[a:b], token[a:b])
    places = np.flatnonzero(bound[:-1] & (symbols != 0))
    found = token[places]
    cuts = np.searchsorted(places, np.concatenate([heads, [len(points)]]))
    lost = np.flatnonzero(found < 0)
    if len(lost):  # characters without a piece of their own become bytes or the unknown piece
        chars, which = np.unique(points[places[lost]], return_inverse=True)
        parts = [vocabulary.of_char(chr(c)) for c in chars]
        size = np.array([len(x) for x in parts])
        width = np.ones(len(found), dtype=np.int64)
        width[lost] = n = size[which]
        ends = np.cumsum(width)
        found = np.repeat(found, width)
        turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found[np.repeat(ends[lost] - n, n) + turn] = np.concatenate(parts)[np.repeat((np.cumsum(size) - size)[which], n) + turn]
        cuts = np.concatenate([[0], ends])[cuts]
    raw = found.astype("<i4").tobytes()
    return [raw[a:b] for a, b in pairwise((4 * cuts).tolist())]


class Encoder:
    """Encodes texts in blocks; each block's distinct segments are indexed anew, and nothing is kept between blocks."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. A block ends where its distinct segments or its texts are long enough, in a long text too."""
        found: list[list[bytes]] = [[] for _ in texts]
        block: list[tuple[int, list[str]]] = []
        own: set[str] = set()
        read = size = 0
        for i, t in enumerate(texts):
            for run in self.vocabulary.runs(t or ""):
                block.append((i, run))
                new = set(run) - own
                own |= new
                read += min(len(t or ""), READ)
                size += sum(map(len, new)) + len(new)
                if size > INDEXED or read > READ:
                    self._finish(block, own, found)
                    block, own, read, size = [], set(), 0, 0
        self._finish(block, own, found)
        return [np.frombuffer(b"".join(x), dtype="<i4") for x in found]

    def _finish(self, block: list[tuple[int, list[str]]], own: set[str], found: list[list[bytes]]) -> None:
        """Adds the ids of the block's segments to those of their texts."""
        ids: dict[str, bytes] = {}
        group = [s for s in own if len(s) <= WIDE]
        if group:
            ids.update(zip(group, encode_segments(group, self.vocabulary), strict=True))
        for s in own:
            if len(s) > WIDE:
                ids[s] = encode_segments([s], self.vocabulary, WIDE)[0]
        for i, run in block:
            found[i].append(b"".join(map(ids.__getitem__, run)))


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of some ``READ`` bytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        before = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, before + READ, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def encode(docs: DataFrame, vocabulary: Vocabulary, ids: bool = True) -> DataFrame:
    """Rows (doc_id, n_chars, n_tokens, ids_sha256, round_trip) and, if asked for, token_ids, for every row.

    Each task cuts a batch of texts into segments that no piece spans, builds a suffix array over its distinct
    segments, finds every piece's range of occurrences by binary search, sorts the occurrences by position, and merges
    neighbours by rank until no occurrence joins two. A long text is cut and encoded in runs of segments, and a segment
    that is long itself is indexed in overlapping chunks. Ids equal those of the SentencePiece library for the model.
    ``ids_sha256`` is of the ids as little-endian 32-bit numbers; ``round_trip`` tells whether decoding them gives the
    text, which holds unless the text has the space mark itself. Whole texts are encoded, of any length. A null text
    counts as empty; an empty text has no ids. Rows that repeat are encoded alike. Only doc_id and text are read.
    """
    model = docs.sparkSession.sparkContext.broadcast((vocabulary.pieces, vocabulary.scores, vocabulary.kinds, vocabulary.unknown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*model.value))
        for b in batches:
            for part in slices(b):
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = encoder.encode(texts)
                columns = {
                    "doc_id": part.column("doc_id"),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "n_tokens": pa.array([len(x) for x in found], pa.int64()),
                    "ids_sha256": pa.array([sha256(x.tobytes()).hexdigest() for x in found]),
                    "round_trip": pa.array([encoder.vocabulary.decode(x) == t for x, t in zip(found, texts, strict=True)]),
                }
                if ids:
                    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                    columns["token_ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int32)))
                yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, n_tokens long, ids_sha256 string, round_trip boolean" + ", token_ids array<int>" * ids)


def decode(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows (doc_id, text) from rows (doc_id, token_ids). Null ids give a null text, no ids an empty one.

    Byte pieces are joined to UTF-8, broken sequences give U+FFFD, and the leading space that encoding put in is taken off.
    """
    model = tokens.sparkSession.sparkContext.broadcast((vocabulary.pieces, vocabulary.scores, vocabulary.kinds, vocabulary.unknown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(*model.value)
        for b in batches:
            texts = [None if x is None else known.decode(np.array(x, dtype=np.int32)) for x in b.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "text": pa.array(texts, pa.string())})

    return tokens.select("doc_id", "token_ids").mapInArrow(run, "doc_id long, text string")
