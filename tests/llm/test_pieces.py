import hashlib

import numpy as np
import pytest

from readloom.llm import pieces
from tests.llm.fixtures import generator, invented, no_documents, odd_documents

sentencepiece = pytest.importorskip("sentencepiece")

ODD = [
    "", " ", "  a  b \n c\t<s> ▁x ﬁ é", "\n", "▁", "a▁", "日本語 テスト 中文字", "\U0001f600 x", "x" * 300, "ab" * 5000 + " the",
    "    def f(x):\n        return   x\r\n", "=" * 30 + "-" * 7, "\x00a\x00 b", "</s><0x0A>", "the" * 40, "responsibility " * 9,
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_ids_equal_the_library(vocabulary, library, monkeypatch):
    rng = generator(5)
    mixed = ["".join(rng.choice(list("aeiou tnrsl\n▁é_=.,日"), rng.integers(1, 200))) for _ in range(400)]
    texts = ODD + invented(rng, 100) + mixed
    for indexed in (50, 10**6):  # blocks of few segments, and of all
        monkeypatch.setattr(pieces, "INDEXED", indexed)
        encoder = pieces.Encoder(vocabulary)
        for lo in range(0, len(texts), 100):
            part = texts[lo : lo + 100]
            for t, got, want in zip(part, encoder.encode(part), library.encode(part), strict=True):
                assert got.tolist() == want, t[:80]
                assert vocabulary.decode(got) == library.decode(want)


def test_long_and_short_segments_merge_alike(vocabulary, monkeypatch):
    words = [w for t in invented(generator(2), 40) for w in t.split()]
    want = pieces.encode_segments(words, vocabulary)
    monkeypatch.setattr(pieces, "LONG", 0)
    assert pieces.encode_segments(words, vocabulary) == want


def test_suffix_array_orders_suffixes():
    x = generator(1).integers(1, 4, 300)
    got = pieces.suffix_array(x, 16)
    cut = [tuple([*x[i : i + 16], *[0] * 16][:16]) for i in got]
    assert cut == sorted(cut) and sorted(got) == list(range(300))


def test_frames_round_trip(spark, vocabulary):
    docs = odd_documents(spark)
    got = pieces.encode(docs, vocabulary)
    rows = got.collect()
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    for r in rows:
        assert r.ids_sha256 == hashlib.sha256(np.array(r.token_ids, dtype="<i4").tobytes()).hexdigest() and r.n_tokens == len(r.token_ids)
    text = {(r.doc_id, r.text or "") for r in docs.collect()}
    assert {tuple(r) for r in pieces.decode(got, vocabulary).collect()} == text
    assert pieces.encode(no_documents(spark), vocabulary).count() == 0


def test_decode_takes_nulls_and_broken_bytes(spark, vocabulary):
    broken = vocabulary.bytes_at[0xE6]
    rows = spark.createDataFrame([(1, None), (2, []), (3, [broken])], "doc_id long, token_ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(rows, vocabulary).collect()} == {1: None, 2: "", 3: "�"}


def test_chunks_of_one_long_segment_change_nothing(vocabulary, library, monkeypatch):
    rng = generator(11)
    long = ["x" * 3000, " " * 2001, "ab" * 900, "".join(rng.choice(list("aeioutnrsl日é"), 4000)), "".join(w.strip() for w in invented(rng, 3)).replace(" ", "")]
    for wide, read in ((65, 10**6), (700, 50)):
        monkeypatch.setattr(pieces, "WIDE", wide)
        monkeypatch.setattr(pieces, "READ", read)
        for t, got, want in zip(long, pieces.Encoder(vocabulary).encode(long), library.encode(long), strict=True):
            assert got.tolist() == want, t[:40]
