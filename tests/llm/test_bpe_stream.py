"""Streaming BPE against the tokenizers library: ids and decoded text, whole texts."""

import hashlib
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ambertill.llm import bpe_stream

TEXTS = [
    None, "", " ", "a", "Hello, world!", "it's  we'll\tthey've\n\n x", "<|endoftext|>", "a<|endoftext|>b<|endoftext",
    "naïve café 日本語 😀 ́", "x" * 5000, " " * 3000 + "y", "ab" * 4000, "ÃÂ" * 3000, "1234567890" * 700,
    "".join(random.Random(3).choices("abé日 \n.,-=0", k=30000)),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_stream.default_vocabulary())


@pytest.fixture(scope="module")
def vocab():
    return bpe_stream.vocabulary(bpe_stream.default_vocabulary())


@pytest.mark.parametrize("window", [bpe_stream.WINDOW, 7, 300])
def test_same_as_library(library, vocab, window, monkeypatch):
    monkeypatch.setattr(bpe_stream, "WINDOW", window)
    encoder = bpe_stream.Encoder(vocab)
    for text in TEXTS:
        ids, decoded = bpe_stream.round_trip(vocab, encoder, text)
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids == expected, repr((text or "")[:40])
        assert decoded == library.decode(expected, skip_special_tokens=False) == bpe_stream.decode(vocab, ids)
        assert bpe_stream.streamed(vocab, encoder, text) == (ids, decoded)


def test_decoder_replaces_broken_bytes(vocab, library):
    ids = [vocab.ids[b"\xe6"], vocab.ids[b"a"], vocab.ids[b"\x97"]]
    text = bpe_stream.decode(vocab, ids)
    assert text == library.decode(ids, skip_special_tokens=False) == "�a�"


def test_query_columns(spark, library):
    rows = [(1, "Hello there"), (1, "Hello there"), (None, None), (2, ""), (3, "x" * 9000 + " <|endoftext|>")]
    docs = spark.createDataFrame([(d, t, "clash", 5) for d, t in rows], "doc_id long, text string, ids string, decoded int")
    coded = bpe_stream.tokenized(docs)
    got = coded.select("_row.doc_id", "_row.ids", *bpe_stream.digests(coded["ids"], coded["decoded"])).collect()
    assert len(got) == len(rows)
    expected = set()
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.add((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == expected
    assert all(r["ids"] == "clash" for r in got)


def test_registered_query(spark):
    from ambertill.llm.queries import QUERIES

    got = QUERIES["op11_bpe"](spark, "/root/testdata/sf0.001")
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_ids_are_kept_and_joined_as_packed_numbers():
    vocab = bpe_stream.vocabulary(bpe_stream.default_vocabulary())
    coder = bpe_stream.Encoder(vocab)
    text = "Grüße an alle, xqzt! " * 3 + next(iter(vocab.special), "") + " a" * 5 + "b" * 9000
    ids, decoded = coder.coded(text)
    assert ids.dtype == "int32" and all(type(kept) is bytes for kept, _ in coder.cache.values())
    assert (ids.tolist(), decoded) == coder.encode(text) == bpe_stream.streamed(vocab, bpe_stream.Encoder(vocab), text)
    assert coder.coded(None)[0].tolist() == [] and decoded == text


def test_a_batch_is_handed_on_in_bounded_slices(vocab, library, monkeypatch):
    monkeypatch.setattr(bpe_stream, "SLICE", 1000)
    texts = [None, "", "é b" * 100, "x" * 5000, None, *["some words 日本 " * k for k in range(1, 60)], ""]
    taken = []

    def batches():
        for batch in (texts, [], [None], ["a"]):
            taken.append(len(batch))
            yield pa.array(batch, pa.string())

    parts = bpe_stream.coded_slices(bpe_stream.Encoder(vocab), batches())
    first = next(parts)
    assert taken == [len(texts)] and len(first) < len(texts) / 4
    got = [first, *parts]
    rows = [row for part in got for row in part.to_pylist()]
    for row, text in zip(rows, [*texts, None, "a"], strict=True):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert row == {"ids": expected, "decoded": library.decode(expected, skip_special_tokens=False)}
    largest = max(len((t or "").encode()) for t in texts)
    assert all(sum(len(row["decoded"].encode()) for row in part.to_pylist()) < 1000 + largest for part in got)


class Counting(dict):
    asked = 0

    def get(self, *key):
        self.asked += 1
        return super().get(*key)


def test_a_slice_looks_up_each_different_piece_once(vocab, library):
    coder = bpe_stream.Encoder(vocab)
    coder.cache = Counting()
    texts = ["the same few words, again and again. " * 20] * 30
    (part,) = bpe_stream.coded_slices(coder, iter([pa.array(texts)]))
    different = {piece for text in texts for piece in vocab.pieces.findall(text)}
    assert coder.cache.asked <= len(different) < 20
    assert part.to_pylist()[7]["ids"] == library.encode(texts[7], add_special_tokens=False).ids


@pytest.mark.parametrize("lot", [1, 5, 64, 1 << 20])
def test_lots_split_as_the_pattern_does(vocab, library, monkeypatch, lot):
    monkeypatch.setattr(bpe_stream, "LOT", lot)
    draw = random.Random(lot)
    special = next(iter(vocab.special))
    signs = ["'", "s", "t", "re", "ve", "l", "ll", "d", "S", " ", "  ", "\n", "\t", " ", " ", "\u0085", "\x1c", "1", "²", "é", "́", "日", "😀", ".", "-", special, special[:-2]]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(1500)] + ["'", "'s", " 's", "\n's", "''s", "'s's", "'rex", "'r", "a'", "e  ", None, "q" * 700, " " * 700]
    coder = bpe_stream.Encoder(vocab)
    ids, counts, decoded = coder.coded_texts(texts)
    assert len(ids) == counts.sum()
    ends = counts.cumsum()
    for text, n, end, back in zip(texts, counts, ends, decoded, strict=True):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids[end - n : end].tolist() == expected, repr(text)
        assert back == library.decode(expected, skip_special_tokens=False)
        assert (expected, back) == bpe_stream.streamed(vocab, coder, text)


def test_pieces_merged_together_as_one_by_one(vocab):
    draw = random.Random(5)
    pieces = ["".join(draw.choices("aehinorst é日", k=draw.randint(1, 21))).encode() for _ in range(3000)] + [b"a", b"aaaa" * 16, b"\xe6", b"ab" * 32]
    for piece, (ids, decoded) in zip(pieces, bpe_stream._merge_all(vocab, pieces), strict=True):
        assert memoryview(ids).cast("i").tolist() == bpe_stream._merge(vocab, piece)
        assert decoded == piece
    assert bpe_stream._merge_all(vocab, []) == []


def test_lots_are_bounded(vocab, monkeypatch):
    monkeypatch.setattr(bpe_stream, "LOT", 100)
    special = next(iter(vocab.special))
    texts = [special * 500, "a b" * 500, None, "", "some words. " * 500, "ab", f"{special} x" * 300]
    lots = list(bpe_stream.Encoder(vocab)._lots(texts))
    assert all(0 < sum(len(stretch) for _, stretch, _ in lot) < 250 for lot in lots)
    joined = [""] * len(texts)
    for lot in lots:
        for k, stretch, _ in lot:
            joined[k] += stretch
    assert joined == [t or "" for t in texts]
