"""Byte-level BPE against the tiktoken library, and back."""

import hashlib
import random
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from feedlake.llm import byte_bpe as B
from tests.conftest import SF_SMALL
from tests.llm.cases import documents, empty, texts

ODD = ["héllo wörld", "中文 字符 テスト", "😀😀 é \U0001f469‍\U0001f52c", "it's we'll I'VE 'sx", " \n\n  a\t b  c\u0085d \u001c e", "<|endoftext|> x",
       "\x00\x01", "1234567890 ١٢٣", "a" * 3000, " " * 4000 + "x", "ก็้" * 50, "﻿bom", " x　y"]


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def definition(ranks):
    return B.definition(ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_table():
    assert sorted(B.BYTE_TO_CHAR) == list(range(256)) and len(B.CHAR_TO_BYTE) == 256
    assert B.as_chars(b" a\n\xc3") == "ĠaĊÃ"


def test_every_letter_and_random_text(definition, reference):
    coder, decoder, draw = B.Coder(definition), B.Decoder(definition), random.Random(1)
    some = ODD + ["".join(draw.choice(["a", "aa", " ", "é", "'s", "\n", "中", "😀", "1", "-", "th", "̀", "אב", "'", "\"'", "s", "'ll", "'LL", ".", "\x1f", "\x00", "²", "_"]) for _ in range(draw.randrange(30)))
             for _ in range(6000)]
    some += [f"a{chr(c)}1 {chr(c)}{chr(c)}!" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    ids, offsets, bounds = coder.encode([t.encode() for t in some])
    for i, t in enumerate(some):
        own, at = ids[bounds[i]:bounds[i + 1]], offsets[bounds[i]:bounds[i + 1]]
        assert own.tolist() == reference.encode_ordinary(t)
        assert decoder.decode(own) == t.encode()
        # A token's bytes lie in the characters that its offsets name.
        assert all(decoder.decode(own[k:k + 1]) in t[a:b].encode() for k, (a, b) in enumerate(at.tolist()))


def test_cuts_of_long_texts(definition, reference, monkeypatch):
    draw = random.Random(2)
    spaces = [" ", "  ", "\n", "\t ", "\x0b", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000"]
    long = "".join(draw.choice(["word", "é", "don't", "!", "à", "‟", "'", "a1", "s", *spaces]) for _ in range(5000))
    for size in (1, 2, 7, 100):
        coder = B.Coder(definition)
        monkeypatch.setattr(B, "BLOCK_BYTES", size)
        parts = list(B.cuts(long.encode()))
        assert b"".join(p for _, p in parts) == long.encode() and all(long.startswith(p.decode(), at) for at, p in parts)
        ids, offsets, _ = coder.encode([b"x", long.encode(), b""])
        assert ids.tolist() == reference.encode_ordinary("x") + reference.encode_ordinary(long)
        assert offsets[-1, 1] == len(long) and (np.diff(offsets[1:, 0]) >= 0).all()


def test_units_longer_than_a_buffer(definition, reference):
    coder = B.Coder(definition)
    spaces = " " * (B.BLOCK_BYTES + 5) + "é"           # more than the pattern's other engine takes
    for text in ("ab " + "x" * (B.BLOCK_BYTES + 9) + " cd", spaces, "é" * B.BLOCK_BYTES):
        ids, offsets, bounds = coder.encode([text.encode(), b"cd"])
        assert text == spaces or ids[:bounds[1]].tolist() == reference.encode_ordinary(text)
        assert offsets[bounds[1] - 1, 1] == len(text) and ids[bounds[1]:].tolist() == reference.encode_ordinary("cd")
        assert B.Decoder(definition).decode(ids[:bounds[1]]) == text.encode()


def test_memory_is_bounded(definition, reference, monkeypatch):
    monkeypatch.setattr(B, "MEMO", 50)
    coder, draw = B.Coder(definition), random.Random(4)
    for _ in range(30):
        text = " ".join(str(draw.randrange(10 ** 6)) for _ in range(40))
        assert coder.encode([text.encode()])[0].tolist() == reference.encode_ordinary(text)
        assert len(coder.memo) <= 50 + 40


def test_round_trip(spark, definition, reference):
    docs = documents(spark, texts() + ODD)
    coded = B.encode(docs, definition)
    assert coded.columns == ["doc_id", "ids", "starts", "ends", "split_tokens"]
    got = Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in B.decode(coded, definition).collect())
    assert got == Counter((r["doc_id"], tuple(reference.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in docs.collect())
    assert B.encode(empty(spark), definition).count() == 0
    once = B.encode(docs, definition, round_trip=True)
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in once.collect()) == got
    assert once.where(B.little_endian("ids") != once["packed"]).count() == 0
    split = spark.createDataFrame([(1, "\U00010348a"), (2, "plain"), (None, None)], "doc_id long, text string")
    assert sorted(((r["doc_id"], r["split_tokens"]) for r in B.encode(split, definition).collect()), key=str) == [(1, 3), (2, 0), (None, 0)]


def test_decoding_refuses_unknown_ids_and_takes_null(spark, definition):
    decoder = B.Decoder(definition)
    for bad in (-1, 50256):
        with pytest.raises(ValueError):
            decoder.decode(np.array([5, bad]))
    ids = spark.createDataFrame([(1, None, "clash"), (2, [], "clash")], "doc_id long, ids array<int>, text string")
    assert [bytes(r["decoded"]) for r in B.decode(ids, definition).collect()] == [b"", b""]


def test_ranks_that_are_no_merges_are_refused(ranks):
    one = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError, match="lower rank"):
        B.definition({**one, b"abc": 256}, "x")
    with pytest.raises(ValueError, match="no token for the bytes"):
        B.definition({b"a": 0}, "x")


def test_query(spark, reference):
    from feedlake.llm.queries import QUERIES
    want = Counter()
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = reference.encode_ordinary(r["text"] or "")
        want[(r["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:4] for r in QUERIES["op13_byte_bpe"](spark, SF_SMALL).collect()) == want
