"""Piece encoding and decoding against the library that the vocabulary is made for."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from oncospan.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", " " * 15, " " * 16, " " * 17, " " * 31 + "x", " " * 999, "a" * 500, "▁a ▁▁b", "x▁", "<s> </s><unk>",
       "é 中😀 ﻿", "a\x00b", "\r\n\t x", "ab" * 300, "ﬁ  　x", "  lead", "trail   ", "123 4567.89",
       "한국어 ПРИВЕТ мир", "́é", "=====-----*****", "\n\n\n  \n", "don't STOP", "naïve Straße", "the the the"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.read(PATH)


@pytest.fixture(scope="module")
def codec(model):
    return pieces.PieceCodec(model)


def ids_of(data):
    return np.frombuffer(data, "<i4").tolist()


def random_texts(n):
    rng = random.Random(1)
    return ["".join(rng.choice("  ▁aAbeinrst\n1=中é😀") for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_encodes_as_the_library(codec, library):
    texts = [*ODD, " ".join(ODD), *random_texts(2000)]
    for text, data in zip(texts, codec.encode_all(texts), strict=True):
        assert ids_of(data) == library.encode(text), text
        assert codec.decode(ids_of(data)) == library.decode(library.encode(text)), text


def test_every_word_alone_in_rounds_and_in_order(codec, library):
    words = sorted({w for t in random_texts(500) for w in t.split()} | {"internationalization", "aaaaaaaaa", "ababababa"})
    for word, data in zip(words, codec.merge_words([" " + w for w in words]), strict=True):
        assert ids_of(data) == ids_of(codec._bytes(codec.merge_in_order(" " + word))) == library.encode(word), word


def test_decodes_any_ids_as_the_library(codec, library):
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.choice([rng.randint(0, 31999), rng.randint(3, 258), rng.choice([0, 1, 2, 259, 28705])])
               for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids), ids
    with pytest.raises(ValueError):
        codec.decode([32000])


def test_very_long_texts(codec, library):
    rng = random.Random(3)
    junk = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGH+/") for _ in range(30_000))
    for text in [" " * 200_000, junk, "ab" * 100_000, "many words in a row " * 50_000]:
        assert ids_of(codec.encode_all([text])[0]) == library.encode(text)


def test_small_cache_and_stretches(monkeypatch, model, library):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 20)
    monkeypatch.setattr(pieces, "BATCH_WORDS", 7)
    monkeypatch.setattr(pieces, "STRETCH", 11)
    texts = [*ODD, *random_texts(100), "some words of a text that is cut into many stretches   with spaces " * 5]
    for text, data in zip(texts, pieces.PieceCodec(model).encode_all(texts), strict=True):
        assert ids_of(data) == library.encode(text), text


def test_on_spark(spark, model, library):
    texts = [None, *ODD, "twice", "twice"]
    rows = [(None if i == 3 else i, t, "clash", 1) for i, t in enumerate(texts)] + [(5, "same id", "clash", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, offsets int").repartition(3)
    got = pieces.decode(pieces.encode(docs, model, 2), model).collect()
    want = sorted((repr(i), [*library.encode(t or ""), 2], library.decode(library.encode(t or ""))) for i, t, *_ in rows)
    assert sorted((repr(r.doc_id), r.ids, r.text) for r in got) == want
    assert pieces.encode(docs.limit(0), model, 2).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in pieces.decode(nulls, model).collect()] == ["", ""]


def test_whole_table(spark, model, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in pieces.decode(pieces.encode(docs, model), model).collect():
        assert r.ids == library.encode(text[r.doc_id]) and r.text == library.decode(r.ids)
