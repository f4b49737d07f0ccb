"""Packing and line dedup against plain Python over the same rows."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oncospan.llm import line_dedup, packing
from oncospan.llm.common import Scratch, components
from oncospan.llm.line_dedup import CuckooFilter, LineStore

DOCS = "doc_id long, text string"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["Hello,world", "don't STOP", "naïve ﬁ Straße", "ΑΣ σας", "İstanbul", "a b", "<|endoftext|> x", "\x1c\x1f",
       "éte", "한국어 text", "x" * 5000, "1234 ½ ²", "tab\tand\r\nline", "😀!?", "  ", "word​join", "ʼs 'S 'LL"]


@pytest.fixture()
def scratch(spark):
    return Scratch(spark)


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOCS)


# ------------------------------------------------------------ packing

def test_chunked_ids_equal_the_tokenizers(spark):
    whole, ours = Tokenizer.from_file(PATH), packing.WordEncoder(packing.read_text(PATH))
    real = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in [*ODD, " ".join(ODD), "\n".join(ODD), *real]:
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_encoder_remembers_a_bounded_number_of_words():
    whole, ours = Tokenizer.from_file(PATH), packing.WordEncoder(packing.read_text(PATH), cache_words=50)
    for at in range(0, 2000, 100):
        text = " ".join(f"the w{'abcdefghij'[i % 10] * (i // 10 % 7)}{'klmnopqrst'[i % 7] * (i // 70)}," for i in range(at, at + 100))
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        for known in (ours.chunks, ours.pieces):
            assert len(known) <= 50 and len(known.older) <= 50
    assert "the" in ours.chunks or "the" in ours.chunks.older


def test_pack_covers_every_id_once(spark, scratch):
    texts = [None, "", "a b c", *ODD, "many words here " * 2000, "a b c"]
    rows = docs_of(spark, texts).withColumn("ids", F.lit("clash")).withColumn("offset", F.lit(1)).repartition(3)
    pieces = packing.pack(rows, scratch, packing.read_text(PATH), window=64)
    got = pieces.collect()
    whole = Tokenizer.from_file(PATH)
    for doc, text in enumerate(texts):
        want = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted((p for p in got if p.doc_id == doc), key=lambda p: p.start)
        assert [i for p in own for i in np.frombuffer(p.ids, "<u4").tolist()] == want
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert {p.doc_tokens for p in own} == {len(want)}
    places = sorted((p.sequence_id, p.offset, p.length) for p in got)
    at = 0
    for sequence, offset, length in places:
        assert sequence * 64 + offset == at and offset + length <= 64
        at += length
    sequences = {r.sequence_id: r for r in packing.assemble(pieces).collect()}
    assert all(r.n_tokens == 64 == len(r.ids) // 4 for s, r in sequences.items() if s != max(sequences))


def test_pack_digest_and_empty(spark, scratch):
    vocabulary = packing.read_text(PATH)
    piece = packing.pack(docs_of(spark, ["hi"]), scratch, vocabulary).select(F.crc32("ids").alias("c"), "ids").first()
    assert piece.c == zlib.crc32(piece.ids)
    assert packing.pack(docs_of(spark, []), scratch, vocabulary).count() == 0


# ------------------------------------------------------------ line dedup

def plain_lines(texts: dict[int, str | None], min_chars=10):
    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare) if len(bare) >= min_chars else None
    first = {}
    for doc in sorted(texts):
        for line in (texts[doc] or "").split("\n"):
            first.setdefault(key(line), doc)
    out = {}
    for doc, text in texts.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) is None or first[key(x)] == doc]
        out[doc] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


LINES = [None, "", "Common line here\nown line number one\nshort", " common LINE here\t\nÉtait à Paris ce jour", "common line here",
         "était à Paris ce jour\nÉtait à Paris ce jour", "x\n\n\nown line number six\nown line number six", "\x0bcommon line here\x0c"]


def cleaned(rows):
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in rows.collect()}


def test_line_dedup_is_exact(spark, scratch):
    rows = docs_of(spark, LINES).withColumn("key", F.lit("clash")).withColumn("shard", F.lit(9))
    got = line_dedup.dedup_lines(rows, scratch)
    assert cleaned(got) == plain_lines(dict(enumerate(LINES)))
    assert {"key", "shard"} <= set(got.columns)


def test_line_dedup_hot_line_null_ids_empty(spark, scratch):
    texts = ["the very common line\nline of document %d" % i for i in range(300)]
    rows = docs_of(spark, texts).union(spark.createDataFrame([(None, "the very common line")], DOCS))
    got = cleaned(line_dedup.dedup_lines(rows, scratch))
    assert got.pop(None) == ("the very common line", 1, 0)
    assert got == plain_lines(dict(enumerate(texts)))
    assert line_dedup.dedup_lines(docs_of(spark, []), scratch).count() == 0


def test_store_is_reversible(spark, scratch):
    texts = dict(enumerate(LINES))
    first, second = {k: texts[k] for k in (2, 4, 6)}, {k: texts[k] for k in (0, 1, 3, 5, 7)}
    frame = lambda d: spark.createDataFrame(sorted(d.items()), DOCS)
    store = LineStore(spark, scratch, keys_per_shard=2).insert(frame(first))
    before = cleaned(store.clean(frame(first)))
    store.insert(frame(second))
    assert cleaned(store.clean(frame(texts))) == plain_lines(texts)
    store.delete(frame({2: "", 5: ""}).select("doc_id"))
    rest = {k: v for k, v in texts.items() if k not in (2, 5)}
    assert cleaned(store.clean(frame(rest))) == plain_lines(rest)
    store.insert(frame({2: texts[2]})).delete(frame(second).select("doc_id"))
    assert cleaned(store.clean(frame(first))) == before == plain_lines(first)
    assert store.counts.filter("n_docs >= 2").count() == 1


def test_line_dedup_keeps_columns_of_any_name(spark, scratch):
    rows = docs_of(spark, LINES)
    for name in ("n_lines", "N_Dropped", "_drop", "_doc", "_drop_", "filter", "first_doc"):
        rows = rows.withColumn(name, F.lit("clash"))
    got = line_dedup.dedup_lines(rows, scratch)
    assert cleaned(got) == plain_lines(dict(enumerate(LINES)))
    assert set(got.columns) == {"doc_id", "text", "n_lines", "n_dropped", "_drop", "_doc", "_drop_", "filter", "first_doc"}
    assert {r["_drop"] for r in got.collect()} == {"clash"}


def test_store_grows_and_is_saved(spark, scratch, tmp_path):
    """Ten documents make one shard; a hundred thousand more make many, and nothing changes in the results."""
    text = F.concat(F.lit("line of document "), (F.col("id") % 60_000).cast("string"), F.lit("\nlast line "),
                    F.col("id").cast("string"))
    docs = spark.range(100_010).select(F.col("id").alias("doc_id"), text.alias("text"))
    store = LineStore(spark, scratch, keys_per_shard=4000).insert(docs.filter("doc_id < 10"))
    assert store.shards == 1
    store.insert(docs.filter("doc_id >= 10 and doc_id < 20000"))
    middle = store.shards
    store.save(str(tmp_path / "store"))
    store = LineStore.load(spark, scratch, str(tmp_path / "store")).insert(docs.filter("doc_id >= 20000"))
    assert 4 < middle < store.shards and store.shards == -(-store.counts.count() // 4000)
    sizes = {r.shard: len(r.filter) for r in store.filters.collect()}
    assert sorted(sizes) == list(range(store.shards)) and max(sizes.values()) <= 8192 * 2
    out = store.clean(docs).agg(F.sum("n_dropped").alias("dropped"), F.sum("n_lines").alias("lines")).first()
    assert (out.dropped, out.lines) == (40_010, 200_020)
    store.delete(docs.filter("doc_id < 30000").select("doc_id"))
    out = store.clean(docs.filter("doc_id >= 30000")).agg(F.sum("n_dropped").alias("dropped")).first()
    assert out.dropped == 10_010


def test_filter_has_no_false_negatives_and_deletes():
    keys = line_dedup._key_matrix([hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(5000)])
    table = CuckooFilter.sized(5000)
    assert table.insert(keys) and table.contains(keys).all()
    table.delete(keys[:2500])
    assert table.contains(keys[2500:]).all() and table.contains(keys[:2500]).mean() < 0.01
    assert not CuckooFilter.sized(10).insert(keys)


# ------------------------------------------------------------ components

def test_components(spark, scratch):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(i, i + 1) for i in range(1000, 1200)]
    edges += [(2000, 2000 + i) for i in range(1, 50)] + [(5, 5)]
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        if a != b:
            root[max(x, y)] = min(x, y)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long"), scratch)
    assert {r.node: r.component for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0
