"""Order MinHash against plain Python, which computes every step anew."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from oncospan.llm import order_minhash as omh
from oncospan.llm.queries import op5_order_minhash

MASK, LOW = (1 << 64) - 1, (1 << 24) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & MASK).to_bytes(8, "little") if isinstance(v, int) else v
        seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def plain(text, k=3, order=2, sketches=64):
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    if not words:
        return []
    kmers = [xx(words[i:i + k]) >> 24 for i in range(max(1, len(words) - k + 1))]
    seen, circle = {}, []
    for at, kmer in enumerate(kmers):
        n = seen[kmer] = seen.get(kmer, -1) + 1
        number = n.to_bytes(4, "little", signed=True)
        circle.append((kmer if n == 0 else xx([kmer, number]) >> 24, at))
    circle.sort()
    out = []
    for b in range(sketches):
        start = (b - sketches // 2) * (1 << (40 - 6))
        i = next((i for i, (h, _) in enumerate(circle) if h >= start), 0)
        taken = [circle[(i + j) % len(circle)] for j in range(min(order, len(circle)))]
        out.append(xx([h for h, _ in sorted(taken, key=lambda x: (x[1], x[0]))]) & 0xFFFF)
    return out


def texts():
    rng = random.Random(3)
    word = lambda: "w%d" % rng.randrange(40)
    long = [" ".join(word() for _ in range(n)) for n in (1, 2, 3, 4, 7, 30, 200, 1500)]
    return [None, "", "  \n\t", "one", "one two", "É à 😀 b c", "same " * 700, "a b c a b c a b c x", "x" * 30000, *long, "one two", ""]


def test_sketches_equal_plain(spark):
    rows = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").withColumn("_h", F.lit("clash"))
    got = {r.doc_id: r.s for r in omh.with_sketches(rows.drop("_h"), "text", "s").collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts())}


def edited_of(text, following):
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: i * i * 7 - 50])
def test_query_equals_plain(spark, tmp_path, ids):
    rows = [(ids(i), t, "extra") for i, t in enumerate(texts())]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, sketches string").repartition(4).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op5_order_minhash(spark, str(tmp_path)).collect()}
    order = sorted((i, t or "") for i, t, _ in rows)
    assert len(got) == len(order)
    for (i, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        edited = edited_of(text, following)
        own, other, after = plain(text), plain(edited), plain(following)
        like = lambda a, b: float(a == b) if not a or not b else sum(map(int.__eq__, a, b)) / 64
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == "".join("%04x" % x for x in own)
        assert got[i].edited_fingerprint == "".join("%04x" % x for x in other)
        assert got[i].near_edited == pytest.approx(like(own, other))
        assert got[i].near_next == pytest.approx(like(own, after))


def test_ties_null_ids_one_row_and_empty(spark, tmp_path):
    rows = [(5, "b"), (5, "a"), (None, "n"), (9, "z"), (5, "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in omh.with_next(frame, "doc_id", "text").fillna(-1).collect())
    assert got == [(-1, "n", "a"), (5, "a", "a"), (5, "a", "b"), (5, "b", "z"), (9, "z", "n")]
    assert omh.with_next(frame.filter("doc_id = 9"), "doc_id", "text").collect()[0].next_text == "z"
    assert omh.with_next(frame.filter("doc_id = 0"), "doc_id", "text").count() == 0


def test_likeness_follows_edits(spark):
    """More moved or replaced words, less likeness; order matters although the words stay."""
    rng = random.Random(0)
    words = ["w%d" % i for i in range(400)]
    few, many = list(words), list(words)
    for at in rng.sample(range(400), 6):
        few[at] = "x%d" % at
    for at in rng.sample(range(400), 60):
        many[at] = "y%d" % at
    a, b, c = (plain(" ".join(w)) for w in (words, few, many))
    like = lambda x, y: sum(map(int.__eq__, x, y)) / 64
    assert like(a, a) == 1 > like(a, b) > like(a, c)
