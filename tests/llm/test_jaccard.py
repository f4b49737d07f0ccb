"""The n-gram Jaccard join against brute force over real strings."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oncospan.llm import jaccard
from oncospan.llm.common import Scratch
from oncospan.llm.jaccard import Bands, JaccardJoin

SPACE = " \t\n\x0b\x0c\r"


def shingle_set(text, k):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE:
        lower = lower.replace(c, " ")
    w = [x for x in lower.split(" ") if x]
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(texts, k, num, den):
    sets = {d: shingle_set(t, k) for d, t in texts.items()}
    root = {d: d for d in texts}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(d for d in texts if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if find(a) == find(b) or min(len(sets[a]), len(sets[b])) * den < num * max(len(sets[a]), len(sets[b])):
                continue
            both = len(sets[a] & sets[b])
            if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in texts}


def run(spark, texts, k, num, den):
    rows = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    rows = rows.withColumn("n", F.lit("clash")).withColumn("rep", F.lit(1)).repartition(5)
    got = JaccardJoin(Scratch(spark), k, num, den).groups(rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()}


def made(seed=0):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [None, "", " \t\n", "One", "one", "a b", "A  b", "a b", "Ünder ünder", "long " * 3000]
    for size in (5, 8, 12, 20, 40, 90, 200):
        base = words(size)
        for edits in (0, 0, 1, 1, 2, 3, 5, 8, 12):
            copy = list(base)
            for _ in range(edits):
                at = rng.randrange(len(copy))
                kind = rng.random()
                if kind < 0.4:
                    copy[at] = rng.choice(vocabulary)
                elif kind < 0.7 and len(copy) > 2:
                    del copy[at]
                else:
                    copy.insert(at, rng.choice(vocabulary))
            texts.append(" ".join(copy))
    passage = words(60)
    texts += [" ".join([*words(rng.randrange(3, 40)), *passage, *words(rng.randrange(3, 40))]) for _ in range(40)]
    rng.shuffle(texts)
    return {i * 3 + 1: t for i, t in enumerate(texts)}


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100), (2, 60, 100)])
def test_components_equal_brute_force(spark, k, num, den):
    texts = made(k)
    assert run(spark, texts, k, num, den) == brute(texts, k, num, den)


def test_large_group_of_near_copies(spark, monkeypatch):
    """Blocks of 16 rows split a group of 150 near copies, of which many pairs are below the threshold."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 16)
    rng = random.Random(7)
    base = ["w%d" % rng.randrange(500) for _ in range(120)]
    texts = {}
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(1, 8)):
            copy[rng.randrange(120)] = "e%d" % rng.randrange(9999)
        texts[i] = " ".join(copy)
    texts |= {200 + i: texts[0] for i in range(60)}
    assert run(spark, texts, 4, 85, 100) == brute(texts, 4, 85, 100)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A B c d e f"), (2, None)]
    got = JaccardJoin(Scratch(spark), 4, 85, 100).groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [(None, 3, None), (4, 3, 4), (4, 3, 4), (9, 3, 4), (2, 0, 2)], key=repr)
    empty = JaccardJoin(Scratch(spark)).groups(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0


def test_linked_sets_always_share_a_signature():
    """Random pairs exactly at the threshold, at every size up to 150."""
    rng = np.random.default_rng(0)
    for num in (60, 80, 85, 95):
        bands = Bands(num, 100)
        for n in range(1, 150):
            both = n
            extra = 0
            while 100 * both >= num * (both + extra + 1):
                extra += 1
            pool = rng.integers(0, 2**63, both + extra).astype(np.uint64)
            cut = both + int(rng.integers(0, extra + 1))
            a, b = np.unique(pool[:cut]), np.unique(np.concatenate([pool[:both], pool[cut:]]))
            if len(a) != len(b) or (a != b).any():
                assert np.intersect1d(jaccard.signatures(a, bands), jaccard.signatures(b, bands)).size
