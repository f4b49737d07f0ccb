"""Embedding near-dedup against brute force, and its recall at the threshold itself."""

import math

import numpy as np
import pytest

from oncospan.llm import embeddings
from oncospan.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, code string"


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA).repartition(4)
    got = embeddings.near_duplicates(frame, Scratch(spark), **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def brute(rows, cosine=0.93):
    usable = {}
    for vec_id, v, label in rows:
        if vec_id is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            usable[vec_id] = (label, x / np.linalg.norm(x))
    root = {r[0]: r[0] for r in rows}
    links = {r[0]: 0 for r in rows}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in usable:
        for b in usable:
            one, two = usable[a], usable[b]
            if a != b and one[0] == two[0] and len(one[1]) == len(two[1]) and one[1] @ two[1] >= cosine:
                links[a] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    out = [(i, links[i], find(i), find(i) == i) if i is not None else (None, 0, None, None) for i in links]
    return sorted(out, key=repr)


def clusters(rng, n_groups, size, noise, dims=64):
    rows = []
    for g in range(n_groups):
        centre = rng.normal(size=dims)
        for _ in range(int(rng.integers(1, size))):
            x = centre / np.linalg.norm(centre) + noise * rng.normal(size=dims) / np.sqrt(dims)
            rows.append((len(rows), [float(v) for v in x], g % 3))
    return rows


def test_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = clusters(rng, 60, 8, 0.1)
    n = len(rows)
    base = rows[0][1]
    rows += [(n + i, base, 0) for i in range(12)] + [(n + 20, base, 1), (n + 21, base, None), (n + 22, None, 0),
             (n + 23, [0.0] * 64, 0), (n + 24, [float("nan"), *base[1:]], 0), (n + 25, [None, *base[1:]], 0),
             (n + 26, base[:32], 0), (n + 27, base[:32], 0), (n + 28, [], 0), (None, base, 0)]
    assert run(spark, rows) == brute(rows)


def test_hot_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 32)
    monkeypatch.setattr(embeddings, "SMALL_BUCKET", 40)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=64)
    rows = [(i, [float(v) for v in centre + 0.05 * rng.normal(size=64)], 1) for i in range(300)]
    rows += [(1000 + r[0], r[1], 1 + r[2]) for r in clusters(rng, 150, 4, 0.1)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("noise,least", [(0.17, 0.999), (0.26, 0.9)])
def test_recall_of_links(spark, noise, least):
    """0.17: cosines about 0.97; 0.26: about 0.93 to 0.95, just above the threshold, where codes differ most."""
    rows = clusters(np.random.default_rng(2), 150, 7, noise)
    got, want = run(spark, rows), brute(rows)
    assert sum(r[1] for r in want) > 300
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))  # none below the threshold
    assert sum(r[1] for r in got) >= least * sum(r[1] for r in want)


def threshold_pairs(rng, n, low=0.930, high=0.932, dims=64):
    """Pairs of unit vectors whose cosine lies in [low, high]."""
    rows = []
    for i in range(n):
        u, w = rng.normal(size=(2, dims))
        u /= np.linalg.norm(u)
        w -= (w @ u) * u
        c = rng.uniform(low, high)
        v = c * u + np.sqrt(1 - c * c) * w / np.linalg.norm(w)
        rows += [(2 * i, u.tolist(), 1), (2 * i + 1, v.tolist(), 1)]
    return rows


def test_recall_at_the_threshold(spark):
    rows = threshold_pairs(np.random.default_rng(5), 1500)
    got = run(spark, rows)
    assert all(r[1] <= 1 for r in got)
    assert sum(r[1] for r in got) >= 0.95 * len(rows)


def test_exact_option_misses_nothing(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 64)
    rows = threshold_pairs(np.random.default_rng(6), 200) + [(1000 + r[0], r[1], 2 + r[2]) for r in clusters(
        np.random.default_rng(7), 40, 6, 0.2)]
    assert run(spark, rows, exact=True) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []
