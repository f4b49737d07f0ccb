"""Hard negatives against brute force over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from oncospan.llm import cover_tree
from oncospan.llm.common import Scratch

SCHEMA = "vec_id long, label int, embedding array<float>"


def usable(v):
    return bool(v) and all(c is not None and math.isfinite(c) and abs(c) * 256 < 1 << 20 for c in v)


def brute(rows, positives=5, negatives=5, least=80, most=100):
    kept = sorted({(i, lab, tuple(math.floor(256 * float(np.float32(c))) for c in v))
                   for i, lab, v in rows if i is not None and lab is not None and usable(v)})
    out = set()
    for i, lab, x in kept:
        if i % 10:
            continue
        scored = [(sum(a * b for a, b in zip(x, y, strict=True)), j, other) for j, other, y in kept
                  if j != i and len(y) == len(x)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in scored if s[2] == lab][:positives]:
            near = [s for s in scored if s[2] != lab and least * p <= 100 * s[0] <= most * p][:negatives]
            out |= {(i, j, rank, n, p, s) for rank, (s, n, _) in enumerate(near, 1)}
    return out


def mined(spark, rows, schema=SCHEMA, **options):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    got = cover_tree.mine(frame, Scratch(spark), F.col("vec_id") % 10 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return [tuple(r) for r in got.collect()]


def clustered(rng, n, groups, dims=16, noise=0.3):
    centres = rng.normal(size=(groups, dims))
    at = rng.integers(0, groups, n)
    x = centres[at] + noise * rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True) * rng.uniform(0.7, 1.4, (n, 1))
    return [(i, int(lab), v) for i, (lab, v) in enumerate(zip(rng.integers(0, 4, n), x.tolist(), strict=True))]


@pytest.mark.parametrize("block_rows", [40, 4096])
def test_equals_brute_force(spark, block_rows):
    rows = clustered(np.random.default_rng(1), 400, 6)
    got = mined(spark, rows, block_rows=block_rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_other_windows(spark):
    rows = clustered(np.random.default_rng(2), 200, 3)
    got = mined(spark, rows, positives=3, negatives=4, least=55, most=90, block_rows=50)
    assert set(got) == brute(rows, 3, 4, 55, 90) and got


def test_a_third_are_copies_and_ties_go_by_id(spark):
    rng = np.random.default_rng(3)
    rows = clustered(rng, 200, 4, dims=8)
    hot = rows[0][2]
    rows += [(1000 + i, i % 2, hot) for i in range(120)] + [(2000 + i, 3, [0.5, -0.5] * 4) for i in range(30)]
    assert set(mined(spark, rows, block_rows=30)) == brute(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = clustered(rng, 60, 2, dims=4)
    nan, inf = float("nan"), float("inf")
    rows += [(None, 1, [1.0] * 4), (100, None, [1.0] * 4), (110, 1, None), (120, 1, []), (130, 1, [1.0, None, 1.0, 1.0]),
             (140, 1, [nan, 1.0, 1.0, 1.0]), (150, 1, [inf] * 4), (160, 1, [1e30] * 4), (170, 1, [0.0] * 4),
             (180, 1, [1.0, 1.0]), (181, 1, [1.0, 0.5]), (182, 2, [0.9, 0.9])]
    rows += rows[:20]  # equal rows count once
    schema = SCHEMA + ", x int, ids int, k1 int, cell int, place int, mark int, is_anchor int"
    assert set(mined(spark, [(*r, 1, 1, 1, 1, 1, 1, 1) for r in rows], schema)) == brute(rows)


def test_empty_and_alone(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, 1, [1.0, 2.0])]) == []


def test_tree_covers_and_skips():
    rng = np.random.default_rng(5)
    x = np.floor(256 * np.array([v for _, _, v in clustered(rng, 600, 8, noise=0.1)])).astype(np.int64)
    labels = np.array(["a", "b"])[rng.integers(0, 2, len(x))]
    norm = float(np.sqrt((x * x).sum(1).max())) * (1 + 1e-9)
    tree = cover_tree.CoverTree(x, labels, [[i] for i in range(len(x))], norm)
    z = cover_tree.augment(x, norm)

    def below(node):
        own = {int(tree.centre[node])}
        for child in range(tree.first[node], tree.first[node] + tree.count[node]):
            own |= below(child)
        return own

    assert below(0) == set(range(len(x)))
    for node in range(len(tree.centre)):
        away = cover_tree.angles(z[sorted(below(node))] @ z[tree.centre[node]])
        assert away.max() <= tree.radius[node] + cover_tree.SLACK
    scored = []
    plain = tree.scores
    tree.scores = lambda at, q: (scored.extend(at.tolist()), plain(at, q))[1]
    for q, label in zip(x[::50], labels[::50], strict=True):
        scored.clear()
        want = sorted(((int(s), i) for i, s in enumerate(x @ q) if labels[i] != label), key=lambda s: (-s[0], s[1]))
        assert tree.best(q, label, False, [(-2 ** 62, 2 ** 62)], 5) == [want[:5]]
        assert len(scored) < len(x)  # some nodes were skipped
