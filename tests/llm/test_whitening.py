"""Whitening against numpy over the same rows."""

import math

import numpy as np
import pytest

from oncospan.llm import whitening
from oncospan.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>"


def whitened(spark, rows, schema=SCHEMA, **options):
    return whitening.whiten(spark.createDataFrame(rows, schema).repartition(3), Scratch(spark), **options).collect()


def check(got, rows, components=32, weights="counts", shift=1_000_000):
    """rows: usable (vec_id, vector) of one length."""
    x = {}
    for i, v in rows:
        x.setdefault(i, []).append([math.floor(64 * float(np.float32(c))) + shift for c in v])
    every = np.array([v for vs in x.values() for v in vs], np.int64)
    fit = every if weights == "counts" else np.unique(every, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = (n * every - s) / n
    base = (n * fit - s) / n
    values, vectors = np.linalg.eigh(base.T @ base / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(components, int((values > 1e-12 * values.sum()).sum()))
    at = {(i, tuple(v)): k for k, (i, v) in enumerate((i, v) for i, vs in x.items() for v in vs)}
    assert len(got) == len(every) * kept
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.component), []).append(r)
        assert r.n == n and abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
        assert 0 <= r.identity_error < 1e-6
    signs = {}
    for (i, v), k in at.items():
        d = n * np.array(v, object) - s.astype(object)
        want = centred[k] @ vectors[:, :kept] / np.sqrt(values[:kept])
        for c in range(1, kept + 1):
            same = [r for r in by_row[i, c] if r.deviation == int((d * d).sum())]
            assert same
            value = next(r.whitened for r in same if abs(abs(r.whitened) - abs(want[c - 1])) < 1e-6)
            if abs(want[c - 1]) > 1e-3:
                assert signs.setdefault(c, np.sign(value * want[c - 1])) == np.sign(value * want[c - 1])


def vectors(rng, n, dims):
    return [(i, v) for i, v in enumerate((rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims)) * 0.3).tolist())]


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_equals_numpy_with_a_hot_vector(spark, weights):
    rows = vectors(np.random.default_rng(1), 300, 40)
    rows += [(1000 + i, rows[0][1]) for i in range(150)]
    check(whitened(spark, rows, weights=weights), rows, weights=weights)


def test_odd_rows(spark):
    rows = vectors(np.random.default_rng(2), 50, 5)
    odd = [(60, None), (61, []), (62, [1.0, None, 1.0, 1.0, 1.0]), (63, [float("nan")] * 5), (64, [float("inf")] * 5),
           (65, [3e38] * 5)]
    rows += [rows[0], (70, rows[1][1])]
    schema = SCHEMA + ", x int, weight int, length int, n int, at int"
    got = whitened(spark, [(*r, 1, 1, 1, 1, 1) for r in rows + odd], schema)
    single = [r for r in got if r.vec_id != 0]  # vec_id 0 is there twice
    assert len(got) == 52 * 5 and len([r for r in got if r.vec_id == 0]) == 10 and len(single) == 50 * 5
    assert {r.n for r in got} == {52}


def test_lengths_do_not_mix(spark):
    rng = np.random.default_rng(3)
    short, long = vectors(rng, 30, 3), [(100 + i, v) for i, v in vectors(rng, 40, 6)]
    got = whitened(spark, short + long, components=4)
    check([r for r in got if r.vec_id < 100], short, 4)
    check([r for r in got if r.vec_id >= 100], long, 4)


def test_flat_directions_have_no_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [a, 2 * a, 0.25]) for i, a in enumerate(np.round(rng.normal(size=20) * 8) / 8)]
    got = whitened(spark, [(i, [float(c) for c in v]) for i, v in rows])
    assert {r.component for r in got} == {1} and len(got) == 20 and all(r.explained == pytest.approx(1) for r in got)
    assert whitened(spark, [(1, [1.0, 2.0])]) == []
    assert whitened(spark, []) == []


def test_deviation_beyond_long_is_null():
    fit = whitening.Whitening(10 ** 9, [0, 0], np.eye(2), 2)
    assert fit.deviations(np.array([[10, 0], [10 ** 6, 0]])) == [None, None]
    assert fit.deviations(np.array([[2, 1]])) == [5 * 10 ** 18]
    with pytest.raises(ValueError):
        whitening.whiten(None, None, weights="other")
