"""Embedding whitening by weighted multiplicity covariance.

1. Every usable vector becomes a vector x of whole numbers, floor(scale * c) + shift per entry.
2. Identical x are grouped: one row with its count. Partial counts meet before the shuffle, so a vector that a third of
   all rows hold is one row per task. Each distinct x gets a fit weight, its count or one.
3. Exact weighted sums S per dimension are whole numbers. The covariance is a weighted product of (x - S/n): each task
   adds up its own part, the parts are added entry by entry in Spark, and only a matrix of dimensions squared reaches
   the driver, which takes its eigenvectors.
4. Every distinct x is whitened once; rows get the result by a join on x, which adaptive execution splits where one x
   is common. The covariance of the whitened rows is measured by the same weighted product.

Defined results: vectors that are null or empty, or hold null or non-finite entries, are left out, and so are those with
an entry whose x is beyond 2**52 in size. Vectors of different lengths are whitened separately. Directions without variance
(eigenvalue at most 1e-12 of the trace) have no whitened value and no row; one vector alone thus gives no rows. Null and
repeated vec_id are rows like any other. A deviation beyond a 64-bit integer is null. Signs of components are arbitrary but the
same for all rows; equal eigenvalues may come in either order. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch, map_arrow, small_batches

FLAT = 1e-12  # eigenvalues up to this part of the trace are no direction
LARGEST = 2.0 ** 52


class Whitening:
    """Fit of the vectors of one length: n, sums S, eigenvalues and eigenvectors (columns), largest first."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int):
        self.n, self.sums = n, sums
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1], vectors[:, ::-1]
        self.trace = float(np.trace(covariance))
        kept = min(components, int((values > FLAT * self.trace).sum()))
        self.values, self.vectors = values[:kept], vectors[:, :kept]

    def scaled_deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S per entry, exact: 64-bit where that holds them, else Python integers."""
        largest = max(int(np.abs(x).max(initial=0)), 1)
        if self.n * largest + max(map(abs, self.sums)) < 2 ** 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled_deviations(x) / self.n).astype(np.float64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S) ** 2; null beyond a 64-bit integer."""
        d = self.scaled_deviations(x)
        if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 2 ** 63:
            return (d * d).sum(1).tolist()
        exact = (d.astype(object) ** 2).sum(1).tolist()
        return [v if v < 2 ** 63 else None for v in exact]


def whole_vectors(vectors: DataFrame, scale: float, shift: int) -> DataFrame:
    """(vec_id, x) of the usable rows."""
    entries = F.col("embedding").cast("array<double>")

    def scaled(c: Column) -> Column:
        return F.floor(F.lit(float(scale)) * c)

    def usable(c: Column) -> Column:
        # NaN compares as the largest number
        return c.isNotNull() & (F.abs(c) * abs(float(scale)) + abs(shift) < LARGEST)

    whole = F.transform("v", lambda c: scaled(c) + F.lit(shift).cast("long"))
    rows = vectors.select("vec_id", entries.alias("v"))
    return rows.select("vec_id", F.when((F.size("v") > 0) & F.forall("v", usable), whole).alias("x")).filter(
        "x is not null")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _by_length(column: pa.Array) -> list[tuple[int, np.ndarray]]:
    lengths = np.diff(column.offsets.to_numpy())
    return [(size, np.flatnonzero(lengths == size)) for size in np.unique(lengths).tolist()]


def weighted_products(rows: DataFrame, transforms: dict[int, Callable[[np.ndarray], np.ndarray]]) -> dict[int, np.ndarray]:
    """Per vector length: covariance (divisor: sum of weights) of the transformed vectors of (x, weight).

    Each task keeps weight, mean and centred products of what it has seen, and joins batches to them; its result is
    taken to a common centre by its mean when the parts are added up.
    """
    def make() -> Callable[[dict | None], dict | None]:
        state: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}

        def step(c: dict | None) -> dict | None:
            if c is None:
                out: dict[str, list] = {"length": [], "i": [], "weight": [], "mean": [], "row": []}
                for size, (w, mean, m2) in state.items():
                    for i in range(len(mean)):
                        out["length"].append(size)
                        out["i"].append(i)
                        out["weight"].append(w)
                        out["mean"].append(mean.tolist())
                        out["row"].append((m2[i] + w * mean[i] * mean).tolist())
                return out
            weights = c["weight"].to_numpy(zero_copy_only=False).astype(np.float64)
            for size, at in _by_length(c["x"]):
                y = transforms[size](_matrix(c["x"].take(pa.array(at))))
                w = weights[at]
                total, mean = w.sum(), w @ y / w.sum()
                part = y - mean
                m2 = (part * w[:, None]).T @ part
                if size in state:
                    w0, mean0, m20 = state[size]
                    gap = mean - mean0
                    m2 = m20 + m2 + np.outer(gap, gap) * (w0 * total / (w0 + total))
                    mean = mean0 + gap * (total / (w0 + total))
                    total = w0 + total
                state[size] = (total, mean, m2)
            return None

        return step

    parts = map_arrow(rows.select("x", "weight"), make,
                      "length int, i int, weight double, mean array<double>, row array<double>", flush=True)
    entries = parts.select("length", "i", "weight", F.col("mean")[F.col("i")].alias("mean"),
                           F.posexplode("row").alias("j", "v"))
    sums = entries.groupBy("length", "i", "j").agg(F.sum("v").alias("v"), F.sum("weight").alias("w"),
                                                   F.sum(F.col("weight") * F.col("mean")).alias("m"))
    out: dict[int, np.ndarray] = {}
    got = sums.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("i", "j", "v", "w", "m"))).alias("cells"))
    for r in got.collect():  # a square matrix per vector length
        d = int(round(len(r.cells) ** 0.5))
        cells = np.array([(c.v, c.w, c.m) for c in r.cells]).reshape(d, d, 3)
        mean = cells[:, 0, 2] / cells[:, 0, 1]
        out[r.length] = cells[:, :, 0] / cells[0, 0, 1] - np.outer(mean, mean)
    return out


def fit(distinct: DataFrame, components: int) -> dict[int, Whitening]:
    """A fit per vector length from distinct vectors (x, weight)."""
    entries = distinct.select(F.size("x").alias("length"), "weight", F.posexplode("x").alias("i", "v"))
    # products and sums in decimals: exact at any number of rows
    sums = (entries.groupBy("length", "i").agg(F.sum(F.col("weight").cast("decimal(19,0)") * F.col("v").cast("decimal(19,0)"))
                                               .alias("s"), F.sum("weight").alias("n"))
            .groupBy("length").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("sums")))
    known = {r.length: (r.n, [int(s.s) for s in r.sums]) for r in sums.collect()}  # one row per vector length
    centre = {}
    for size, (n, total) in known.items():
        start = Whitening.__new__(Whitening)
        start.n, start.sums = n, total
        centre[size] = start.centred
    if not known:
        return {}
    covariances = weighted_products(distinct, centre)
    return {size: Whitening(*known[size], covariances[size], components) for size in known}


def whiten(vectors: DataFrame, scratch: Scratch, scale: float = 64, shift: int = 1_000_000, components: int = 32,
           weights: str = "counts") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row per usable vector and component.

    ``weights``: "counts" fits on all rows, "one" on distinct vectors; n is the sum of the weights.
    """
    if weights not in ("counts", "one"):
        raise ValueError('weights is "counts" or "one"')
    small_batches(vectors.sparkSession, 4000)
    rows = whole_vectors(vectors, scale, shift)
    counted = rows.groupBy("x").agg(F.count("*").alias("copies"))
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    distinct = scratch.write(counted.select("x", weight.alias("weight")), "distinct")
    fits = fit(distinct, components)
    useful = {size: f for size, f in fits.items() if len(f.values)}
    errors = {size: float(np.abs(c - np.eye(len(c))).max()) for size, c in weighted_products(
        distinct.filter(F.size("x").isin(sorted(useful))), {size: f.whitened for size, f in useful.items()}).items()}

    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            out: dict[str, list] = {"x": c["x"], "deviation": [None] * len(c["x"]), "whitened": [None] * len(c["x"])}
            for size, at in _by_length(c["x"]):
                x, f = _matrix(c["x"].take(pa.array(at))), useful[size]
                for k, deviation, values in zip(at.tolist(), f.deviations(x), f.whitened(x).tolist(), strict=True):
                    out["deviation"][k], out["whitened"][k] = deviation, values
            return out

        return step

    once = map_arrow(distinct.select("x").filter(F.size("x").isin(sorted(useful))), make,
                     "x array<long>, deviation long, whitened array<double>")
    facts = [(size, f.n, errors[size], [float(v) / f.trace for v in f.values]) for size, f in useful.items()]
    facts = vectors.sparkSession.createDataFrame(facts, "length int, n long, identity_error double, parts array<double>")
    joined = rows.join(scratch.write(once, "whitened"), "x").withColumn("length", F.size("x"))
    # one row per vector length, which the driver has just fitted
    out = joined.join(F.broadcast(facts), "length").select(
        "vec_id", "n", "deviation", "identity_error", "parts", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                      F.col("parts")[F.col("at")].alias("explained"), "identity_error")
