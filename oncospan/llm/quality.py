"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; the unlabelled sample is web text of unknown quality. With the class
prior p, the risk of a scorer g is estimated without any negative:

    p * E_pos[loss(g, +1)]  +  max(0, E_unl[loss(g, -1)] - p * E_pos[loss(g, -1)])

The second term estimates the risk on negatives; clipping it at zero (the non-negative estimator) keeps a flexible scorer
from driving it below what any scorer can reach. The prior is estimated over all documents: for every score region S,
P_unl(S) / P_pos(S) is at least p, and it is p where S holds no negatives, so p is the smallest such ratio of a scorer that
tells positives from unlabelled. The documents are dealt into two halves; each half's regions are counted, in one
aggregation over all of them, under a scorer that learned from the other.

Only bounded samples (``sample_rows`` positives and as many unlabelled rows, chosen by a hash of doc_id) set the weights
of the scorers; every whole text is described, counted and scored. A text is described by shape alone (lengths,
repetition, character classes); labels, language, source and doc_id are no inputs.

Defined results: null text scores like empty text; every score lies between 0 and 1. A labelled doc_id that no document
has, null labels and null doc_ids teach nothing; repeated label rows count once, and contradicting ones not as positives.
Without any positive or without documents the model is neutral: 0.5 for every text, so everything is kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch, map_arrow, small_batches, summed

SAMPLE_ROWS = 12_000
BINS, WIDEST = 4096, 30.0  # score regions end at multiples of 60 / 4096 of the log-odds

# Byte classes.
_KIND = np.zeros(256, np.uint8)  # 0: other
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[ord(c) for c in ".,;:'\"()-?"]] = 5
_KIND[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_KIND[128:] = 7

FEATURES = 23


def features(text: str | None) -> np.ndarray:
    """Shape of a whole text, as numbers of comparable size. Words are runs between ASCII white space."""
    data = (text or "").encode()
    kind = _KIND[np.frombuffer(b" " + data + b" ", np.uint8)]
    share = np.bincount(kind, minlength=8) / len(kind)
    space = kind == 4
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:])
    n = max(1, len(starts))
    lengths = ends - starts + 1 if len(starts) else np.zeros(1, np.int64)
    first, last = np.bincount(kind[starts], minlength=8) / n, np.bincount(kind[ends], minlength=8) / n
    upper = np.concatenate([[0], np.cumsum(kind == 2)])
    shouted = ((upper[ends + 1] - upper[starts] > 1) & (2 * (upper[ends + 1] - upper[starts]) > lengths)).sum() / n \
        if len(starts) else 0.0
    words = data.split()
    counts = Counter(words)
    top = sorted(counts.values(), reverse=True)[:3] + [0] * 3
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    lines = data.split(b"\n")
    n_lines = len(lines)
    letters = share[1] + share[2] + share[7] + 1e-6
    return np.array([
        np.log1p(len(words)) / 5, lengths.mean() / 6, lengths.std() / 4, (lengths > 18).mean() * 4, len(counts) / n,
        np.log1p(len(counts)) / 5, top[0] / n * 4, sum(top[:3]) / n * 2, repeats / n * 4, share[2] / letters * 4,
        share[3] * 10, share[5] * 10, share[6] * 10, share[7] * 2, share[4] * 5, first[2] * 4, shouted * 4,
        (first[6] + first[3]) * 4, last[6] * 4, last[5] * 4, np.log1p(n_lines) / 3, len(set(lines)) / n_lines,
        np.log1p(n / n_lines) / 4])


# ------------------------------------------------------------ the model

class Scorer:
    """One hidden layer of rectifiers over standardised features; the output is the log-odds of the positive class."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, hidden: int = 32, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = [rng.normal(0, np.sqrt(2 / len(mean)), (len(mean), hidden)), np.zeros(hidden),
                  rng.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1)]

    def _input(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(self._input(x) @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]

    def gradient(self, x: np.ndarray, by_output: np.ndarray) -> list[np.ndarray]:
        z = self._input(x)
        h = np.maximum(z @ self.w[0] + self.w[1], 0)
        back = np.outer(by_output, self.w[2]) * (h > 0)
        return [z.T @ back, back.sum(0), h.T @ by_output, np.array([by_output.sum()])]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int = 60, batch: int = 512,
          rate: float = 3e-3, decay: float = 1e-4, seed: int = 0) -> Scorer:
    """Minimise the non-negative risk under ``prior``; with ``prior`` None, tell positives from unlabelled."""
    both = np.concatenate([positive, unlabelled])
    model = Scorer(both.mean(0), both.std(0) + 1e-3, seed=seed)
    rng = np.random.default_rng(seed)
    first, second = [np.zeros_like(w) for w in model.w], [np.zeros_like(w) for w in model.w]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(unlabelled))
        for lo in range(0, len(order), batch):
            u = unlabelled[order[lo:lo + batch]]
            p = positive[rng.integers(0, len(positive), batch)]
            g_u, g_p = model.odds(u), model.odds(p)
            if prior is None:
                grad = _sum(model.gradient(p, -sigmoid(-g_p) / len(p)), model.gradient(u, sigmoid(g_u) / len(u)))
            else:
                # logistic loss: loss(g, -1) = log(1 + e^g), loss(g, +1) = log(1 + e^-g)
                negative_risk = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
                on_negative = _sum(model.gradient(u, sigmoid(g_u) / len(u)),
                                   model.gradient(p, -prior * sigmoid(g_p) / len(p)))
                if negative_risk >= 0:
                    grad = _sum(model.gradient(p, -prior * sigmoid(-g_p) / len(p)), on_negative)
                else:  # step back until the estimate is possible again
                    grad = [-g for g in on_negative]
            step += 1
            now = rate * (1 - epoch / epochs)
            for i, g in enumerate(grad):
                g = g + decay * model.w[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                model.w[i] -= now * first[i] / (1 - 0.9 ** step) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _sum(one: list[np.ndarray], two: list[np.ndarray]) -> list[np.ndarray]:
    return [a + b for a, b in zip(one, two, strict=True)]


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 0) -> float:
    """Smallest P_unl(S) / P_pos(S) over upper score regions of a scorer trained on the other half of both samples."""
    halves = [(positive[0::2], unlabelled[0::2], positive[1::2], unlabelled[1::2]),
              (positive[1::2], unlabelled[1::2], positive[0::2], unlabelled[0::2])]
    found = []
    for p, u, p_test, u_test in halves:
        if not len(p) or not len(u) or not len(p_test) or not len(u_test):
            return 0.5
        model = train(p, u, None, epochs=15, seed=seed)
        s_p, s_u = np.sort(model.odds(p_test)), np.sort(model.odds(u_test))
        ratios = []
        for share in np.linspace(0.4, 1.0, 61):
            at = s_p[int((1 - share) * (len(s_p) - 1))]
            in_p, in_u = (s_p >= at).mean(), (s_u >= at).mean()
            error = np.sqrt(in_u * (1 - in_u) / len(s_u) + in_u ** 2 * (1 - in_p) / in_p / len(s_p))
            ratios.append((in_u + error) / in_p)
        found.append(min(ratios))
    return float(np.clip(np.mean(found), 0.01, 0.99))


# ------------------------------------------------------------ on documents

@dataclass
class QualityModel:
    """A trained scorer, or the neutral one."""

    prior: float
    scorer: Scorer | None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.scorer is None or not len(x):
            return np.full(len(x), 0.5)
        return np.round(sigmoid(self.scorer.odds(x)), 12)  # the last digits depend on the batch


def smallest_ratio(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest P_unl(S) / P_pos(S) over upper score regions, from counts per bin of rising score. The ratio's own
    error is added, and regions with less than 0.4 of the positives are too small to count."""
    n_p, n_u = positive.sum(), unlabelled.sum()
    if not n_p or not n_u:
        return 0.5
    in_p, in_u = np.cumsum(positive[::-1]) / n_p, np.cumsum(unlabelled[::-1]) / n_u
    large = in_p >= 0.4
    in_p, in_u = in_p[large], in_u[large]
    error = np.sqrt(in_u * (1 - in_u) / n_u + in_u ** 2 * (1 - in_p) / in_p / n_p)
    return float(((in_u + error) / in_p).min())


def corpus_prior(described: DataFrame, scorers: list[Scorer]) -> float:
    """The class prior from all described documents (fold, trusted, x); fold i is scored by scorer i."""
    def part(c: dict) -> np.ndarray:
        out = np.zeros((2, 2, BINS))
        x = c["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
        fold, trusted = c["fold"].to_numpy(), c["trusted"].to_numpy(zero_copy_only=False).astype(bool)
        for f, scorer in enumerate(scorers):
            own = fold == f
            odds = np.clip(scorer.odds(x[own]), -WIDEST, WIDEST)
            at = np.minimum(((odds + WIDEST) * (BINS / (2 * WIDEST))).astype(np.int64), BINS - 1)
            out[f, 0] += np.bincount(at[trusted[own]], minlength=BINS)
            out[f, 1] += np.bincount(at, minlength=BINS)
        return out

    counts = summed(described.select("fold", "trusted", "x"), part, 4 * BINS).reshape(2, 2, BINS)
    return float(np.clip(np.mean([smallest_ratio(p, u) for p, u in counts]), 0.01, 0.99))


def fit(docs: DataFrame, positives: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Train on a hash sample of ``positives`` (doc_id) and of ``docs`` (doc_id, text), about ``sample_rows`` of each,
    with the prior of all ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    trusted = positives.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()

    def make() -> Callable[[dict], dict]:
        return lambda c: {"doc_id": c["doc_id"], "x": [features(t).tolist() for t in c["text"].to_pylist()]}

    described = map_arrow(docs, make, "doc_id long, x array<double>").join(
        trusted.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumns(
        {"trusted": F.coalesce("trusted", F.lit(False)), "fold": F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)).cast("int")})
    described = scratch.write(described, "described")  # 24 numbers a document
    sizes = described.agg(F.count("*").alias("n"), F.count_if("trusted").alias("n_trusted")).first()
    positive_part = F.col("trusted") & _share("positive", sample_rows, sizes.n_trusted)
    web_part = _share("unlabelled", sample_rows, sizes.n)
    sample = described.filter(positive_part | web_part).select(
        "fold", positive_part.alias("positive"), web_part.alias("web"), "x").collect()
    sample.sort(key=lambda r: r.x)  # the order of rows between runs is not fixed

    def rows(kind: str, seed: int) -> tuple[np.ndarray, np.ndarray]:
        chosen = [r for r in sample if r[kind]]
        np.random.default_rng(seed).shuffle(chosen)
        return np.array([r.x for r in chosen]).reshape(-1, FEATURES), np.array([r.fold for r in chosen], int)

    (positive, p_fold), (web, w_fold) = rows("positive", 1), rows("web", 2)
    if not len(positive) or not len(web):
        return QualityModel(0.5, None)
    if all((p_fold == f).any() and (w_fold == f).any() for f in (0, 1)):
        prior = corpus_prior(described, [train(positive[p_fold != f], web[w_fold != f], None, epochs=15) for f in (0, 1)])
    else:
        prior = 0.5
    scratch.close()
    return QualityModel(prior, train(positive, web, prior))


def _share(name: str, rows: int, of: int) -> Column:
    """True for about ``rows`` of ``of`` ids, by hash."""
    return F.pmod(F.xxhash64("doc_id", F.lit(name)), F.lit(1 << 30)) < int(min(1.0, rows / max(1, of)) * (1 << 30))


def with_score(docs: DataFrame, model: QualityModel, column: str = "score") -> DataFrame:
    """``docs`` and the score of every whole text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts]).reshape(-1, FEATURES)
            yield pd.Series(model.score(x), dtype="float64")

    return docs.withColumn(column, score(F.col("text")))
