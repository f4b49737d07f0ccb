"""Mixing sources to target weights by iterative proportional fitting.

Every document lies in a cell (source, language, topic). Raking finds factors of sources, languages and topics so that
token weights, tokens x factor x factor x factor, meet the target share of every source, language and topic at once.
Documents are then kept with calibrated probabilities: the raked factors of a sample as large as possible, where a
probability is at most 1 and the rest is raked again, so the expected tokens of the sample have the target shares. A
sample cannot be larger than its scarcest value allows: all of its tokens over its target share.

Topics come from spherical k-means over hashed words. Vectors of all documents are staged once; first centres are drawn
from a bounded sample, and every round moves them by all documents. Languages and topics are few, sources may be many: a
source is one row with its tokens per (language, topic), so a round of raking is one pass over the sources, of which only
the (language, topic) sums reach the driver. Hot sources are summed up before the shuffle.

Defined results: null source or language is a value of its own. A text without words has topic 0 and no tokens; it is
kept, as it weighs nothing. Targets without a value present are ignored, values without a target keep their natural
share; targets are scaled to add up to one. A source with a positive target but no tokens gets nothing. Rows with one
doc_id share their fate. Only ``doc_id``, ``text``, ``lang`` and ``source`` are read; other columns are handed on.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch, map_arrow, small_batches, summed

WORD_BUCKETS = 512
CACHE_WORDS = 200_000
MISSING = "\x00"  # stands for null in a key
CELL = ["source_key", "lang_key", "topic"]


class WordBuckets(dict):
    """Word to bucket, for the words met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word) % WORD_BUCKETS
        return value


def word_vector(text: str | None, known: WordBuckets) -> tuple[np.ndarray, int]:
    """Length-one vector of damped word counts, and the number of words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(WORD_BUCKETS), 0
    counts = np.bincount(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), minlength=WORD_BUCKETS)
    x = np.log1p(counts)
    return x / np.linalg.norm(x), len(words)


def _vectors(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` with tokens and x, the word vector as half-precision floats."""
    small_batches(docs.sparkSession)

    def make() -> Callable[[dict], dict]:
        known = WordBuckets()

        def step(c: dict) -> dict:
            found = [word_vector(t, known) for t in c["text"].to_pylist()]
            return {"doc_id": c["doc_id"], "lang": c["lang"], "source": c["source"], "tokens": [n for _, n in found],
                    "x": [v.astype(np.float16).tobytes() for v, _ in found]}

        return step

    kinds = dict(docs.select("doc_id", "lang", "source").dtypes)
    return map_arrow(docs.select("doc_id", "lang", "source", "text"), make,
                     ", ".join(f"{n} {t}" for n, t in kinds.items()) + ", tokens long, x binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(-1, WORD_BUCKETS).astype(np.float64)


def fit_topics(vectors: DataFrame, n_topics: int, sample_rows: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Centres of all vectors. The first ones are spread over a hash sample of about ``sample_rows`` vectors."""
    share = int(min(1.0, sample_rows / max(1, vectors.count())) * (1 << 30))
    chosen = vectors.filter(F.pmod(F.xxhash64("doc_id", F.lit("topics")), F.lit(1 << 30)) < share).select("x")
    x = np.frombuffer(b"".join(sorted(r.x for r in chosen.collect())), np.float16).reshape(-1, WORD_BUCKETS)
    x = np.unique(x[x.any(1)].astype(float), axis=0)
    if not len(x):
        return np.zeros((n_topics, WORD_BUCKETS))
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), 1)]
    while len(centres) < n_topics:  # spread the first centres
        far = np.clip(1 - (x @ centres.T).max(1), 0, None) + 1e-12
        centres = np.vstack([centres, x[rng.choice(len(x), p=far / far.sum())]])
    for _ in range(rounds):
        sums = summed(vectors.select("x"), lambda c, centres=centres: _members(_matrix(c["x"]), centres),
                       n_topics * WORD_BUCKETS).reshape(centres.shape)
        # sums differ in their last digits with the order of the tasks; centres are rounded, so that a run repeats
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        moved = np.round(np.where(size > 0, sums / np.maximum(size, 1e-300), centres), 9)
        if (moved == centres).all():
            break
        centres = moved
    return centres


def _members(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    own = (x @ centres.T).argmax(1)
    return np.stack([x[own == k].sum(0) for k in range(len(centres))])


def with_topic(docs: DataFrame, centres: np.ndarray) -> DataFrame:
    """``docs`` with ``topic`` (int) and ``tokens`` (long: words between white space) of every whole text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("topic int, tokens long")
    def topic_and_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = WordBuckets()
        for texts in batches:
            found = [word_vector(t, known) for t in texts]
            x = np.array([v for v, _ in found]).reshape(-1, WORD_BUCKETS).astype(np.float16).astype(float)  # as staged
            yield pd.DataFrame({"topic": (x @ centres.T).argmax(1).astype("int32"),
                                "tokens": np.array([n for _, n in found], "int64")})

    seen = docs.withColumn("_m", topic_and_tokens(F.col("text")))
    return seen.withColumns({"topic": F.col("_m.topic"), "tokens": F.col("_m.tokens")}).drop("_m")


# ------------------------------------------------------------ raking

@dataclass
class Raked:
    """Factors per (language, topic), and the sources with theirs."""

    languages: list[str]
    topics: list[int]
    inner: np.ndarray  # (languages, topics): factor of language times factor of topic
    sources: DataFrame  # source_key, target, cells: places of the (language, topic) present, tokens there
    total: float
    rounds: int
    error: float  # largest difference of a language's or topic's share from its target
    lang_targets: dict[str, float]
    topic_targets: dict[int, float]


def tempered(tokens: dict, power: float) -> dict:
    """Shares in proportion to tokens ** power: below 1, small values gain on large ones."""
    raised = {k: v ** power for k, v in tokens.items() if v > 0}
    whole = sum(raised.values())
    return {k: v / whole for k, v in raised.items()}


def _shares(natural: dict, target: dict | None, power: float) -> dict:
    """Target share of every value that has tokens."""
    if target is None:
        return tempered(natural, power)
    whole = sum(natural.values())
    wanted = {k: float(target.get(k, natural[k] / whole)) for k in natural if natural[k] > 0}
    return {k: v / sum(wanted.values()) for k, v in wanted.items()}


def rake(cells: DataFrame, scratch: Scratch, source_targets: DataFrame | None = None, languages: dict | None = None,
         topics: dict | None = None, power: float = 0.7, tolerance: float = 1e-7, rounds: int = 60,
         temper: str = "margins") -> Raked:
    """``cells``: source_key, lang_key, topic, tokens. Targets: shares by value; a missing one is tempered by ``power``.

    With ``temper`` "margins" a missing target is in proportion to the value's tokens ** power. Where topics nearly follow
    languages such targets contradict each other a little, which a few rare cells then have to make up for. With "cells"
    it is the sum of tokens ** power over the value's cells: all missing targets are margins of one table and agree.

    ``source_targets`` (source_key, target) may be large and stays distributed. A column ``start`` holds weights to rake
    in place of the tokens; natural shares are those of the tokens either way.
    """
    if temper not in ("margins", "cells"):
        raise ValueError('temper is "margins" or "cells"')
    raised = F.pow(F.col("tokens").cast("double"), F.lit(power))
    held_tokens = "start" if "start" in cells.columns else "tokens"
    by_lang = {r[0]: r[1] for r in cells.groupBy("lang_key").agg(F.sum("tokens")).collect()}
    by_topic = {r[0]: r[1] for r in cells.groupBy("topic").agg(F.sum("tokens")).collect()}
    if temper == "cells":
        whole = cells.filter("tokens > 0").agg(F.sum(raised)).first()[0] or 1.0
        by_cell = {name: {r[0]: r[1] / whole for r in cells.filter("tokens > 0").groupBy(name).agg(F.sum(raised)).collect()}
                   for name in ("lang_key", "topic")}
        languages = by_cell["lang_key"] if languages is None else languages
        topics = by_cell["topic"] if topics is None else topics
    lang_share, topic_share = _shares(by_lang, languages, power), _shares(by_topic, topics, power)
    langs, kinds = sorted(lang_share), sorted(topic_share)
    total = float(sum(by_lang.values()))
    spark = cells.sparkSession
    place = [(lang, topic, i * len(kinds) + j) for i, lang in enumerate(langs) for j, topic in enumerate(kinds)]
    places = spark.createDataFrame(place, "lang_key string, topic int, place int")
    held = F.sort_array(F.collect_list(F.struct("place", F.col(held_tokens).cast("double").alias("n"))))
    rows = (cells.filter("tokens > 0").join(places, ["lang_key", "topic"]).groupBy("source_key")
            .agg(held.alias("held"), F.sum("tokens").alias("natural"),  # at most one entry per (language, topic)
                 F.sum(raised).alias("raised")))
    if source_targets is None:
        rows = rows.withColumn("target", F.col("raised") if temper == "cells" else F.pow(
            F.col("natural").cast("double"), F.lit(power)))
    else:
        rows = rows.join(source_targets, "source_key", "left").withColumn(
            "target", F.coalesce("target", F.col("natural") / F.lit(total)))
    whole = rows.agg(F.sum("target")).first()[0] or 1.0
    sources = scratch.write(rows.select("source_key", (F.col("target") / whole).alias("target"),
                                        F.col("held.place").alias("place"), F.col("held.n").alias("n")), "sources")
    lang_factor, topic_factor = np.ones(len(langs)), np.ones(len(kinds))
    want_lang = np.array([lang_share[k] for k in langs])
    want_topic = np.array([topic_share[k] for k in kinds])
    inner, error, done = np.ones((len(langs), len(kinds))), 0.0, 0
    while place and done < rounds:
        done += 1
        inner = np.outer(lang_factor, topic_factor)
        share = _round(sources, inner)
        # without the inner factors; a target of 0 has the factor 0
        shares = np.divide(share, inner, out=np.zeros_like(share), where=inner > 0)
        error = max(np.abs(share.sum(1) - want_lang).max(), np.abs(share.sum(0) - want_topic).max())
        if error < tolerance:
            break
        # languages and topics in turn, on the sums over the sources
        lang_factor = want_lang / np.maximum((shares * topic_factor).sum(1), 1e-300)
        topic_factor = want_topic / np.maximum((shares * lang_factor[:, None]).sum(0), 1e-300)
        scale = topic_factor.mean()
        topic_factor /= scale
        lang_factor /= lang_factor.mean()
    return Raked(langs, kinds, inner, sources, total, done, float(error), lang_share, topic_share)


def _source_rows(c: dict) -> Iterator[tuple[int, float, np.ndarray, np.ndarray]]:
    """(row, target, places, tokens) of each source."""
    targets = c["target"].to_numpy(zero_copy_only=False)
    ends = c["place"].offsets.to_numpy()
    places, tokens = c["place"].values.to_numpy(zero_copy_only=False), c["n"].values.to_numpy(zero_copy_only=False)
    for row, (lo, hi) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        yield row, float(targets[row]), places[lo:hi], tokens[lo:hi]


def plain_factor(target: float, weights: np.ndarray, tokens: np.ndarray) -> float:
    """The factor a for which the tokens x weights x a add up to ``target``."""
    held = float(weights @ tokens)
    return target / held if held > 0 else 0.0


def bounded_factor(target: float, weights: np.ndarray, tokens: np.ndarray) -> float:
    """The factor a for which the tokens x min(1, weights x a) add up to ``target``; infinite if all of them are less."""
    use = (weights > 0) & (tokens > 0)
    w, n = weights[use], tokens[use]
    if target <= 0 or not len(w):
        return 0.0
    if n.sum() <= target:
        return np.inf
    order = np.argsort(-w)  # the largest weights reach 1 first
    w, n = w[order], n[order]
    full = np.r_[0.0, np.cumsum(n)[:-1]]
    rest = np.cumsum((w * n)[::-1])[::-1]
    factors = (target - full) / rest  # with the first k at 1
    return float(factors[np.flatnonzero(factors * w <= 1 + 1e-12)[0]])


def _round(sources: DataFrame, inner: np.ndarray, drawn: float | None = None) -> np.ndarray:
    """Sums per (language, topic) of the weights under the sources' factors; with ``drawn`` tokens in the sample, of the
    tokens kept at most once, over ``drawn``."""
    flat = inner.ravel()

    def part(c: dict) -> np.ndarray:
        out = np.zeros(flat.size)
        for _, target, place, n in _source_rows(c):
            w = flat[place]
            if drawn is None:
                np.add.at(out, place, plain_factor(target, w, n) * w * n)
            else:
                factor = bounded_factor(target * drawn, w, n)
                chance = (w > 0).astype(float) if np.isinf(factor) else np.minimum(1.0, factor * w)
                np.add.at(out, place, chance * n / drawn)
        return out

    return summed(sources, part, flat.size).reshape(inner.shape)


def rates(raked: Raked, inner: np.ndarray | None = None, drawn: float | None = None) -> DataFrame:
    """(source_key, lang_key, topic, rate): share of the mix per token, over all cells with tokens; with ``drawn`` the
    probability of a document."""
    flat = (raked.inner if inner is None else inner).ravel()
    languages, topics = np.array(raked.languages, object), np.array(raked.topics)

    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            rows, places, values = [], [np.empty(0, np.int64)], [np.empty(0)]
            for row, target, place, n in _source_rows(c):
                w = flat[place]
                if drawn is None:
                    value = plain_factor(target, w, n) * w
                else:
                    factor = bounded_factor(target * drawn, w, n)
                    value = (w > 0).astype(float) if np.isinf(factor) else np.minimum(1.0, factor * w)
                rows += [row] * len(place)
                places.append(place)
                values.append(value)
            at = np.concatenate(places).astype(np.int64)
            return {"source_key": c["source_key"].take(pa.array(rows, pa.int64())),
                    "lang_key": languages[at // max(1, len(topics))].tolist() if len(at) else [],
                    "topic": topics[at % max(1, len(topics))].tolist() if len(at) else [], "rate": np.concatenate(values)}

        return step

    return map_arrow(raked.sources, make, "source_key string, lang_key string, topic int, rate double")


def bounded(raked: Raked, slack: float, rounds: int = 12) -> tuple[np.ndarray, float] | None:
    """Inner factors and expected tokens of the largest sample whose probabilities stay within 1 and whose expected
    shares differ from the targets by at most ``slack`` of each; None when no sample of some size does.

    Its size starts at what the scarcest value allows and falls until the rounds meet all targets.
    """
    want_lang = np.array([raked.lang_targets[k] for k in raked.languages])
    want_topic = np.array([raked.topic_targets[k] for k in raked.topics])
    if not want_lang.size or raked.total <= 0:
        return None
    use = raked.inner.ravel() > 0  # cells of a value with the target 0 are never drawn
    wanted = raked.sources.filter("target > 0")
    natural = summed(wanted, lambda c: _natural(c, use), use.size).reshape(raked.inner.shape)
    most = min([(natural.sum(1)[want_lang > 0] / want_lang[want_lang > 0]).min(),
                (natural.sum(0)[want_topic > 0] / want_topic[want_topic > 0]).min(), _scarcest(wanted, use)])

    def fit_to(drawn: float, inner: np.ndarray) -> np.ndarray | None:
        gaps: list[float] = []
        for _ in range(rounds):
            share = _round(raked.sources, inner, drawn)
            got_lang, got_topic = share.sum(1), share.sum(0)
            off = max(_largest_gap(got_lang, want_lang), _largest_gap(got_topic, want_topic))
            if off <= slack / 2 and abs(share.sum() - 1) <= slack / 2:
                return inner
            gaps.append(off)
            if len(gaps) > 3 and off > 0.7 * gaps[-4]:  # no sample of this size
                return None
            by_lang = np.divide(want_lang, got_lang, out=np.zeros_like(want_lang), where=got_lang > 0)
            inner = inner * by_lang[:, None]
            share = _round(raked.sources, inner, drawn)
            got_topic = share.sum(0)
            inner = inner * np.divide(want_topic, got_topic, out=np.zeros_like(want_topic), where=got_topic > 0)
            if not np.isfinite(inner).all() or not inner.any():
                return None
            inner = inner / inner[inner > 0].mean()
        return None

    high, low = None, most
    while (found := fit_to(low, raked.inner)) is None:
        high, low = low, low * (0.7 if high else 1 - slack / 4)
        if low < most / 200:
            return None
    for _ in range(4 if high and high < most else 0):  # between the last size that failed and the first that did not
        middle = (low * high) ** 0.5
        more = fit_to(middle, found)
        if more is None:
            high = middle
        else:
            low, found = middle, more
    return found, low


def _natural(c: dict, use: np.ndarray) -> np.ndarray:
    out = np.zeros(use.size)
    for _, _, place, n in _source_rows(c):
        np.add.at(out, place, n * use[place])
    return out


def _scarcest(sources: DataFrame, use: np.ndarray) -> float:
    """Smallest number of tokens that a source can give, over its target share."""
    def make() -> Callable[[dict], dict]:
        return lambda c: {"most": [float((n * use[place]).sum()) / target for _, target, place, n in _source_rows(c)]}

    return map_arrow(sources, make, "most double").agg(F.min("most")).first()[0] or 0.0


def _largest_gap(got: np.ndarray, want: np.ndarray) -> float:
    gap = np.abs(np.divide(got, want, out=np.ones_like(got), where=want > 0) - 1)
    return float(max(gap.max(initial=0.0), got[want <= 0].max(initial=0.0)))


# ------------------------------------------------------------ sampling

@dataclass
class Mix:
    """A calibrated mix: what ``decide`` needs to give any measured row its probability."""

    rates: DataFrame  # source_key, lang_key, topic, per_token, probability
    seed: int
    error: float  # largest |expected share / target - 1| of a source, language or topic
    kept: float  # expected share of all tokens in the sample

    def decide(self, measured: DataFrame) -> DataFrame:
        """Add weight (raked tokens), probability and sampled to rows with topic and tokens."""
        keyed = measured.withColumns({"_source": _key("source"), "_lang": _key("lang")})
        rates = self.rates.toDF("_source", "_lang", "_topic", "_per_token", "_probability")
        rows = keyed.join(rates, (keyed["_source"] == rates["_source"]) & (keyed["_lang"] == rates["_lang"])
                          & (keyed["topic"] == rates["_topic"]), "left")
        draw = F.pmod(F.xxhash64("doc_id", F.lit(self.seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        probability = F.when(F.col("tokens") == 0, 1.0).otherwise(F.coalesce("_probability", F.lit(0.0)))
        return rows.select(*[measured[c] for c in measured.columns],
                           F.coalesce(F.col("tokens") * F.col("_per_token"), F.lit(0.0)).alias("weight"),
                           probability.alias("probability"), (draw < probability).alias("sampled"))


def _key(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def fit(measured: DataFrame, scratch: Scratch, slack: float = 0.005, trim: float | None = None,
        seed: int = 0, **targets) -> Mix:
    """Rake the cells of measured rows (source, lang, topic, tokens) and find the probabilities of the largest sample.

    Expected shares differ from the targets by at most ``slack`` of each target, however small it is. Where raking does
    not meet the targets, as they contradict each other, the probabilities follow the raked weights as far as it came,
    with the largest constant that keeps within ``slack`` of them.

    A caller that would rather keep more than meet the targets gives ``trim``: weights above ``trim`` times the natural
    ones are cut and raked again. ``Mix.error`` says how far the expected shares are from the targets in any case.
    """
    cells = scratch.write(measured.groupBy(_key("source").alias("source_key"), _key("lang").alias("lang_key"), "topic")
                          .agg(F.sum("tokens").alias("tokens")).filter("tokens > 0"), "cells")
    raked = rake(cells, scratch, **targets)
    rated = scratch.write(rates(raked).join(cells, CELL), "rates")
    if trim is not None:
        rated = _trimmed(rated, raked.total, trim, scratch, targets)
    per_token = F.col("rate") * raked.total
    largest = bounded(raked, slack) if trim is None and raked.error < 1e-4 else None
    if largest is None:
        constant = _constant(rated, slack, raked.total)
        rated = rated.withColumns({"per_token": per_token, "probability": F.least(F.lit(1.0), per_token * constant)})
    else:
        chances = rates(raked, *largest).withColumnRenamed("rate", "probability")
        rated = scratch.write(rated.withColumn("per_token", per_token).join(chances, CELL), "chances")
    error, kept = _margin_error(rated, raked)
    if error > 2 * slack:
        logging.getLogger(__name__).warning("a share of the mix is off its target by %.3g of it", error)
    return Mix(rated.select(*CELL, "per_token", "probability"), seed, error, kept)


def measure(docs: DataFrame, scratch: Scratch, n_topics: int = 8, topic_sample: int = 4000,
            seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """``docs`` with topic and tokens, and the same measures staged without texts (doc_id, lang, source)."""
    vectors = scratch.write(_vectors(docs), "vectors")
    centres = fit_topics(vectors, n_topics, topic_sample, seed=seed)

    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            return {**c, "topic": (_matrix(c.pop("x")) @ centres.T).argmax(1)}

        return step

    kinds = ", ".join(f"{n} {t}" for n, t in vectors.dtypes if n != "x")
    slim = scratch.write(map_arrow(vectors, make, f"{kinds}, topic int"), "measured")
    return with_topic(docs, centres), slim


def _trimmed(rated: DataFrame, total: float, trim: float, scratch: Scratch, targets: dict, rounds: int = 10) -> DataFrame:
    """``rated`` with no rate above ``trim`` times the natural one: cut and raked again in turn, cut at the end."""
    cut = F.least(F.col("rate"), F.lit(trim / total))
    for _ in range(rounds):
        if (rated.agg(F.max("rate")).first()[0] or 0.0) * total <= trim * 1.001:
            break
        start = scratch.write(rated.select(*CELL, "tokens", (F.col("tokens") * cut).alias("start")), "trimmed")
        again = rates(rake(start.filter("start > 0"), scratch, **targets)).withColumnRenamed("rate", "by")
        rated = scratch.write(start.join(again, CELL).select(
            *CELL, (F.col("by") * F.col("start") / F.col("tokens")).alias("rate"), "tokens"), "rates")
    return rated.withColumn("rate", cut)


def _margin_error(rated: DataFrame, raked: Raked) -> tuple[float, float]:
    """Largest difference of an expected share from its target, as a part of it, and the share of tokens drawn."""
    drawn = F.sum(F.col("tokens") * F.col("probability"))
    whole = rated.agg(drawn).first()[0]
    if not whole:
        return 0.0, 0.0
    off = lambda got, want: abs(got / whole / want - 1) if want > 0 else float(got > 0)
    got = {name: dict(map(tuple, rated.groupBy(name).agg(drawn).collect())) for name in ("lang_key", "topic")}
    found = [off(got[name].get(k, 0.0), want) for name, wanted in (("lang_key", raked.lang_targets),
                                                                  ("topic", raked.topic_targets)) for k, want in wanted.items()]
    by_source = raked.sources.join(rated.groupBy("source_key").agg(drawn.alias("got")), "source_key", "left")
    share = F.coalesce("got", F.lit(0.0)) / F.lit(whole)
    gap = F.when(F.col("target") > 0, F.abs(share / F.col("target") - 1)).otherwise((share > 0).cast("double"))
    return max(*found, by_source.agg(F.max(gap)).first()[0]), whole / raked.total


def _constant(rated: DataFrame, slack: float, total: float) -> float:
    """The largest constant within ``slack``, by bisection between exact and natural shares."""
    first = rated.filter("rate > 0").agg(F.max("rate").alias("top"), F.min("rate").alias("low")).first()
    if not first.top:
        return 1.0
    values = F.array(*[F.struct(F.lit(name).alias("of"), F.col(name).cast("string").alias("value")) for name in CELL])

    def within(constant: float) -> bool:
        drawn = F.col("tokens") * F.least(F.lit(1.0), F.col("rate") * total * constant)
        raked = F.col("tokens") * F.col("rate")
        whole = rated.agg(F.sum(drawn).alias("drawn"), F.sum(raked).alias("raked")).first()
        margins = rated.filter("rate > 0").select(F.explode(values).alias("m"), (drawn / whole.drawn).alias("got"),
                                                  (raked / whole.raked).alias("want"))
        off = margins.groupBy("m").agg(F.abs(F.sum("got") / F.sum("want") - 1).alias("off"))  # of any share, however small
        return off.agg(F.max("off")).first()[0] <= slack

    low, high = 1 / (first.top * total), 1 / (first.low * total)
    if high <= low or within(high):
        return high
    for _ in range(25):
        middle = (low * high) ** 0.5
        low, high = (middle, high) if within(middle) else (low, middle)
        if high < low * 1.01:
            break
    return low
