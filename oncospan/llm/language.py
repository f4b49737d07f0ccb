"""Language identification by Bayesian evidence fusion.

A page's language has four witnesses: its text, the language that its markup declares, the suffix of its address, and
what else its host serves. Their evidence is multiplied:

* *Text.* Letter trigrams of the visible text under a smoothed model per language, counted over all labelled documents.
  Neighbouring trigrams overlap, so the log-likelihood counts as that of at most ``text_weight`` trigrams.
* *Declared language and suffix.* How often pages of each language declare a value, estimated by grouped sums of the
  pages' text posteriors: a host of tools that all declare "en" teaches how little that says.
* *Host.* The prior of a host is its pages' mean posterior, smoothed towards its domain's, which is smoothed towards the
  corpus's; a page's own posterior is left out of its host's and domain's.

Counts are summed per key before the shuffle, so a hot language, host or suffix is no hot key; joins on host are split by
adaptive execution. The model has 65,536 numbers per language.

Defined results: null or wordless html has no text evidence, and a missing declaration, suffix or host is no evidence;
a page without any witness has the corpus prior. Repeated pages are pages like any other and repeated in the result, and so
are pages without page_id. Very long html takes time in proportion to its length. Documents with null text or language teach nothing. Without any labelled
document the language is null. Ties go to the first language by name. Only ``page_id``, ``url``, ``html`` of pages and
``text``, ``lang`` of documents are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch, map_arrow, small_batches

BUCKETS = 1 << 16
_CHUNK = 1 << 13
# a script, style or comment that is never closed hides the rest; every other pattern ends at the next "<" or ";"
_DROP = re.compile(r"<(script|style)\b.*?(?:</\1\s*+>|\Z)|<!--.*?(?:-->|\Z)|<[^<>]*+>?|&[a-zA-Z#0-9]{1,32};", re.S | re.I)
#: ASCII other than letters becomes a space.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of bytes, with one space around words."""
    data = np.frombuffer(b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" ", np.uint8)
    if len(data) < 3:
        return np.empty(0, np.int64)
    x = data.astype(np.uint32)
    whole = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((whole * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def visible(html: str | None) -> str:
    return _DROP.sub(" ", html or "")


@dataclass
class TextModel:
    languages: list[str]
    log_p: np.ndarray  # (languages, BUCKETS)

    def log_likelihood(self, text: str, text_weight: float) -> np.ndarray:
        found = trigrams(text)
        if not len(found):
            return np.zeros(len(self.languages))
        counts = np.bincount(found, minlength=BUCKETS)
        at = np.flatnonzero(counts)
        return self.log_p[:, at] @ counts[at] * min(1.0, text_weight / len(found))


def fit_text(docs: DataFrame, scratch: Scratch, smoothing: float = 0.5) -> TextModel:
    """Trigram counts per language over all documents; one array per language reaches the driver."""
    small_batches(docs.sparkSession)
    rows = docs.select("text", F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")

    def count() -> Callable[[dict | None], dict]:
        sums: dict[str, np.ndarray] = {}

        def step(c: dict | None) -> dict:
            if c is not None:
                by_lang: dict[str, list] = {}
                for text, lang in zip(c["text"].to_pylist(), c["lang"].to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(trigrams(text))
                for lang, found in by_lang.items():
                    total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    total += np.bincount(np.concatenate(found), minlength=BUCKETS)
                return {"lang": [], "chunk": [], "counts": []}
            parts = [(lang, i, total[i * _CHUNK:(i + 1) * _CHUNK].tobytes()) for lang, total in sums.items()
                     for i in range(BUCKETS // _CHUNK)]
            return {"lang": [p[0] for p in parts], "chunk": [p[1] for p in parts], "counts": [p[2] for p in parts]}

        return step

    def add() -> Callable[[dict | None], dict]:
        """Sum sorted runs of (lang, chunk); holds one array."""
        held: dict = {"key": None, "sum": None}

        def step(c: dict | None) -> dict:
            out = []
            rows = [] if c is None else zip(c["lang"].to_pylist(), c["chunk"].to_pylist(), c["counts"].to_pylist(),
                                            strict=True)
            for lang, chunk, data in rows:
                if held["key"] != (lang, chunk):
                    out.append((held["key"], held["sum"]))
                    held.update(key=(lang, chunk), sum=np.zeros(_CHUNK, np.int64))
                held["sum"] += np.frombuffer(data, np.int64)
            if c is None:
                out.append((held["key"], held["sum"]))
            out = [(k, s) for k, s in out if k is not None]
            return {"lang": [k[0] for k, _ in out], "chunk": [k[1] for k, _ in out],
                    "counts": [s.tobytes() for _, s in out]}

        return step

    schema = "lang string, chunk int, counts binary"
    counted = map_arrow(rows, count, schema, flush=True)
    met = counted.repartition("lang", "chunk").sortWithinPartitions("lang", "chunk")
    summed = scratch.write(map_arrow(met, add, schema, flush=True), "trigrams").collect()
    languages = sorted({r.lang for r in summed})
    counts = np.zeros((len(languages), BUCKETS))
    for r in summed:
        counts[languages.index(r.lang), r.chunk * _CHUNK:(r.chunk + 1) * _CHUNK] = np.frombuffer(r.counts, np.int64)
    smooth = counts + smoothing
    return TextModel(languages, np.log(smooth / smooth.sum(1, keepdims=True)))


# ------------------------------------------------------------ evidence

def _address(url: Column) -> dict[str, Column]:
    """host, domain (its last two labels) and suffix (its last label, unless the host is a number)."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", F.regexp_replace(host, r"^www\.|\.$", ""))
    suffix = F.regexp_extract(host, r"\.([a-z][a-z0-9-]*)$", 1)
    return {"host": host, "domain": F.substring_index(host, ".", -2), "suffix": F.when(suffix != "", suffix)}


def _declared(html: Column) -> Column:
    tag = F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    return F.when(tag != "", F.lower(tag))


def evidence(pages: DataFrame, model: TextModel, scratch: Scratch, text_weight: float) -> DataFrame:
    """page_id, address parts, declared language, text log-likelihoods and text posterior of every page; staged."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "html",
                        _declared(F.col("html")).alias("declared"),
                        *[c.alias(n) for n, c in _address(F.col("url")).items()])
    shared = pages.sparkSession.sparkContext.broadcast(model)  # 512 KB per language

    def make() -> Callable[[dict], dict]:
        def step(c: dict) -> dict:
            ll = [shared.value.log_likelihood(visible(h), text_weight) for h in c["html"].to_pylist()]
            return {**c, "ll": [x.tolist() for x in ll], "p": [_normal(x).tolist() for x in ll]}

        return step

    return scratch.write(map_arrow(rows.select("page_id", "declared", "host", "domain", "suffix", "html"), make,
                                   "page_id long, declared string, host string, domain string, suffix string, "
                                   "ll array<double>, p array<double>"), "evidence")


def _normal(log_weights: np.ndarray) -> np.ndarray:
    x = np.exp(log_weights - log_weights.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def _sums(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """Summed posteriors per key, and the pages of the key."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(n)]).alias(name))


def identify(pages: DataFrame, docs: DataFrame, scratch: Scratch, text_weight: float = 60.0, strength: float = 5.0,
             smoothing: float = 1.0) -> DataFrame:
    """page_id, lang, confidence, text_lang, declared, host for every page."""
    model = fit_text(docs, scratch)
    languages, n = model.languages, len(model.languages)
    if not n:
        return pages.select(F.col("page_id").cast("long").alias("page_id"), F.lit(None).cast("string").alias("lang"),
                            F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("text_lang"),
                            _declared(F.col("html")).alias("declared"), _address(F.col("url"))["host"].alias("host"))
    rows = evidence(pages, model, scratch, text_weight)
    total = rows.agg(*[F.sum(F.get("p", F.lit(i))) for i in range(n)]).first()
    corpus = np.array([x or 0.0 for x in total], float)
    prior = (corpus + 1) / (corpus.sum() + n)
    joined = rows
    values = {}
    for key in ("declared", "suffix", "domain", "host"):
        sums = scratch.write(_sums(rows, key, n, f"{key}_sum"), key)
        if key in ("declared", "suffix"):
            values[key] = sums.count() + 1
        joined = joined.join(sums, key, "left")

    def make() -> Callable[[dict], dict]:
        def matrix(column) -> tuple[np.ndarray, np.ndarray]:
            known = np.array([x is not None for x in column.to_pylist()], bool)
            return np.array([x if x is not None else [0.0] * n for x in column.to_pylist()], float).reshape(-1, n), known

        def step(c: dict) -> dict:
            if not len(c["page_id"]):
                return {k: c[k] for k in ("page_id", "declared", "host")} | {
                    "lang": [], "confidence": [], "text_lang": []}
            own, _ = matrix(c["p"])
            text, _ = matrix(c["ll"])
            base = prior
            for key in ("domain", "host"):  # each smoothed towards the wider one, without the page itself
                sums, known = matrix(c[f"{key}_sum"])
                rest = np.clip(sums - own, 0, None)
                smooth = (rest + strength * base) / (rest.sum(1, keepdims=True) + strength)
                base = np.where(known[:, None], smooth, base)
            score = text + np.log(base)
            for key, n_values in values.items():
                sums, known = matrix(c[f"{key}_sum"])
                share = (sums + smoothing) / (corpus + smoothing * n_values)
                score += np.where(known[:, None], np.log(share), 0.0)
            post = _normal(score)
            best = post.argmax(1)
            heard = np.ptp(text, axis=1) > 0
            first = text.argmax(1)
            return {"page_id": c["page_id"], "lang": [languages[i] for i in best], "confidence": post.max(1),
                    "text_lang": [languages[i] if h else None for i, h in zip(first, heard, strict=True)],
                    "declared": c["declared"], "host": c["host"]}

        return step

    return map_arrow(joined, make, "page_id long, lang string, confidence double, text_lang string, declared string, "
                                   "host string")
