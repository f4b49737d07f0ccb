"""The quality classifier on held-out rows and planted samples; raking against targets; the pipeline's stages."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oncospan.llm import mixing, quality
from oncospan.llm.common import Scratch
from oncospan.llm.queries import held_out, op6_mix, op10_quality

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------ quality

def test_nonnegative_risk_recovers_the_prior_and_the_classes():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (6000, 4)), rng.normal(2.5, 1, (1500, 4))
    positive, web = good[:3000], np.concatenate([good[3000:], bad[:1000]])
    prior = quality.estimate_prior(positive, web)
    assert prior == pytest.approx(0.75, abs=0.05)
    model = quality.train(positive, web, prior, epochs=40)
    fresh_good, fresh_bad = rng.normal(0, 1, (500, 4)), rng.normal(2.5, 1, (500, 4))
    assert (model.odds(fresh_good) > 0).mean() > 0.97 and (model.odds(fresh_bad) > 0).mean() < 0.05


def test_held_out_accuracy(spark):
    got = op10_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_labels_of_the_held_out_fold_teach_nothing(spark, tmp_path):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    wrong = F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    labels.withColumn("quality", wrong).write.parquet(f"{tmp_path}/labels.parquet")
    one = {r.doc_id: r.score for r in op10_quality(spark, SF).collect()}
    two = {r.doc_id: r.score for r in op10_quality(spark, str(tmp_path)).collect()}
    assert one == pytest.approx(two, abs=1e-12)


def plain_features(text):
    """The features again, word by word."""
    data = (text or "").encode()
    low, up, digit, space = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"\t\n\x0b\x0c\r "
    marks, signs = b".,;:'\"()-?", b"!#$%&*+/<=>@[\\]^_`{|}~"
    kinds = [low, up, digit, space, marks, signs]

    def kind(b):
        return 7 if b >= 128 else next((i + 1 for i, k in enumerate(kinds) if b in k), 0)

    padded = b" " + data + b" "
    share = [sum(kind(b) == k for b in padded) / len(padded) for k in range(8)]
    words = data.split()
    n = max(1, len(words))
    lengths = [len(w) for w in words] or [0]
    first = [sum(kind(w[0]) == k for w in words) / n for k in range(8)]
    last = [sum(kind(w[-1]) == k for w in words) / n for k in range(8)]
    capitals = [sum(b in up for b in w) for w in words]
    shouted = sum(c > 1 and 2 * c > len(w) for c, w in zip(capitals, words, strict=True)) / n
    counts = sorted((words.count(w) for w in set(words)), reverse=True) + [0, 0, 0]
    lines, letters = data.split(b"\n"), share[1] + share[2] + share[7] + 1e-6
    return [np.log1p(len(words)) / 5, np.mean(lengths) / 6, np.std(lengths) / 4, np.mean([x > 18 for x in lengths]) * 4,
            len(set(words)) / n, np.log1p(len(set(words))) / 5, counts[0] / n * 4, sum(counts[:3]) / n * 2,
            sum(a == b for a, b in zip(words, words[1:])) / n * 4, share[2] / letters * 4, share[3] * 10, share[5] * 10,
            share[6] * 10, share[7] * 2, share[4] * 5, first[2] * 4, shouted * 4, (first[6] + first[3]) * 4, last[6] * 4,
            last[5] * 4, np.log1p(len(lines)) / 3, len(set(lines)) / len(lines), np.log1p(n / len(lines)) / 4]


@pytest.mark.parametrize("text", ["a", "Some words, and MORE words: 12 of 34!\n\nsome words", "\xe9t\xe9 \U0001F600 <b>", "A" * 50,
                                  "the the the\nthe\t\rthe", " lead and trail ", "#1 $2 %%", "x\x1cy\x00"])
def test_features_equal_a_plain_version(text):
    assert quality.features(text) == pytest.approx(plain_features(text))


def test_prior_counts_all_documents(spark):
    """Counts of 30,000 described rows against the same ratio by sorting."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30_000, quality.FEATURES))
    trusted = rng.random(30_000) < 0.1
    x[~trusted & (rng.random(30_000) < 0.3), 0] += 4  # negatives
    fold = rng.integers(0, 2, 30_000)
    scorers = [quality.train(x[trusted & (fold != f)], x[fold != f], None, epochs=10) for f in (0, 1)]
    rows = spark.createDataFrame([(int(f), bool(t), v.tolist()) for f, t, v in zip(fold, trusted, x, strict=True)],
                                 "fold int, trusted boolean, x array<double>")
    got = quality.corpus_prior(rows, scorers)
    want = []
    for f in (0, 1):  # every score as a border
        odds = scorers[f].odds(x[fold == f])
        p, u = odds[trusted[fold == f]], odds
        ratios = []
        for at in np.quantile(p, np.linspace(0.0, 0.6, 200)):
            in_p, in_u = (p >= at).mean(), (u >= at).mean()
            error = np.sqrt(in_u * (1 - in_u) / len(u) + in_u ** 2 * (1 - in_p) / in_p / len(p))
            ratios.append((in_u + error) / in_p)
        want.append(min(ratios))
    assert got == pytest.approx(np.mean(want), abs=0.005) and got < 0.9  # 0.73 of the rows are no negatives


def test_quality_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "x" * 200_000), (None, "text"), (5, "a b"), (5, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    none = docs.select("doc_id").filter("doc_id = 99")
    model = quality.fit(docs, none)
    assert model.scorer is None
    got = quality.with_score(docs, model, "s").collect()
    assert [r.s for r in got] == [0.5] * 7
    trained = quality.fit(docs, docs.select("doc_id"))
    scores = {r.text: r.s for r in quality.with_score(docs, trained, "s").collect()}
    assert scores[None] == scores[""] and all(0 <= s <= 1 for s in scores.values())
    assert quality.with_score(docs.filter("doc_id = 99"), trained).count() == 0


# ------------------------------------------------------------ mixing

def cells(spark, rows):
    return spark.createDataFrame(rows, "source_key string, lang_key string, topic int, tokens long")


def test_raking_meets_all_margins(spark):
    rng = random.Random(0)
    rows = [(f"s{s}", lang, t, rng.randrange(10, 1000) * (30 if s == 0 else 1))
            for s in range(12) for lang in ("en", "de", "fr") for t in range(4) if rng.random() < 0.8]
    wanted = spark.createDataFrame([(f"s{i}", 1.0 + i) for i in range(12)], "source_key string, target double")
    raked = mixing.rake(cells(spark, rows), Scratch(spark), wanted, {"en": 0.5, "de": 0.3, "fr": 0.2}, power=0.5)
    rate = {(r.source_key, r.lang_key, r.topic): r.rate for r in mixing.rates(raked).collect()}
    weight = {r[:3]: r[3] * rate[r[:3]] for r in rows}
    assert sum(weight.values()) == pytest.approx(1) and raked.error < 1e-6
    for s in range(12):
        assert sum(w for k, w in weight.items() if k[0] == f"s{s}") == pytest.approx((1 + s) / 78, abs=1e-5)
    for lang, share in (("en", 0.5), ("de", 0.3), ("fr", 0.2)):
        assert sum(w for k, w in weight.items() if k[1] == lang) == pytest.approx(share, abs=1e-5)
    natural = {t: sum(r[3] for r in rows if r[2] == t) ** 0.5 for t in range(4)}
    for t in range(4):
        assert sum(w for k, w in weight.items() if k[2] == t) == pytest.approx(natural[t] / sum(natural.values()), abs=1e-5)


def plain_raking(rows, wanted, rounds=200):
    """Tokens scaled to the shares of sources, languages and topics in turn."""
    weight = {r[:3]: float(r[3]) for r in rows if r[3] > 0}
    for _ in range(rounds):
        for at in range(3):
            held = {}
            for cell, w in weight.items():
                held[cell[at]] = held.get(cell[at], 0.0) + w
            weight = {cell: w * wanted[at][cell[at]] / held[cell[at]] if held[cell[at]] else 0.0 for cell, w in weight.items()}
    return weight


def test_raking_equals_plain_python(spark):
    rng = random.Random(5)
    rows = [(f"s{s}", lang, t, rng.randrange(1, 500)) for s in range(6) for lang in ("a", "b", "c") for t in range(3)]
    raked = mixing.rake(cells(spark, rows), Scratch(spark), power=0.6)
    shares = []
    for at in range(3):
        natural = {}
        for r in rows:
            natural[r[at]] = natural.get(r[at], 0) + r[3]
        shares.append({k: v ** 0.6 / sum(x ** 0.6 for x in natural.values()) for k, v in natural.items()})
    want = plain_raking(rows, shares)
    rate = {(r.source_key, r.lang_key, r.topic): r.rate for r in mixing.rates(raked).collect()}
    assert {r[:3]: r[3] * rate[r[:3]] for r in rows} == pytest.approx(want, abs=1e-6)


def test_bounded_factor():
    rng = np.random.default_rng(0)
    for _ in range(200):
        w, n = rng.exponential(size=6) * (rng.random(6) < 0.8), rng.integers(0, 50, 6).astype(float)
        target = rng.random() * 60
        a = mixing.bounded_factor(target, w, n)
        if np.isinf(a):
            assert n[w > 0].sum() <= target + 1e-9
        else:
            assert (n * np.minimum(1, a * w)).sum() == pytest.approx(target if n[w > 0].sum() else 0.0)


def test_five_hundred_languages(spark):
    """A dirty language column: the plan does not grow with the cells."""
    rng = random.Random(6)
    rows = [(f"s{s}", f"l{i}", t, rng.randrange(50, 400)) for i in range(500) for s in range(3) for t in range(8)]
    raked = mixing.rake(cells(spark, rows), Scratch(spark), power=0.8)
    assert raked.error < 1e-6 and mixing.rates(raked).count() == len(rows)


def test_sample_is_as_large_as_the_scarcest_value_allows(spark):
    rng = random.Random(7)
    made = [(f"{s}{lang}{t}{i}", f"s{s}", lang, t, rng.randrange(20, 200)) for s in range(5) for lang in ("a", "b", "c")
            for t in range(4) for i in range(rng.choice([1, 3, 30, 60]))]
    docs = spark.createDataFrame(made, "doc_id string, source string, lang string, topic int, tokens long")
    mix = mixing.fit(docs, Scratch(spark), power=0.9)
    got = mix.decide(docs).collect()
    drawn, whole = sum(r.tokens * r.probability for r in got), sum(r.tokens for r in got)
    assert mix.error <= 0.01 and mix.kept == pytest.approx(drawn / whole) and max(r.probability for r in got) <= 1
    most = 1.0
    for key in ("source", "lang", "topic"):
        natural = {}
        for r in got:
            natural[r[key]] = natural.get(r[key], 0) + r.tokens
        share = {k: v ** 0.9 / sum(x ** 0.9 for x in natural.values()) for k, v in natural.items()}
        most = min([most, *(natural[k] / whole / share[k] for k in natural)])
        for k in natural:
            assert sum(r.tokens * r.probability for r in got if r[key] == k) / drawn == pytest.approx(share[k], rel=0.011)
    assert drawn / whole > 0.9 * most


def test_cell_targets_agree_and_keep_most(spark):
    """Topics that nearly follow languages: margins tempered one by one would hang on the few odd documents."""
    rng = random.Random(8)
    sizes = {("a", 0): 60, ("a", 1): 60, ("a", 2): 60, ("b", 3): 30, ("c", 4): 4}
    made = [(f"{lang}{t}{i}", f"s{i % 3}", lang, t, rng.randrange(50, 150)) for (lang, t), n in sizes.items() for i in range(n)]
    made += [("x", "s0", "a", 3, 20), ("y", "s1", "b", 4, 20), ("z", "s2", "c", 0, 20)]
    docs = spark.createDataFrame(made, "doc_id string, source string, lang string, topic int, tokens long")
    one = mixing.fit(docs, Scratch(spark), power=0.8)
    both = mixing.fit(docs, Scratch(spark), power=0.8, temper="cells")
    assert both.error <= 0.011 and both.kept > 0.4 and both.kept > 3 * one.kept
    got = both.decide(docs).collect()
    drawn = sum(r.tokens * r.probability for r in got)
    raised = {}
    for r in got:
        raised[r.source, r.lang, r.topic] = raised.get((r.source, r.lang, r.topic), 0) + r.tokens
    raised = {k: v ** 0.8 for k, v in raised.items()}
    for at, key in enumerate(("source", "lang", "topic")):
        for value in {k[at] for k in raised}:
            want = sum(v for k, v in raised.items() if k[at] == value) / sum(raised.values())
            assert sum(r.tokens * r.probability for r in got if r[key] == value) / drawn == pytest.approx(want, rel=0.012)


def test_sample_follows_the_weights(spark):
    got = op6_mix(spark, SF).collect()
    assert len(got) == 1000 and sum(r.weight for r in got) == pytest.approx(sum(r.tokens for r in got))
    drawn = sum(r.tokens * r.probability for r in got)
    for key in ("source", "lang", "topic"):
        for value in {r[key] for r in got}:
            share = sum(r.tokens * r.probability for r in got if r[key] == value) / drawn
            want = sum(r.weight for r in got if r[key] == value) / sum(r.weight for r in got)
            assert abs(share - want) <= 0.005 + 1e-9
    chosen = sum(r.tokens for r in got if r.sampled)
    assert chosen == pytest.approx(drawn, rel=0.1)


def measured_rows(spark, rows):
    """Rows of (source, lang, documents) with 100 tokens and one topic each."""
    made = [(f"{s}-{lang}-{i}", s, lang, 0, 100) for s, lang, n in rows for i in range(n)]
    return spark.createDataFrame(made, "doc_id string, source string, lang string, topic int, tokens long")


def test_targets_far_from_natural_shares_are_met(spark):
    docs = measured_rows(spark, [("s", "en", 900), ("s", "de", 100)])
    mix = mixing.fit(docs, Scratch(spark), languages={"en": 0.5, "de": 0.5}, power=1.0)
    drawn = dict(mix.decide(docs).groupBy("lang").agg(F.sum(F.col("tokens") * F.col("probability"))).collect())
    assert drawn["de"] / sum(drawn.values()) == pytest.approx(0.5, abs=0.005)
    assert mix.error <= 0.0101 and mix.kept == pytest.approx(0.2, rel=0.02)
    trimmed = mixing.fit(docs, Scratch(spark), trim=1.5, languages={"en": 0.5, "de": 0.5}, power=1.0)
    assert trimmed.kept > 0.4 and trimmed.error == pytest.approx(0.54, abs=0.02)  # de has 0.15 / 0.65


def test_targets_of_zero_drop_their_documents(spark):
    docs = measured_rows(spark, [("s", "en", 50), ("s", "de", 50), ("t", "en", 50)])
    wanted = spark.createDataFrame([("s", 1.0), ("t", 0.0)], "source_key string, target double")
    got = mixing.fit(docs, Scratch(spark), source_targets=wanted, languages={"en": 1.0, "de": 0.0}, power=1.0).decide(docs)
    kept = {(r.source, r.lang): r.probability for r in got.collect()}
    assert kept == {("s", "en"): 1.0, ("s", "de"): 0.0, ("t", "en"): 0.0}


def test_small_sources_have_their_targets(spark):
    docs = measured_rows(spark, [(f"s{i}", "en", 4) for i in range(400)])
    wanted = spark.createDataFrame([(f"s{i}", 2.0 if i < 200 else 1.0) for i in range(400)], "source_key string, target double")
    mix = mixing.fit(docs, Scratch(spark), source_targets=wanted, power=1.0)
    got = mix.decide(docs).groupBy("source").agg(F.sum(F.col("tokens") * F.col("probability")).alias("n")).collect()
    whole = sum(r.n for r in got)
    assert all(r.n / whole == pytest.approx((2 if int(r.source[1:]) < 200 else 1) / 600, rel=0.006) for r in got)
    assert mix.error <= 0.006


def test_mix_odd_rows(spark):
    rows = [(1, None, "en", "s"), (2, "", None, None), (3, "one two three", None, "s"), (None, "a b", "en", None),
            (4, "w " * 50_000, "en", "s"), (5, "one two three", "de", "t"), (5, "one two three", "de", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("rate", F.lit(1))
    measured, slim = mixing.measure(docs, Scratch(spark))
    assert sorted(map(str, slim.select("doc_id", "topic", "tokens").collect())) == sorted(
        map(str, measured.select("doc_id", "topic", "tokens").collect()))
    got = mixing.fit(measured, Scratch(spark)).decide(measured).collect()
    assert len(got) == 7 and all(r.sampled for r in got if not r.text)
    assert len({r.sampled for r in got if r.doc_id == 5}) == 1
    none = measured.filter("doc_id = 99")
    assert mixing.fit(none, Scratch(spark)).decide(none).count() == 0


# ------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch, before = Scratch(spark), None
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = scratch.write(stage(spark, docs, SF), name)
        if name == "packing":
            total = out.select("doc_id", "doc_tokens").distinct()
            assert total.count() == docs.count()
            assert out.agg(F.sum("length")).first()[0] == total.agg(F.sum("doc_tokens")).first()[0]
            break
        assert out.columns == docs.columns
        assert 0 < out.count() <= docs.count() and out.select("doc_id").distinct().count() == out.count()
        if name == "quality":
            kept = out.join(labels, "doc_id").groupBy("quality").count().rdd.collectAsMap()
            every = dict(labels.groupBy("quality").count().collect())
            assert kept[1] >= 0.99 * every[1] and kept.get(0, 0) <= 0.1 * every[0]
        if name == "mixing":
            assert out.count() >= 0.25 * docs.count()  # the scarcest value sets the size
        if name == "line_dedup":
            lines = out.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter("length(trim(line)) >= 10")
            again = lines.groupBy(F.lower(F.trim("line"))).agg(F.countDistinct("doc_id").alias("n")).filter("n > 1")
            assert again.count() == 0
        docs, before = out, docs
    assert before is not None


def test_pipeline_takes_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "same words again " * 30, "en", "s", 1),
            (4, "same words again " * 30, "en", "s", 1), (5, "x" * 50_000, "de", "t", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    labels = spark.createDataFrame([(3, 1, 0), (1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, frame in (("all", spark.createDataFrame(rows, schema)), ("none", spark.createDataFrame([], schema))):
        docs, scratch = frame, Scratch(spark)
        for _, stage in corpus_pipeline.STAGES:
            docs = scratch.write(stage(spark, docs, str(tmp_path)), "stage")
        assert (docs.count() > 0) == (name == "all")
