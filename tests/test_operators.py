"""Operators against brute force, with hot groups and ties."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oncospan import RegistryPipeline
from oncospan.operators.factored import FactoredLinks
from oncospan.operators.ids import number_in_groups, number_rows
from oncospan.operators.intervals import events_in_intervals, state_runs
from oncospan.operators.paths import ordered_paths, path_levels, path_nodes
from oncospan.operators.substrings import single_hit
from oncospan.plans import clinical
from oncospan.sources import sinks

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_numbers_are_dense_and_ordered(spark, stage):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    rows = sorted((r["k"], r["n"]) for r in number_rows(df, ["k"], stage, "t", "n", first=11).collect())
    assert [n for _, n in rows] == list(range(11, 5011))


def test_numbers_of_an_empty_table(spark, stage):
    assert number_rows(spark.createDataFrame([], "k long"), ["k"], stage, "t", "n").collect() == []


def test_group_numbers_with_a_hot_and_a_null_group(spark, stage):
    rows = [("hot", i) for i in range(2000)] + [(f"g{i % 50}", i) for i in range(500)] + [(None, 1), (None, 2)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o long")
    found = number_in_groups(df, ["g"], ["o"], stage, "t", "n").collect()
    expected = {}
    for g, o in rows:
        expected.setdefault(g, []).append(o)
    assert sorted((str(r["g"]), r["o"], r["n"]) for r in found) == sorted(
        (str(g), o, n) for g, os in expected.items() for n, o in enumerate(sorted(os), 1))


def _runs(rows):
    """The interval rule on one tumor, row by row."""
    rows, last, out = sorted(set(rows)), max(d for d, _ in rows), []
    for i, (d, s) in enumerate(rows):
        end = d if d == last else rows[i + 1][0] - 1
        if i and rows[i - 1][1] == s:
            out[-1][2] = end
        else:
            out.append([s, d, end])
    return [(s, a, b, b == last, n) for n, (s, a, b) in enumerate(out, 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.sampled_from("ABC")), min_size=1, max_size=40))
def test_state_runs_follow_the_rule(spark, rows):
    df = spark.createDataFrame([(f"p{k}", "1", day(d), s) for k, d, s in rows],
                               "pat_id string, Tumor_ID string, date date, state string")
    found = {}
    for r in state_runs(df, ["pat_id", "Tumor_ID"], "date", "state").collect():
        found.setdefault(r["pat_id"], []).append((r["state"], (r["start_date"] - DAY).days, (r["end_date"] - DAY).days,
                                                  r["is_last"], r["episode_number"]))
    for k in {k for k, _, _ in rows}:
        assert sorted(found[f"p{k}"], key=lambda r: r[-1]) == _runs([(d, s) for x, d, s in rows if x == k])


def test_interval_of_equal_dates_ends_before_it_starts(spark):
    rows = [("p", "1", day(0), "A"), ("p", "1", day(5), "A"), ("p", "1", day(5), "B"), ("p", "1", day(9), "B")]
    df = spark.createDataFrame(rows, "pat_id string, Tumor_ID string, date date, state string")
    found = sorted((r["state"], r["start_date"], r["end_date"]) for r in
                   state_runs(df, ["pat_id", "Tumor_ID"], "date", "state").collect())
    assert found == [("A", day(0), day(4)), ("B", day(5), day(9))]


def test_events_in_intervals_equal_brute_force(spark):
    rnd = random.Random(3)
    intervals = [(i, 0 if i % 3 else rnd.randrange(5), day(a), day(a + rnd.randrange(-3, 1500)))
                 for i, a in enumerate(rnd.randrange(-900, 900) for _ in range(60))]
    intervals.append((99, 1, day(0), None))
    events = [(i, 0 if i % 2 else rnd.randrange(5), day(rnd.randrange(-1000, 2000))) for i in range(200)]
    found = events_in_intervals(
        spark.createDataFrame(intervals, "episode_id long, person_id long, start_date date, end_date date"),
        spark.createDataFrame(events, "event_id long, person_id long, event_date date"), "person_id").collect()
    assert sorted((r["episode_id"], r["event_id"]) for r in found) == sorted(
        (i, e) for i, p, a, b in intervals if b for e, q, d in events if p == q and a <= d <= b)


def test_single_hit_equals_brute_force(spark):
    rnd = random.Random(5)
    texts = {"".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 40))) for _ in range(120)} | {"x" * 3000 + "needle"}
    needles = [(n, n, n.upper()) for n in {"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 9)))
                                          for _ in range(30)}] + [("needle", "needle", "N"), ("", "", "EMPTY")]
    found = single_hit(spark.createDataFrame([(t,) for t in texts], "text string"),
                       spark.createDataFrame(needles, "entry string, needle string, value string")).collect()
    expected = {}
    for text in texts:
        hits = {e: v for e, n, v in needles if n and n in text}
        if len(hits) == 1:
            expected[text] = next(iter(hits.values()))
    assert {r["text"]: r["value"] for r in found} == expected


def test_path_nodes_count_every_prefix(spark):
    rows = [(1, day(0), 1, "A"), (1, day(1), 2, "B"), (2, day(0), 3, "A"), (2, day(2), 4, "B"), (3, day(0), 5, "B")]
    df = spark.createDataFrame(rows, "person_id long, episode_start_date date, episode_id long, concept_name string")
    paths = ordered_paths(df, ["person_id"], ["episode_start_date", "episode_id"], "concept_name")
    assert {(r["id"], r["parent"], r["label"], r["count"]) for r in path_nodes(paths, 0).collect()} == {
        ("A", "", "A", 2), ("A - B", "A", "B", 2), ("B", "", "B", 1)}
    assert path_nodes(paths, 2).count() == 0


def test_stage_uses_the_shared_folder(spark, stage):
    root = spark.conf.get("spark.checkpoint.dir")
    assert stage.path.startswith(root + "/")
    assert stage.write(spark.range(3).toDF("k"), "t").inputFiles()[0].startswith("file://" + stage.path)


def test_numbering_runs_its_input_once(spark, stage):
    ran = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        ran.add(1)
        return x

    number_rows(spark.range(500, numPartitions=3).select(counted("id").alias("k")), ["k"], stage, "once", "n").collect()
    assert ran.value == 500


def test_path_levels_of_any_depth(spark):
    paths = spark.createDataFrame([(1, "A -> B -> C -> D -> E"), (2, "A")], "person_id long, concept_path string")
    rows = {tuple(r) for r in path_levels(paths, ["person_id"]).collect()}
    assert rows == {(1, i + 1, x) for i, x in enumerate("ABCDE")} | {(2, 1, "A")}


def test_links_of_a_hot_person_grow_linearly(spark):
    tumors = [(1, "p", f"t{i}", "8000/3-C50.9") for i in range(200)]
    links = spark.createDataFrame([(i, *t) for i, t in enumerate(tumors)],
                                  "condition_occurrence_id long, _person long, _pat string, _tumor string, _icdo3 string")
    rows = spark.createDataFrame([t for t in tumors for _ in range(3)], "person_id long, pat_id string, tumor_id string, icdo3 string")
    assert clinical._link(rows, links, equal_codes=False).count() == 600
    assert clinical._link(rows, links, equal_codes=True).count() == 600 * 200


def test_stage_needs_a_shared_folder(spark, stage):
    kept = stage.write(spark.range(3), "kept")
    stage.write(spark.range(2), "gone")
    stage.remove("gone")
    assert kept.count() == 3
    stage.close()
    with pytest.raises(Exception):
        spark.read.parquet(stage.path).count()


# ------------------------------------------------------------ factorised links

def test_factored_links_equal_a_join(spark):
    rng = random.Random(3)
    left = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["a", "b", None])) for i in range(300)]
    right = [(1000 + i, rng.choice([1, 1, 2, 4, None]), rng.choice(["a", "b"])) for i in range(200)]
    right += right[:5]  # repeated partners stay
    rows = spark.createDataFrame(left, "event int, person int, code string")
    partners = spark.createDataFrame(right, "condition int, person int, code string")
    for tile_rows in (4, 512):
        links = FactoredLinks(rows, partners, ["person", "code"], tile_rows)
        got = sorted(map(repr, links.expand().select("event", "condition").collect()))
        want = sorted(map(repr, rows.join(partners, ["person", "code"], "left").select("event", "condition").collect()))
        assert got == want
        counts = {(r["person"], r["code"]): (r["n_rows"], r["n_partners"], r["n_links"]) for r in links.groups.collect()}
        n, m = sum(r[1:] == (1, "a") for r in left), sum(r[1:] == (1, "a") for r in right)
        assert counts[1, "a"] == (n, m, n * m) and (3, "a") not in counts
    with pytest.raises(ValueError, match="event"):
        FactoredLinks(rows, rows, ["person", "code"])


def test_links_of_a_hot_key_are_linear_until_written(spark):
    """100,000 x 100,000 links of one person are ten thousand million; the groups count them without a pair."""
    rows = spark.range(100_000).select(F.lit(1).alias("person"), F.lit("a").alias("code"), F.col("id").alias("event"))
    partners = spark.range(100_000).select(F.lit(1).alias("person"), F.lit("a").alias("code"), F.col("id").alias("condition"))
    links = FactoredLinks(rows, partners, ["person", "code"])
    assert [r["n_links"] for r in links.groups.collect()] == [10 ** 10]


def test_links_of_a_hot_key_are_written_by_many_tasks(spark):
    rows = spark.range(6000).select(F.lit(1).alias("person"), F.col("id").alias("event"))
    partners = spark.range(3000).select(F.lit(1).alias("person"), F.col("id").alias("condition"))
    expanded = FactoredLinks(rows, partners, ["person"], tile_rows=500).expand()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["n"] for r in expanded.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 18_000_000 and len(sizes) == 4 and max(sizes) < 9_000_000


# ------------------------------------------------------------ heavy intervals, long paths

def test_heavy_buckets_equal_brute_force(spark):
    rng = random.Random(4)
    events = [(rng.choice([1, 1, 1, 2]), i, day(rng.randint(0, 800))) for i in range(600)]
    events += [(1, 1000 + i, day(100)) for i in range(200)]  # one day holds a third of a person's events
    spans = [(rng.choice([1, 2]), i, day(a), day(a + rng.randint(0, 500))) for i, a in enumerate(rng.choices(range(700), k=60))]
    got = events_in_intervals(spark.createDataFrame(spans, "p int, span int, start_date date, end_date date"),
                              spark.createDataFrame(events, "p int, event int, event_date date"), "p", heavy=50)
    pairs = [(r["span"], r["event"]) for r in got.collect()]
    want = {(s, e) for p, s, a, b in spans for q, e, d in events if p == q and a <= d <= b}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_heavy_bucket_is_spread(spark):
    events = spark.range(200_000).select(F.lit(1).alias("p"), F.col("id").alias("event"),
                                         F.date_add(F.lit(DAY), (F.col("id") % 300).cast("int")).alias("event_date"))
    spans = spark.createDataFrame([(1, i, day(i), day(i + 20)) for i in range(0, 300, 50)],
                                  "p int, span int, start_date date, end_date date")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = events_in_intervals(spans, events, "p", heavy=5000)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == sum(1 for i in range(200_000) for s in range(0, 300, 50) if s <= i % 300 <= s + 20)
    assert len(sizes) == 4 and max(sizes) < 0.6 * sum(sizes)


def test_nodes_of_a_long_path_are_linear(spark):
    """Two paths of 5,000 steps that share 3 of them: 3 nodes are spelled out, not 10,000 prefixes."""
    long = [[f"{name}{i}" if i >= 3 else f"s{i}" for i in range(5000)] for name in "ab"]
    paths = spark.createDataFrame([(" -> ".join(p),) for p in long], "concept_path string")
    got = {r["id"]: (r["parent"], r["label"], r["count"]) for r in path_nodes(paths, more_than=1).collect()}
    assert got == {"s0": ("", "s0", 2), "s0 - s1": ("s0", "s1", 2), "s0 - s1 - s2": ("s0 - s1", "s2", 2)}


def test_equal_labels_at_other_places_are_other_nodes(spark):
    paths = spark.createDataFrame([("a -> b",), ("b -> a",), ("a -> a",), ("a -> a",), ("a",)], "concept_path string")
    got = {r["id"]: r["count"] for r in path_nodes(paths, more_than=0).collect()}
    assert got == {"a": 4, "a - b": 1, "b": 1, "b - a": 1, "a - a": 2}


# ------------------------------------------------------------ a CDM at rest

CARE_SITES = "care_site_id long, care_site_name string"


def test_readers_see_whole_versions_only(spark, tmp_path):
    folder = str(tmp_path / "cdm")
    with pytest.raises(ValueError, match="no finished CDM"):
        sinks.manifest(spark, folder)
    first = spark.createDataFrame([(1, "a"), (2, "b")], CARE_SITES)
    assert sinks.write_tables({"care_site": first}, folder) == {"care_site": 2}
    old = sinks.read_tables(spark, folder)["care_site"]

    @F.udf("string")
    def fails(_):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        sinks.write_tables({"care_site": first.withColumn("care_site_name", fails("care_site_name"))}, folder)
    assert sinks.read_tables(spark, folder)["care_site"].count() == 2  # a failed run changes nothing
    sinks.write_tables({"care_site": first.limit(1)}, folder)
    assert old.count() == 2 and sinks.read_tables(spark, folder)["care_site"].count() == 1
    assert sinks.remove_older(spark, folder) == 1 and sinks.manifest(spark, folder)["rows"] == {"care_site": 1}
    assert sinks.read_tables(spark, folder)["care_site"].count() == 1


def test_a_cdm_with_other_columns_is_refused(spark, tmp_path):
    folder = str(tmp_path / "cdm")
    sinks.write_tables({"care_site": spark.createDataFrame([(1, "a")], CARE_SITES)}, folder)
    path = f"{folder}/{sinks.manifest(spark, folder)['version']}/care_site"
    spark.createDataFrame([("x",)], "care_site_id string").write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="care_site"):
        sinks.read_tables(spark, folder)


def test_reports_at_rest_name_what_is_missing(spark, tmp_path, stage):
    folder = str(tmp_path / "cdm")
    sinks.write_tables({"care_site": spark.createDataFrame([(1, "a")], CARE_SITES)}, folder)
    pipeline = RegistryPipeline.from_cdm(spark, folder, {}, stage)
    assert pipeline.care_site.collect()[0]["care_site_name"] == "a"
    with pytest.raises(ValueError, match="tumor"):
        pipeline.prepared_tumor


def test_counts_are_taken_by_the_write(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, None)], CARE_SITES)
    counts = sinks.write_counted(rows, str(tmp_path / "t"), "t", "care_site_id", "care_site_name")
    assert counts == {"n_rows": 3, "after_1": 2, "after_2": 1} and spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_sql_file_takes_parameters(spark, tmp_path):
    (tmp_path / "q.sql").write_text("-- a comment\nselect count(*) as n from t\nwhere id >= :least\n")
    assert sinks.sql_file(spark, str(tmp_path / "q.sql"), {"t": spark.range(10)}, least=4).collect()[0]["n"] == 6
