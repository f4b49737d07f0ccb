"""Ordered paths of labels and the prefix tree they form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ARROW = " -> "
LEVEL = " - "


def ordered_paths(rows: DataFrame, key: list[str], order: list[str], label: str) -> DataFrame:
    """Labels joined in time order per key, with the number of steps."""
    steps = F.array_sort(F.collect_list(F.struct(*order, label)))
    return (rows.groupBy(*key).agg(steps.alias("_steps"))
            .withColumn("_labels", F.transform("_steps", lambda s: s[label]))
            .select(*key, F.array_join("_labels", ARROW).alias("concept_path"),
                    F.size("_labels").alias("path_length")))


def path_levels(paths: DataFrame, key: list[str]) -> DataFrame:
    """One row per key and level: (key, level from 1, label), as deep as each path is."""
    levels = F.posexplode(F.split("concept_path", ARROW)).alias("_at", "label")
    return paths.select(*key, levels).select(*key, (F.col("_at") + 1).alias("level"), "label")


def _prefix_hashes(labels: DataFrame, key: list[str]) -> list[Column]:
    """128 bits that name the labels from the first to this one: exclusive or of hashes of (place, label)."""
    until = W.partitionBy(*key).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    hashes = F.xxhash64("_at", "label"), F.xxhash64("label", F.lit(1), "_at")
    return [F.bit_xor(h).over(until).alias(n) for h, n in zip(hashes, ("_h1", "_h2"), strict=True)]


def path_nodes(paths: DataFrame, more_than: int) -> DataFrame:
    """Prefixes shared by more than ``more_than`` paths as (id, parent, label, count).

    Equal paths are counted before they are spread over their steps. A step carries a running hash of its prefix, not
    the prefix, so the work grows with the number of steps; prefixes are spelled out for the surviving nodes only, from
    one path each.
    """
    weighted = paths.groupBy("concept_path").agg(F.count("*").alias("_paths")).select(
        "_paths", F.split("concept_path", ARROW).alias("_labels"), F.xxhash64("concept_path").alias("_p1"),
        F.xxhash64("concept_path", F.lit(1)).alias("_p2"))
    steps = weighted.select("_p1", "_p2", "_paths", F.posexplode("_labels").alias("_at", "label"))
    hashed = steps.select("_p1", "_p2", "_paths", "_at", "label", *_prefix_hashes(steps, ["_p1", "_p2"]))
    nodes = (hashed.groupBy("_at", "_h1", "_h2")
             .agg(F.sum("_paths").alias("count"), F.min(F.struct("_p1", "_p2")).alias("_one"))
             .filter(F.col("count") > more_than).select("_at", "count", "_one.*"))
    spelled = nodes.join(weighted.drop("_paths"), ["_p1", "_p2"])
    return spelled.select(
        F.array_join(F.slice("_labels", F.lit(1), F.col("_at") + 1), LEVEL).alias("id"),
        F.array_join(F.slice("_labels", F.lit(1), F.col("_at")), LEVEL).alias("parent"),
        F.get("_labels", F.col("_at")).alias("label"), "count")
