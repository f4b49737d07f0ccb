"""Dense row numbers without a single-partition window.

``number_rows`` range-partitions by a total order, sorts inside each partition and writes the rows together with
(partition, position). The id is the number of rows in the partitions before it, plus the position; the starts are a
staged table of one row per partition. Range partitioning splits a hot leading key by the keys that follow it, so a
group that holds a third of the rows is still numbered by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oncospan.staging import Stage

_POSITION_MASK = (1 << 33) - 1


def number_rows(df: DataFrame, order: list[str | Column], stage: Stage, name: str, id_col: str,
                first: int = 1, run_once: bool = True) -> DataFrame:
    """Stage ``df`` with ``id_col`` = ``first``, ``first`` + 1, … in ``order``. Ties in ``order`` get arbitrary turns.

    Range partitioning samples its input by running it, so ``df`` is staged first and runs once. Without ``run_once`` the
    last stage of ``df`` runs twice (its shuffles do not) and nothing is written but the numbered rows; not for rows
    that are counted on their way.
    """
    rows = stage.write(df, f"{name}_rows") if run_once else df
    ranged = stage.write(_placed(rows.repartitionByRange(*order), order), name)
    if run_once:
        stage.remove(f"{name}_rows")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    starts = stage.write(sizes.select("_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + first).alias("_start")),
                         f"{name}_starts")
    others = [c for c in df.columns if c != id_col]
    # two numbers per partition of the range shuffle
    return ranged.join(F.broadcast(starts), "_part").select((F.col("_start") + F.col("_pos")).alias(id_col), *others)


def _placed(rows: DataFrame, order: list[str | Column]) -> DataFrame:
    return (rows.sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
            .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))))


def number_kinds(rows: DataFrame, kind: str, order: list[str | Column], stage: Stage, name: str,
                 id_col: str) -> DataFrame:
    """Stage ``rows`` with 1, 2, … in the order of ``kind`` and ``order``, where the partitions of ``rows`` are already
    ranges of the first column of ``order``: a partition holds all kinds of its range, and each kind's number starts
    after the rows of that kind in the partitions before. Each kind has a folder of its own."""
    ranged = stage.write(_placed(rows, [kind, *order]), name, kind)
    sizes = ranged.groupBy(kind, "_part").agg(F.count("*").alias("_n"), F.min("_pos").alias("_least"))
    earlier = W.orderBy(kind, "_part").rowsBetween(W.unboundedPreceding, -1)  # one row per kind and partition
    start = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1 - F.col("_least")
    starts = stage.write(sizes.select(kind, "_part", start.alias("_start")), f"{name}_starts")
    others = [c for c in rows.columns if c != id_col]
    return ranged.join(F.broadcast(starts), [kind, "_part"]).select(
        (F.col("_start") + F.col("_pos")).alias(id_col), *others)


def number_in_groups(df: DataFrame, group: list[str], order: list[str | Column], stage: Stage, name: str,
                     id_col: str, run_once: bool = True) -> DataFrame:
    """1, 2, … inside each group, for groups too large for one window task: global number minus the group's first."""
    rows = number_rows(df, [*group, *order], stage, name, "_row", run_once=run_once)
    firsts = rows.groupBy(*group).agg(F.min("_row").alias("_first"))
    keyed = firsts.select(*[F.col(c).alias(f"_g_{c}") for c in group], "_first")
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group]
    return (rows.join(keyed, same, "inner")
            .select(*df.columns, (F.col("_row") - F.col("_first") + 1).alias(id_col)))
