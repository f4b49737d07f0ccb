"""Code-map lookups: filter the map to a slice, reduce it to the needed columns, join on the code.

A vocabulary is large and the codes that occur in the rows are few, some of them in very many rows. ``seen`` reduces a
slice to those codes before the join, so that Spark sees a small table and need not shuffle the rows by their code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncospan.staging import Stage


def map_slice(code_map: DataFrame, condition: Column, code: str, distinct: bool = False,
              **outputs: str) -> DataFrame:
    """Rows of ``code_map`` under ``condition`` as (``_code``, one column per output)."""
    part = code_map.filter(condition & F.col(code).isNotNull()).select(
        F.col(code).alias("_code"), *[F.col(src).alias(name) for name, src in outputs.items()])
    return part.distinct() if distinct else part


def seen(entries: DataFrame, rows: DataFrame, code: Column, stage: Stage | None, name: str,
         key: str = "_code") -> DataFrame:
    """The ``entries`` whose ``key`` is the ``code`` of some row, staged; all entries without a ``stage``."""
    if stage is None:
        return entries
    return stage.write(entries.join(rows.select(code.alias(key)).distinct(), key, "left_semi"), name)


def lookup(df: DataFrame, code: Column, entries: DataFrame, how: str = "inner") -> DataFrame:
    """``df`` with the entry columns of its code; several entries for one code give several rows."""
    return df.withColumn("_lookup", code).join(entries, F.col("_lookup") == F.col("_code"), how).drop("_lookup", "_code")
