"""Unions by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
