"""Vocabulary tables and code maps from delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncospan import schemas


def guess_delimiter(spark: SparkSession, path: str) -> str:
    """``;`` before tab before ``,``, by the first line."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0]["value"] if first else ""
    return next((d for d in (";", "\t") if d in line), ",")


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("header", True).option("sep", guess_delimiter(spark, path)).option("quote", '"')
            .option("escape", '"').csv(path))


def read_vocabulary(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A vocabulary table with its CDM types; dates are written ``YYYYMMDD``; unnamed concepts are called 'None'."""
    rows = read_delimited(spark, path)
    rows = rows.withColumns({c: F.try_to_date(c, "yyyyMMdd") for c in rows.columns if "date" in c})
    if table == "concept":
        rows = rows.fillna("None", ["concept_name", "vocabulary_id"])
    return schemas.conform(rows, table)


def read_vocabularies(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, DataFrame]:
    return {t: read_vocabulary(spark, f"{folder}/{t}{suffix}", t) for t in schemas.VOCABULARY_TABLES}
