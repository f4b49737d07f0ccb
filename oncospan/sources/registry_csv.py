"""Registry tables from CSV files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncospan.sources.quoted_lines import DAMAGED, read_quoted

# The files a registry delivers. The last two are optional.
FILES = ("patient", "tumor", "fe", "op", "systemtherapie", "strahlentherapie", "modul_mamma",
         "systemtherapie_with_substance_service_variable")
REQUIRED_FILES = FILES[:6]
SUBSTANCE_FILE = FILES[-1]


def read_registry_csv(spark: SparkSession, folder: str, line_breaks: bool = True,
                      damaged: bool = False) -> dict[str, DataFrame]:
    """``<folder>/<name>.csv`` (a file or a folder of parts) per known name, all columns as strings.

    Values stay text, so a register id keeps its leading zero; preparation casts what it needs. Quoted values may hold
    line breaks, wherever a file is split; ``line_breaks=False`` reads files that are known to have none in one pass.
    ``damaged`` adds the column of that name, see ``damaged_records``.
    """
    tables = {}
    for name in FILES:
        path = f"{folder}/{name}.csv"
        try:
            if line_breaks or damaged:
                df = read_quoted(spark, path, damaged=damaged)
            else:
                df = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            if name in REQUIRED_FILES:
                raise ValueError(f"missing registry file: {path}") from error
            continue
        tables["substance_override" if name == SUBSTANCE_FILE else name] = df
    return tables


def damaged_records(tables: dict[str, DataFrame]) -> DataFrame:
    """Records and damaged records of tables read with ``damaged=True``."""
    counts = [df.agg(F.count("*").alias("n_rows"), F.count_if(DAMAGED).alias("n_damaged")).select(
        F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out
