"""Stage and CDM sinks, and reading tables back.

A CDM is written as a whole: all tables go to a folder of their own, with their row counts taken while they are written,
and one small manifest then names that folder. Readers follow the newest manifest, so they see the CDM before the run or
the one after it and never half of each; a run that fails leaves no manifest and can be repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from oncospan import schemas

MANIFEST = "manifest-"


def write_stage(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{name}")


def _cdm_rows(df: DataFrame, table: str) -> DataFrame:
    """Columns in order and type; rows are clustered by person within the files."""
    rows = schemas.conform(df, table)
    return rows.sortWithinPartitions("person_id") if "person_id" in rows.columns else rows


def write_cdm(df: DataFrame, folder: str, table: str) -> None:
    """Replace one CDM table."""
    _cdm_rows(df, table).write.mode("overwrite").parquet(f"{folder}/{table}")


def write_counted(df: DataFrame, path: str, name: str, *steps: str) -> dict[str, int]:
    """Write ``df`` and return its row count and those of the rows with ``steps[:1]``, ``steps[:2]``, … not null, all
    counted by the write itself."""
    observed = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    kept, counts = F.lit(True), [F.count(F.lit(1)).alias("n_rows")]
    for step, column in enumerate(steps, 1):
        kept = kept & F.col(column).isNotNull()
        counts.append(F.count_if(kept).alias(f"after_{step}"))
    df.observe(observed, *counts).write.mode("overwrite").parquet(path)
    return dict(observed.get)


# ---------------------------------------------------------------- a whole CDM

def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    files, path = _files(spark, folder), _path(spark, folder)
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return sorted(n for n in names if n.startswith(MANIFEST) and n.endswith(".json"))


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Write all CDM tables and switch to them at once. Returns the rows of each."""
    spark = next(iter(tables.values())).sparkSession
    version = f"cdm-{uuid.uuid4().hex[:12]}"
    rows = {name: write_counted(_cdm_rows(df, name), f"{folder}/{version}/{name}", name)["n_rows"]
            for name, df in tables.items()}
    known = _manifests(spark, folder)
    number = int(known[-1][len(MANIFEST):-len(".json")]) + 1 if known else 1
    files = _files(spark, folder)
    new = _path(spark, f"{folder}/{version}/manifest.json")
    out = files.create(new, True)
    out.write(bytearray(json.dumps({"version": version, "rows": rows}).encode()))
    out.close()
    # the switch: a file under a new name appears whole or not at all
    if not files.rename(new, _path(spark, f"{folder}/{MANIFEST}{number:08d}.json")):
        raise RuntimeError(f"another run wrote {folder} at the same time")
    return rows


def manifest(spark: SparkSession, folder: str) -> dict:
    """Version folder and row counts of the newest CDM in ``folder``."""
    known = _manifests(spark, folder)
    if not known:
        raise ValueError(f"no finished CDM in {folder}")
    return json.loads("".join(r.value for r in spark.read.text(f"{folder}/{known[-1]}").collect()))


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables of the newest CDM in ``folder``; their columns must be those of the CDM."""
    newest = manifest(spark, folder)
    tables = {}
    for name in newest["rows"]:
        df = spark.read.parquet(f"{folder}/{newest['version']}/{name}")
        want = schemas.conform(df.limit(0), name).schema if set(schemas.columns(name)) <= set(df.columns) else None
        if want is None or [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in want]:
            raise ValueError(f"{folder}: columns of {name} are not those of the CDM")
        tables[name] = df
    return tables


def remove_older(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete all but the newest ``keep`` versions, which no reader may still use. Returns how many went."""
    old = _manifests(spark, folder)[:-keep]
    for name in old:
        version = json.loads("".join(r.value for r in spark.read.text(f"{folder}/{name}").collect()))["version"]
        _files(spark, folder).delete(_path(spark, f"{folder}/{name}"), False)
        _files(spark, folder).delete(_path(spark, f"{folder}/{version}"), True)
    return len(old)


# ---------------------------------------------------------------- databases, single tables, SQL

def write_cdm_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Replace a table in a database, keeping its column types."""
    (schemas.conform(df, table.rpartition(".")[2]).write.option("truncate", True)
     .jdbc(url, table, mode="overwrite", properties=properties))


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def sql_file(spark: SparkSession, path: str, tables: Mapping[str, DataFrame], **parameters) -> DataFrame:
    """The statement in a file over ``tables``; ``:name`` in it stands for a parameter."""
    text = "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())
    register_views(tables)
    return spark.sql(text, args=parameters)
