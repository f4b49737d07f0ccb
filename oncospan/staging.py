"""Stage tables: intermediate results written as parquet so that later plans read files, not lineage.

A lost executor then re-reads files instead of recomputing the pipeline, and row numbers stay what they were when
they were written. The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from oncospan.operators.counting import StepCounts


def stage_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach, or give Stage a root")
    return root.rstrip("/")


class Stage:
    """One run's stage folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or stage_root(spark)}/stage-{uuid.uuid4().hex[:12]}"
        self.counts = StepCounts()
        self._serial = itertools.count(1)
        self._folders: dict[str, str] = {}
        self._written: dict[str, str] = {}

    def next_path(self, name: str) -> str:
        return f"{self.path}/{next(self._serial):03d}-{name}"

    def write(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """Write ``df`` once, in a folder for each value of ``by``, and return a reader over the written files."""
        path = self._written[name] = self.next_path(name)
        df.write.partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self, name: str, fill: Callable[[str], None]) -> str:
        """The folder ``fill`` wrote for ``name``; filled on first use."""
        if name not in self._folders:
            path = self.next_path(name)
            fill(path)
            self._folders[name] = path
        return self._folders[name]

    def remove(self, name: str) -> None:
        """Delete the last table written as ``name``; nothing may read it any more."""
        self._delete(self._written.pop(name))

    def close(self) -> None:
        """Delete the whole folder, when no table of the run is read any more."""
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
