"""Helpers that the training-data operators share: stage tables, block tiles, streaming groups, components."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ASCII_SPACE = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or next to a local session's warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stage"


class Scratch:
    """One run's stage tables. A lost executor re-reads files; lineage ends at each table."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_root(spark)}/llm-{uuid.uuid4().hex[:12]}"
        self._serial = itertools.count(1)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{next(self._serial):03d}-{name}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table.scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that no later plan reads."""
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


    def close(self) -> None:
        """Remove all tables of the run, when nothing reads them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of whole texts stay small: at most ``rows`` rows, and 16 MB where the session can bound bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def map_arrow(df: DataFrame, make: Callable[[], Callable[[dict], dict | None]], schema: str,
              flush: bool = False) -> DataFrame:
    """``mapInArrow`` over dicts of columns. ``make`` runs once per task and returns the function for its batches;
    with ``flush`` it is called with None after the last batch."""
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in itertools.chain(batches, [None] if flush else []):
            made = step(None if batch is None else {n: batch.column(i) for i, n in enumerate(batch.schema.names)})
            if made is not None:
                yield pa.RecordBatch.from_arrays([_array(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def summed(rows: DataFrame, part: Callable[[dict], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``part`` over all batches, ``size`` numbers: per task, then per number in Spark."""
    def make() -> Callable[[dict | None], dict | None]:
        total = np.zeros(size)

        def step(c: dict | None) -> dict | None:
            nonlocal total
            if c is not None:
                total = total + np.asarray(part(c), float).ravel()
                return None
            return {"v": [total.tolist()]} if total.any() else {"v": []}

        return step

    sums = map_arrow(rows, make, "v array<double>", flush=True).select(F.posexplode("v").alias("i", "v"))
    out = np.zeros(size)
    for i, v in sums.groupBy("i").agg(F.sum("v")).collect():
        out[i] = v
    return out


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array | pa.ChunkedArray):
        return values.cast(kind) if values.type != kind else values
    return pa.array(values, type=kind)


def stream_groups(df: DataFrame, keys: list[str], make: Callable[[], Callable[[dict], dict | None]], schema: str,
                  order: list[str | Column] | None = None) -> DataFrame:
    """Give ``make()``'s function dicts of numpy columns that hold whole groups of ``keys``, many at a time.

    Rows meet by a shuffle on ``keys`` and are sorted, so a task holds one batch and the group that it ends in: the
    caller bounds the groups. Functions find the borders with ``borders``.
    """
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        held: list[dict] = []

        def emit(parts: list[dict]) -> Iterator[pa.RecordBatch]:
            made = step({n: np.concatenate([p[n] for p in parts]) for n in names})
            if made is not None:
                yield pa.RecordBatch.from_arrays([_array(made[f.name], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(names)}
            starts = borders(part, keys)
            first_is_new = bool(held) and any(held[-1][k][-1] != part[k][0] for k in keys)
            cut = int(starts[-1])
            if cut == 0 and not first_is_new:
                held.append(part)
                continue
            whole = [*held, {n: v[:cut] for n, v in part.items()}] if cut else held
            if whole:
                yield from emit(whole)
            held = [{n: v[cut:] for n, v in part.items()}]
        if held:
            yield from emit(held)

    sorted_rows = df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))
    return sorted_rows.mapInArrow(run, out)


def borders(columns: dict, keys: list[str]) -> np.ndarray:
    """Index of the first row of each run of equal keys."""
    n = len(columns[keys[0]])
    change = np.zeros(n, bool)
    change[0] = True
    for k in keys:
        change[1:] |= columns[k][1:] != columns[k][:-1]
    return np.flatnonzero(change)


def block_tiles(df: DataFrame, keys: list[str], row_id: str, block_rows: int) -> DataFrame:
    """Split large groups into blocks and list every row under the block pairs (tiles) that it takes part in.

    Adds ``_i``, ``_j`` (the tile, ``_i`` <= ``_j``) and ``_side`` (the row's own block). A group of m rows gives
    m / block_rows blocks, so no task holds more than two blocks, however large a group is.
    """
    sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("_blocks"))
    rows = df.join(sizes, keys).withColumn("_side", F.pmod(F.xxhash64(row_id, F.lit("block")), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (rows.withColumn("_other", other)
            .withColumn("_i", F.least("_side", "_other")).withColumn("_j", F.greatest("_side", "_other"))
            .drop("_other", "_blocks"))


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of an undirected edge list, component = smallest node that links reach.

    Each round sends every node to its smallest neighbour, follows these pointers to their roots by doubling, and
    contracts the edges to the roots. Minima combine before the shuffle and joins are split by adaptive execution,
    so a node with very many links is no hot spot.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    links = scratch.write(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    mapping = None
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"),
                                                                    F.least("a", "m").alias("root"))
        parent = scratch.write(parent, "parent")
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = scratch.write(parent.join(up, "root").select(
                "node", F.col("up").alias("next"), F.col("root").alias("was")), "jump")
            moved = not jumped.filter("next <> was").isEmpty()
            scratch.drop(parent)
            parent = jumped.select("node", F.col("next").alias("root"))
            parent.scratch_path = jumped.scratch_path
            if not moved:
                break
        to = [parent.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab"]
        contracted = (links.join(to[0], "a").join(to[1], "b").filter("ra <> rb")
                      .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        contracted = scratch.write(contracted, "edges")
        scratch.drop(links)
        links = contracted
        if mapping is None:
            mapping = parent
            continue
        final = parent.select(F.col("node").alias("root"), F.col("root").alias("top"))
        composed = scratch.write(mapping.join(final, "root", "left").select(
            "node", F.coalesce("top", "root").alias("root")), "mapping")
        scratch.drop(mapping, parent)
        mapping = composed
    if mapping is None:
        kind = edges.schema[a].dataType.simpleString()
        return spark.createDataFrame([], f"node {kind}, component {kind}")
    return mapping.select("node", F.col("root").alias("component"))
