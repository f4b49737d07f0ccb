"""Session defaults.

Broadcast decisions are left to Spark: ``spark.sql.autoBroadcastJoinThreshold`` is the size check, and above it the
same join runs as a shuffled join whose skewed partitions adaptive execution splits. No plan in this package carries
a broadcast hint.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs one more shuffle after it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # a task's share is bounded by these and not by the size of the input: CDM rows are many times wider in memory than
    # in their files, and a task of 128 MB of them sorts on disk
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Spark takes a file's size for that of its rows. Codes, names and keys are many times larger in memory than in their
    # files, so without this a table of some 10 MB of files would be built and broadcast by the driver as one of some 100s
    "spark.sql.sources.fileCompressionFactor": "16",
    # stage tables and the CDM are written far more than they are read
    "spark.sql.parquet.compression.codec": "zstd",
}
INPUT_PER_PARTITION = 4 << 20


def tune(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the runtime SQL settings the plans rely on to an existing session. With ``input_bytes`` shuffles start with
    at least a partition for each 4 MB of them, which adaptive execution puts together again where they are small."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if input_bytes // INPUT_PER_PARTITION > least:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", input_bytes // INPUT_PER_PARTITION)
    return spark


def session(app: str = "oncospan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
