"""A training corpus from raw documents: five stages, each over all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.

Defined results: a null or empty text is scored like the empty text, has one empty line, no shingles, no tokens but the end
token, and topic 0; it passes or goes by its quality score alone, as it weighs nothing in the mix. Null labels and doc_ids
teach the classifier nothing. Rows that share a doc_id are one document: they go or stay together, and packing packs each
row. Rows without doc_id are no one's copy and stay until the mix, whose draw is theirs together. Ties between near copies
go to the smallest doc_id. An empty table passes every stage as an empty table. Further columns of ``documents``, whatever
their names, end at the first stage; ``n_chars`` is counted again where lines go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncospan.llm import line_dedup, mixing, quality
from oncospan.llm.common import Scratch
from oncospan.llm.jaccard import BROADCAST_IDS, JaccardJoin
from oncospan.llm.queries import MIX_POWER, pack_documents, quality_model, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PACK_CACHE = 50_000  # the executors hold what four stages left in them, so the last one remembers fewer words


def _documents(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*COLUMNS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier finds more likely good than bad."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model).filter("score >= 0.5").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document holds, and documents of which nothing but white space is left."""
    kept = line_dedup.dedup_lines(docs, Scratch(spark))
    return _documents(kept.filter((F.col("n_dropped") == 0) | (F.length(F.trim("text")) > 0)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id: 5-word shingles, 0.8."""
    scratch = Scratch(spark)
    groups = JaccardJoin(scratch, words=5, num=80, den=100).groups(docs)
    copies = scratch.write(groups.filter("component_id <> doc_id").select("doc_id").distinct(), "copies")
    if copies.count() <= BROADCAST_IDS:  # else both sides meet in a shuffle
        copies = F.broadcast(copies)
    return docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that sources, languages and topics have their tempered target shares."""
    scratch = Scratch(spark)
    measured, slim = mixing.measure(docs, scratch)
    return mixing.fit(slim, scratch, power=MIX_POWER, temper="cells").decide(measured).filter("sampled").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of 2048."""
    return pack_documents(spark, docs, PACK_CACHE)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [("quality", quality_filter), ("line_dedup", dedup_lines),
                                   ("near_duplicates", near_duplicates), ("mixing", mix_sources), ("packing", pack)]

ORACLE_SQL = None  # a trained classifier, tokenizer ids and sampling hashes are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
