"""Chat formatting with collapse of cumulative snapshots, in DataFrame functions alone.

A logging service that saves a conversation after every turn leaves many prefixes of one conversation. Every turn gets
the hash of all turns up to it; a conversation whose last hash equals an inner hash of a longer one is a prefix of it and
goes (an anti-join), copies collapse to the smallest conv_id, and what is left is rendered.

The prefix hash is a sum of hashes of (place, role, text), so it is a prefix sum: turns are range-partitioned by
(conv_id, turn), sums run inside each partition, and the totals of earlier partitions of the same conversation are added.
A conversation that holds a third of all turns is thus numbered, hashed and rendered by many tasks. Conversations are
summed up by hash before any join, so many copies or a common first turn make no hot key.

Defined results: rows without conv_id belong to no conversation. Turns are ordered by (turn, role, text), nulls first;
repeated rows are turns of their own. Null text is empty, null role is "unknown". A conversation is rendered in parts of
at most ``part_turns`` turns, in order; nearly every one is a single part. "<|" in a text is written "< |", so no text
can forge a turn. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch

PART_TURNS = 256
_SUMS = ("s0", "s1", "s2", "s3")
_LOW = (1 << 31) - 1


def prefix_hashes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, place (from 1), role, text and the prefix hash (``s0`` to ``s3``) of every turn; staged."""
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("role", "text")  # splits many turns of one number
    placed = scratch.write(
        rows.repartitionByRange("conv_id", "turn", tie).sortWithinPartitions("conv_id", "turn", "role", "text")
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    starts = counts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    numbered = placed.join(starts, ["conv_id", "part"]).select(
        "conv_id", "part", "role", "text", (F.col("at") - F.col("first") + F.col("earlier") + 1).alias("place"))
    hashed = numbered.withColumns({"x": F.xxhash64("place", "role", "text"),
                                   "y": F.xxhash64(F.lit(1), "text", "role", "place")})
    # four sums of 31-bit halves: no sum of fewer than 2^32 turns overflows
    halves = {"s0": F.col("x").bitwiseAND(F.lit(_LOW)), "s1": F.shiftrightunsigned("x", 33),
              "s2": F.col("y").bitwiseAND(F.lit(_LOW)), "s3": F.shiftrightunsigned("y", 33)}
    inside = Window.partitionBy("conv_id", "part").orderBy("place")
    summed = scratch.write(hashed.withColumns(halves).select(
        "conv_id", "part", "place", "role", "text", *[F.sum(s).over(inside).alias(s) for s in _SUMS]), "summed")
    totals = summed.groupBy("conv_id", "part").agg(*[F.max(s).alias(s) for s in _SUMS])
    carried = totals.select("conv_id", "part", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"c{s}")
                                                 for s in _SUMS])
    return scratch.write(summed.join(carried, ["conv_id", "part"]).select(
        "conv_id", "place", "role", "text", *[(F.col(s) + F.col(f"c{s}")).alias(s) for s in _SUMS]), "prefixes")


def maximal(prefixes: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turns, copies) of the conversations that are no proper prefix of another; of copies the smallest id."""
    key = ["place", *_SUMS]
    sizes = scratch.write(prefixes.groupBy("conv_id").agg(F.max("place").alias("turns")), "sizes")
    known = prefixes.select("conv_id", *key).join(sizes, "conv_id")
    whole = (known.filter("place = turns").groupBy(*key)
             .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")))
    inner = known.filter("place < turns").select(*key).distinct()
    return whole.join(inner, key, "left_anti").select("conv_id", F.col("place").alias("turns"), "copies")


def render(turns: DataFrame, kept: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, part, turns, copies, text): the kept conversations in chat markup, in parts of bounded size."""
    rows = turns.select("conv_id", "place", "role", "text").join(kept, "conv_id")
    safe = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    piece = F.concat(F.lit("<|im_start|>"), safe("role"), F.lit("\n"), safe("text"), F.lit("<|im_end|>\n"))
    part = F.floor((F.col("place") - 1) / part_turns)
    parts = rows.groupBy("conv_id", part.alias("part"), "turns", "copies").agg(
        F.sort_array(F.collect_list(F.struct("place", piece.alias("piece")))).alias("p"))  # at most part_turns
    return parts.select("conv_id", "part", "turns", "copies",
                        F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text"))


def format_chats(turns: DataFrame, scratch: Scratch) -> DataFrame:
    prefixes = prefix_hashes(turns, scratch)
    return render(prefixes, scratch.write(maximal(prefixes, scratch), "maximal"))
