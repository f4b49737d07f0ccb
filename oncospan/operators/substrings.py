"""Which needle does a text contain? A hash join on anchors instead of a test of every pair.

Each needle is filed under its first ``ANCHOR`` characters (all of them when it is shorter). A text emits the pieces
of up to that length at every position; pieces join needles on equality and the rest of the needle is compared at the
position found. The work is proportional to the text lengths plus the true anchor hits. A hot anchor is an ordinary
skewed join key. Nothing is capped: every text is read to its end and every needle is tried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANCHOR = 6


def single_hit(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """(text, value) for each distinct ``text`` that contains the needle of exactly one entry.

    ``needles`` has (entry, needle, value); two entries with the same needle are two hits. Empty needles are ignored.
    """
    filed = needles.filter(F.length("needle") > 0).select(
        "entry", "needle", "value", F.substring("needle", 1, ANCHOR).alias("anchor"))
    pieces = (texts.filter(F.length("text") > 0)
              .select("text", F.explode(F.sequence(F.lit(1), F.length("text"))).alias("at"))
              # near the end of the text the longer pieces do not exist
              .select("text", "at", F.explode(F.sequence(F.lit(1), F.least(
                  F.lit(ANCHOR), F.length("text") - F.col("at") + 1))).alias("size"))
              .select("text", "at", F.expr("substring(text, at, size)").alias("piece")))
    hits = pieces.join(filed, F.col("piece") == F.col("anchor")).filter(
        F.expr("substring(text, at, length(needle)) = needle"))
    return (hits.groupBy("text").agg(F.min("entry").alias("first"), F.max("entry").alias("last"),
                                     F.max("value").alias("value"))
            .filter("first = last").select("text", "value"))
