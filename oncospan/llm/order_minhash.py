"""Document fingerprints by order MinHash, in DataFrame functions alone.

A text's words give overlapping k-mers; each is numbered by its occurrence in the text, so that repeats count. Every
numbered k-mer has a place on a hash circle. Sketch b starts at the b-th of ``sketches`` equally spaced points, takes the
``order`` nearest k-mers from there, puts them back in text order and hashes that tuple. Texts share a sketch when they
share the minimal k-mers and their order, which follows edit distance, not only the set of words. A fingerprint is the
sketches as 4 hex digits each; the likeness of two is the share of equal sketches.

Each text costs one sort of 64-bit numbers (40 bits of hash, 24 of position), whatever the number of sketches; all
steps are linear or a sort in the length of the text, also for texts that repeat one word.

Defined results: null is the empty text. A text without words has the empty fingerprint, like to itself only. Fewer than
``k`` words are one k-mer. Fewer than ``order`` k-mers give tuples of all there are. In a text of more than 2**24 words
positions count modulo 2**24. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, ORDER, SKETCHES = 3, 2, 64
RANGE_CHARS, MOST_RANGES = 1 << 24, 1 << 14
_POSITION_BITS = 24
_POSITIONS = (1 << _POSITION_BITS) - 1


def with_sketches(rows: DataFrame, text: str, out: str, k: int = K, order: int = ORDER,
                  sketches: int = SKETCHES) -> DataFrame:
    """Add ``out``: array of ``sketches`` ints, empty for a text without words. ``sketches`` is a power of two."""
    shift = 64 - (sketches.bit_length() - 1)
    kept = [F.col(f"`{c}`") for c in rows.columns]
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")
    step = rows.select(*kept, words.alias("_w"))
    # k-mers, sorted by hash; equal ones are neighbours in text order
    last = F.greatest(F.lit(1), F.size("_w") - F.lit(k - 1))
    kmer = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(k)])
                       .bitwiseAND(F.lit(~_POSITIONS)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(_POSITIONS))))
    none = F.array().cast("array<bigint>")
    step = step.select(*kept, F.when(F.size("_w") > 0, F.sort_array(kmer)).otherwise(none).alias("_h"))
    # number the occurrences: the first keeps its hash, later ones are hashed with their number
    first = F.filter(F.sequence(F.lit(0), F.size("_h") - 1), lambda i: (i == 0) | (
        F.shiftright(F.get("_h", i), _POSITION_BITS) != F.shiftright(F.get("_h", i - 1), _POSITION_BITS)))
    step = step.select(*kept, "_h", F.when(F.size("_h") > 0, first).otherwise(F.array().cast("array<int>")).alias("_f"))
    runs = F.zip_with("_f", F.concat(F.slice("_f", 2, F.greatest(F.size("_f"), F.lit(1))), F.array(F.size("_h"))),
                      lambda lo, hi: F.transform(F.sequence(lo, hi - 1), lambda i: F.when(
                          i == lo, F.get("_h", i)).otherwise(
                          F.xxhash64(F.shiftright(F.get("_h", i), _POSITION_BITS), i - lo)
                          .bitwiseAND(F.lit(~_POSITIONS)).bitwiseOR(F.get("_h", i).bitwiseAND(F.lit(_POSITIONS))))))
    numbered = F.when(F.size("_f") == F.size("_h"), F.col("_h")).otherwise(F.sort_array(F.flatten(runs)))
    step = step.select(*kept, numbered.alias("_h"))
    # the k-mers that are the first in their part of the circle
    heads = F.filter(F.sequence(F.lit(0), F.size("_h") - 1), lambda i: (i == 0) | (
        F.shiftright(F.get("_h", i), shift) != F.shiftright(F.get("_h", i - 1), shift)))
    step = step.select(*kept, "_h", F.when(F.size("_h") > 0, heads).otherwise(F.array().cast("array<int>")).alias("_f"))

    def sketch(i: Column) -> Column:
        """Hash of the tuple that starts at sorted place i, going on from the end to the start of the circle."""
        size = F.size("_h")
        taken = F.transform(F.sequence(F.lit(0), F.least(F.lit(order), size) - 1),
                            lambda j: F.get("_h", (i + j) % size))
        in_text_order = F.sort_array(F.transform(taken, lambda x: F.struct(
            x.bitwiseAND(F.lit(_POSITIONS)).alias("at"), F.shiftright(x, _POSITION_BITS).alias("kmer"))))
        return F.xxhash64(F.transform(in_text_order, lambda x: x["kmer"])).bitwiseAND(F.lit(0xFFFF)).cast("int")

    half = sketches // 2
    drawn = F.transform("_f", lambda i: F.struct(
        (F.shiftright(F.get("_h", i), shift) + half).cast("int").alias("part"), sketch(i).alias("sketch")))
    step = step.select(*kept, drawn.alias("_d"))
    # a part without k-mers has the sketch of the next part that has some
    spread = F.transform("_d", lambda d, i: F.array_repeat(
        d["sketch"], d["part"] - F.when(i == 0, F.lit(-1)).otherwise(F.get("_d", i - 1)["part"])))
    after = F.array_repeat(F.get("_d", F.lit(0))["sketch"],
                           F.lit(sketches - 1) - F.get("_d", F.size("_d") - 1)["part"])
    whole = F.concat(F.flatten(spread), after)
    return step.select(*kept, F.when(F.size("_d") > 0, whole).otherwise(F.array().cast("array<int>")).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches; two empty fingerprints are alike, an empty and another are not."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
            .otherwise(equal / F.size(a)))


def as_text(sketches: Column) -> Column:
    return F.array_join(F.transform(sketches, lambda x: F.lower(F.lpad(F.hex(x.cast("long")), 4, "0"))), "")


def with_next(rows: DataFrame, doc_id: str, *columns: str) -> DataFrame:
    """Add ``next_<column>``: each row's successor by ascending id, ties by the columns in turn; after the last the first.

    Ids are cut into ranges at approximate quantiles, which take one aggregation; the first row of the next range is
    copied into each range, so a range is a window of its own and no row's text moves more than once. There are as many
    ranges as the first column's characters fill (``RANGE_CHARS``), so a task's share does not grow with the table. Rows
    without id come first.
    """
    spark = rows.sparkSession
    chars = rows.agg(F.sum(F.length(columns[0]))).first()[0] or 0
    n_ranges = min(MOST_RANGES, max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // RANGE_CHARS)))
    keyed = rows.withColumn("_key", F.coalesce(F.col(doc_id), F.lit(-(1 << 63))))
    cuts = keyed.agg(F.percentile_approx("_key", [i / n_ranges for i in range(1, n_ranges)], 10 * n_ranges)).first()[0]
    keyed = keyed.withColumn("_range", _range_of(F.col("_key"), sorted(set(cuts or []))))
    heads = keyed.groupBy("_range").agg(F.min("_key").alias("head")).collect()  # one row per range
    order = sorted((h["_range"], h["head"]) for h in heads)
    # each head goes to the range before it, the first of all to the last range; two numbers per range, so broadcast
    into = F.array(*[F.struct(F.lit(head).alias("_key"), F.lit(order[i - 1][0]).alias("_range"))
                     for i, (_, head) in enumerate(order)]) if order else F.array().cast(
                         "array<struct<_key:bigint,_range:int>>")
    borders = spark.range(1).select(F.inline(into))
    copies = keyed.drop("_range").join(F.broadcast(borders), "_key").withColumn("_copy", F.lit(True))
    window = Window.partitionBy("_range").orderBy("_copy", "_key", *columns)
    both = keyed.withColumn("_copy", F.lit(False)).unionByName(copies)
    out = both.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns])
    return out.filter(~F.col("_copy")).drop("_range", "_key", "_copy")


def _range_of(value: Column, cuts: list[int]) -> Column:
    """Number of cuts below ``value``: first among every step-th cut, then inside that step."""
    step = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    if not groups:
        return F.lit(0)
    firsts = F.split(F.lit(",".join(str(g[0]) for g in groups)), ",").cast("array<bigint>")
    members = F.transform(F.split(F.lit(";".join(",".join(map(str, g)) for g in groups)), ";"),
                          lambda g: F.split(g, ",").cast("array<bigint>"))
    group = F.size(F.filter(firsts, lambda c: c < value))
    inside = F.size(F.filter(F.get(members, F.greatest(group - 1, F.lit(0))), lambda c: c < value))
    return F.greatest(group - 1, F.lit(0)) * step + inside


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text and sketches of every whole text, with the next document's."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return with_next(with_sketches(plain, "text", "sketches"), "doc_id", "text", "sketches")
