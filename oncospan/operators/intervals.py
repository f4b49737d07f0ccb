"""Runs of equal states, and events inside intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oncospan.staging import Stage

BUCKET_DAYS = 366
HEAVY_EVENTS = 20_000  # events of one key in one bucket beyond which the bucket is cut into tiles
TILE_DAYS = 8


def state_runs(states: DataFrame, key: list[str], date: str, state: str) -> DataFrame:
    """Merge consecutive rows of equal ``state`` per ``key`` into runs with ``start_date``, ``end_date``, ``is_last``
    and ``episode_number``.

    A run ends the day before the next row starts, also when that is the same day. A run that reaches the last date
    of its key is marked ``is_last`` and ends there. Rows are reduced to distinct (key, date, state) first, which
    bounds a key's window partition by the calendar times the states.
    """
    by_date = W.partitionBy(*key).orderBy(date, state)
    rows = (states.select(*key, date, state).distinct()
            .withColumn("_max", F.max(date).over(W.partitionBy(*key)))
            .withColumn("_starts", ~F.col(state).eqNullSafe(F.lag(state).over(by_date)))
            .withColumn("_ends", ~F.col(state).eqNullSafe(F.lead(state).over(by_date)))
            .withColumn("_next", F.date_sub(F.lead(date).over(by_date), 1)))
    rows = rows.withColumn("_end", F.when(F.col(date) == F.col("_max"), F.col(date)).otherwise(F.col("_next")))
    edges = rows.filter("_starts or _ends")
    # a run of several rows takes the end of its closing row, the next one left
    closing = F.when(F.col("_ends"), F.col("_end")).otherwise(F.lead("_end").over(by_date))
    runs = edges.withColumn("end_date", closing).filter("_starts")
    return runs.select(*key, state, F.col(date).alias("start_date"), "end_date",
                       (F.col("end_date") == F.col("_max")).alias("is_last"),
                       F.row_number().over(by_date).alias("episode_number"))


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / F.lit(BUCKET_DAYS)).cast("int")


def events_in_intervals(intervals: DataFrame, events: DataFrame, key: str, heavy: int = HEAVY_EVENTS,
                        stage: Stage | None = None) -> DataFrame:
    """Pairs of an interval and an event of the same ``key`` with ``start_date <= event_date <= end_date``.

    An interval is listed under each year-long bucket it touches and an event under its own, so the join key is
    (key, bucket): a key with very many events is spread over its buckets, and only pairs from one bucket are compared.
    Buckets with more than ``heavy`` events, known from a count per bucket, are cut into tiles of some days, and the
    events of such a bucket are dealt over parts of about ``heavy`` each, in every one of which its intervals are listed.
    With ``stage`` the list of heavy buckets is staged: it is short, and Spark then sees its size before it plans the
    joins with it, so the events are shuffled only by their tile.
    """
    spread = (intervals.filter("start_date is not null and end_date is not null and start_date <= end_date")
              .withColumn("_bucket", F.explode(F.sequence(_bucket(F.col("start_date")), _bucket(F.col("end_date"))))))
    dated = events.filter("event_date is not null").withColumn("_bucket", _bucket(F.col("event_date")))
    hot = dated.groupBy(key, "_bucket").agg(F.ceil(F.count("*") / heavy).cast("int").alias("_parts")).filter("_parts > 1")
    if stage:
        hot = stage.write(hot, "heavy_buckets")

    def tile(day: Column) -> Column:
        return F.floor((F.unix_date(day) - F.col("_bucket") * BUCKET_DAYS) / F.lit(TILE_DAYS)).cast("int")

    dated = dated.join(hot, [key, "_bucket"], "left")
    own = [c for c in dated.columns if c not in (key, "_bucket", "_parts")]
    dated = dated.select(key, "_bucket", *own, F.when(F.col("_parts") > 1, tile(F.col("event_date"))).otherwise(0)
                         .alias("_tile"), F.when(F.col("_parts") > 1, F.pmod(F.xxhash64(*own), F.col("_parts")))
                         .otherwise(0).cast("int").alias("_part"))
    # an interval's tiles within the bucket; the last tile of a bucket may be short
    first = F.greatest(tile(F.col("start_date")), F.lit(0))
    last = F.least(tile(F.col("end_date")), F.lit((BUCKET_DAYS - 1) // TILE_DAYS))
    none = F.array(F.lit(0))
    spread = (spread.join(hot, [key, "_bucket"], "left")
              .withColumn("_tile", F.explode(F.when(F.col("_parts") > 1, F.sequence(first, last)).otherwise(none)))
              .withColumn("_part", F.explode(F.when(F.col("_parts") > 1, F.sequence(F.lit(0), F.col("_parts") - 1))
                                             .otherwise(none))).drop("_parts"))
    return (spread.join(dated, [key, "_bucket", "_tile", "_part"])
            .filter((F.col("event_date") >= F.col("start_date")) & (F.col("event_date") <= F.col("end_date")))
            .drop("_bucket", "_tile", "_part"))
