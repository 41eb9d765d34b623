"""Distinct counts that can be merged: theta sketches kept by window and rolled up later.

A sketch holds the smallest hashes of the values seen.  Below 2^lg values it is exact; above, its relative error is about
1 / sqrt(2^lg) (1.6 % at 12).  Its size is bounded by 8 * 2^lg bytes, so sums of distinct users over windows, which count a
user many times, can be replaced by the union of the windows' sketches without reading events again.

Reach keeps such sketches: each batch of events adds a delta of window sketches (`deltas`), and any coarser keys,
span of time or trailing days are answered from them.  A late event goes to its window whenever it comes, without a
watermark or state; a replayed event changes nothing.  A value can't be taken out of a sketch: where rows are retracted,
`retract` counts them.  Rows without a time are in no window.

An estimate is no count: where SQL's COUNT(DISTINCT) is asked for, Reach keeps the different values of each window instead of
their sketch (*exact*), a row each, which are counted by shuffles however many there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adlake.operators import deltas

LG = 12


def sketch_by(df: DataFrame, keys: Sequence[str | Column], column: str, lg: int = LG, name: str = "sketch") -> DataFrame:
    """A sketch of *column* for each *keys*; nulls and empty texts do not count."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(column, lg).alias(name))


def roll_up(sketches: DataFrame, keys: Sequence[str | Column], lg: int = LG, name: str = "sketch") -> DataFrame:
    """The unions of sketches over coarser *keys*."""
    return sketches.groupBy(*keys).agg(F.theta_union_agg(name, lg).alias(name))


def distinct_count(name: str = "sketch") -> Column:
    return F.theta_sketch_estimate(name)


@dataclass(frozen=True)
class Reach:
    """What is kept: the different values of *column* by *keys* and windows of *size* of the column *time*; exact: themselves as the column value, not a sketch."""

    keys: Sequence[str]
    column: str
    time: str = "event_ts"
    size: str = "1 hour"
    lg: int = LG
    exact: bool = False


def log_reach(rows: DataFrame, path: str, reach: Reach, batch_id: int, run: str = "batch") -> None:
    """Add the window sketches, or values, of a batch; a replay of the batch overwrites itself."""
    by, start = [*reach.keys, F.window(reach.time, reach.size).alias("_w")], F.col("_w.start").alias("window_start")
    if reach.exact:
        by_window = rows.select(*by, F.col(reach.column).alias("value")).select(*reach.keys, start, "value").distinct()
    else:
        by_window = sketch_by(rows, by, reach.column, reach.lg).select(*reach.keys, start, "sketch")
    deltas.log(by_window, path, batch_id, run)


def fold_reach(spark: SparkSession, path: str, reach: Reach, keep: int = 2) -> int | None:
    """Merge finished batches into one sketch for each window, or a row for each of its values; the base's new version, or None if there was nothing to add."""
    return deltas.fold(spark, path, lambda rows: rows.distinct() if reach.exact else roll_up(rows, [*reach.keys, "window_start"], reach.lg), keep)


def reached(spark: SparkSession, path: str, reach: Reach, keys: Sequence[str | Column], since: str | None = None, until: str | None = None) -> DataFrame:
    """*keys* (of the kept keys and window_start) and their merged sketch, or a row for each of their values, of windows from *since* and before *until*; both must begin a window."""
    rows = deltas.read(spark, path)
    if since is not None:
        rows = rows.filter(F.col("window_start") >= F.lit(since).cast("timestamp"))
    if until is not None:
        rows = rows.filter(F.col("window_start") < F.lit(until).cast("timestamp"))
    return rows.select(*keys, "value").distinct() if reach.exact else roll_up(rows, keys, reach.lg)


def trailing(daily: DataFrame, keys: Sequence[str], day: str, days: int, lg: int = LG) -> DataFrame:
    """For each row of *daily* (keys, a date *day*, sketch) the sketch of the *days* days that end with it."""
    by = [day, *keys]
    dealt = daily.withColumn(day, F.explode(F.sequence(F.col(day), F.date_add(day, days - 1))))
    own = daily.select(*by, F.lit(True).alias("_own"))
    # one shuffle: whether the day has a row of its own travels with the sketches
    both = dealt.select(*by, "sketch", F.lit(None).cast("boolean").alias("_own")).unionByName(own.withColumn("sketch", F.lit(None).cast("binary")))
    return both.groupBy(*by).agg(F.theta_union_agg("sketch", lg).alias("sketch"), F.max("_own").alias("_own")).filter("_own").drop("_own")


def trailing_counts(daily: DataFrame, keys: Sequence[str], day: str, days: int, name: str) -> DataFrame:
    """For each keys and date *day* of *daily* (keys, day, value; different rows) how many values it has, and how many the *days* days have that end with it; nulls do not count.

    A value counts from its day on and is taken off when *days* days have passed without it, so no row is multiplied by *days*.
    """
    again = F.lead(day).over(Window.partitionBy(*keys, "value").orderBy(day))
    one = F.when(F.col("value").isNotNull(), 1).otherwise(0)
    steps = F.array(
        F.struct(F.col(day).alias("_day"), one.alias("_own"), one.alias("_step"), F.lit(True).alias("_there")),
        F.struct(F.least(F.date_add(day, days), "_again").alias("_day"), F.lit(0).alias("_own"), (-one).alias("_step"), F.lit(False).alias("_there")),
    )
    dealt = daily.withColumn("_again", again).select(*keys, F.explode(steps).alias("_s")).select(*keys, "_s.*")
    by_day = dealt.groupBy(*keys, "_day").agg(F.sum("_own").alias("_own"), F.sum("_step").alias("_step"), F.max("_there").alias("_there"))
    running = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    return by_day.withColumn(f"{name}_{days}d", F.sum("_step").over(running)).filter("_there").select(*keys, F.col("_day").alias(day), F.col("_own").alias(name), f"{name}_{days}d")


def reach_job(events: DataFrame, path: str, reach: Reach, checkpoint: str, once: bool = False, every: str = "10 seconds") -> StreamingQuery:
    """A stream of events into the window sketches, or values, of *path*."""
    from adlake.streaming.jobs import _start, query_id

    return _start(events, lambda batch, n: log_reach(batch, path, reach, n, query_id(batch.sparkSession, checkpoint)), checkpoint, "append", once, every)
