"""Active-day retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.measures import safe_ratio


def retention(events: DataFrame, entity: str = "advertiser_id", days: Sequence[int] = (1, 7, 15, 30)) -> DataFrame:
    """For each day: entities with spend that day, and how many of them have spend again n days later.

    The days of an entity are gathered once (at most one element a day), so there is no self-join and no distinct count:
    two shuffles, each after partial aggregation.
    """
    day = F.datediff(F.to_date("event_date"), F.lit("1970-01-01").cast("date"))
    active = events.filter((F.col("spend") > 0) & F.col(entity).isNotNull()).groupBy(entity).agg(F.collect_set(day).alias("days"))
    rows = active.select("days", F.explode("days").alias("day"))
    sums = rows.groupBy("day").agg(F.count("*").alias("cohort_size"), *[F.count(F.when(F.array_contains("days", F.col("day") + n), 1)).alias(f"retained_{n}d") for n in days])
    return sums.select(
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).cast("string").alias("cohort_date"), "cohort_size",
        *[f"retained_{n}d" for n in days], *[safe_ratio(F.col(f"retained_{n}d"), F.col("cohort_size")).alias(f"rate_{n}d") for n in days],
    )
