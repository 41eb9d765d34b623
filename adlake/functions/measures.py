"""Column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column, scale: int = 6) -> Column:
    """num / den rounded half up at *scale*; null where den is zero or null."""
    den = den.cast("double")
    return F.round(num.cast("double") / F.when(den != 0, den), scale).cast(f"decimal(18,{scale})")


def count_of(event_type: str, column: str = "event_type") -> Column:
    """Number of rows of one event type."""
    return F.count(F.when(F.col(column) == event_type, True))


def money(column: str, scale: int) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast(f"decimal(18,{scale})")


def plain_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparing with engines that scale decimals otherwise."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])
