"""Tables stored in buckets of their keys, so that joins and groupings by the keys need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write *df* as a table with one file for each bucket, sorted by the keys, and read it.

    Tables of one number of buckets - or one number a multiple of the other - meet on their keys bucket by bucket.
    Choose it so that a bucket is some hundred megabytes.  path: where an external table lies.
    """
    dealt = df.repartition(buckets, *keys)  # the same hash as the buckets': each task writes one file
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
