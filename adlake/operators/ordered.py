"""Exports in a global order over many files, and reading them by position.

Rows are dealt by ranges of the sort key and sorted inside each range, so no task sees more than its range; files are
numbered in the order of their ranges.  A manifest tells how many rows precede each file, which gives every row its
position without a sort of all rows in one task, and a slice of the order without reading the other files.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.sources import files

_MANIFEST = "_order.json"
_PART = re.compile(r"part-(\d+)-.*?(?:-c(\d+))?(?:\.[a-z0-9.]+)?$")


def _keys(by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in by]


def in_order(df: DataFrame, by: Sequence[str | Column], ties: Sequence[str | Column] = (), parts: int | None = None) -> DataFrame:
    """*df* in partitions that follow each other in the order of *by*, then of *ties*.

    ties: columns that tell rows of the same *by* apart; they also split a value of *by* that many rows share, so that it
    fills as many partitions as it needs.  Bounds are found from a sample of *df*, which is therefore computed twice.
    """
    keys = [*_keys(by), *_keys(ties)]
    return (df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)


def export_ordered(df: DataFrame, path: str, by: Sequence[str | Column], ties: Sequence[str | Column] = (), parts: int | None = None, fmt: str = "parquet", rows_per_file: int = 0, **options) -> int:
    """Write *df* in order to files whose names follow the order; the number of files.

    fmt: any of Spark's formats; Parquet exports also get a manifest, for `read_ordered` and `read_slice`.
    """
    spark = df.sparkSession
    in_order(df, by, ties, parts).write.mode("overwrite").options(**options).option("maxRecordsPerFile", rows_per_file).format(fmt).save(path)
    names = sorted((n for n in files.names(spark, path) if _PART.match(n)), key=_number)
    if fmt == "parquet":
        counts = {r[0]: r[1] for r in spark.read.schema(df.schema).parquet(path).groupBy("_metadata.file_name").count().collect()}  # a row a file
        listed, start = [], 0
        for name in names:
            listed.append([name, start])
            start += counts.get(name, 0)
        files.put_new(spark, f"{path}/{_MANIFEST}", json.dumps({"rows": start, "files": listed, "schema": df.schema.jsonValue()}))
    return len(names)


def _number(name: str) -> tuple[int, int]:
    m = _PART.match(name)
    return int(m[1]), int(m[2] or 0)


def _manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(files.read_small(spark, f"{path}/{_MANIFEST}"))


def _positioned(spark: SparkSession, path: str, manifest: dict, listed: list) -> DataFrame:
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(manifest["schema"])
    starts = spark.createDataFrame(listed, "_file string, _start long")
    rows = spark.read.schema(schema).parquet(*[f"{path}/{name}" for name, _ in listed]) if listed else spark.createDataFrame([], schema).withColumn("_metadata", F.lit(None).cast("struct<file_name:string,row_index:long>"))
    at = rows.select("*", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_row"))
    return at.join(F.broadcast(starts), F.col("_name") == F.col("_file")).select((F.col("_start") + F.col("_row") + 1).alias("position"), *schema.names)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a Parquet export with their position in the order, from 1; no shuffle."""
    manifest = _manifest(spark, path)
    return _positioned(spark, path, manifest, manifest["files"])


def read_slice(spark: SparkSession, path: str, first: int, n: int) -> DataFrame:
    """*n* rows from position *first* on, from the files that hold them."""
    manifest = _manifest(spark, path)
    ends = [start for _, start in manifest["files"][1:]] + [manifest["rows"]]
    held = [f for f, end in zip(manifest["files"], ends) if end >= first and f[1] < first + n - 1 + 1 and end > f[1]]
    return _positioned(spark, path, manifest, held).filter(F.col("position").between(first, first + n - 1))
