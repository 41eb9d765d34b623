"""Small helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlake.sources import files

#: Rows of an Arrow batch: with texts of some kilobytes a worker holds a few megabytes at once.
ARROW_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bits of a set of ids that is sent to all tasks (16 MB).
BITMAP_BITS = 1 << 27
#: Keys that one join may deal to several tasks, and the rows of a key up to which one task is enough.
HOT_KEYS, HOT_ROWS = 10_000, 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names.  Only a local master may go without one: its executors share the driver's disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), "adlake-checkpoints")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to Parquet in the shared folder and read it again: splittable, and safe against lost executors.

    drop_stored() deletes it when nothing reads it any more, files.clean_up() all that are left.
    """
    spark = df.sparkSession
    path = files.made(spark, f"{checkpoint_dir(spark)}/adlake-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_in = path
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Delete the files of frames that stored() returned."""
    for df in frames:
        files.forget(df.sparkSession, df.stored_in)


def unused(name: str, *frames: DataFrame) -> str:
    """*name*, with underscores behind it as far as a column of *frames* has it."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_batches(df: DataFrame, f: Callable, schema: StructType | str) -> DataFrame:
    """mapInArrow with batches of ARROW_ROWS rows, unless the session names another number."""
    small_batches(df.sparkSession)
    return df.mapInArrow(f, schema)


def small_batches(spark: SparkSession) -> None:
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(ARROW_ROWS))


def spread_join(rows: DataFrame, sides: DataFrame, key: str, n: str = "n", by: str = "id") -> DataFrame:
    """*rows* with the columns of *sides* (one row a key, *n* of them the key's rows), the rows of a hot key dealt to many tasks by a hash of *by*.

    Hot are keys with more than HOT_ROWS rows and more than 1/HOT_KEYS of all, so fewer than HOT_KEYS, which are broadcast.
    """
    limit = max(HOT_ROWS, (sides.agg(F.sum(n)).first()[0] or 0) // HOT_KEYS)
    parts = F.when(F.col(n) > limit, F.ceil(F.col(n) / F.lit(limit))).otherwise(1).cast("int")
    hot = sides.filter(F.col(n) > limit).select(F.col(key).alias("_hot"), parts.alias("_parts"))
    salt = F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")), F.lit(0)).cast("int")
    salted = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt).drop("_hot", "_parts")
    return salted.join(sides.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))), [key, "_salt"]).drop("_salt")


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast if *df* has at most *max_rows* rows (counted); else Spark shuffles the join. The result is the same."""
    return F.broadcast(df) if is_few(df, max_rows) else df


def id_bitmap(ids: DataFrame, column: str, bits: int = BITMAP_BITS) -> Callable[[Column], Column]:
    """A test that is true for every id of *ids*, and for few others as long as they are fewer than *bits*; its size is fixed.

    Put before a join that shuffles, it lets only rows move that may have a partner.
    """
    at = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits))
    words = ids.groupBy(F.shiftright(at, 15).alias("word")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(32767))).alias("held"))
    whole = np.zeros(bits // 8, np.uint8)
    for row in words.toLocalIterator():  # at most bits / 32768 rows of 4 KB
        whole[row["word"] * 4096 : (row["word"] + 1) * 4096] = np.frombuffer(row["held"], np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(whole)

    @F.pandas_udf("boolean")
    def held(place: pd.Series) -> pd.Series:
        x = place.to_numpy()
        return pd.Series((shared.value[x >> 3] >> (x & 7)) & 1 == 1)

    return lambda c: held(F.pmod(F.xxhash64(c.cast("long")), F.lit(bits)))


def semi_join(rows: DataFrame, ids: DataFrame, column: str, max_rows: int) -> DataFrame:
    """The *rows* whose *column* is in *ids*: by a broadcast up to *max_rows* ids, else only rows that a bitmap of the ids lets pass are shuffled."""
    if is_few(ids, max_rows):
        return rows.join(F.broadcast(ids), column, "left_semi")
    return rows.filter(id_bitmap(ids, column)(F.col(column))).join(ids, column, "left_semi")


def anti_join(rows: DataFrame, ids: DataFrame, column: str, max_rows: int) -> DataFrame:
    """The *rows* whose *column* is not in *ids*, in the same way; rows that no id can meet are not shuffled."""
    if is_few(ids, max_rows):
        return rows.join(F.broadcast(ids), column, "left_anti")
    may = F.coalesce(id_bitmap(ids, column)(F.col(column)), F.lit(False))
    return rows.filter(~may).union(rows.filter(may).join(ids, column, "left_anti").select(*rows.columns))


def is_few(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def crc_mod(doc_id, m: int):
    """crc32 of the id as decimal text, modulo m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(m)
