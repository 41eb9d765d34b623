"""Keyed tables on plain files: upsert, change feeds, change logs."""

from __future__ import annotations

import time
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.sources import files


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str) -> DataFrame:
    """The last row of each key; the plan keeps one row a key before the shuffle (window group limit)."""
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert_batch(df: DataFrame, path: str, batch_id: int, run: str = "batch", seq: str | None = None) -> None:
    """Append a batch to a keyed table's log; a replay of the batch overwrites itself, so it counts once.

    run: who numbers the batches - for a stream its query's id, so that one with a new checkpoint, which begins at 0 again,
    adds to the log.  seq: the column by which the last of a key's rows in one batch is known; else the order of the rows.
    A replayed batch keeps the time at which it was first written, so an old one does not come before later ones.
    """
    order = F.col(seq).cast("long") if seq else F.monotonically_increasing_id()
    written = F.timestamp_micros(F.lit(_first_written(df.sparkSession, f"{path}/_written/{run}-{batch_id}")))
    df.withColumns({"_written": written, "_seq": order}).write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")


def _first_written(spark: SparkSession, file: str) -> int:
    """The time in *file* in microseconds; now, if it has none yet.  The file is there before the batch's rows and outlives them."""
    files.put_new(spark, file, str(time.time_ns() // 1000))
    return int(files.read_small(spark, file))


def read_keyed(spark, path: str, keys: Sequence[str]) -> DataFrame:
    """The current rows of a keyed table: of each key the last row of the batch that was last written for the first time."""
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return latest_by_key(rows, keys, ["_written", "batch", "_seq"]).drop("run", "batch", "_written", "_seq")


def compact(spark, path: str, keys: Sequence[str], target: str, buckets: int | None = None) -> None:
    """Write the current rows to a new folder, dealt by key."""
    rows = read_keyed(spark, path, keys)
    (rows.repartition(buckets, *keys) if buckets else rows).write.mode("overwrite").parquet(target)


def tail_keyed(spark: SparkSession, path: str, since: Column, schema: str | None = None) -> DataFrame:
    """A keyed table's log as a stream of only what is written after *since* (an instant); the filter reaches the row groups.

    A restarted stream must name the same instant as before, or rows written meanwhile are lost.
    schema: the log's columns; else they are read from the files there now.
    """
    rows = spark.readStream.schema(schema or spark.read.option("mergeSchema", "true").parquet(path).schema).parquet(path)
    return rows.filter(F.col("_written") > since).drop("run", "batch", "_written", "_seq")


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """Write by date; only the dates in *df* are replaced.  Rows of a date gather by a shuffle that Spark may split."""
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def route_changes(changes: DataFrame, table: str) -> DataFrame:
    """The changes of one source table, without the routing column."""
    return changes.filter(F.col("table") == table).drop("table")


def local_times(changes: DataFrame, columns: Sequence[str], zone: str = "Asia/Shanghai") -> DataFrame:
    """The change feed's UTC times as wall-clock times of *zone*; nulls stay."""
    return changes.withColumns({c: F.from_utc_timestamp(F.col(c).cast("timestamp"), zone) for c in columns})


def cdc_apply(base: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str = "seq", op: str = "op") -> DataFrame:
    """*base* after the changes (op r, c, u or d): the last change of each key by *seq* wins; new columns are added, null in old rows."""
    rest = [c for c in changes.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_c")).select(*keys, "_c.*")
    kept = base.join(last.select(*keys), list(keys), "left_anti")
    fresh = last.filter(F.col(op) != "d").drop(op, seq)
    return kept.unionByName(fresh, allowMissingColumns=True)


def changelog_between(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows +I, -U, +U and -D that turn *old* into *new*; unchanged rows are silent."""
    values = [c for c in old.columns if c not in keys]
    pack = lambda df, n: df.select(*keys, F.struct(*values).alias(n))
    both = pack(old, "_old").join(pack(new, "_new"), list(keys), "full")
    o, n = F.col("_old"), F.col("_new")
    kinds = F.when(o.isNull(), F.array(F.lit("+I"))).when(n.isNull(), F.array(F.lit("-D"))).when(~o.eqNullSafe(n), F.array(F.lit("-U"), F.lit("+U"))).otherwise(F.array().cast("array<string>"))
    rows = both.withColumn("row_kind", F.explode(kinds))
    side = F.when(F.col("row_kind").isin("-U", "-D"), o).otherwise(n)
    return rows.select("row_kind", *keys, side.alias("_v")).select("row_kind", *keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def partial_update(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """One row for each key: of every column the last value that is not null."""
    rest = [c for c in df.columns if c not in keys and c != seq]
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in rest])


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], metrics: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Both sides' metrics by key, their difference, and whether all agree; a missing side counts as no match."""
    a = left.select(*keys, *[F.col(m).alias(f"{m}_left") for m in metrics], F.lit(True).alias("_l"))
    b = right.select(*keys, *[F.col(m).alias(f"{m}_right") for m in metrics], F.lit(True).alias("_r"))
    both = a.join(b, list(keys), "full")
    diffs = {f"{m}_diff": F.abs(F.coalesce(f"{m}_left", F.lit(0)).cast("double") - F.coalesce(f"{m}_right", F.lit(0)).cast("double")) for m in metrics}
    agree: Column = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    for d in diffs.values():
        agree = agree & (d <= tolerance)
    return both.withColumns({**diffs, "is_match": agree}).drop("_l", "_r")


def upsert_messages(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """key and value as JSON, for a keyed topic; times as SQL text with milliseconds."""
    options = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSS", "ignoreNullFields": "false"}
    return df.select(F.to_json(F.struct(*keys), options).alias("key"), F.to_json(F.struct(*df.columns), options).alias("value"))


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 100, properties: dict[str, str] | None = None) -> None:
    """Append a batch over JDBC in groups of rows."""
    df.write.option("batchsize", batch_size).mode("append").jdbc(url, table, properties=properties or {})


def _execute(spark: SparkSession, url: str, statements: Sequence[str], properties: dict[str, str]) -> None:
    """Statements in one transaction, sent by the driver: they move no rows through it."""
    jvm = spark._jvm
    if "driver" in properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        connection.commit()
    except Py4JJavaError:
        connection.rollback()
        raise
    finally:
        connection.close()


def upsert_jdbc(
    df: DataFrame, url: str, table: str, stage: str, keys: Sequence[str], order: str | None = None, batch_size: int = 100, tries: int = 3, wait: float = 1.0, properties: dict[str, str] | None = None
) -> None:
    """Write a batch over JDBC so that each key has one row, the batch's; a replay or a second try changes nothing.

    Executors fill *stage*, a table with the target's columns and types that belongs to this writer; then one transaction
    takes the stage's keys from the target and puts the stage's rows there.  order: the column by which the last of a key's
    rows is known (without it keys must be unique).  A failed try is repeated after *wait* seconds, twice as long each time.
    """
    spark, properties = df.sparkSession, properties or {}
    rows = latest_by_key(df, keys, order) if order else df
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    for n in range(tries):
        try:
            there = {c.lower(): quote(c) for c in spark.read.jdbc(url, table, properties=properties).columns}
            columns = ", ".join(there[c.lower()] for c in rows.columns)
            same = " AND ".join(f"{stage}.{there[k.lower()]} = {table}.{there[k.lower()]}" for k in keys)
            rows.write.option("batchsize", batch_size).option("truncate", True).mode("overwrite").jdbc(url, stage, properties=properties)
            # a task that Spark ran twice may have left its rows twice
            _execute(spark, url, [f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {stage} WHERE {same})", f"INSERT INTO {table} ({columns}) SELECT DISTINCT {columns} FROM {stage}"], properties)
            return
        except Py4JJavaError:
            if n == tries - 1:
                raise
            time.sleep(wait * 2**n)
