"""Structured Streaming jobs: the same transformations as in batch, on a stream."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adlake.operators.attribution import settled_touches, touch_stream
from adlake.operators.enrich import lookup_enrich
from adlake.operators.keyed import upsert_batch, upsert_jdbc, upsert_messages
from adlake.operators.metrics import window_metrics
from adlake.schemas import METRIC_KEYS
from adlake.sources import files
from adlake.sources.events import parse_events, split_dirty
from adlake.streaming.last_click import final_touches

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state off the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """For streams that are started inside, keep state off the heap; the session's own setting comes back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns the checkpoint: it stays over restarts and is new with a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def keyed_batch(df: DataFrame, path: str, batch_id: int, checkpoint: str, seq: str | None = None) -> None:
    """A micro-batch to a keyed log, numbered by its query."""
    upsert_batch(df, path, batch_id, query_id(df.sparkSession, checkpoint), seq)


def _start(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str, once: bool, every: str) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def ods_job(raw: DataFrame, ods_path: str, dirty_path: str, checkpoint: str, once: bool = False, every: str = "10 seconds", zone: str = "Asia/Shanghai") -> StreamingQuery:
    """Raw JSON to the event log, and dirty texts to quarantine, from one read of each micro-batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_events(batch, zone).persist()
        valid, dirty = split_dirty(parsed)
        keyed_batch(valid, ods_path, batch_id, checkpoint)
        keyed_batch(dirty, dirty_path, batch_id, checkpoint)
        parsed.unpersist()

    return _start(raw, sink, checkpoint, "append", once, every)


def enrich_job(ods: DataFrame, enrich: Callable[[DataFrame], DataFrame], dwd_path: str, checkpoint: str, once: bool = False, every: str = "10 seconds") -> StreamingQuery:
    """The event log to the enriched log; dimensions are read anew in each micro-batch by *enrich*."""
    return _start(ods, lambda batch, n: keyed_batch(enrich(batch), dwd_path, n, checkpoint), checkpoint, "append", once, every)


def metrics_job(
    events: DataFrame,
    path: str,
    checkpoint: str,
    advertiser: Callable[[], DataFrame] | None = None,
    keys: Sequence[str] = METRIC_KEYS,
    watermark: str = "5 seconds",
    size: str = "10 seconds",
    dedupe: bool = False,
    once: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Watermarked window metrics, emitted once when a window closes, named after aggregation, upserted by micro-batch."""
    metrics = window_metrics(events.withWatermark("event_ts", watermark), keys, size, dedupe)

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = lookup_enrich(batch, advertiser(), "advertiser_id", {"advertiser_name": "advertiser_name"}) if advertiser else batch
        keyed_batch(rows, path, batch_id, checkpoint)

    return _start(metrics, sink, checkpoint, "append", once, every)


def attribution_job(events: DataFrame, path: str, checkpoint: str, lookback: str = "30 days", watermark: str = "10 minutes", once: bool = False, every: str = "10 seconds") -> StreamingQuery:
    """Orders and their clicks to a log that `settled_attribution` reads; a replayed micro-batch overwrites itself."""
    return _start(touch_stream(events, lookback, watermark), lambda batch, n: keyed_batch(batch, path, n, checkpoint), checkpoint, "append", once, every)


def final_attribution_job(
    events: DataFrame,
    path: str,
    checkpoint: str,
    lookback: str = "30 days",
    watermark: str = "10 minutes",
    once: bool = False,
    every: str = "10 seconds",
    parts: int = 4096,
    names: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Each order once with its last click, when the watermark has passed it, to a keyed log; the state is a click a key and the watermark's delay, in *parts*.

    names: looks names up for the rows of a micro-batch, if the events have none.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        keyed_batch(names(batch) if names else batch, path, batch_id, checkpoint)

    with rocksdb(events.sparkSession):
        return _start(final_touches(events, lookback, watermark, parts), sink, checkpoint, "append", once, every)


def settled_attribution(spark: SparkSession, path: str) -> DataFrame:
    """Each order of the log with its last click so far."""
    return settled_touches(spark.read.parquet(path).drop("run", "batch", "_written", "_seq"))


def relay_job(rows: DataFrame, keys: Sequence[str], options: dict[str, str], checkpoint: str) -> StreamingQuery:
    """Keyed rows as JSON messages to Kafka."""
    return upsert_messages(rows, keys).writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).outputMode("append").start()


def jdbc_job(rows: DataFrame, url: str, table: str, stage: str, keys: Sequence[str], checkpoint: str, order: str | None = None, once: bool = False, every: str = "1 second", **options) -> StreamingQuery:
    """Rows of a stream to a JDBC table, one for each key; micro-batches are the buffer, *options* go to upsert_jdbc."""
    return _start(rows, lambda batch, n: upsert_jdbc(batch, url, table, stage, keys, order, **options), checkpoint, "append", once, every)


def cdc_job(changes: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False, every: str = "10 seconds") -> StreamingQuery:
    """Change rows to keyed tables; *apply* routes and upserts a micro-batch and must bear a replay."""
    return _start(changes, apply, checkpoint, "append", once, every)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, until files.clean_up(); only a local master, whose executors share the driver's disk, may name none."""
    base, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not base:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "adlake-streams")
    return files.made(spark, f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")


def run_to_table(stream: DataFrame, mode: str = "append", watch: Callable[[StreamingQuery], None] | None = None) -> DataFrame:
    """Run a stream over what is there now, and read what it wrote; in complete mode the last result."""
    spark = stream.sparkSession
    path, checkpoint = shared_folder(spark, "rows"), shared_folder(spark, "offsets")
    # each micro-batch in a folder of its own; a complete result replaces the former
    target = lambda n: f"{path}/batch={0 if mode == 'complete' else n}"
    job = _start(stream, lambda batch, n: batch.write.mode("overwrite").parquet(target(n)), checkpoint, mode, True, "")
    job.awaitTermination()
    if watch:
        watch(job)
    return spark.read.schema(stream.schema).parquet(path).select(*stream.columns)
