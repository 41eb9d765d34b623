"""Event sources, parsing, validation and checks of the source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.schemas import EVENT_JSON, EVENT_TYPES, REQUIRED

OFFSET = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"


def read_events_stream(spark: SparkSession, options: dict[str, str], fmt: str = "kafka", start: str = "earliest") -> DataFrame:
    """A stream with the column value (JSON text): Kafka from *start*, or files of lines (fmt="text", options["path"])."""
    reader = spark.readStream.format(fmt).options(**{k: v for k, v in options.items() if k != "path"})
    if fmt == "kafka":
        return reader.option("startingOffsets", start).load().select(F.col("value").cast("string").alias("value"))
    return reader.load(options["path"]).select("value")


def read_dimension_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """A whole dimension table over JDBC, to be joined by broadcast - never one query for each key."""
    return spark.read.jdbc(url, table, properties=properties or {})


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def parse_events(raw: DataFrame, zone: str = "Asia/Shanghai", topic: str = "ods_log") -> DataFrame:
    """value, the event's columns, event_ts (instant), event_date (business date in *zone*), source_topic and is_valid.

    Valid: a JSON object with all required fields not blank and a ts with an offset.  Missing or unreadable money is 0.
    """
    e = F.from_json("value", EVENT_JSON, {"mode": "PERMISSIVE"})
    # behind a generator the text is parsed once, however many columns are taken from it
    rows = raw.select("value", F.explode(F.array(e)).alias("e")).select("value", "e.*")
    ts = F.when(F.col("ts").rlike(OFFSET), F.try_to_timestamp("ts"))
    blank = reduce(Column.__or__, [_blank(F.col(c)) for c in REQUIRED])
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(EVENT_JSON[c].dataType)) for c in ("bid_price", "spend", "gmv")}
    rows = rows.withColumns({**zero, "event_ts": ts})
    # the session's zone is where times are shown; the business date needs its own
    local = F.from_utc_timestamp(F.to_utc_timestamp("event_ts", F.current_timezone()), zone)
    return rows.withColumns({"event_date": F.date_format(local, "yyyy-MM-dd"), "source_topic": F.lit(topic), "is_valid": ~blank & F.col("event_ts").isNotNull()}).drop("ts")


def split_dirty(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid events, dirty raw texts)."""
    return parsed.filter("is_valid").drop("value", "is_valid"), parsed.filter("NOT is_valid").select("value")


def contract_violations(raw: DataFrame) -> DataFrame:
    """value and violations: names of the contract's rules that the JSON text breaks; empty if none."""
    e = F.from_json("value", EVENT_JSON)
    names = [f.name for f in EVENT_JSON.fields]
    keys = F.json_object_keys("value")
    rows = raw.select("value", e.alias("e"), keys.alias("k"))

    def rule(broken: Column, name: str) -> Column:
        return F.when(F.coalesce(broken, F.lit(False)), F.lit(name))

    listed = F.array(*[F.lit(n) for n in names])
    checks = [
        rule(F.col("k").isNull(), "not_an_object"),
        rule(F.size(F.array_except(listed, F.col("k"))) > 0, "missing_field"),
        rule(F.size(F.array_except(F.col("k"), listed)) > 0, "extra_field"),
        rule(F.col("k").isNotNull() & ~F.coalesce(F.col("e.event_type").isin(*EVENT_TYPES), F.lit(False)), "event_type"),
        *[rule(F.col(f"e.{c}") < 0, f"negative_{c}") for c in ("bid_price", "spend", "gmv")],
        rule(F.col("e.schema_version") < 1, "schema_version"),
    ]
    return rows.select("value", F.array_compact(F.array(*checks)).alias("violations"))


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each frame."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in frames.items()])


def source_check(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("row_count"), F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"))


def freshness(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.max(ts).alias("latest"))


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows of one key; the filter reaches the Parquet scan."""
    return df.filter(F.col(key) == value)
