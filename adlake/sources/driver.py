"""The test tables read as advertising data: events, dimensions, raw JSON and change feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEDIA = ("douyin", "kuaishou", "bilibili", "xiaohongshu", "toutiao", "weibo")

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _advertiser(number: Column) -> Column:
    """One of nine advertisers, or one that no dimension lists, so that defaults are exercised."""
    return F.when(number % 10 == 9, "adv_unlisted").otherwise(_id("adv_", number % 10))


def as_ad_events(events: DataFrame) -> DataFrame:
    """The ad-event columns of a batch or stream of `events` rows; times are instants in the session's zone."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    media = F.element_at(F.array(*[F.lit(m) for m in MEDIA]), (k % len(MEDIA)) + 1)
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("ts").cast("date").cast("string").alias("event_date"),
        _advertiser(k).alias("advertiser_id"),
        _id("cmp_", k % 20).alias("campaign_id"),
        _id("unit_", k % 40).alias("unit_id"),
        _id("crt_", k).alias("creative_id"),
        media.alias("media"),
        _id("user_", F.col("user_id")).alias("user_id"),
        F.when(kind == "view", "impression").when(kind == "signup", "conversion").when(kind == "purchase", "order").otherwise(kind).alias("event_type"),
        F.when(kind == "click", F.col("value")).otherwise(0.0).cast("decimal(18,4)").alias("spend"),
        F.when(kind == "purchase", F.col("value")).otherwise(0.0).cast("decimal(18,2)").alias("gmv"),
        F.when(kind == "purchase", _id("ord_", F.col("event_id"))).alias("order_id"),
    )


def ad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ad_events(read_table(spark, sf_dir, "events"))


def ad_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a file stream."""
    return as_ad_events(spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def _pick(number: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number % len(names) + 1).cast("int"))


def dim_advertiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers as advertisers."""
    key = F.col("s_suppkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("home_region"))
    supplier = read_table(spark, sf_dir, "supplier")
    return supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select(
        _id("adv_", key).alias("advertiser_id"), F.col("s_name").alias("advertiser_name"), _pick(key, ["game", "retail", "travel"]).alias("industry"), _pick(key, ["S", "A", "B", "C"]).alias("tier"), "home_region"
    )


def dim_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        _id("cmp_", key).alias("campaign_id"), _advertiser(key).alias("advertiser_id"), F.col("c_name").alias("campaign_name"),
        _pick(key, ["ROI", "GMV", "CTR", "Retention"]).alias("objective"), F.col("c_acctbal").cast("decimal(18,2)").alias("budget"), _pick(key, ["active", "paused"]).alias("status"),
    )


def dim_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return read_table(spark, sf_dir, "part").select(
        _id("unit_", key).alias("unit_id"), _id("cmp_", key % 20).alias("campaign_id"), F.col("p_name").alias("unit_name"),
        _pick(key, ["CPC", "OCPC", "CPM"]).alias("bid_type"), F.col("p_retailprice").cast("decimal(18,4)").alias("bid_amount"),
    )


def dim_creative(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return read_table(spark, sf_dir, "part").select(
        _id("crt_", key).alias("creative_id"), _id("unit_", key % 40).alias("unit_id"), _id("cmp_", key % 20).alias("campaign_id"), F.col("p_name").alias("creative_name"), F.col("p_type").alias("format")
    )


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text for each event; by event number modulo 50 some are broken in a known way."""
    e = ad_events(spark, sf_dir)
    case = F.col("event_id").cast("long") % 50
    ts = F.concat(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.when(case == 3, "").otherwise("Z"))
    fields = [
        "event_id", ts.alias("ts"), "advertiser_id", "campaign_id", "unit_id", F.when(case == 1, " ").otherwise(F.col("creative_id")).alias("creative_id"), "media",
        F.lit("CN").alias("region"), "user_id", "event_type", F.lit(1).alias("bid_price"), F.when(case == 4, -1).otherwise(F.col("spend")).cast("decimal(18,4)").alias("spend"), "gmv", "order_id",
        F.when(case == 6, 0).otherwise(1).alias("schema_version"), F.when(case == 5, "x").alias("extra"),
    ]
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "true"})
    # the contract wants order_id present, null where there is no order
    text = F.when(F.col("order_id").isNull(), F.regexp_replace(text, r"\}$", ',"order_id":null}')).otherwise(text)
    return e.select(F.when(case == 2, F.lit("not json")).otherwise(text).alias("value"))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed (key, op, seq, columns) from `orders`: a snapshot, an update of every third, a delete of every tenth row."""
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(18,2)").alias("gmv"))
    n = F.col("order_id")
    first = o.select("*", F.lit("r").alias("op"), n.alias("seq"))
    second = o.filter(n % 3 == 0).select("order_id", F.lit("PAID").alias("status"), (F.col("gmv") + 1).cast("decimal(18,2)").alias("gmv"), F.lit("u").alias("op"), (n + 1_000_000_000).alias("seq"))
    third = o.filter(n % 10 == 0).select("*", F.lit("d").alias("op"), (n + 2_000_000_000).alias("seq"))
    return first.unionByName(second).unionByName(third)


def order_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial rows of an order's life: created, paid (odd keys), refunded (every ninth) and finished (every fourth), each with only its own time."""
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("day"))
    n = F.col("order_id")
    steps = {"create_time": (0, "created", F.lit(True)), "payment_time": (1, "paid", n % 2 == 1), "refund_time": (3, "refunded", n % 9 == 0), "finish_time": (5, "finished", n % 4 == 0)}
    parts = []
    for seq, (own, (days, status, when)) in enumerate(steps.items(), 1):
        times = [(F.date_add("day", days) if c == own else F.lit(None).cast("date")).alias(c) for c in steps]
        parts.append(o.filter(when).select("order_id", *times, F.lit(status).alias("order_status"), F.lit(seq).alias("seq")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
