"""Explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY4, MONEY2, RATIO6 = T.DecimalType(18, 4), T.DecimalType(18, 2), T.DecimalType(18, 6)

#: The JSON contract of one ad event; all fields must be present, order_id may be null.
EVENT_JSON = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("advertiser_id", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("unit_id", T.StringType()),
        T.StructField("creative_id", T.StringType()),
        T.StructField("media", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("bid_price", MONEY4),
        T.StructField("spend", MONEY4),
        T.StructField("gmv", MONEY2),
        T.StructField("order_id", T.StringType()),
        T.StructField("schema_version", T.IntegerType()),
    ]
)

#: Fields without which an event is dirty.
REQUIRED = ("event_id", "ts", "advertiser_id", "campaign_id", "unit_id", "creative_id", "event_type")
EVENT_TYPES = ("impression", "click", "conversion", "order")
METRIC_KEYS = ("advertiser_id", "campaign_id", "unit_id", "creative_id")
