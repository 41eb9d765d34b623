"""The daily batch as frames in dependency order, built lazily and once for each run."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators import attribution, enrich, fraud, metrics, publishing, retention
from adlake.sources import driver


class Offline:
    """All layers over one set of tables; *as_of* ends the completed days."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str | None = None, fraud_features: dict | None = None, fraud_rules: dict | None = None, retained: str = "advertiser_id") -> None:
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self.fraud_options, self.fraud_rules, self.retained = fraud_features or {}, fraud_rules or {}, retained

    @cached_property
    def events(self) -> DataFrame:
        return driver.ad_events(self.spark, self.sf_dir)

    @cached_property
    def advertiser(self) -> DataFrame:
        return driver.dim_advertiser(self.spark, self.sf_dir)

    @cached_property
    def campaign(self) -> DataFrame:
        return driver.dim_campaign(self.spark, self.sf_dir)

    @cached_property
    def unit(self) -> DataFrame:
        return driver.dim_unit(self.spark, self.sf_dir)

    @cached_property
    def creative(self) -> DataFrame:
        return driver.dim_creative(self.spark, self.sf_dir)

    @cached_property
    def hierarchy(self) -> DataFrame:
        return enrich.ad_hierarchy(self.advertiser, self.campaign, self.unit, self.creative)

    @cached_property
    def dwd(self) -> DataFrame:
        return enrich.enrich_dwd(self.events, self.advertiser, self.campaign, self.creative)

    @cached_property
    def daily(self) -> DataFrame:
        return metrics.creative_daily(self.dwd)

    @cached_property
    def candidates(self) -> DataFrame:
        return attribution.attribution_candidates(self.dwd)

    @cached_property
    def points(self) -> DataFrame:
        return attribution.touchpoints(self.candidates)

    @cached_property
    def touches(self) -> DataFrame:
        """Last clicks, found on events without names; names are looked up for the orders only."""
        return attribution.name_touches(attribution.last_touch(self.events), self.advertiser, self.campaign)

    @cached_property
    def detail(self) -> DataFrame:
        return attribution.order_detail(self.touches)

    @cached_property
    def summary(self) -> DataFrame:
        return attribution.attribution_summary(self.detail)

    @cached_property
    def clicks(self) -> DataFrame:
        return enrich.lookup_enrich(fraud.click_features(self.events, **self.fraud_options), self.advertiser, "advertiser_id", {"advertiser_name": "advertiser_name"})

    @cached_property
    def fraud(self) -> DataFrame:
        return fraud.fraud_features(self.clicks, **self.fraud_rules)

    @cached_property
    def signals(self) -> DataFrame:
        return fraud.fraud_signals(fraud.label_clicks(self.clicks, **self.fraud_rules))

    @cached_property
    def fraud_daily(self) -> DataFrame:
        return fraud.fraud_daily(self.signals)

    @cached_property
    def retention(self) -> DataFrame:
        return retention.retention(self.events, self.retained)

    @cached_property
    def creative_offline(self) -> DataFrame:
        return metrics.creative_offline(self.daily, self.advertiser, self.campaign, self.unit, self.creative, self.as_of)

    @cached_property
    def dates(self) -> DataFrame:
        """The completed days, from one column of the events."""
        days = self.events.select(F.col("event_date").alias("stat_date"))
        return days if self.as_of is None else days.filter(F.col("stat_date") < self.as_of)

    @cached_property
    def metrics_10s(self) -> DataFrame:
        return metrics.window_metrics(self.events)

    @cached_property
    def metrics_named(self) -> DataFrame:
        return enrich.lookup_enrich(self.metrics_10s, self.advertiser, "advertiser_id", {"advertiser_name": "advertiser_name"})

    @cached_property
    def realtime(self) -> DataFrame:
        """The serving view of real-time metrics."""
        return metrics.metrics_change(self.metrics_named).withColumnRenamed("roi", "roas")

    def register_views(self) -> list[str]:
        """Temporary views of all layers, for SQL; their names."""
        names = ["advertiser", "campaign", "unit", "creative", "dwd", "daily", "detail", "summary", "fraud_daily", "retention", "creative_offline", "metrics_10s"]
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
        return names

    def dataset(self, name: str) -> DataFrame:
        """The rows of a dataset of the semantic layer."""
        return {
            "events_detail": lambda: self.dwd,
            "realtime": lambda: self.realtime,
            "retention": lambda: self.retention,
            "attribution": lambda: self.summary,
            "order_detail": lambda: self.detail,
            "creative": lambda: metrics.with_latest_flag(self.creative_offline, "stat_date", self.dates),
            "fraud": lambda: self.fraud_daily,
        }[name]()

    def publish(self, name: str, folder: str, zero_cols: tuple[str, ...] = (), force: bool = False, skip_if_present: str | None = None) -> bool:
        """Replace the published snapshot of one dataset only, in a folder of its name; False if nothing was done."""
        return publishing.publish_snapshot(self.dataset(name), f"{folder}/{name}", zero_cols, force, skip_if_present)
