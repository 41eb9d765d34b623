"""Windowed metrics, daily facts and their changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.measures import count_of, money, safe_ratio
from adlake.operators.enrich import small
from adlake.schemas import METRIC_KEYS


def window_metrics(events: DataFrame, keys: Sequence[str] = METRIC_KEYS, size: str = "10 seconds", dedupe: bool = False) -> DataFrame:
    """Spend, gmv, four counts and ratios by tumbling window and keys; the same plan for batch and stream.

    Event types outside the four add money but no count.  dedupe: each event_id once.
    """
    if dedupe:
        events = events.dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])
    sums = events.groupBy(F.window("event_ts", size).alias("w"), *keys).agg(
        money("spend", 4).alias("spend"), money("gmv", 2).alias("gmv"),
        count_of("impression").alias("impressions"), count_of("click").alias("clicks"), count_of("conversion").alias("conversions"), count_of("order").alias("orders"),
    )
    return sums.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "spend", "gmv", "impressions", "clicks", "conversions", "orders",
        safe_ratio(F.col("clicks"), F.col("impressions")).alias("ctr"), safe_ratio(F.col("conversions"), F.col("clicks")).alias("cvr"), safe_ratio(F.col("gmv"), F.col("spend")).alias("roi"),
    )


def metrics_change(metrics: DataFrame, keys: Sequence[str] = METRIC_KEYS, order: str = "window_start", cols: Sequence[str] = ("spend", "gmv")) -> DataFrame:
    """previous_, _change and _change_rate of each column against the keys' previous window; the rate is null after 0."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = metrics.withColumns({f"previous_{c}": F.lag(c).over(w) for c in cols})
    out = out.withColumns({f"{c}_change": F.col(c) - F.col(f"previous_{c}") for c in cols})
    return out.withColumns({f"{c}_change_rate": safe_ratio(F.col(f"{c}_change"), F.col(f"previous_{c}")) for c in cols})


def creative_daily(dwd: DataFrame) -> DataFrame:
    """Facts of each creative and day.

    Names are grouping keys at first, so that the scan feeds a hash aggregate; their maximum, which Spark can only take by
    sorting, is left for the few rows of the second step.
    """
    c = F.col
    fine = dwd.groupBy(c("event_date").alias("stat_date"), "creative_id", "campaign_id", "creative_name").agg(
        count_of("impression").alias("imp"), count_of("click").alias("click"), count_of("conversion").alias("conv"), count_of("order").alias("ord"), F.sum("spend").alias("_spend"), F.sum("gmv").alias("_gmv")
    )
    sums = fine.groupBy("stat_date", "creative_id").agg(
        F.max("campaign_id").alias("campaign_id"), F.max("creative_name").alias("creative_name"),
        F.sum("imp").alias("imp_cnt_1d"), F.sum("click").alias("click_cnt_1d"), F.sum("conv").alias("conv_cnt_1d"), F.sum("ord").alias("order_cnt_1d"),
        money("_spend", 2).alias("cost_1d"), money("_gmv", 2).alias("gmv_1d"),
        F.sum("_spend").alias("_spend"), F.sum("_gmv").alias("_gmv"),
    )
    return sums.withColumns(
        {"ctr_1d": safe_ratio(c("click_cnt_1d"), c("imp_cnt_1d")), "cvr_1d": safe_ratio(c("conv_cnt_1d"), c("click_cnt_1d")), "roi_1d": safe_ratio(c("_gmv"), c("_spend"), 4)}
    ).drop("_spend", "_gmv")


def creative_rolling(daily: DataFrame, days: int = 7) -> DataFrame:
    """Adds cost and gmv of the trailing *days* days and since the beginning; days without rows count as days."""
    base = Window.partitionBy("creative_id").orderBy(F.datediff(F.to_date("stat_date"), F.lit("1970-01-01").cast("date")))
    trailing, whole = base.rangeBetween(-(days - 1), 0), base.rangeBetween(Window.unboundedPreceding, 0)
    return daily.withColumns(
        {f"{c}_{days}d": F.sum(f"{c}_1d").over(trailing).cast("decimal(18,2)") for c in ("cost", "gmv")} | {f"{c}_total": F.sum(f"{c}_1d").over(whole).cast("decimal(18,2)") for c in ("cost", "gmv")}
    )


def creative_offline(daily: DataFrame, advertiser: DataFrame, campaign: DataFrame, unit: DataFrame, creative: DataFrame, as_of: str | None = None) -> DataFrame:
    """Daily facts with all dimensions, for days before *as_of*; ratios are taken after rounding cost to cents."""
    text = lambda c: F.coalesce(F.col(c), F.lit("UNKNOWN")).alias(c)
    cr = creative.select("creative_id", F.col("creative_name").alias("_creative"), "format", "unit_id")
    facts = daily if as_of is None else daily.filter(F.col("stat_date") < as_of)
    rows = (
        facts.join(small(cr, of=creative), "creative_id", "left")
        .join(small(campaign.select("campaign_id", "campaign_name", "objective", "budget", "status", "advertiser_id"), of=campaign), "campaign_id", "left")
        .join(small(advertiser.select("advertiser_id", "advertiser_name", "industry", F.col("tier").alias("advertiser_tier")), of=advertiser), "advertiser_id", "left")
        .join(small(unit.select("unit_id", "unit_name", "bid_type", "bid_amount"), of=unit), "unit_id", "left")
    )
    objective = F.when(F.col("objective") == "ROI", "ROAS").otherwise(F.col("objective"))
    return rows.select(
        "stat_date", "creative_id", F.coalesce("_creative", "creative_name", F.lit("UNKNOWN")).alias("creative_name"), F.coalesce("format", F.lit("unknown")).alias("creative_format"),
        "campaign_id", text("campaign_name"), F.coalesce(objective, F.lit("UNKNOWN")).alias("campaign_objective"), F.col("budget").alias("campaign_budget"), F.coalesce("status", F.lit("UNKNOWN")).alias("campaign_status"),
        "advertiser_id", text("advertiser_name"), text("industry"), text("advertiser_tier"), "unit_id", text("unit_name"), text("bid_type"), "bid_amount",
        F.col("imp_cnt_1d").alias("impressions"), F.col("click_cnt_1d").alias("clicks"), F.col("conv_cnt_1d").alias("conversions"), F.col("order_cnt_1d").alias("orders"), F.col("cost_1d").alias("cost"), F.col("gmv_1d").alias("gmv"),
        *_ratios("click_cnt_1d", "imp_cnt_1d", "conv_cnt_1d", "cost_1d", "gmv_1d"),
    )


def _ratios(clicks: str, impressions: str, conversions: str, cost: str, gmv: str):
    c = F.col
    return (
        safe_ratio(c(clicks), c(impressions)).alias("ctr"),
        safe_ratio(c(conversions), c(clicks)).alias("cvr"),
        safe_ratio(c(cost), c(clicks), 4).alias("cpc"),
        safe_ratio(c(cost), c(conversions), 4).alias("cpa"),
        safe_ratio(c(gmv), c(cost)).alias("roas"),
    )


def creative_backfill(metrics_10s: DataFrame, hierarchy: DataFrame, as_of: str | None = None) -> DataFrame:
    """Daily creative rows rebuilt from window metrics, for days before *as_of*; ids stand in for missing names; cost keeps 4 digits."""
    rows = metrics_10s.withColumn("stat_date", F.date_format("window_start", "yyyy-MM-dd"))
    if as_of is not None:
        rows = rows.filter(F.col("stat_date") < as_of)
    facts = rows.groupBy("stat_date", "creative_id").agg(
        F.max("advertiser_id").alias("advertiser_id"), F.max("campaign_id").alias("campaign_id"), F.max("unit_id").alias("unit_id"),
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "conversions", "orders")],
        F.sum("spend").cast("decimal(18,4)").alias("cost"), F.sum("gmv").cast("decimal(18,4)").alias("gmv"),
    )
    names = hierarchy.select("creative_id", F.col("creative_name").alias("_cr"), F.col("campaign_name").alias("_cmp"), F.col("advertiser_name").alias("_adv"), F.col("unit_name").alias("_unit"))
    return facts.join(small(names, of=hierarchy), "creative_id", "left").select(
        "stat_date", "creative_id", F.coalesce("_cr", "creative_id").alias("creative_name"), "campaign_id", F.coalesce("_cmp", "campaign_id").alias("campaign_name"),
        "advertiser_id", F.coalesce("_adv", "advertiser_id").alias("advertiser_name"), "unit_id", F.coalesce("_unit", "unit_id").alias("unit_name"),
        "impressions", "clicks", "conversions", "orders", "cost", "gmv", *_ratios("clicks", "impressions", "conversions", "cost", "gmv"),
    )


def with_latest_flag(df: DataFrame, date_col: str, dates: DataFrame | None = None) -> DataFrame:
    """Adds is_latest_partition: the row's date is the largest of all (one scalar, no unpartitioned window).

    dates: a narrower frame with the same dates in *date_col*, so that the joins of *df* are not done twice.
    """
    latest = (df if dates is None else dates).agg(F.max(date_col).alias("_latest"))
    return df.join(F.broadcast(latest), F.lit(True)).withColumn("is_latest_partition", F.col(date_col) == F.col("_latest")).drop("_latest")
