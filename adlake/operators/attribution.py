"""Last-click attribution."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from adlake.operators.enrich import lookup_enrich, small
from adlake.operators.keyed import latest_by_key

#: Upper limits in minutes, type, period label and sort number; labels are part of the result.
DIRECT = (30, "direct", "30分钟直接归因", 1)
INDIRECT = ((1440, "1日间接归因", 2), (4320, "3日间接归因", 3), (10080, "7日间接归因", 4))
LAST_INDIRECT = ("30日间接归因", 5)
NATURAL = ("natural", "自然订单", 6)
ORGANIC_CAMPAIGN, ORGANIC_NAME = "__organic__", "自然订单"
MODEL = "last_click_30d"

_ORDER = {"event_date": "stat_date", "event_id": "outcome_event_id", "order_id": "order_id", "event_ts": "outcome_time", "user_id": "user_id", "advertiser_id": "order_advertiser_id", "advertiser_name": "order_advertiser_name", "campaign_id": "order_campaign_id", "campaign_name": "order_campaign_name", "gmv": "order_gmv"}
_TOUCH = {"event_id": "touch_event_id", "event_ts": "touch_time", "creative_id": "creative_id", "campaign_id": "campaign_id", "campaign_name": "campaign_name", "advertiser_id": "advertiser_id", "advertiser_name": "advertiser_name", "spend": "touch_spend"}


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes, truncated."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / 60_000_000).cast("long")


def _finish(rows: DataFrame) -> DataFrame:
    touch = F.coalesce(F.col("touch_event_id"), F.lit("organic"))
    return rows.withColumns(
        {"candidate_id": F.concat_ws("_", "outcome_event_id", touch), "lag_minutes": F.when(F.col("touch_event_id").isNotNull(), minutes_between(F.col("touch_time"), F.col("outcome_time")))}
    )


def _there(names: dict[str, str], events: DataFrame) -> dict[str, str]:
    """The columns that *events* have: names may be looked up later, for the few rows of the result (`name_touches`)."""
    return {c: n for c, n in names.items() if c in events.columns}


def name_touches(touches: DataFrame, advertiser: DataFrame, campaign: DataFrame) -> DataFrame:
    """Adds the names of advertiser and campaign of order and touch to rows made from events without names."""
    touched = F.col("touch_event_id").isNotNull()
    out = lookup_enrich(touches, advertiser, "order_advertiser_id", {"advertiser_name": "order_advertiser_name"}, dim_key="advertiser_id")
    out = out.withColumn("advertiser_name", F.when(touched, F.col("order_advertiser_name")))  # both are of one advertiser
    out = lookup_enrich(out, campaign, "order_campaign_id", {"campaign_name": "order_campaign_name"}, dim_key="campaign_id")
    return lookup_enrich(out, campaign, "campaign_id", {"campaign_name": "campaign_name"}).withColumn("campaign_name", F.when(touched, F.col("campaign_name")))


def _sides(events: DataFrame, lookback: str) -> tuple[DataFrame, DataFrame, Column]:
    """Orders, clicks, and when a click may have led to an order."""
    orders = events.filter("event_type = 'order'").select([F.col(c).alias(n) for c, n in _there(_ORDER, events).items()])
    clicks = events.filter("event_type = 'click'").select([F.col(c).alias(n) for c, n in _there(_TOUCH, events).items()] + [F.col("user_id").alias("_user")])
    near = (
        (F.col("user_id") == F.col("_user"))
        & (F.col("order_advertiser_id") == F.col("advertiser_id"))
        & (F.col("touch_time") <= F.col("outcome_time"))
        & (F.col("touch_time") >= F.col("outcome_time") - F.expr(f"INTERVAL {lookback}"))
    )
    return orders, clicks, near


def attribution_candidates(events: DataFrame, lookback: str = "30 days", strategy: str = "join", hot_orders: int = 10_000) -> DataFrame:
    """Each order with every click of its user and advertiser in the look-back, the latest first (ties: larger event_id); an order without one has a row of its own.

    join: an equi-join with a range residual; Spark splits skewed users.  banded: for tables in which one user has a large share
    of the rows.  Time is cut into bands as wide as the look-back, an order lies in one band and a click in two, so an order
    meets only clicks of two bands; and in bands of a key with more than *hot_orders* orders these are dealt to as many parts
    as that takes, with the band's clicks in each.  No task then has more than about *hot_orders* orders of a key.
    """
    orders, clicks, near = _sides(events, lookback)
    if strategy == "banded":
        orders, clicks, same = _banded(orders, clicks, lookback, hot_orders)
        pairs = orders.join(clicks, same & near, "left").drop("_user", "_band", "_part", "_click_band", "_click_part")
    else:
        pairs = orders.join(clicks, near, "left").drop("_user")
    w = Window.partitionBy("outcome_event_id").orderBy(F.desc("touch_time"), F.desc("touch_event_id"))
    return _finish(pairs.withColumn("touchpoint_seq", F.row_number().over(w)))


def _banded(orders: DataFrame, clicks: DataFrame, lookback: str, hot_orders: int) -> tuple[DataFrame, DataFrame, Column]:
    """Orders with band and part, clicks in every band and part that may ask for them, and when both are the same."""
    orders = orders.withColumn("_band", time_slice(F.unix_micros("outcome_time"), lookback))
    clicks = clicks.withColumn("_at", time_slice(F.unix_micros("touch_time"), lookback)).withColumn("_click_band", F.explode(F.array("_at", F.col("_at") + 1))).drop("_at")
    parts = F.ceil(F.col("_n") / F.lit(hot_orders)).cast("int").alias("_parts")
    counted = orders.groupBy("user_id", "order_advertiser_id", "_band").agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_orders)
    # one row for more than hot_orders orders; still counted before it is broadcast
    hot = small(counted.select(F.col("user_id").alias("_hot_user"), F.col("order_advertiser_id").alias("_hot_advertiser"), F.col("_band").alias("_hot_band"), parts))
    is_hot = lambda user, advertiser, band: (F.col(user) == F.col("_hot_user")) & (F.col(advertiser) == F.col("_hot_advertiser")) & (F.col(band) == F.col("_hot_band"))
    part = F.coalesce(F.pmod(F.xxhash64("outcome_event_id"), F.col("_parts")), F.lit(0)).cast("int")
    done = ("_hot_user", "_hot_advertiser", "_hot_band", "_parts")
    orders = orders.join(hot, is_hot("user_id", "order_advertiser_id", "_band"), "left").withColumn("_part", part).drop(*done)
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    clicks = clicks.join(hot, is_hot("_user", "advertiser_id", "_click_band"), "left").withColumn("_click_part", every).drop(*done)
    return orders, clicks, (F.col("_band") == F.col("_click_band")) & (F.col("_part") == F.col("_click_part"))


def last_touch(events: DataFrame, lookback: str = "30 days", strategy: str = "auto", slice_width: str = "1 hour", hot_rows: int = 100_000) -> DataFrame:
    """Each order with its last click only: an as-of join.

    window: one pass over all rows of a user and advertiser - one shuffle and no join.  sliced: the last click before each order
    within a slice of time, and for orders before the first click of their slice the last click of the earlier slices, carried
    over from one row for each slice; so no task holds more of a user than one slice.  auto: keys with more than
    *hot_rows* rows (counted in a pass over the keys alone) are sliced, all others take one pass.  join: candidates and row
    number.  All give the same rows; a click older than the look-back is dropped at the end.
    """
    if strategy == "join":
        return attribution_candidates(events, lookback).filter("touchpoint_seq = 1").drop("touchpoint_seq")
    keys = ["user_id", "advertiser_id"]
    # null keys match nothing
    rows = events.filter("event_type IN ('order', 'click')").filter("event_type = 'order' OR (user_id IS NOT NULL AND advertiser_id IS NOT NULL)")
    if strategy == "auto":
        return by_heat(rows, keys, hot_rows, lambda part, how: last_touch(part, lookback, how, slice_width))
    touch = _there(_TOUCH, events)
    click = F.when(F.col("event_type") == "click", F.struct(F.col("event_ts").alias("t"), F.col("event_id").alias("i"), F.struct(*[F.col(c).alias(n) for c, n in touch.items()]).alias("touch")))
    # clicks of an instant come before its orders
    order = ["event_ts", F.when(F.col("event_type") == "click", 0).otherwise(1), "event_id"]
    if strategy == "sliced":
        rows = rows.withColumn("_slice", time_slice(F.unix_micros("event_ts"), slice_width))
        ends = rows.groupBy(*keys, "_slice").agg(F.max(click).alias("_end"), F.max(F.col("event_type") == "order").alias("_asked"))
        earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).filter("_asked AND _carried IS NOT NULL").drop("_end", "_asked")
        orders = rows.withColumn("_last", F.last(click, ignorenulls=True).over(running(*keys, "_slice", order=order))).filter("event_type = 'order'")
        out = orders.join(carried, [*keys, "_slice"], "left").withColumn("_last", F.coalesce("_last", "_carried"))
    else:
        out = rows.withColumn("_last", F.last(click, ignorenulls=True).over(running(*keys, order=order))).filter("event_type = 'order'")
    near = F.col("user_id").isNotNull() & F.col("advertiser_id").isNotNull() & (F.unix_micros("_last.t") >= F.unix_micros("event_ts") - _micros(lookback))
    out = out.withColumn("_last", F.when(near, F.col("_last")))
    return _finish(out.select([F.col(c).alias(n) for c, n in _there(_ORDER, events).items()] + [F.col(f"_last.touch.{n}").alias(n) for n in touch.values()]))


def by_heat(rows: DataFrame, keys: Sequence[str], hot_rows: int, run: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """*run* over the rows of keys with at most *hot_rows* rows as "window", and over those of the others as "sliced"."""
    hot = rows.filter(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows).select(*keys)
    if hot.isEmpty():
        return run(rows, "window")
    hot = small(hot)
    return run(rows.join(hot, list(keys), "left_anti"), "window").unionByName(run(rows.join(hot, list(keys), "left_semi"), "sliced"))


def running(*keys: str, order) -> WindowSpec:
    """All rows up to this one."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def time_slice(micros: Column, width: str) -> Column:
    return F.floor(micros / F.lit(_micros(width))).cast("long")


def touch_stream(events: DataFrame, lookback: str = "30 days", watermark: str = "10 minutes") -> DataFrame:
    """Attribution of a stream of events: each order at once without a click, and again with every click of the look-back.

    The latest touch of an order, whenever its row came, is its last click (`settled_touches`), so no order waits for the
    watermark; that and the look-back bound the join's state.  Events later than the watermark are dropped.
    """
    orders, clicks, near = _sides(events, lookback)
    orders = orders.withWatermark("outcome_time", watermark)
    pairs = orders.join(clicks.withWatermark("touch_time", watermark), near).drop("_user")
    return _finish(pairs.unionByName(orders, allowMissingColumns=True))


def settled_touches(log: DataFrame) -> DataFrame:
    """Each order with its last click so far, from what `touch_stream` gave; the same rows as `last_touch`."""
    return latest_by_key(log, ["outcome_event_id"], ["touch_time", "touch_event_id"])


def _micros(span: str) -> int:
    number, unit = span.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000


def touchpoints(candidates: DataFrame, model: str = MODEL, lookback_days: int = 30) -> DataFrame:
    """Weights of each candidate: the last click has all."""
    touched = F.col("touch_event_id").isNotNull()
    last = touched & (F.col("touchpoint_seq") == 1)
    share = F.when(last, 1).otherwise(0).cast("decimal(10,6)")
    return candidates.select(
        F.col("candidate_id").alias("attribution_id"), "stat_date", F.col("outcome_event_id").alias("conversion_event_id"), "order_id", "user_id",
        F.when(touched, F.col("touchpoint_seq")).otherwise(0).alias("touchpoint_seq"), F.when(touched, "click").otherwise("organic").alias("touchpoint_type"),
        "touch_time", "creative_id", "campaign_id", "advertiser_id", last.alias("is_last_click"), F.lit(model).alias("attribution_model"),
        share.alias("touch_weight"), F.when(last, F.col("order_gmv")).otherwise(0).cast("decimal(18,4)").alias("attributed_gmv"), share.alias("attributed_conv"), F.lit(lookback_days).alias("lookback_days"),
    )


def _by_lag(natural, direct, indirect, last) -> Column:
    lag = F.col("lag_minutes")
    out = F.when(F.col("touch_event_id").isNull(), natural).when(lag <= DIRECT[0], direct)
    for limit, value in indirect:
        out = out.when(lag <= limit, value)
    return out.otherwise(last)


def order_detail(candidates: DataFrame, points: DataFrame | None = None, model: str = MODEL) -> DataFrame:
    """One row for each order: its last click or none, with type, period and sort number of the lag.

    points: touchpoints whose model decides, joined by candidate.  Without them the candidates decide themselves: those of
    `last_touch`, one for each order, or the first of `attribution_candidates`; that needs no join.
    """
    if points is not None:
        final = points.filter("is_last_click OR touchpoint_type = 'organic'").select("stat_date", F.col("attribution_id").alias("candidate_id"), "attribution_model")
        chosen = candidates.join(final, ["stat_date", "candidate_id"])
    else:
        first = candidates.filter("touchpoint_seq = 1") if "touchpoint_seq" in candidates.columns else candidates
        chosen = first.withColumn("attribution_model", F.lit(model))
    return chosen.select(
        F.col("stat_date").alias("event_date"), F.col("outcome_event_id").alias("order_event_id"), "order_id", F.col("outcome_time").alias("order_ts"), "user_id",
        "order_advertiser_id", "order_advertiser_name", "order_campaign_id", "order_campaign_name", "order_gmv",
        F.col("touch_event_id").alias("click_event_id"), F.col("touch_time").alias("click_ts"), "creative_id", "campaign_id", "campaign_name", "advertiser_id", "advertiser_name", "touch_spend", "attribution_model",
        _by_lag(NATURAL[0], DIRECT[1], [(n, "indirect") for n, *_ in INDIRECT], "indirect").alias("attribution_type"),
        _by_lag(NATURAL[1], DIRECT[2], [(n, p) for n, p, _ in INDIRECT], LAST_INDIRECT[0]).alias("attribution_period"),
        _by_lag(NATURAL[2], DIRECT[3], [(n, s) for n, _, s in INDIRECT], LAST_INDIRECT[1]).alias("attribution_sort"),
        "lag_minutes", F.col("touch_event_id").isNotNull().alias("is_attributed"),
    )


def attribution_summary(detail: DataFrame) -> DataFrame:
    """Orders, gmv and spend by day, advertiser, campaign of the click and period."""
    return detail.groupBy("event_date", F.col("order_advertiser_id").alias("advertiser_id"), F.coalesce("campaign_id", F.lit(ORGANIC_CAMPAIGN)).alias("campaign_id"), "attribution_period").agg(
        F.max("order_advertiser_name").alias("advertiser_name"), F.max(F.coalesce("campaign_name", F.lit(ORGANIC_NAME))).alias("campaign_name"),
        F.lit(0).cast("long").alias("conversions"), F.count("*").alias("orders"), F.sum("order_gmv").cast("decimal(18,2)").alias("attributed_gmv"),
        F.sum(F.coalesce("touch_spend", F.lit(0))).cast("decimal(18,4)").alias("attributed_spend"),
    )
