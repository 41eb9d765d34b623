"""Rolling click features and rule-based fraud signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.attribution import _micros, by_heat, time_slice
from adlake.operators.sketches import distinct_count, roll_up, sketch_by

NORMAL = "NORMAL"
#: Rule code, score and description.
RULES = {
    "HIGH_CLICK_BURST": ("0.9500", "User click count in the rolling hour exceeds the burst threshold"),
    "ABNORMAL_CTR": ("0.8500", "User rolling click-through rate deviates strongly from baseline"),
    "HIGH_DAILY_CLICKS": ("0.7500", "User daily click count exceeds the threshold"),
}
NORMAL_SCORE, OTHER_RULE = "0.1000", "DM anti-fraud model signal"


def _trailing(events: DataFrame, long: str, short: str, keys: Sequence[str], strategy: str, slice_width: str) -> DataFrame:
    """Clicks with click and impression counts of the trailing spans, rows of the same instant included."""
    known = [F.col(k).isNotNull() for k in keys]
    complete = known[0] if len(known) == 1 else known[0] & known[1]
    is_click, is_view = F.col("event_type") == "click", F.col("event_type") == "impression"
    if strategy != "join":
        # each event is counted from its time on and taken off when a span has passed, so that running sums are the counts of the spans
        clicks, views = F.when(is_click, 1).otherwise(0), F.when(is_view, 1).otherwise(0)
        steps = F.array(
            F.struct(F.lit(0).alias("after"), clicks.alias("c"), views.alias("v"), views.alias("s")),
            F.struct(F.lit(_micros(long) + 1).alias("after"), (-clicks).alias("c"), (-views).alias("v"), F.lit(0).alias("s")),
            F.struct(F.lit(_micros(short) + 1).alias("after"), F.lit(0).alias("c"), F.lit(0).alias("v"), (-views).alias("s")),
        )
        rows = events.filter(is_click | is_view).withColumn("_e", F.explode(F.when(is_click, F.slice(steps, 1, 2)).otherwise(steps)))
        at = F.unix_micros("event_ts") + F.col("_e.after")
        within, sums = list(keys), ("c", "v", "s")
        if strategy == "sliced":
            rows, within = rows.withColumn("_slice", time_slice(at, slice_width)), [*keys, "_slice"]
        w = Window.partitionBy(*within).orderBy(at).rangeBetween(Window.unboundedPreceding, 0)
        counted = rows.withColumn("_n", F.struct(*[F.sum(f"_e.{c}").over(w).alias(c) for c in sums])).filter(is_click & (F.col("_e.after") == 0))
        earlier = {c: F.lit(0) for c in sums}
        if strategy == "sliced":  # one row for each slice has the sums of the slices before
            before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
            totals = rows.groupBy(*within).agg(*[F.sum(f"_e.{c}").alias(c) for c in sums], F.max(is_click & (F.col("_e.after") == 0)).alias("_asked"))
            carried = totals.select(*within, "_asked", F.struct(*[F.sum(c).over(before).alias(c) for c in sums]).alias("_before")).filter("_asked").drop("_asked")
            counted = counted.join(carried, within, "left")
            earlier = {c: F.coalesce(F.col(f"_before.{c}"), F.lit(0)) for c in sums}
        # a null key matches nothing in the join form
        count = lambda c: F.when(complete, F.col(f"_n.{c}") + earlier[c]).otherwise(0).cast("int")
        return counted.select(*events.columns, *[count(c).alias(n) for c, n in zip(sums, ("click_cnt_1h", "impression_cnt_1h", "impression_cnt_1m"))])
    past = events.filter(is_click | is_view).select(*[F.col(k).alias(f"h_{k}") for k in keys], F.col("event_ts").alias("h_ts"), F.col("event_type").alias("h_type"))
    clicks = events.filter(is_click)
    near = (F.col("h_ts") <= F.col("event_ts")) & (F.col("h_ts") >= F.col("event_ts") - F.expr(f"INTERVAL {long}"))
    for k in keys:
        near = near & (F.col(k) == F.col(f"h_{k}"))
    soon = F.col("h_ts") >= F.col("event_ts") - F.expr(f"INTERVAL {short}")
    h_click, h_view = F.col("h_type") == "click", F.col("h_type") == "impression"
    sums = clicks.select("event_id", "event_ts", *keys).join(past, near).groupBy("event_id").agg(
        F.count(F.when(h_click, 1)).cast("int").alias("click_cnt_1h"), F.count(F.when(h_view, 1)).cast("int").alias("impression_cnt_1h"), F.count(F.when(h_view & soon, 1)).cast("int").alias("impression_cnt_1m")
    )
    return clicks.join(sums, "event_id", "left").fillna(0, ["click_cnt_1h", "impression_cnt_1h", "impression_cnt_1m"])


def click_features(events: DataFrame, long: str = "1 hour", short: str = "1 minute", keys: Sequence[str] = ("user_id", "media"), base_ctr: float = 0.10, strategy: str = "auto", slice_width: str = "1 hour", hot_rows: int = 100_000) -> DataFrame:
    """Features of each click.

    sliced: running sums within slices of time, with the sums, counts and last clicks of earlier slices from one row for each
    slice, so that no task holds more of a user than one slice.  window: running sums over all rows of a key, without a join,
    for tables without hot users.  auto: users with more than *hot_rows* rows are sliced, the others are not.  join: range
    self-join.  All give the same rows.  device, ip and ua columns are the proxies of the model: no such data exist.
    """
    if strategy == "auto":
        rows = events.filter("event_type IN ('click', 'impression')")
        return by_heat(rows, ["user_id"], hot_rows, lambda part, how: click_features(part, long, short, keys, base_ctr, how, slice_width))
    clicks = _trailing(events, long, short, keys, strategy, slice_width)
    whole = Window.partitionBy("event_date", "user_id")
    if strategy == "sliced":
        at = time_slice(F.unix_micros("event_ts"), slice_width)
        parts = events.filter("event_type = 'click'").groupBy("user_id", "event_date", at.alias("_at")).agg(F.count("*").alias("_n"), F.max("event_ts").alias("_end"))
        earlier = Window.partitionBy("user_id").orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
        parts = parts.select(F.col("user_id").alias("_user"), F.col("event_date").alias("_date"), "_at", F.sum("_n").over(whole).alias("_daily"), F.max("_end").over(earlier).alias("_before"))
        same = F.col("user_id").eqNullSafe(F.col("_user")) & F.col("event_date").eqNullSafe(F.col("_date")) & F.col("_slice").eqNullSafe(F.col("_at"))
        within = F.lag("event_ts").over(Window.partitionBy("user_id", "_slice").orderBy("event_ts", "event_id"))
        clicks = clicks.withColumn("_slice", at).withColumn("_within", within).join(parts, same, "left")
        before, daily = F.coalesce("_within", "_before"), F.col("_daily")
    else:
        before, daily = F.lag("event_ts").over(Window.partitionBy("user_id").orderBy("event_ts", "event_id")), F.count("*").over(whole)
    seconds = F.floor((F.unix_micros("event_ts") - F.unix_micros(before)) / 1_000_000)
    deviation = F.when(F.col("impression_cnt_1h") == 0, F.col("click_cnt_1h").cast("double")).otherwise(F.col("click_cnt_1h") / F.col("impression_cnt_1h") - F.lit(base_ctr))
    return clicks.select(
        F.col("event_date").alias("stat_date"), "event_id", F.col("event_ts").alias("event_time"), "user_id", F.col("user_id").alias("device_id"), F.lit(None).cast("string").alias("device_ip"),
        "creative_id", F.col("media").alias("slot_id"), "advertiser_id", *[c for c in ("advertiser_name",) if c in events.columns], "media", "spend",
        "click_cnt_1h", daily.cast("int").alias("click_cnt_1d"), "impression_cnt_1h", "impression_cnt_1m",
        F.col("click_cnt_1h").alias("ip_click_cnt_1h"), F.lit(1).alias("ip_uv_1h"), (seconds * 1000).cast("long").alias("click_interval_ms"),
        F.round(deviation, 6).cast("decimal(10,6)").alias("ctr_deviation"), F.hour("event_ts").between(0, 5).alias("is_night_burst"),
    )


def label_clicks(clicks: DataFrame, burst: int = 10, mid: int = 5, mid_dev: float = 0.7, daily: int = 20) -> DataFrame:
    """*clicks* with fraud_label, fraud_score and rule_hits; the first rule that holds counts."""
    conditions = {"HIGH_CLICK_BURST": F.col("click_cnt_1h") >= burst, "ABNORMAL_CTR": (F.col("click_cnt_1h") >= mid) & (F.col("ctr_deviation") >= mid_dev), "HIGH_DAILY_CLICKS": F.col("click_cnt_1d") >= daily}

    def cascade(of, otherwise) -> Column:
        out = F
        for rule, condition in conditions.items():
            out = out.when(condition, of(rule))
        return out.otherwise(otherwise)

    return clicks.withColumns(
        {
            "fraud_score": cascade(lambda r: F.lit(RULES[r][0]), F.lit(NORMAL_SCORE)).cast("decimal(6,4)"),
            "fraud_label": cascade(F.lit, F.lit(NORMAL)),
            "rule_hits": cascade(lambda r: F.array(F.lit(r)), F.array(F.lit("NONE"))),
        }
    )


def fraud_features(clicks: DataFrame, **rules) -> DataFrame:
    """The feature table of the clicks with their labels; *rules* as in label_clicks."""
    return label_clicks(clicks, **rules).select(
        "stat_date", "event_id", "user_id", "device_id", "device_ip", "creative_id", "slot_id", "click_cnt_1h", "click_cnt_1d", "ip_click_cnt_1h", "ip_uv_1h", "click_interval_ms", "ctr_deviation",
        F.lit(0).cast("decimal(10,6)").alias("ua_entropy"), F.lit(False).alias("geo_ip_mismatch"), "is_night_burst", "fraud_score", "fraud_label", "rule_hits",
    )


def fraud_signals(features: DataFrame, clicks: DataFrame | None = None, size: str = "1 minute") -> DataFrame:
    """Abnormal clicks by window, advertiser, media and rule.

    features: labelled clicks; or a feature table, to be joined with *clicks* by date and event.
    """
    abnormal = features.filter(F.col("fraud_label") != NORMAL)
    if clicks is not None:
        abnormal = clicks.join(abnormal.select("stat_date", "event_id", "fraud_label", "fraud_score"), ["stat_date", "event_id"])
    sums = abnormal.groupBy(F.window("event_time", size).alias("w"), "advertiser_id", "media", F.col("fraud_label").alias("rule_code")).agg(
        F.max("advertiser_name").alias("advertiser_name"), F.count("*").alias("click_count"), F.max("impression_cnt_1m").alias("impression_count"),
        F.countDistinct("user_id").alias("unique_users"), F.sum("spend").cast("decimal(18,4)").alias("suspicious_spend"), F.max("fraud_score").cast("decimal(18,6)").alias("risk_score"),
    )
    said = F
    for rule, (_, text) in RULES.items():
        said = said.when(F.col("rule_code") == rule, text)
    return sums.select(
        F.date_format("w.start", "yyyy-MM-dd").alias("event_date"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "advertiser_id", "advertiser_name", "media", "rule_code",
        said.otherwise(OTHER_RULE).alias("rule_desc"), "click_count", "impression_count", "unique_users", "suspicious_spend", "risk_score",
    )


def _abnormal_windows(labelled: DataFrame, size: str) -> tuple[DataFrame, list[str | Column]]:
    """Abnormal clicks, and the keys of `fraud_signals`."""
    return labelled.filter(F.col("fraud_label") != NORMAL), [F.window("event_time", size).alias("w"), "advertiser_id", "media", F.col("fraud_label").alias("rule_code")]


def _dated(rows: DataFrame, value: str) -> DataFrame:
    return rows.select(F.date_format("w.start", "yyyy-MM-dd").alias("event_date"), F.col("w.start").alias("window_start"), "advertiser_id", "media", "rule_code", value)


def fraud_user_sketches(labelled: DataFrame, size: str = "1 minute") -> DataFrame:
    """The users of each window, advertiser, media and rule of `fraud_signals` as a sketch that can be merged."""
    return _dated(sketch_by(*_abnormal_windows(labelled, size), "user_id"), "sketch")


def fraud_window_users(labelled: DataFrame, size: str = "1 minute") -> DataFrame:
    """The same users themselves, a row each, for exact counts."""
    abnormal, keys = _abnormal_windows(labelled, size)
    return _dated(abnormal.select(*keys, "user_id"), "user_id").distinct()


def fraud_daily_users(signals: DataFrame, users: DataFrame) -> DataFrame:
    """By day and advertiser: users summed over windows, which counts one user many times, and different users, counted (`fraud_window_users`) or estimated from merged sketches (`fraud_user_sketches`)."""
    keys = ["event_date", "advertiser_id"]
    summed = signals.groupBy(*keys).agg(F.sum("unique_users").alias("suspicious_users"))
    different = roll_up(users, keys).select(*keys, distinct_count().alias("different_users")) if "sketch" in users.columns else users.groupBy(*keys).agg(F.countDistinct("user_id").alias("different_users"))
    return summed.join(different, keys)


def fraud_daily(signals: DataFrame) -> DataFrame:
    """Signals by day and advertiser."""
    return signals.groupBy("event_date", "advertiser_id").agg(
        F.max("advertiser_name").alias("advertiser_name"), F.sum("unique_users").alias("suspicious_users"), F.count("*").alias("suspicious_windows"),
        F.sum("click_count").alias("suspicious_clicks"), F.sum("suspicious_spend").cast("decimal(18,4)").alias("suspicious_spend"), F.avg(F.col("risk_score").cast("double")).alias("avg_risk_score"),
    )
