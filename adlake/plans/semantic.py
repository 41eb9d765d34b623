"""Semantic layer: datasets with named metrics, and one query function over them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators import attribution


def _ratio(a: str, b: str) -> str:
    return f"round(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 6)"


def _where(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} ELSE 0 END"


def _mean(*columns: str) -> dict[str, str]:
    """The parts of means: a sum and how many values it has."""
    return {f"{c}_sum": f"CAST({c} AS DOUBLE)" for c in columns} | {f"{c}_n": f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in columns}


def _same(names: str) -> dict[str, str]:
    return {n: n for n in names.split()}


_MONEY_AND_COUNTS = "gmv impressions clicks conversions orders"


@dataclass(frozen=True)
class Dataset:
    """A time column, parts and metrics.

    parts: name -> what a row adds.  metrics: name -> SQL over the sums of parts, so that a metric can be had from rows and
    from roll-ups alike.  distinct: name -> column whose values are counted.
    """

    time: str
    parts: dict[str, str]
    metrics: dict[str, str]
    distinct: dict[str, str] = field(default_factory=dict)


DATASETS: dict[str, Dataset] = {
    "events_detail": Dataset(
        "event_ts",
        {"rows": "1L", **_same("spend gmv"), **{f"{k}s": _where(f"event_type = '{k}'", "1") for k in ("impression", "click", "conversion")}},
        {"count": "rows", "total_spend": "spend", "total_gmv": "gmv", "impression_events": "impressions", "click_events": "clicks", "conversion_events": "conversions"},
    ),
    "realtime": Dataset(
        "window_start",
        {"rows": "1L", **_same(f"spend {_MONEY_AND_COUNTS} spend_change gmv_change")},
        {
            "count": "rows", "total_spend": "spend", "total_gmv": "gmv", "total_impressions": "impressions", "total_clicks": "clicks", "total_conversions": "conversions", "total_orders": "orders",
            "ctr": _ratio("clicks", "impressions"), "cvr": _ratio("conversions", "clicks"), "roas": _ratio("gmv", "spend"), "spend_change": "spend_change", "gmv_change": "gmv_change",
        },
    ),
    "retention": Dataset(
        "cohort_date",
        {"rows": "1L", **_same("cohort_size retained_1d retained_7d"), **_mean("rate_1d", "rate_7d", "rate_15d", "rate_30d")},
        {"count": "rows", "cohort_size": "cohort_size", "retained_1d": "retained_1d", "retained_7d": "retained_7d"} | {f"avg_rate_{n}d": _ratio(f"rate_{n}d_sum", f"rate_{n}d_n") for n in (1, 7, 15, 30)},
    ),
    "attribution": Dataset(
        "event_date",
        {
            "rows": "1L", **_same("conversions orders"), "gmv": "attributed_gmv", "spend": "attributed_spend",
            "touched_gmv": _where("attribution_sort_name <> 'natural'", "attributed_gmv"), "touched_orders": _where("attribution_sort_name <> 'natural'", "orders"),
            **{f"{k}_gmv": _where(f"attribution_sort_name = '{k}'", "attributed_gmv") for k in ("direct", "indirect", "natural")},
        },
        {
            "count": "rows", "total_conversions": "conversions", "total_orders": "orders", "total_order_gmv": "gmv", "attributed_gmv": "touched_gmv", "direct_gmv": "direct_gmv", "indirect_gmv": "indirect_gmv",
            "organic_gmv": "natural_gmv", "attributed_orders": "touched_orders", "attributed_order_rate": _ratio("touched_orders", "orders"), "attributed_gmv_rate": _ratio("touched_gmv", "gmv"), "attributed_spend": "spend",
        },
    ),
    "order_detail": Dataset("order_ts", {"rows": "1L", "gmv": "order_gmv", **_mean("lag_minutes")}, {"order_count": "rows", "order_gmv": "gmv", "avg_lag_minutes": _ratio("lag_minutes_sum", "lag_minutes_n")}),
    "creative": Dataset(
        "stat_date",
        {"rows": "1L", **_same(f"cost {_MONEY_AND_COUNTS}"), **{f"latest_{c}": _where("is_latest_partition", c) for c in ("cost", *_MONEY_AND_COUNTS.split())}},
        {
            "count": "rows", "row_count": "rows", "total_cost": "cost", "total_gmv": "gmv", "total_impressions": "impressions", "total_clicks": "clicks", "total_conversions": "conversions", "total_orders": "orders",
            "ctr": _ratio("clicks", "impressions"), "cvr": _ratio("conversions", "clicks"), "roas": _ratio("gmv", "cost"), "cpc": _ratio("cost", "clicks"), "cpa": _ratio("cost", "conversions"),
            **_same(" ".join(f"latest_{c}" for c in ("cost", *_MONEY_AND_COUNTS.split()))),
            "latest_roas": _ratio("latest_gmv", "latest_cost"), "latest_ctr": _ratio("latest_clicks", "latest_impressions"), "latest_cvr": _ratio("latest_conversions", "latest_clicks"),
        },
        {"active_creatives": "creative_id"},
    ),
    "fraud": Dataset(
        "event_date",
        {"rows": "1L", **_same("suspicious_users suspicious_windows suspicious_clicks suspicious_spend"), **_mean("avg_risk_score")},
        {"count": "rows", **_same("suspicious_users suspicious_windows suspicious_clicks suspicious_spend"), "avg_risk_score": _ratio("avg_risk_score_sum", "avg_risk_score_n")},
    ),
}

#: Columns that parts need beside those of the dataset.
_ADDED = {
    "attribution_sort_name": lambda: F.when(F.col("attribution_period") == attribution.NATURAL[1], "natural").when(F.col("attribution_period") == attribution.DIRECT[2], "direct").otherwise("indirect")
}


def parts_of(dataset: str, metrics: Sequence[str]) -> set[str]:
    """The parts that these metrics are made of."""
    spec = DATASETS[dataset]
    words = {w for m in metrics if m in spec.metrics for w in re.findall(r"\w+", spec.metrics[m])}
    return {"rows", *(words & set(spec.parts))}


def summed_parts(dataset: str, df: DataFrame, keys: Sequence[str], rolled: bool = False, extra: Sequence[Column] = (), parts: set[str] | None = None) -> DataFrame:
    """The sums of a dataset's *parts* (or all) by *keys*; of rows, or of a roll-up, whose columns they are."""
    spec = {n: e for n, e in DATASETS[dataset].parts.items() if parts is None or n in parts}
    if not rolled:
        df = df.withColumns({n: make() for n, make in _ADDED.items() if any(n in e for e in spec.values())})
    sums = [F.sum(F.col(n) if rolled else F.expr(e)).alias(n) for n, e in spec.items()]
    out = df.groupBy(*keys).agg(*sums, *extra)
    return out.withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long"))


def in_time_range(column: str, time_range: str | None, as_of: str | None = None) -> Column:
    """`No filter`, `2024-01-01 : 2024-02-01` (end exclusive, either side may be empty) or `Last N days` before *as_of*."""
    if not time_range or time_range == "No filter":
        return F.lit(True)
    day = F.to_date(F.col(column).cast("string").substr(1, 10))
    words = time_range.split()
    if words[0].lower() == "last":
        end = F.lit(as_of).cast("date") if as_of else F.current_date()
        return (day >= F.date_sub(end, int(words[1]))) & (day < end)
    start, _, end = time_range.partition(" : ")
    out = F.lit(True)
    if start.strip():
        out = out & (day >= F.lit(start.strip()).cast("date"))
    if end.strip():
        out = out & (day < F.lit(end.strip()).cast("date"))
    return out


def query(
    dataset: str,
    df: DataFrame,
    groupby: Sequence[str] = (),
    metrics: Sequence[str] = (),
    filters: dict[str, Sequence] | None = None,
    time_range: str | None = None,
    grain: str | None = None,
    limit: int | None = None,
    share: bool = False,
    as_of: str | None = None,
    rolled: bool = False,
) -> DataFrame:
    """Aggregate a dataset's rows.

    filters: column -> allowed values; grain: "day" groups by the time column's day; limit: the first rows by falling first
    metric, ties by the grouping columns; share: adds the first metric's share of the total of the groups.
    rolled: *df* is a roll-up (`adlake.plans.lattice`), with `day` for the time and the parts' sums as columns.
    """
    spec = DATASETS[dataset]
    time = "day" if rolled else spec.time
    rows = df.filter(in_time_range(time, time_range, as_of))
    for column, values in (filters or {}).items():
        rows = rows.filter(F.col(column).isin(list(values)))
    keys = list(groupby)
    if grain == "day":
        rows = rows if rolled else rows.withColumn("day", F.col(time).cast("string").substr(1, 10))
        keys = ["day", *keys]
    # metrics may be named like parts and keys
    named = {k: f"_key_{k}" for k in keys}
    counted = [F.count_distinct(spec.distinct[m]).alias(f"_{m}") for m in metrics if m in spec.distinct]
    sums = summed_parts(dataset, rows.withColumns({n: F.col(k) for k, n in named.items()}), list(named.values()), rolled, counted, parts_of(dataset, metrics))
    out = sums.select(*[F.col(n).alias(k) for k, n in named.items()], *[F.expr(spec.metrics[m] if m in spec.metrics else f"_{m}").alias(m) for m in metrics])
    if share:
        # over the groups of a chart, which are few: the rows are read once
        total = F.sum(metrics[0]).over(Window.partitionBy()).cast("double")
        out = out.withColumn("share", F.round(F.col(metrics[0]).cast("double") / F.nullif(total, F.lit(0.0)), 6))
    return out.orderBy(F.desc(metrics[0]), *keys).limit(limit) if limit else out


@dataclass(frozen=True)
class Chart:
    dataset: str
    metrics: tuple[str, ...]
    groupby: tuple[str, ...] = ()
    grain: str | None = None
    limit: int | None = None
    share: bool = False
    filters: dict[str, tuple] = field(default_factory=dict)
    time_range: str | None = None

    def run(self, df: DataFrame, rolled: bool = False) -> DataFrame:
        return query(self.dataset, df, self.groupby, self.metrics, self.filters, self.time_range, self.grain, self.limit, self.share, rolled=rolled)

    @property
    def needs(self) -> set[str]:
        """The columns that a roll-up must have to answer this."""
        spec = DATASETS[self.dataset]
        timed = self.grain == "day" or (self.time_range or "No filter") != "No filter"
        return {*self.groupby, *self.filters, *(spec.distinct[m] for m in self.metrics if m in spec.distinct), *(["day"] if timed else [])}


def _kpis(prefix: str, dataset: str, metrics: str) -> dict[str, Chart]:
    return {f"{prefix}_{m}": Chart(dataset, (m,)) for m in metrics.split()}


#: The fifty charts of the five dashboards.
CHARTS: dict[str, Chart] = {
    **_kpis("realtime_kpi", "realtime", "total_spend total_gmv total_impressions total_clicks total_conversions roas"),
    "realtime_daily": Chart("realtime", ("total_gmv", "total_spend"), grain="day"),
    "realtime_top_advertisers": Chart("realtime", ("total_gmv",), ("advertiser_name",), limit=20),
    "realtime_advertiser_table": Chart("realtime", ("roas", "ctr", "cvr", "total_spend", "total_gmv"), ("advertiser_name",), limit=100),
    "retention_daily": Chart("retention", tuple(f"avg_rate_{n}d" for n in (1, 7, 15, 30)), grain="day"),
    **_kpis("creative_kpi", "creative", "latest_cost latest_gmv latest_impressions latest_clicks latest_conversions latest_orders latest_roas latest_ctr latest_cvr"),
    "creative_daily_money": Chart("creative", ("total_cost", "total_gmv"), grain="day"),
    "creative_daily_volume": Chart("creative", ("total_impressions", "total_clicks", "total_conversions", "total_orders"), grain="day"),
    "creative_daily_ratios": Chart("creative", ("roas", "ctr", "cvr"), grain="day"),
    "creative_top_advertisers": Chart("creative", ("total_gmv",), ("advertiser_name",), limit=15),
    "creative_top_objectives": Chart("creative", ("total_gmv",), ("campaign_objective",), limit=10),
    "creative_top_creatives": Chart("creative", ("total_gmv",), ("creative_name",), limit=20),
    "creative_detail": Chart(
        "creative",
        ("total_cost", "total_gmv", "total_impressions", "total_clicks", "total_conversions", "total_orders", "ctr", "cvr", "roas", "cpc", "cpa"),
        ("stat_date", "advertiser_name", "industry", "campaign_name", "campaign_objective", "unit_name", "creative_name", "creative_format"),
        limit=1000,
    ),
    **_kpis("attribution_kpi", "attribution", "total_order_gmv attributed_gmv attributed_order_rate direct_gmv indirect_gmv organic_gmv"),
    "attribution_daily_gmv": Chart("attribution", ("attributed_gmv", "direct_gmv", "indirect_gmv", "organic_gmv"), grain="day"),
    "attribution_daily_orders": Chart("attribution", ("total_orders", "attributed_orders"), grain="day"),
    "attribution_share_gmv": Chart("attribution", ("total_order_gmv",), ("attribution_period",), share=True),
    "attribution_share_orders": Chart("attribution", ("total_orders",), ("attribution_period",), share=True),
    "attribution_by_period": Chart("attribution", ("total_order_gmv",), ("attribution_period",), limit=10),
    "attribution_by_advertiser": Chart("attribution", ("attributed_gmv",), ("advertiser_name",), limit=10),
    "attribution_detail": Chart(
        "order_detail",
        ("order_count", "order_gmv", "avg_lag_minutes"),
        ("event_date", "attribution_period", "order_advertiser_name", "order_campaign_name", "campaign_name", "creative_id", "order_id", "user_id", "order_ts", "click_ts", "lag_minutes"),
        limit=1000,
    ),
    **_kpis("fraud_kpi", "fraud", "suspicious_users suspicious_windows suspicious_clicks suspicious_spend avg_risk_score"),
    "fraud_daily_spend": Chart("fraud", ("suspicious_clicks", "suspicious_spend"), grain="day"),
    "fraud_daily_users": Chart("fraud", ("suspicious_users", "suspicious_windows"), grain="day"),
    "fraud_top_clicks": Chart("fraud", ("suspicious_clicks",), ("advertiser_name",), limit=10),
    "fraud_top_spend": Chart("fraud", ("suspicious_spend",), ("advertiser_name",), limit=10),
    "fraud_top_score": Chart("fraud", ("avg_risk_score",), ("advertiser_name",), limit=10),
    "fraud_detail": Chart("fraud", ("suspicious_users", "suspicious_windows", "suspicious_clicks", "suspicious_spend", "avg_risk_score"), ("event_date", "advertiser_id", "advertiser_name"), limit=1000),
}

#: Reports beside the charts: the event dataset, filters and time ranges, and the metrics that no chart shows.
REPORTS: dict[str, Chart] = {
    "report_events": Chart("events_detail", ("count", "total_spend", "total_gmv", "impression_events", "click_events", "conversion_events"), ("advertiser_name",), grain="day"),
    "report_active_creatives": Chart("creative", ("active_creatives", "row_count", "total_gmv"), ("industry",), filters={"campaign_objective": ("ROAS", "GMV")}, time_range="2024-01-05 : 2024-01-20"),
    "report_attribution_rates": Chart("attribution", ("count", "total_conversions", "attributed_gmv_rate", "attributed_spend"), ("advertiser_name",), time_range="2024-01-10 : "),
    "report_realtime_changes": Chart("realtime", ("count", "total_orders", "spend_change", "gmv_change"), ("advertiser_name",)),
    "report_last_days": Chart("creative", ("total_cost", "row_count"), ("campaign_objective",), time_range="Last 10000 days"),
    "report_cohorts": Chart("retention", ("count", "cohort_size", "retained_1d", "retained_7d"), grain="day"),
    "report_attribution_types": Chart("order_detail", ("order_count", "order_gmv"), ("attribution_type",), filters={"is_attributed": (True,)}, time_range=" : 2024-01-16"),
}

#: Dashboards over one dataset: its charts, and the keys of the roll-ups that answer them.
DASHBOARDS: dict[str, tuple[list[str], list[tuple[str, ...]]]] = {
    "creative": (
        [n for n, c in CHARTS.items() if c.dataset == "creative" and n != "creative_detail"],
        [("day", "advertiser_name", "campaign_objective", "creative_name"), ("day", "advertiser_name", "campaign_objective"), ("day",), ("creative_name",)],
    ),
    "attribution": ([n for n, c in CHARTS.items() if c.dataset == "attribution"], [("day", "attribution_period", "advertiser_name"), ("attribution_period", "advertiser_name"), ("day",)]),
    "fraud": ([n for n, c in CHARTS.items() if c.dataset == "fraud"], [("day", "event_date", "advertiser_id", "advertiser_name"), ("advertiser_name",)]),
}
#: What a user of the attribution dashboard has chosen: two periods in the share chart, two advertisers in another.
SELECTED: dict[str, dict[str, tuple]] = {
    "attribution_share_gmv": {"attribution_period": ("自然订单", "1日间接归因")},
    "attribution_by_advertiser": {"advertiser_name": ("Supplier#000000001", "Supplier#000000002", "Supplier#000000003")},
}
