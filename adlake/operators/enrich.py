"""Dimension enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Dimension rows up to which a broadcast is asked for; larger ones are left to Spark's own choice.
BROADCAST_ROWS = 500_000
UNKNOWN = "UNKNOWN"


#: Whether frames had few rows, by plan, files and bound: each table is counted once in a session.
_COUNTED: dict[tuple, bool] = {}


def small(side: DataFrame, max_rows: int = BROADCAST_ROWS, of: DataFrame | None = None) -> DataFrame:
    """A broadcast hint after counting, so that a dimension that has grown is shuffled instead.

    of: the dimension that *side* was made from, with no more rows; it is counted instead.  A count holds as long as the
    dimension's files have their names; frames without files are counted each time.
    """
    dim = side if of is None else of
    files = tuple(sorted(dim.inputFiles()))
    key = (dim.sparkSession.sparkContext.applicationId, dim.semanticHash(), files, max_rows)
    if key not in _COUNTED or not files:
        _COUNTED[key] = dim.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(side) if _COUNTED[key] else side


def lookup_enrich(df: DataFrame, dim: DataFrame, key: str, cols: dict[str, str], default: str = UNKNOWN, dim_key: str | None = None) -> DataFrame:
    """Adds dim's columns (cols: column of dim -> new name) by key (in dim: *dim_key*, if it has another name); a miss or a blank key gives *default*.

    Of several rows of a key the largest counts, by the columns in their order.
    """
    row = F.max(F.struct(*[F.col(c).alias(f"_{n}") for c, n in cols.items()])).alias("_row")
    side = dim.groupBy(F.col(dim_key or key).alias("_key")).agg(row).select("_key", "_row.*")
    key_or_null = F.when(F.trim(F.col(key)) != "", F.col(key))
    joined = df.join(small(side, of=dim), key_or_null == F.col("_key"), "left")
    return joined.withColumns({n: F.coalesce(F.col(f"_{n}"), F.lit(default)) for n in cols.values()}).drop("_key", *[f"_{n}" for n in cols.values()])


def enrich_dwd(ods: DataFrame, advertiser: DataFrame, campaign: DataFrame, creative: DataFrame) -> DataFrame:
    """Events with the names and attributes of advertiser, campaign and creative; one scan, three broadcasts."""
    out = lookup_enrich(ods, advertiser, "advertiser_id", {"advertiser_name": "advertiser_name", "industry": "industry", "tier": "advertiser_tier"})
    out = lookup_enrich(out, campaign, "campaign_id", {"campaign_name": "campaign_name", "objective": "campaign_objective"})
    return lookup_enrich(out, creative, "creative_id", {"creative_name": "creative_name", "format": "creative_format"})


def reenrich_unknown(dwd: DataFrame, dims: dict[str, tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Look up again where a column still is UNKNOWN, for dimension rows that came late.  dims: key -> (dimension, its column -> dwd's column)."""
    for key, (dim, cols) in dims.items():
        fresh = lookup_enrich(dwd, dim, key, {c: f"_new_{n}" for c, n in cols.items()})
        dwd = fresh.withColumns({n: F.when(F.col(n) == UNKNOWN, F.col(f"_new_{n}")).otherwise(F.col(n)) for n in cols.values()}).drop(*[f"_new_{n}" for n in cols.values()])
    return dwd


def ad_hierarchy(advertiser: DataFrame, campaign: DataFrame, unit: DataFrame, creative: DataFrame) -> DataFrame:
    """One row for each creative with a complete chain up to its advertiser."""
    up = unit.join(small(campaign), "campaign_id").join(small(advertiser), "advertiser_id")
    return creative.drop("campaign_id").join(small(up, of=unit), "unit_id")
