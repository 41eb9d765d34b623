"""Roll-ups of a dataset, and dashboards answered from them.

A dashboard's charts ask for the same rows by different keys.  The sums of a dataset's parts by a few sets of keys are written once,
each from the smallest one that has its keys; a chart then takes the smallest roll-up with its keys, filters and
time, and only a chart that none can answer goes back to the rows.  Filters that a user sets in one chart hold in all others of the dashboard.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.plans.semantic import DATASETS, Chart, summed_parts


@dataclass
class RollUp:
    keys: frozenset[str]
    frame: DataFrame
    rows: int


def roll_up(dataset: str, df: DataFrame, keys: Sequence[str], rolled: bool = False) -> DataFrame:
    """Sums of parts by *keys*, of which `day` is the day of the dataset's time."""
    if "day" in keys and not rolled:
        df = df.withColumn("day", F.col(DATASETS[dataset].time).cast("string").substr(1, 10))
    # a key may be named like a part, but no dataset has such
    return summed_parts(dataset, df, list(keys), rolled)


class Lattice:
    """store: writes a frame and reads it again, so that it is computed once."""

    def __init__(self, dataset: str, df: DataFrame, key_sets: Sequence[Sequence[str]], store: Callable[[DataFrame], DataFrame]) -> None:
        self.dataset, self.df = dataset, df
        self.roll_ups: list[RollUp] = []
        for keys in sorted(key_sets, key=len, reverse=True):
            above = self.smallest(set(keys))
            frame = store(roll_up(dataset, above.frame if above else df, list(keys), rolled=above is not None))
            self.roll_ups.append(RollUp(frozenset(keys), frame, frame.count()))

    def smallest(self, needs: set[str]) -> RollUp | None:
        """The roll-up with fewest rows that has all columns of *needs*."""
        return min((r for r in self.roll_ups if needs <= r.keys), key=lambda r: r.rows, default=None)

    def answer(self, chart: Chart) -> DataFrame:
        """The chart's rows, the same as `chart.run` gives."""
        found = self.smallest(chart.needs)
        return chart.run(found.frame, rolled=True) if found else chart.run(self.df)


def cross_filtered(charts: dict[str, Chart], selected: dict[str, dict[str, tuple]]) -> dict[str, Chart]:
    """The charts with the values selected in the other ones as filters; a chart's own selection leaves it as it is.

    selected: chart -> column -> values.  Two selections of one column both hold.
    """
    out = {}
    for name, chart in charts.items():
        filters = dict(chart.filters)
        for origin, columns in selected.items():
            for column, values in columns.items() if origin != name else ():
                filters[column] = tuple(v for v in filters[column] if v in values) if column in filters else tuple(values)
        out[name] = replace(chart, filters=filters)
    return out


def tall(answers: dict[str, DataFrame], charts: dict[str, Chart]) -> DataFrame:
    """All charts' rows as (chart, keys, metric, value): what a dashboard loads at once."""
    parts = []
    for name, df in answers.items():
        keys = [c for c in df.columns if c not in charts[name].metrics and c != "share"]
        text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in df.columns if m not in keys])
        parts.append(df.select(F.lit(name).alias("chart"), text.alias("keys"), F.explode(cells).alias("c")).select("chart", "keys", "c.metric", "c.value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
