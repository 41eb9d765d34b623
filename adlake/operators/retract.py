"""Aggregates that follow a change log: additions and retractions, without a full refresh.

A change log has rows +I, -U, +U and -D (`keyed.changelog_between`).  Counts and sums take each row with its sign; a
maximum or a distinct count is kept as the number of rows of each value, so that a retracted value can go.
All of these are sums, so a batch of changes is written as a small delta of its own, a replay overwrites
it, and reading adds the deltas up.  `fold` adds them to a base now and then; base and list of folded batches change in one commit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adlake.operators import deltas


@dataclass(frozen=True)
class Facts:
    """What is kept for each *keys*: name -> SQL expression of a row, summed, or of which the maximum or the number of different values is taken."""

    keys: Sequence[str]
    sums: dict[str, str]
    maxima: dict[str, str] = field(default_factory=dict)
    distinct: dict[str, str] = field(default_factory=dict)

    @property
    def kept(self) -> list[str]:
        """The sums, and for each the number of rows in which it is not null, so that it becomes null again without them."""
        return [*self.sums, *(f"_c_{n}" for n in self.sums)]

    @property
    def values(self) -> dict[str, str]:
        return {f"_v_{n}": e for n, e in {**self.maxima, **self.distinct}.items()}


def delta(changes: DataFrame, facts: Facts) -> DataFrame:
    """Signed sums by keys (`_set` 0) and by keys and value of each maximum and distinct count (`_set` 1, 2, ...); `_n` counts rows."""
    kind = F.col("row_kind")
    plus = kind.isin("+I", "+U")
    counted = [F.expr(e).isNotNull().cast("long").alias(f"_c_{n}") for n, e in facts.sums.items()]
    rows = changes.select(*facts.keys, *[F.expr(e).alias(n) for n, e in (facts.sums | facts.values).items()], *counted, F.when(plus, 1).otherwise(-1).alias("_n"))
    values = list(facts.values)
    keys = [F.col(k) for k in facts.keys]
    sets = [keys, *[[*keys, F.col(v)] for v in values]]
    which = F.lit(0)
    for k, v in enumerate(values, 1):
        which = F.when(F.grouping(v) == 0, k).otherwise(which)
    signed = [F.sum(F.when(F.col("_n") > 0, F.col(n)).otherwise(-F.col(n))).alias(n) for n in facts.kept]
    out = rows.groupingSets(sets, *keys, *[F.col(v) for v in values]).agg(which.alias("_set"), *signed, F.sum("_n").alias("_n"))
    # sums are kept once, with the keys; a row of changes that cancel out says nothing
    alone = {n: F.when(F.col("_set") == 0, F.col(n)) for n in facts.kept}
    moved = [F.coalesce(F.col(n) != 0, F.lit(False)) for n in facts.kept]
    silent = F.col("_n") == 0
    for m in moved:
        silent = silent & ~m
    return out.withColumns(alone).filter(~silent)


def added_up(rows: DataFrame, facts: Facts) -> DataFrame:
    """Deltas and bases as one base: a row for each keys, and for each keys and value that some row still has."""
    by = [*facts.keys, "_set", *facts.values]
    # the sum keeps its type, so that bases can be added again and again
    total = [F.sum(n).cast(rows.schema[n].dataType).alias(n) for n in [*facts.kept, "_n"]]
    return rows.groupBy(*by).agg(*total).filter("_n <> 0")


def facts_of(rows: DataFrame, facts: Facts) -> DataFrame:
    """The aggregates of *rows* (deltas and bases): keys, row_count, sums, maxima and distinct counts; keys without rows are gone."""
    base = added_up(rows, facts)
    of = {n: k for k, n in enumerate([*facts.maxima, *facts.distinct], 1)}
    there = lambda n: F.when((F.col("_set") == of[n]) & (F.col("_n") > 0), F.col(f"_v_{n}"))
    own = lambda n: F.max(F.when((F.col("_set") == 0) & (F.col(f"_c_{n}") > 0), F.col(n))).alias(n)
    out = base.groupBy(*facts.keys).agg(
        F.max(F.when(F.col("_set") == 0, F.col("_n"))).alias("row_count"), *[own(n) for n in facts.sums], *[F.max(there(n)).alias(n) for n in facts.maxima], *[F.count(there(n)).alias(n) for n in facts.distinct]
    )
    return out.filter("row_count > 0")


def log_changes(changes: DataFrame, path: str, facts: Facts, batch_id: int, run: str = "batch") -> None:
    """Write a batch's delta; a replay of the batch overwrites itself.  run: who numbers the batches."""
    deltas.log(delta(changes, facts), path, batch_id, run)


def read_facts(spark: SparkSession, path: str, facts: Facts) -> DataFrame:
    """The aggregates as of the last batch."""
    return facts_of(deltas.read(spark, path), facts)


def fold(spark: SparkSession, path: str, facts: Facts, keep: int = 2) -> int | None:
    """Add the finished batches to the base and return its version; None if there was nothing to add.  The *keep* last bases stay."""
    return deltas.fold(spark, path, lambda rows: added_up(rows, facts), keep)


def retract_job(changes: DataFrame, path: str, facts: Facts, checkpoint: str, once: bool = False, every: str = "10 seconds") -> StreamingQuery:
    """A stream of changes into the deltas of *path*; `read_facts` follows it micro-batch by micro-batch."""
    from adlake.streaming.jobs import _start, query_id

    return _start(changes, lambda batch, n: log_changes(batch, path, facts, n, query_id(batch.sparkSession, checkpoint)), checkpoint, "append", once, every)
