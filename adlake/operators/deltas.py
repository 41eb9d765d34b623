"""A log of small deltas, one for each batch, and a base into which finished ones are folded.

For whatever can be merged in any order: signed sums, sketches.  A replayed batch overwrites its own delta; base and
list of folded batches change in one commit, so no delta is read twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators import publishing
from adlake.sources import files


def log(delta: DataFrame, path: str, batch_id: int, run: str = "batch") -> None:
    """Write a batch's delta.  run: who numbers the batches."""
    delta.write.mode("overwrite").parquet(f"{path}/log/run={run}/batch={batch_id}")


def folded(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch of each run that the base holds."""
    commit = publishing.current(spark, f"{path}/base")
    return commit.note["folded"] if commit else {}


def _upto(last: dict[str, int]):
    """Rows of batches up to the last one of their run."""
    out = F.lit(False)
    for run, batch in last.items():
        out = out | ((F.col("run") == run) & (F.col("batch").cast("long") <= batch))
    return out


def read(spark: SparkSession, path: str, upto: dict[str, int] | None = None) -> DataFrame:
    """The base and the deltas that it lacks; folders of folded batches are not read."""
    done = folded(spark, path)
    log = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(f"{path}/log").filter(~_upto(done))
    if upto is not None:
        log = log.filter(_upto(upto))
    log = log.drop("run", "batch")
    return publishing.read_published(spark, f"{path}/base").unionByName(log) if done else log


def fold(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], keep: int = 2) -> int | None:
    """Merge the finished batches with the base and return its version; None if there was nothing to add.  The *keep* last bases stay."""
    done, last = folded(spark, path), {}
    for run in (n.removeprefix("run=") for n in files.names(spark, f"{path}/log") if n.startswith("run=")):
        batches = [n for n in files.names(spark, f"{path}/log/run={run}") if n.startswith("batch=")]
        whole = [int(b.removeprefix("batch=")) for b in batches if "_SUCCESS" in files.names(spark, f"{path}/log/run={run}/{b}")]
        if whole and max(whole) > done.get(run, -1):
            last[run] = max(whole)
    if not last:
        return None
    version = publishing.publish(merge(read(spark, path, last)), f"{path}/base", note={"folded": done | last}, allow_empty=True)
    publishing.vacuum(spark, f"{path}/base", keep)
    return version
