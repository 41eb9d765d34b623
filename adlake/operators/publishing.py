"""Snapshots that are replaced whole: each version has a folder, and one commit file makes it current.

    path/data/<id>            the rows of a version
    path/log/<number>.json    a commit: folder, rows and schema of the version; the highest number is current

Rows are written before the commit, and a commit is put in place by a rename that fails where the number is taken.  So a reader
sees the old rows or the new ones, a failed write changes nothing, of two writers at once the second learns of the first,
and going back is one more commit.  Old folders stay for readers that have begun, until `vacuum`.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from adlake.sources import files


class PublicationConflict(RuntimeError):
    """Another writer has published meanwhile."""


@dataclass(frozen=True)
class Commit:
    version: int
    folder: str
    rows: int
    schema: StructType
    #: What the writer wants to remember with the version.
    note: dict


def history(spark: SparkSession, path: str) -> list[Commit]:
    """All commits that are still listed, the current one last."""
    numbers = sorted(int(n.removesuffix(".json")) for n in files.names(spark, f"{path}/log") if n.endswith(".json") and not n.startswith("."))
    return [_commit(spark, path, n) for n in numbers]


def current(spark: SparkSession, path: str) -> Commit | None:
    """The commit that readers see; None before the first one."""
    numbers = [int(n.removesuffix(".json")) for n in files.names(spark, f"{path}/log") if n.endswith(".json") and not n.startswith(".")]
    return _commit(spark, path, max(numbers)) if numbers else None


def _commit(spark: SparkSession, path: str, version: int) -> Commit:
    got = json.loads(files.read_small(spark, f"{path}/log/{version:012}.json"))
    return Commit(version, got["folder"], got["rows"], StructType.fromJson(got["schema"]), got["note"])


def _put(spark: SparkSession, path: str, after: Commit | None, folder: str, rows: int, schema: StructType, note: dict) -> int:
    version = after.version + 1 if after else 1
    text = json.dumps({"folder": folder, "rows": rows, "schema": schema.jsonValue(), "note": note, "at": time.time()})
    if not files.put_new(spark, f"{path}/log/{version:012}.json", text):
        raise PublicationConflict(f"version {version} of {path} was published by another writer")
    return version


def publish(df: DataFrame, path: str, zero_cols: Sequence[str] = (), note: dict | None = None, allow_empty: bool = False) -> int:
    """Make the rows of *df* the current version and return its number.

    The frame is computed once.  An empty one is refused (unless *allow_empty*) and the old version stays current.  Nulls in
    *zero_cols* become 0; other nulls stay.  PublicationConflict if another writer was faster; its version stays.
    """
    spark = df.sparkSession
    seen = current(spark, path)
    folder = uuid.uuid4().hex
    target = f"{path}/data/{folder}"
    try:
        rows = df.fillna(0, list(zero_cols)) if zero_cols else df
        rows.write.parquet(target)
        n = spark.read.schema(rows.schema).parquet(target).count()  # from the files' footers
        if not n and not allow_empty:
            raise ValueError(f"refusing to replace {path} by an empty snapshot")
        return _put(spark, path, seen, folder, n, rows.schema, note or {})
    except Exception:
        files.delete(spark, target)
        raise


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the current version, or of a former one whose folder is still there."""
    found = current(spark, path) if version is None else _commit(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.schema(found.schema).parquet(f"{path}/data/{found.folder}")


def roll_back(spark: SparkSession, path: str, version: int) -> int:
    """Make a former version current again: a new commit that names its folder."""
    old = _commit(spark, path, version)
    if old.folder not in files.names(spark, f"{path}/data"):
        raise ValueError(f"the rows of version {version} of {path} are deleted")
    return _put(spark, path, current(spark, path), old.folder, old.rows, old.schema, old.note)


def vacuum(spark: SparkSession, path: str, keep: int = 2, unfinished: float = 86_400.0) -> list[str]:
    """Delete the folders that none of the last *keep* commits names, and the commits before them; returns the folders.

    A folder that no commit at all names may belong to a writer at work: it stays until it is *unfinished* seconds old.
    """
    commits = history(spark, path)
    held = {c.folder for c in commits[-keep:]}
    former = {c.folder for c in commits} - held
    old = (time.time() - unfinished) * 1000
    gone = [n for n, changed in files.names(spark, f"{path}/data").items() if n in former or (n not in held and changed < old)]
    for c in commits[:-keep]:
        files.delete(spark, f"{path}/log/{c.version:012}.json")
    for folder in gone:
        files.delete(spark, f"{path}/data/{folder}")
    return gone


def publish_snapshot(df: DataFrame, path: str, zero_cols: Sequence[str] = (), force: bool = False, skip_if_present: str | None = None) -> bool:
    """`publish`, but False and nothing done if the current version has rows and the column *skip_if_present*, unless *force*."""
    if skip_if_present and not force:
        there = current(df.sparkSession, path)
        if there is not None and there.rows and skip_if_present in there.schema.names:
            return False
    publish(df, path, zero_cols)
    return True
