"""A change feed whose columns grow and widen while it runs.

The feed's rows are JSON texts.  Each micro-batch tells the types it has (one aggregate over the batch); a schema log takes them in: new columns
are added, numbers widen to larger numbers, what fits nothing else becomes text, and no type ever narrows.  A batch is
written with the schema of its time, and reading casts every batch to the newest one, so no file is written again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from adlake.operators.keyed import _first_written, latest_by_key
from adlake.sources import files

#: Numbers with a fraction; those that do not fit are doubles.
FRACTION = T.DecimalType(28, 6)
_WIDER = [T.BooleanType(), T.LongType(), FRACTION, T.DoubleType()]


def _plain(kind: T.DataType) -> T.DataType | None:
    """The type that a JSON value's type is kept as; None if it says nothing."""
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.DecimalType):
        if kind.scale == 0 and kind.precision <= 18:
            return T.LongType()
        return FRACTION if kind.scale <= FRACTION.scale and kind.precision - kind.scale <= FRACTION.precision - FRACTION.scale else T.DoubleType()
    if isinstance(kind, T.StructType):
        return merged(T.StructType(), kind)
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType) or T.StringType())
    return T.StringType() if isinstance(kind, (T.VariantType, T.StringType)) else kind


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text if there is no other."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    numbers = _WIDER[1:]
    return max(a, b, key=numbers.index) if a in numbers and b in numbers else T.StringType()


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """*old* with the further and wider columns of *new*."""
    fields = {f.name: f.dataType for f in old}
    for f in new:
        kind = _plain(f.dataType)
        if kind is not None:
            fields[f.name] = widened(fields[f.name], kind) if f.name in fields else kind
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])


def types_of(batch: DataFrame, column: str = "row") -> T.StructType:
    """The columns and types that the JSON objects in *column* have; texts that are no objects say nothing."""
    value = F.try_parse_json(column)
    told = batch.filter(F.schema_of_variant(value).startswith("OBJECT<")).agg(F.schema_of_variant_agg(value)).first()[0]
    return T.StructType() if told in (None, "VOID", "OBJECT<>") else T.StructType.fromDDL(told.replace("OBJECT<", "STRUCT<"))


def schemas(spark: SparkSession, path: str) -> dict[int, T.StructType]:
    """All versions of the feed's schema."""
    numbers = sorted(int(n.removesuffix(".json")) for n in files.names(spark, f"{path}/_schema") if n.endswith(".json") and not n.startswith("."))
    return {n: T.StructType.fromJson(json.loads(files.read_small(spark, f"{path}/_schema/{n:06}.json"))) for n in numbers}


def admit(spark: SparkSession, path: str, seen: T.StructType, tries: int = 10) -> tuple[int, T.StructType]:
    """The version and schema that hold what was *seen*; a new version if the last one does not."""
    for _ in range(tries):
        known = schemas(spark, path)
        version, now = max(known.items(), default=(0, T.StructType()))
        wanted = merged(now, seen)
        if version and wanted == now:
            return version, now
        if files.put_new(spark, f"{path}/_schema/{version + 1:06}.json", wanted.json()):
            return version + 1, wanted
    raise RuntimeError(f"other writers change the schema of {path} all the time")


def log_changes(batch: DataFrame, path: str, batch_id: int, run: str = "batch") -> None:
    """Write a batch of changes - op, seq and row (a JSON object) - with the schema that it needs; a replay overwrites itself.

    Rows that are no objects have null columns; before the first object there are no columns, and such batches are left out.
    """
    spark, seen = batch.sparkSession, types_of(batch)
    if not seen.fields and not schemas(spark, path):
        return
    version, schema = admit(spark, path, seen)
    written = F.timestamp_micros(F.lit(_first_written(spark, f"{path}/_written/{run}-{batch_id}")))
    rows = batch.select("op", "seq", F.from_json("row", schema, {"mode": "PERMISSIVE"}).alias("row"), written.alias("_written"))
    rows.write.mode("overwrite").parquet(f"{path}/version={version}/run={run}/batch={batch_id}")


def _cast(value, old: T.DataType, new: T.DataType):
    """A value of an earlier version's type as one of the newest."""
    if old == new:
        return value
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        had = {f.name: f.dataType for f in old}
        fields = [_cast(value[f.name], had[f.name], f.dataType).alias(f.name) if f.name in had else F.lit(None).cast(f.dataType).alias(f.name) for f in new]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: _cast(x, old.elementType, new.elementType))
    if isinstance(new, T.StringType) and isinstance(old, (T.StructType, T.ArrayType)):
        return F.to_json(value)
    if isinstance(new, T.StringType) and isinstance(old, T.DecimalType):  # without the zeros of the scale
        return F.regexp_replace(value.cast("string"), r"\.?0+$", "")
    return value.cast(new)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes of the log in the newest schema: op, seq, the columns, and _written."""
    known = schemas(spark, path)
    if not known:
        raise FileNotFoundError(f"no change is logged at {path}")
    newest = known[max(known)]
    parts = []
    held = files.names(spark, path)
    for version, schema in known.items():
        if f"version={version}" not in held:
            continue
        fixed = T.StructType([T.StructField("op", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("row", schema), T.StructField("_written", T.TimestampType())])
        rows = spark.read.schema(fixed).option("recursiveFileLookup", True).parquet(f"{path}/version={version}")
        had = {f.name: f.dataType for f in schema}
        columns = [_cast(F.col("row")[f.name], had[f.name], f.dataType).alias(f.name) if f.name in had else F.lit(None).cast(f.dataType).alias(f.name) for f in newest]
        parts.append(rows.select("op", "seq", *columns, "_written"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_current(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The rows of the table as of the last change of each key (by seq, then by the time it was written); deleted ones are gone."""
    rows = read_changes(spark, path).dropna(subset=list(keys))
    return latest_by_key(rows, keys, ["seq", "_written"]).filter("op <> 'd'").drop("op", "seq", "_written")


def evolving_job(changes: DataFrame, path: str, checkpoint: str, once: bool = False, every: str = "10 seconds") -> StreamingQuery:
    """A stream of changes (op, seq, row) into the log."""
    from adlake.streaming.jobs import _start, query_id

    return _start(changes, lambda batch, n: log_changes(batch, path, n, query_id(batch.sparkSession, checkpoint)), checkpoint, "append", once, every)
