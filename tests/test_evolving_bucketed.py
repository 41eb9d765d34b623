import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators import bucketed, evolving, keyed
from adlake.sources import events


def changes(spark, *rows):
    return spark.createDataFrame([(op, seq, row if isinstance(row, str) or row is None else json.dumps(row)) for op, seq, row in rows], "op string, seq long, row string")


def current(spark, path):
    return {r.id: r.asDict(recursive=True) for r in evolving.read_current(spark, path, ["id"]).collect()}


def test_columns_are_added_and_widened_between_batches_of_a_stream(spark, tmp_path):
    feed, log, cp = (str(tmp_path / n) for n in ("feed", "log", "cp"))
    batches = [
        [("r", 1, {"id": 1, "n": 5, "s": None}), ("r", 2, {"id": 2, "n": 6})],
        [("u", 3, {"id": 1, "n": 5.25, "s": "x", "new": True})],
        [("u", 4, {"id": 2, "n": "six", "o": {"a": 1}}), ("c", 5, {"id": 3, "n": 7})],
        [("u", 6, {"id": 3, "n": 8, "o": {"a": 1.5, "b": [1]}}), ("d", 7, {"id": 1})],
    ]
    versions = []
    for rows in batches:
        changes(spark, *rows).coalesce(1).write.mode("append").json(feed)
        stream = spark.readStream.schema("op string, seq long, row string").json(feed)
        evolving.evolving_job(stream, log, cp, once=True).awaitTermination()
        versions.append(len(evolving.schemas(spark, log)))
        if len(versions) == 2:
            assert {i: str(r["n"]) for i, r in current(spark, log).items()} == {1: "5.250000", 2: "6.000000"}
    assert versions == [1, 2, 3, 4]
    got = current(spark, log)
    assert {i: (r["n"], r["s"], r["new"]) for i, r in got.items()} == {2: ("six", None, None), 3: ("8", None, None)}
    assert got[3]["o"] == {"a": pytest.approx(1.5), "b": [1]} and float(got[2]["o"]["a"]) == 1 and got[2]["o"]["b"] is None
    old = {r.seq: r.n for r in evolving.read_changes(spark, log).collect()}
    assert old[1] == "5" and old[3] == "5.25" and old[7] is None


def test_a_batch_that_brings_nothing_new_keeps_the_version_and_replays_count_once(spark, tmp_path):
    log = str(tmp_path / "log")
    for n, rows in ((0, [("r", 1, {"id": 1, "x": 1.5})]), (1, [("u", 2, {"id": 1, "x": 2})]), (1, [("u", 2, {"id": 1, "x": 2})]), (2, [("u", 3, "no object"), ("u", 4, None), ("u", 5, "[1]")])):
        evolving.log_changes(changes(spark, *rows), log, n)
    assert list(evolving.schemas(spark, log)) == [1] and evolving.read_changes(spark, log).filter("seq = 2").count() == 1
    assert float(current(spark, log)[1]["x"]) == 2
    evolving.log_changes(changes(spark).limit(0), str(tmp_path / "none"), 0)
    with pytest.raises(FileNotFoundError):
        evolving.read_changes(spark, str(tmp_path / "none"))


def test_no_type_narrows():
    s = T.StructType.fromDDL
    assert evolving.merged(s("a bigint, b double"), s("a decimal(5,2), b bigint, c void")) == s("a decimal(28,6), b double")
    assert evolving.merged(s("a decimal(28,6)"), s("a decimal(38,10)")) == s("a double")
    assert evolving.merged(s("a boolean, d array<bigint>"), s("a bigint, d array<string>, e decimal(20,0)")) == s("a string, d array<string>, e decimal(28,6)")
    assert evolving.merged(s("a string"), s("a bigint")) == s("a string")


def test_two_writers_of_the_schema_log(spark, tmp_path, monkeypatch):
    log, s = str(tmp_path / "log"), T.StructType.fromDDL
    evolving.admit(spark, log, s("a bigint"))
    real, first = evolving.files.put_new, []

    def overtaken(spark, file, text):
        if not first:
            first.append(1)
            real(spark, file, s("a bigint, other string").json())
        return real(spark, file, text)

    monkeypatch.setattr(evolving.files, "put_new", overtaken)
    version, schema = evolving.admit(spark, log, s("a bigint, mine double"))
    assert version == 3 and schema == s("a bigint, other string, mine double")


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Exchange ")


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        make = lambda name, df, n=4: bucketed.write_bucketed(df, f"bucketed_{name}", ["k", "d"], n, str(tmp_path / name))
        rows = spark.range(500).select((F.col("id") % 50).alias("k"), F.concat(F.lit("d"), F.col("id") % 10).alias("d"), F.col("id").alias("v")).dropDuplicates(["k", "d"])
        a, b = make("a", rows), make("b", rows.withColumn("v", F.col("v") + (F.col("k") == 3).cast("int")))
        for plain, stored in (
            (keyed.reconcile(rows, b, ["k", "d"], ["v"]), keyed.reconcile(a, b, ["k", "d"], ["v"])),
            (keyed.changelog_between(rows, b, ["k", "d"]), keyed.changelog_between(a, b, ["k", "d"])),
            (rows.groupBy("k", "d").count(), a.groupBy("k", "d").count()),
        ):
            assert exchanges(stored) == 0 and exchanges(plain) > 0
            assert sorted(map(str, plain.collect())) == sorted(map(str, stored.collect()))
        assert len([f for f in (tmp_path / "a").iterdir() if f.name.startswith("part-")]) <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


class Reader:
    """Stands for a session without Kafka's jar: what a stream was asked for."""

    def __init__(self):
        self.asked, self.readStream = {}, self

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked |= options
        return self

    def option(self, key, value):
        self.asked[key] = value
        return self

    def load(self, *path):
        self.asked["path"] = path
        return self

    def select(self, *columns):
        return self


def test_kafka_is_asked_for_start_and_group(spark):
    r = Reader()
    events.read_events_stream(r, {"kafka.bootstrap.servers": "b:9092", "subscribe": "ods", "kafka.group.id": "g"}, start="latest")
    assert r.asked == {"format": "kafka", "kafka.bootstrap.servers": "b:9092", "subscribe": "ods", "kafka.group.id": "g", "startingOffsets": "latest", "path": ()}
    r = Reader()
    events.read_events_stream(r, {"subscribe": "ods"})
    assert r.asked["startingOffsets"] == "earliest"
