import glob
import os

import pytest
from pyspark.sql import functions as F

from adlake.operators import keyed, ordered, publishing
from adlake.sources import files


def rows(spark, *ids):
    return spark.createDataFrame([(i, f"v{i}") for i in ids], "id int, v string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    publishing.publish(rows(spark, 1, 2), path)
    before = publishing.read_published(spark, path)
    broken = rows(spark, 3, 4, 5).withColumn("v", F.when(F.col("id") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        publishing.publish(broken, path)
    with pytest.raises(ValueError, match="empty"):
        publishing.publish(rows(spark, 3).filter("false"), path)
    assert ids(publishing.read_published(spark, path)) == ids(before) == [1, 2]
    assert len(os.listdir(tmp_path / "t" / "data")) == 1  # nothing is left of the failed ones


def test_readers_of_an_old_version_go_on_and_versions_return(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        publishing.read_published(spark, path)
    assert publishing.publish(rows(spark, 1), path, note={"day": "d1"}) == 1
    old = publishing.read_published(spark, path)
    assert publishing.publish(rows(spark, 2).withColumn("more", F.lit(1)), path) == 2
    assert ids(old) == [1] and ids(publishing.read_published(spark, path)) == [2]
    assert publishing.roll_back(spark, path, 1) == 3
    assert ids(publishing.read_published(spark, path)) == [1] and publishing.read_published(spark, path).columns == ["id", "v"]
    assert [(c.version, c.rows, c.note) for c in publishing.history(spark, path)] == [(1, 1, {"day": "d1"}), (2, 1, {}), (3, 1, {"day": "d1"})]
    assert len(publishing.vacuum(spark, path, keep=1)) == 1 and ids(old) == [1]
    assert [c.version for c in publishing.history(spark, path)] == [3]
    publishing.publish(rows(spark, 4), path)
    with pytest.raises(Exception):
        publishing.roll_back(spark, path, 2)


def test_the_second_of_two_writers_is_told(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publishing.publish(rows(spark, 1), path)
    real = publishing.current

    def overtaken(spark, path):
        seen = real(spark, path)
        if len(publishing.history(spark, path)) == 1:
            monkeypatch.setattr(publishing, "current", real)
            publishing.publish(rows(spark, 2), path)  # the other writer, between this one's look and its commit
        return seen

    monkeypatch.setattr(publishing, "current", overtaken)
    with pytest.raises(publishing.PublicationConflict):
        publishing.publish(rows(spark, 3), path)
    assert ids(publishing.read_published(spark, path)) == [2]
    assert len(os.listdir(tmp_path / "t" / "data")) == 2


def test_vacuum_leaves_writers_at_work_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    publishing.publish(rows(spark, 1), path)
    rows(spark, 9).write.parquet(f"{path}/data/unfinished")
    assert publishing.vacuum(spark, path) == []
    assert publishing.vacuum(spark, path, unfinished=-1) == ["unfinished"] and ids(publishing.read_published(spark, path)) == [1]


def test_a_snapshot_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    publishing.publish_snapshot(rows(spark, *range(50)).mapInArrow(count, "id int, v string"), str(tmp_path / "t"), ["id"])
    assert seen.value == 50


def test_a_file_is_put_once(spark, tmp_path):
    f = str(tmp_path / "a" / "b")
    assert files.put_new(spark, f, "one") and not files.put_new(spark, f, "two")
    assert files.read_small(spark, f) == "one" and list(files.names(spark, str(tmp_path / "a"))) == ["b"] and files.names(spark, str(tmp_path / "none")) == {}


def test_an_older_batch_replayed_stays_older(spark, tmp_path):
    path = str(tmp_path / "log")
    put = lambda v, n: keyed.upsert_batch(spark.createDataFrame([(1, v)], "id int, v string"), path, n)
    for v, n in (("old", 0), ("new", 1), ("old", 0)):
        put(v, n)
    assert [r.v for r in keyed.read_keyed(spark, path, ["id"]).collect()] == ["new"]
    put("newest", 2)
    assert [r.v for r in keyed.read_keyed(spark, path, ["id"]).collect()] == ["newest"]


@pytest.fixture(scope="module")
def table(spark):
    """A third of the rows share one day."""
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, "d0").when(F.col("id") % 101 == 1, None).otherwise(F.concat(F.lit("d"), F.col("id") % 17)).alias("day"), F.col("id").alias("k"), F.hash("id").alias("x")).repartition(5)


def by_file(path):
    return [f for f in sorted(glob.glob(f"{path}/part-*")) if not f.endswith(".crc")]


def test_files_in_order_meet_the_order_of_all_rows(spark, tmp_path, table):
    path = str(tmp_path / "out")
    n = ordered.export_ordered(table, path, ["day"], ["k"], parts=6, rows_per_file=300)
    got = []
    for f in by_file(path):
        got += [tuple(r) for r in spark.read.parquet(f).collect()]
    want = sorted((tuple(r) for r in table.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == want and n == len(by_file(path)) >= 10
    hot = [spark.read.parquet(f).filter("day = 'd0'").count() for f in by_file(path)]
    assert sum(h > 0 for h in hot) >= 3  # the hot day fills several files
    positions = ordered.read_ordered(spark, path)
    assert sorted((r.position, r.day, r.k, r.x) for r in positions.collect()) == [(k + 1, *r) for k, r in enumerate(want)]
    assert "Exchange" not in positions._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")


def test_order_takes_no_single_partition(spark, table):
    plan = ordered.in_order(table, [F.desc("x")], ["k"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan


@pytest.mark.parametrize(("first", "n"), [(1, 1), (1, 3000), (290, 25), (2999, 50), (3001, 5), (700, 900)])
def test_a_slice_reads_only_its_files(spark, tmp_path_factory, table, first, n):
    path = str(tmp_path_factory.getbasetemp() / "slices")
    if not os.path.exists(path):
        ordered.export_ordered(table, path, [F.desc_nulls_last("x")], ["k"], parts=6)
    want = [tuple(r) for r in table.orderBy(F.desc_nulls_last("x"), "k").collect()]
    part = ordered.read_slice(spark, path, first, n)
    assert sorted((r.position, r.day, r.k, r.x) for r in part.collect()) == [(k + 1, *want[k]) for k in range(first - 1, min(3000, first + n - 1))]
    assert len(part.inputFiles()) <= max(1, n // 400 + 2)


def test_exports_as_text_and_of_nothing(spark, tmp_path, table):
    ordered.export_ordered(table, str(tmp_path / "csv"), ["k"], parts=3, fmt="csv", header=True)
    lines = []
    for f in by_file(tmp_path / "csv"):
        lines += open(f).read().splitlines()[1:]
    assert [int(x.split(",")[1]) for x in lines] == list(range(3000))
    ordered.export_ordered(table.filter("false"), str(tmp_path / "none"), ["k"])
    assert ordered.read_ordered(spark, str(tmp_path / "none")).count() == 0 and ordered.read_slice(spark, str(tmp_path / "none"), 1, 5).count() == 0


def test_folders_of_queries_are_cleaned_up(spark):
    from adlake.plans import registry

    files.clean_up(spark)
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(files.names(spark, base))
    for name in ("ordered_creatives", "published_rollback", "stream_tail"):
        registry.queries()[name](spark, "/root/testdata/sf0.001").count()
    assert len(set(files.names(spark, base)) - before) >= 4
    assert files.clean_up(spark) >= 4 and set(files.names(spark, base)) == before and files.clean_up(spark) == 0
