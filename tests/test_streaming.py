import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from adlake.operators.keyed import _execute, read_keyed
from adlake.operators.metrics import window_metrics
from adlake.sources.events import parse_events, read_events_stream
from adlake.streaming import jobs

T = datetime(2024, 1, 1)


def line(i, second, kind="impression", **more):
    ts = (T + timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
    row = {"event_id": i, "ts": ts, "advertiser_id": "a", "campaign_id": "c", "unit_id": "u", "creative_id": "k", "event_type": kind, "spend": 1} | more
    return json.dumps(row)


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_closed_windows_equal_batch(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "1.txt", [line("1", 1), line("2", 9.999), line("3", 14.999), line("4", 15), line("5", 40)])
    raw = read_events_stream(spark, {"path": str(src)}, "text")
    events = parse_events(raw, "UTC").filter("is_valid")
    job = jobs.metrics_job(events, str(tmp_path / "out"), str(tmp_path / "cp"), lambda: spark.createDataFrame([("b", "B")], "advertiser_id string, advertiser_name string"), once=True)
    job.awaitTermination()
    write(src, "2.txt", [line("6", 41)])
    jobs.metrics_job(events, str(tmp_path / "out"), str(tmp_path / "cp"), lambda: spark.createDataFrame([("b", "B")], "advertiser_id string, advertiser_name string"), once=True).awaitTermination()
    got = read_keyed(spark, str(tmp_path / "out"), ["window_start", "creative_id"])
    assert sorted((r.window_start.second, r.impressions, r.advertiser_name) for r in got.collect()) == [(0, 2, "UNKNOWN"), (10, 2, "UNKNOWN")]
    batch = window_metrics(parse_events(spark.read.text(str(src)), "UTC").filter("is_valid")).filter(F.col("window_start") < F.lit(T + timedelta(seconds=40)))
    assert got.select(batch.columns).exceptAll(batch).isEmpty()


def test_late_rows_are_dropped_two_batches_later(spark, tmp_path):
    src = tmp_path / "in"
    run = lambda: jobs.metrics_job(parse_events(read_events_stream(spark, {"path": str(src)}, "text"), "UTC").filter("is_valid"), str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    for name, lines in (("1.txt", [line("1", 1), line("2", 15)]), ("2.txt", [line("3", 16)]), ("3.txt", [line("4", 5)]), ("4.txt", [line("5", 60)])):
        write(src, name, lines)
        run()
    rows = spark.read.parquet(str(tmp_path / "out")).filter(F.second("window_start") == 0)
    assert [r.impressions for r in rows.collect()] == [1]


def test_ods_job_splits_dirty_and_bears_replay(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "1.txt", [line("1", 1), "broken", line("2", 2, creative_id="")])
    raw = read_events_stream(spark, {"path": str(src)}, "text")
    jobs.use_rocksdb(spark)
    for _ in range(2):
        jobs.ods_job(raw, str(tmp_path / "ods"), str(tmp_path / "dirty"), str(tmp_path / "cp"), once=True).awaitTermination()
    assert read_keyed(spark, str(tmp_path / "ods"), ["event_id"]).count() == 1
    assert spark.read.parquet(str(tmp_path / "dirty")).count() == 2


def test_replay_after_a_crash_before_the_commit(spark, tmp_path):
    src, cp = tmp_path / "in", tmp_path / "cp"
    write(src, "1.txt", [line("1", 1), "broken", line("2", 2)])
    raw = read_events_stream(spark, {"path": str(src)}, "text")
    run = lambda checkpoint: jobs.ods_job(raw, str(tmp_path / "ods"), str(tmp_path / "dirty"), str(checkpoint), once=True).awaitTermination()
    run(cp)
    for f in (cp / "commits").glob("*0*"):  # as if the job had died between its sink and the commit: the batch runs again
        f.unlink()
    run(cp)
    assert spark.read.parquet(str(tmp_path / "ods")).count() == 2 and spark.read.parquet(str(tmp_path / "dirty")).count() == 1
    # a job with a new checkpoint begins at batch 0 again and overwrites nothing
    write(src, "2.txt", [line("3", 3)])
    (src / "1.txt").unlink()
    run(tmp_path / "cp2")
    assert sorted(r.event_id for r in read_keyed(spark, str(tmp_path / "ods"), ["event_id"]).collect()) == ["1", "2", "3"]


def test_jdbc_job_over_two_runs(spark, tmp_path):
    url, src = "jdbc:derby:memory:jobs;create=true", tmp_path / "in"
    for table in ("seen", "seen_stage"):
        _execute(spark, url, [f"CREATE TABLE {table} (event_id VARCHAR(20), event_type VARCHAR(20))"], {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    for name, kind in (("1.txt", "click"), ("2.txt", "order")):
        write(src, name, [line("1", 1, kind), line(kind, 2)])
        rows = parse_events(read_events_stream(spark, {"path": str(src)}, "text"), "UTC").select("event_id", "event_type")
        jobs.jdbc_job(rows, url, "seen", "seen_stage", ["event_id"], str(tmp_path / "cp"), once=True).awaitTermination()
    got = spark.read.jdbc(url, "seen").collect()
    assert sorted(tuple(r) for r in got) == [("1", "order"), ("click", "impression"), ("order", "impression")]
