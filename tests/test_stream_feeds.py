"""Feeds of the streaming queries are written and summed by all tasks, and each part is one micro-batch."""

import pytest
from pyspark.sql import functions as F

from adlake.operators import attribution
from adlake.plans import registry
from adlake.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture
def seen(monkeypatch):
    """What the queries hand to their jobs, and the folders they make."""
    kept = {"folders": {}, "streams": []}

    def folder(spark, name, make=jobs.shared_folder):
        kept["folders"][name] = path = make(spark, name)
        return path

    monkeypatch.setattr(jobs, "shared_folder", folder)
    for name in ("metrics_job", "final_attribution_job"):

        def job(stream, *args, run=getattr(jobs, name), **more):
            kept["streams"].append(stream)
            return run(stream, *args, **more)

        monkeypatch.setattr(jobs, name, job)
    return kept


def files_by_batch(spark, checkpoint):
    """Number of the feed's files by micro-batch."""
    lines = spark.read.text(f"{checkpoint}/sources/0").filter("value LIKE '{%'")
    return [r["n"] for r in lines.selectExpr("CAST(get_json_object(value, '$.batchId') AS INT) AS b").groupBy("b").count().orderBy("b").selectExpr("count AS n").collect()]


def test_attribution_is_one_job_whose_events_pass_no_single_task(spark, seen):
    o = registry.offline(spark, SF)
    got = registry._stream_final_attribution(o)
    assert files_by_batch(spark, seen["folders"]["offsets"]) == [1, 1, 1] and len(seen["streams"]) == 1
    # the feed has a row for each part; the events are read where they are
    assert spark.read.parquet(seen["folders"]["feed"]).count() == 3
    last = o.events.filter("event_type IN ('order', 'click')").agg(F.max("event_ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    want = attribution.last_touch(o.dwd).filter(F.col("outcome_time") < F.lit(last)).select(got.columns)
    assert got.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_metrics_feeds_are_written_and_summed_by_all_tasks(spark, seen):
    for query in (registry._late_dropped, registry._restarted):
        o = registry.offline(spark, SF)
        o.events = o.events.repartition(4, "event_id")
        got, want = query(o), o.metrics_10s
        assert files_by_batch(spark, seen["folders"]["offsets"]) == [4, 4, 4]
        # all windows but those that the watermark has not closed
        assert got.exceptAll(want).isEmpty() and 0 < want.exceptAll(got).count() < 5
    assert all("RepartitionByExpression" in s._jdf.queryExecution().analyzed().toString() for s in seen["streams"])
