import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adlake.operators import attribution, deltas, keyed, publishing, retract, sketches

SCHEMA = "id int, day string, k string, x decimal(10,2), user string"
FACTS = retract.Facts(("day", "k"), {"x_sum": "x", "big": "IF(x > 5, 1, 0)"}, {"x_max": "x"}, {"users": "user", "values": "x"})


def random_rows(r, n):
    return {i: (i, f"d{r.randrange(3)}", r.choice(("a", "b", None)), r.choice((None, Decimal(r.randrange(-9, 10)))), r.choice((None, "u", "v", "w"))) for i in range(n)}


def change(r, rows):
    """Some rows deleted, some changed, some new."""
    new = dict(rows)
    for i in r.sample(sorted(new), len(new) // 3):
        if r.random() < 0.4:
            del new[i]
        else:
            new[i] = random_rows(r, 1)[0][1:]
            new[i] = (i, *new[i])
    top = max(new, default=0)
    for i in range(top + 1, top + 1 + r.randrange(8)):
        new[i] = (i, *random_rows(r, 1)[0][1:])
    return new


def refreshed(spark, rows):
    """The full refresh."""
    df = spark.createDataFrame(list(rows.values()), SCHEMA)
    return {
        (r.day, r.k): tuple(r)[2:]
        for r in df.groupBy("day", "k").agg(F.count("*"), F.sum("x"), F.sum(F.when(F.col("x") > 5, 1).otherwise(0)), F.max("x"), F.countDistinct("user"), F.countDistinct("x")).collect()
    }


def followed(spark, path):
    return {(r.day, r.k): tuple(r)[2:] for r in retract.read_facts(spark, path, FACTS).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_facts_follow_random_changes(spark, tmp_path, seed):
    r, path = random.Random(seed), str(tmp_path / "facts")
    rows, batches = {}, []
    for n in range(5):
        new = random_rows(r, 60) if n == 0 else change(r, rows) if n < 4 else {}
        old_df, new_df = (spark.createDataFrame(list(x.values()), SCHEMA) for x in (rows, new))
        batches.append(keyed.changelog_between(old_df, new_df, ["id"]))
        retract.log_changes(batches[-1], path, FACTS, n)
        rows = new
        if n in (1, 2):
            assert retract.fold(spark, path, FACTS) == n
        if n == 2:  # replays of a folded and of an open batch
            retract.log_changes(batches[1], path, FACTS, 1)
        if n == 3:
            retract.log_changes(batches[3], path, FACTS, 3)
            plan = deltas.read(spark, path)._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [NOT" in plan or "PartitionFilters: [(NOT" in plan  # folders of folded batches are not read
        assert followed(spark, path) == refreshed(spark, rows)
    assert followed(spark, path) == {} and retract.fold(spark, path, FACTS) == 3 and followed(spark, path) == {}
    assert retract.fold(spark, path, FACTS) is None
    assert len(os.listdir(tmp_path / "facts" / "base" / "data")) == 2


def test_a_delta_is_small_and_an_unfinished_batch_is_not_folded(spark, tmp_path):
    path = str(tmp_path / "facts")
    big = spark.range(5000).select(F.col("id").cast("int"), F.lit("d").alias("day"), F.lit("a").alias("k"), F.lit(1).cast("decimal(10,2)").alias("x"), F.lit("u").alias("user"), F.lit("+I").alias("row_kind"))
    assert retract.delta(big, FACTS).count() == 4  # the keys, and the one value of each of the three
    both = big.unionByName(big.withColumn("row_kind", F.lit("-D")))
    assert retract.delta(both, FACTS).count() == 0
    retract.log_changes(big, path, FACTS, 0)
    retract.log_changes(big, path, FACTS, 1)
    os.remove(f"{path}/log/run=batch/batch=1/_SUCCESS")
    retract.fold(spark, path, FACTS)
    assert publishing.current(spark, f"{path}/base").note == {"folded": {"batch": 0}}
    assert followed(spark, path)["d", "a"][0] == 10_000


def test_streamed_changes_of_two_runs(spark, tmp_path):
    path, feed = str(tmp_path / "facts"), str(tmp_path / "feed")
    rows = random_rows(random.Random(3), 40)
    df = spark.createDataFrame(list(rows.values()), SCHEMA).withColumn("row_kind", F.lit("+I"))
    for k, part in enumerate(("id < 15", "id >= 15")):
        df.filter(part).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(df.schema).parquet(feed)
        retract.retract_job(stream, path, FACTS, str(tmp_path / "cp"), once=True).awaitTermination()
        if k == 0:
            retract.fold(spark, path, FACTS)
    assert followed(spark, path) == refreshed(spark, rows)
    # a job with its own checkpoint numbers its batches itself
    more = spark.createDataFrame([(99, "d9", "a", Decimal(1), "u")], SCHEMA).withColumn("row_kind", F.lit("+I"))
    retract.log_changes(more, path, FACTS, 0, "other")
    assert followed(spark, path) == refreshed(spark, rows | {99: (99, "d9", "a", Decimal(1), "u")})


def test_merged_sketches_count_users_once(spark):
    r = random.Random(5)
    rows = [(k % 24, f"u{r.randrange(300)}") for k in range(3000)] + [(3, None), (4, "")]
    df = spark.createDataFrame(rows, "hour int, user string")
    by_hour = sketches.sketch_by(df, ["hour"], "user")
    exact = {h: len({u for x, u in rows if x == h and u}) for h in range(24)}
    assert {x.hour: x.n for x in by_hour.select("hour", sketches.distinct_count().alias("n")).collect()} == exact
    whole = sketches.roll_up(by_hour, [F.lit(1).alias("all")]).select(sketches.distinct_count()).first()[0]
    assert whole == len({u for _, u in rows if u})
    # beyond its size a sketch estimates, within a few of its standard errors
    many = spark.range(200_000).select((F.col("id") % 50).alias("hour"), (F.col("id") % 60_000).cast("string").alias("user"))
    got = sketches.roll_up(sketches.sketch_by(many, ["hour"], "user"), [F.lit(1).alias("all")]).select(sketches.distinct_count(), F.length("sketch")).first()
    assert abs(got[0] - 60_000) < 4 * 60_000 / 64 and got[1] < 8 * 4096 + 100


def test_stored_sketches_follow_batches_late_events_and_replays(spark, tmp_path):
    r, path = random.Random(9), str(tmp_path / "reach")
    reach = sketches.Reach(["media"], "user", "at", "1 hour")
    start = datetime(2024, 3, 1)
    rows = [(start + timedelta(minutes=r.randrange(20 * 24 * 60)), r.choice("ab"), f"u{r.randrange(150)}") for _ in range(2500)]
    rows += [(None, "a", "lost"), (start, "a", None), (start, "b", "")]
    r.shuffle(rows)  # each batch has events of all days: all but the first are late
    schema = "at timestamp, media string, user string"
    for n in range(3):
        sketches.log_reach(spark.createDataFrame(rows[n * 500 : (n + 1) * 500], schema), path, reach, n)
        if n == 1:
            assert sketches.fold_reach(spark, path, reach) is not None
            assert sketches.fold_reach(spark, path, reach) is None
    sketches.log_reach(spark.createDataFrame(rows[:500], schema), path, reach, 0)  # folded already
    sketches.log_reach(spark.createDataFrame(rows[1000:1500], schema), path, reach, 2)
    feed = str(tmp_path / "feed")
    spark.createDataFrame(rows[1500:], schema).repartition(2).write.parquet(feed)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
    sketches.reach_job(stream, path, reach, str(tmp_path / "cp"), once=True).awaitTermination()

    def users(keep):
        return len({u for t, m, u in rows if t and u and keep(t, m)})

    whole = {x.media: x.n for x in sketches.reached(spark, path, reach, ["media"]).select("media", sketches.distinct_count().alias("n")).collect()}
    assert whole == {m: users(lambda t, x, m=m: x == m) for m in "ab"}
    span = sketches.reached(spark, path, reach, [F.lit(1).alias("all")], "2024-03-03 05:00:00", "2024-03-04 00:00:00").select(sketches.distinct_count()).first()[0]
    assert span == users(lambda t, m: datetime(2024, 3, 3, 5) <= t < datetime(2024, 3, 4))
    daily = sketches.reached(spark, path, reach, ["media", F.to_date("window_start").alias("day")]).filter("day <> '2024-03-05'")
    week = sketches.trailing(daily, ["media"], "day", 3).select("media", "day", sketches.distinct_count().alias("n")).collect()
    gone = datetime(2024, 3, 5).date()
    assert len(week) == daily.count() and all(x.day != gone for x in week)
    for x in week:
        assert x.n == users(lambda t, m, x=x: m == x.media and t.date() != gone and x.day - timedelta(days=2) <= t.date() <= x.day)


def test_banded_candidates_equal_the_join_and_deal_a_hot_user(spark):
    from test_attribution import SCHEMA as EVENTS
    from test_attribution import event

    t = datetime(2024, 3, 1)
    rows = [event(f"b{k:04}", "click" if k % 2 else "order", t + timedelta(hours=k), "bot", gmv=1) for k in range(600)]
    rows += [event(f"s{k}", ("click", "order")[k % 2], t + timedelta(days=k * 7 % 50), f"u{k % 5}", gmv=1) for k in range(60)] + [event("n", "order", t, None), event("m", "click", t, None)]
    df = spark.createDataFrame(rows, EVENTS)
    for lookback in ("30 days", "3 days"):
        want = attribution.attribution_candidates(df, lookback)
        for hot in (10_000, 20):
            got = attribution.attribution_candidates(df, lookback, "banded", hot).select(want.columns)
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == want.count()
    orders, clicks, _ = attribution._sides(df, "3 days")
    orders, clicks, _ = attribution._banded(orders, clicks, "3 days", 10)
    largest = orders.groupBy("user_id", "order_advertiser_id", "_band", "_part").count().agg(F.max("count")).first()[0]
    assert orders.filter("user_id = 'bot'").count() == 300 and largest <= 20
    # a click is in two bands, and in each part of a band that is dealt
    assert clicks.filter("_user <> 'bot'").groupBy("touch_event_id").count().agg(F.max("count")).first()[0] == 2
