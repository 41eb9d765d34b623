"""Distinct users of the registered queries are counts, not estimates, above the size of a sketch."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from adlake.operators import sketches
from adlake.plans import registry

SF = "/root/testdata/sf0.001"


def test_reach_is_exact_above_a_sketch(spark):
    n = F.col("id")
    day = F.expr("date_add(DATE'2024-03-01', CAST(element_at(array(0, 1, 2, 8, 9, 20), CAST(id % 6 + 1 AS INT)) AS INT))")
    user = F.when(n % 1000 != 0, F.concat(F.lit("u"), (n * 7 % 11_003).cast("string")))
    rows = spark.range(90_000).select(
        n.cast("string").alias("event_id"), F.expr("make_interval(0, 0, 0, 0, CAST(id % 24 AS INT))").alias("i"), day.alias("d"), F.expr("concat('adv_', id DIV 6 % 2)").alias("advertiser_id"),
        user.alias("user_id"), F.when(n % 10 == 9, "order").otherwise("click").alias("event_type"),
    )
    o = registry.offline(spark, SF)
    o.events = rows.select("event_id", (F.col("d").cast("timestamp") + F.col("i")).alias("event_ts"), F.col("d").cast("string").alias("event_date"), "advertiser_id", "user_id", "event_type")
    seen: dict = {}
    for r in o.events.filter("event_type = 'click'").collect():
        seen.setdefault((r.advertiser_id, date.fromisoformat(r.event_date)), set()).add(r.user_id)
    week = lambda a, d: set().union(*(seen.get((a, d - timedelta(days=k)), set()) for k in range(7)))
    want = {(a, str(d), len(users - {None}), len(week(a, d) - {None})) for (a, d), users in seen.items()}
    got = [(r.advertiser_id, r.day, r.users, r.users_7d) for r in registry._reach(o).collect()]
    assert sorted(got) == sorted(want)
    assert max(w[2] for w in want) > 4096 and any(w[3] > w[2] > 4096 for w in want)


def test_trailing_counts_of_users_who_come_again_and_of_none(spark):
    d = lambda k: date(2024, 3, k)
    rows = [("a", d(1), "u"), ("a", d(3), "u"), ("a", d(4), None), ("a", d(5), "v"), ("a", d(6), "w"), ("a", d(20), None), ("b", d(5), "u")]
    daily = spark.createDataFrame(rows, "k string, day date, value string")
    got = {(r.k, r.day.day): (r.n, r.n_3d) for r in sketches.trailing_counts(daily, ["k"], "day", 3, "n").collect()}
    assert got == {("a", 1): (1, 1), ("a", 3): (1, 1), ("a", 4): (0, 1), ("a", 5): (1, 2), ("a", 6): (1, 2), ("a", 20): (0, 0), ("b", 5): (1, 1)}


def test_different_fraud_users_are_exact_above_a_sketch(spark):
    o = registry.offline(spark, SF)
    n = F.col("id")
    # each of 9,000 users is abnormal in two windows of the day
    o.clicks = spark.range(18_000).select(
        n.cast("string").alias("event_id"), F.lit("2024-03-01").alias("stat_date"), (F.lit("2024-03-01").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, CAST(id DIV 9000 AS INT))")).alias("event_time"),
        F.concat(F.lit("u"), n % 9000).alias("user_id"), F.lit("adv_1").alias("advertiser_id"), F.lit("A").alias("advertiser_name"), F.lit("weibo").alias("media"), F.lit(1).cast("decimal(18,4)").alias("spend"),
        F.lit(1).alias("click_cnt_1h"), F.lit(3).alias("click_cnt_1d"), F.lit(1).alias("impression_cnt_1m"), F.lit(0).cast("decimal(10,6)").alias("ctr_deviation"),
    )
    assert [tuple(r) for r in registry._QUERIES["fraud_daily_users"](o).collect()] == [("2024-03-01", "adv_1", 18_000, 9_000)]
