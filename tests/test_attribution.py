from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adlake.operators import attribution as A
from adlake.streaming import jobs, last_click

T = datetime(2024, 3, 1, 12)
SCHEMA = "event_id string, event_ts timestamp, event_date string, advertiser_id string, advertiser_name string, campaign_id string, campaign_name string, creative_id string, user_id string, event_type string, spend decimal(18,4), gmv decimal(18,2), order_id string"


def event(i, kind, ts, user="u", adv="a", gmv=0):
    return (i, ts, ts.strftime("%Y-%m-%d"), adv, "A", "c", "C", "k", user, kind, Decimal(1), Decimal(gmv), f"o{i}" if kind == "order" else None)


CASES = [
    (timedelta(0), "30分钟直接归因"),
    (timedelta(minutes=30, seconds=59), "30分钟直接归因"),
    (timedelta(minutes=31), "1日间接归因"),
    (timedelta(minutes=1440), "1日间接归因"),
    (timedelta(minutes=1441), "3日间接归因"),
    (timedelta(minutes=4320), "3日间接归因"),
    (timedelta(minutes=4321), "7日间接归因"),
    (timedelta(minutes=10080), "7日间接归因"),
    (timedelta(minutes=10081), "30日间接归因"),
    (timedelta(days=30), "30日间接归因"),
    (timedelta(days=30, milliseconds=1), "自然订单"),
    (timedelta(seconds=-1), "自然订单"),
]


@pytest.fixture(scope="module")
def events(spark):
    rows = []
    for k, (lag, _) in enumerate(CASES):
        rows += [event(f"o{k}", "order", T, f"u{k}", gmv=10), event(f"c{k}", "click", T - lag, f"u{k}")]
    rows += [event("x1", "order", T, "x", gmv=5), event("x2", "click", T - timedelta(hours=1), "x"), event("x3", "click", T - timedelta(minutes=1), "x")]
    rows += [event("y1", "order", T, "y", gmv=5), event("y2", "click", T, "y"), event("y3", "click", T, "y")]
    rows += [event("z1", "order", T, "z", gmv=5), event("z2", "click", T, "z", adv="other")]
    rows += [event("n1", "order", T, None, gmv=5), event("n2", "click", T, None)]
    return spark.createDataFrame(rows, SCHEMA)


def detail(events):
    c = A.attribution_candidates(events)
    return {r.order_event_id: r for r in A.order_detail(c, A.touchpoints(c)).collect()}


def test_lag_limits(events):
    got = detail(events)
    assert [got[f"o{k}"].attribution_period for k in range(len(CASES))] == [p for _, p in CASES]
    assert got["o0"].lag_minutes == 0 and got["o1"].lag_minutes == 30


def test_last_click_ties_and_strangers(events):
    got = detail(events)
    assert got["x1"].click_event_id == "x3" and got["y1"].click_event_id == "y3"
    assert got["z1"].attribution_type == "natural" and got["n1"].attribution_type == "natural"


def test_one_row_per_order_and_sums(events):
    c = A.attribution_candidates(events)
    d = A.order_detail(c, A.touchpoints(c))
    orders = events.filter("event_type = 'order'")
    assert d.count() == orders.count()
    s = A.attribution_summary(d).agg(F.sum("orders"), F.sum("attributed_gmv")).first()
    assert tuple(s) == tuple(orders.agg(F.count("*"), F.sum("gmv")).first())
    weights = A.touchpoints(c).filter("conversion_event_id = 'x1'").select("touchpoint_seq", "attributed_gmv").collect()
    assert {(r[0], int(r[1])) for r in weights} == {(1, 5), (2, 0)}


def test_detail_without_join_equals_join(events):
    c = A.attribution_candidates(events)
    joined = A.order_detail(c, A.touchpoints(c))
    for other in (A.order_detail(c), A.order_detail(A.last_touch(events))):
        assert joined.exceptAll(other).isEmpty() and other.exceptAll(joined).isEmpty()


def test_sliced_and_window_forms_equal_join_form(events):
    b = A.last_touch(events, strategy="join")
    for a in (A.last_touch(events), A.last_touch(events, hot_rows=2), A.last_touch(events, strategy="window"), *(A.last_touch(events, strategy="sliced", slice_width=w) for w in ("1 second", "1 hour", "40 days"))):
        assert a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty()


def test_names_looked_up_after_attribution(spark, events):
    names = ("advertiser_name", "campaign_name")
    adv, cmp = spark.createDataFrame([("a", "A")], "advertiser_id string, advertiser_name string"), spark.createDataFrame([("x", "X")], "campaign_id string, campaign_name string")
    rows = events.withColumn("campaign_name", F.lit("UNKNOWN")).withColumn("advertiser_name", F.when(F.col("advertiser_id") == "a", "A").otherwise("UNKNOWN"))
    want = A.last_touch(rows)
    got = A.name_touches(A.last_touch(rows.drop(*names)), adv, cmp).select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_user_with_most_rows(spark):
    """Clicks and orders of one user by the second; both forms agree, also at the end of the look-back."""
    rows = [event(f"{k:05}", ("click", "order", "click")[k % 3], T + timedelta(seconds=k // 2), "bot", gmv=1) for k in range(6000)]
    rows += [event("late", "order", T + timedelta(seconds=2999, days=30), "bot"), event("later", "order", T + timedelta(seconds=3000, days=30), "bot")]
    df = spark.createDataFrame(rows, SCHEMA)
    a = A.last_touch(df, slice_width="7 minutes", hot_rows=1000)
    plan = a._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan and "LeftAnti" in plan and "_slice" not in A.last_touch(df)._jdf.queryExecution().optimizedPlan().toString()
    b = A.last_touch(df.filter("event_id > '05000' OR event_type = 'order'"), strategy="join").select(a.columns)
    recent = "outcome_event_id > '05010'"
    assert a.filter(recent).exceptAll(b.filter(recent)).isEmpty() and b.filter(recent).exceptAll(a.filter(recent)).isEmpty()
    got = {r.outcome_event_id: r.touch_event_id for r in a.filter("outcome_event_id LIKE 'late%'").collect()}
    assert got == {"late": "05999", "later": None}


def test_streamed_attribution_equals_batch(spark, tmp_path):
    """Clicks before, with and after their order, over restarts of the stream; an order needs no watermark to be there."""
    m = lambda n: T + timedelta(minutes=n)
    batches = [
        [event("c1", "click", m(0), "u"), event("c2", "click", m(1), "u"), event("q", "order", m(1), "w", gmv=5)],
        [event("o1", "order", m(5), "u", gmv=5), event("o2", "order", m(4), "u", gmv=5), event("n", "click", m(5), None)],
        [event("c3", "click", m(3), "u"), event("o3", "order", m(2), "u", gmv=5), event("c0", "click", m(-1), "u"), event("o4", "order", m(6), None, gmv=5)],
    ]
    src, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
        jobs.attribution_job(stream, log, checkpoint, once=True).awaitTermination()
    got, want = jobs.settled_attribution(spark, log), A.last_touch(spark.read.parquet(src))
    want = want.select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert {r.outcome_event_id: r.touch_event_id for r in got.collect()} == {"q": None, "o1": "c3", "o2": "c3", "o3": "c2", "o4": None}


def feed(spark, tmp_path, *batches, **options):
    """Runs the keyed-state job after each batch of rows; what it wrote, and the last run."""
    src, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))
    job = None
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
        job = jobs.final_attribution_job(stream, log, checkpoint, once=True, **options)
        job.awaitTermination()
    return spark.read.parquet(log).drop("run", "batch", "_written", "_seq"), spark.read.parquet(src), checkpoint


def test_each_order_has_one_final_row(spark, tmp_path):
    """Clicks that come after their order, ties, an order that waits over restarts, null keys, and a look-back that has passed."""
    m = lambda n: T + timedelta(minutes=n)
    got, rows, _ = feed(
        spark, tmp_path,
        [event("o1", "order", m(5), gmv=5), event("c1", "click", m(0)), event("s", "click", m(5), "v", "other"), event("p", "order", m(5), None, gmv=5), event("w", "order", m(5), "w", gmv=1)],
        [event("c2", "click", m(4)), event("c3", "click", m(4)), event("c4", "click", m(6)), event("o2", "order", m(7), gmv=5), event("o3", "order", m(5), "v", gmv=2)],
        [event("far", "click", m(60), "z"), event("o4", "order", m(61), gmv=5), event("o5", "order", m(90), "z", gmv=9)],
        [event("end", "click", m(300), "z"), event("o6", "order", m(291), gmv=5)],
        lookback="60 minutes",
    )
    want = A.last_touch(rows, "60 minutes").filter("outcome_event_id <> 'o6'").select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == want.count() == 7
    assert {r.outcome_event_id: r.touch_event_id for r in got.collect()} == {"o1": "c3", "o2": "c4", "o3": None, "o4": "c4", "o5": "far", "p": None, "w": None}


def test_state_is_a_click_a_key_and_the_delay(spark, tmp_path):
    users = [f"u{k}" for k in range(4)]
    clicks = [event(f"{u}-{k:03}", "click", T + timedelta(minutes=k), u) for u in users for k in range(200)]
    orders = [event(f"o{u}", "order", T + timedelta(minutes=199, seconds=30), u, gmv=1) for u in users]
    got, _, checkpoint = feed(spark, tmp_path, clicks + orders, [event("x", "click", T + timedelta(minutes=215), "other")])
    assert {r.touch_event_id for r in got.collect()} == {f"{u}-199" for u in users}
    held = lambda name: spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    assert held("last").count() == 4 and held("orders").count() == 0 and held("clicks").select("key").distinct().count() <= 1
    _, _, _ = feed(spark, tmp_path, [event("y", "click", T + timedelta(days=31), "other")], [event("z", "click", T + timedelta(days=32), "other")])
    assert held("last").select("key").distinct().count() <= 1  # the look-back of the four has passed


def test_state_grows_with_parts_not_with_keys(spark, tmp_path, monkeypatch):
    """300 users in 4 parts: all of a part's rows are in few rows of the state, and each order still has its own last click."""
    monkeypatch.setattr(last_click, "_CHUNK", 50)
    m = lambda n: T + timedelta(minutes=n)
    users = [f"u{k:03}" for k in range(300)]
    early = [event(f"{u}-{n}", "click", m(n), u) for u in users for n in (0, 3, 9)]
    orders = [event(f"o{n}-{u}", "order", m(n), u, gmv=1) for u in users for n in (2, 5, 90)]
    got, rows, checkpoint = feed(spark, tmp_path, early + orders, [event("x", "click", m(85), "x")], [event("y", "click", m(120), "y")], parts=4)
    want = A.last_touch(rows).select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert {(r.outcome_event_id, r.touch_event_id) for r in got.collect()} == {(f"o{n}-{u}", f"{u}-{c}") for u in users for n, c in ((2, 0), (5, 3), (90, 9))}
    held = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint).select("key", F.size("list_element.event_id").alias("n"))
    assert held.select("key").distinct().count() <= 4 and held.count() < 12 and held.agg(F.sum("n")).first()[0] == 301


def test_names_of_final_touches_looked_up_for_the_result(spark, tmp_path):
    names = ("advertiser_name", "campaign_name")
    adv, cmp = spark.createDataFrame([("a", "A")], "advertiser_id string, advertiser_name string"), spark.createDataFrame([("c", "C")], "campaign_id string, campaign_name string")
    m = lambda n: T + timedelta(minutes=n)
    rows = [event("o1", "order", m(5), gmv=5), event("c1", "click", m(4)), event("o2", "order", m(5), "v", gmv=1), event("p", "order", m(5), None, gmv=2), event("end", "click", m(60), "z")]
    src, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))
    events = spark.createDataFrame(rows, SCHEMA)
    events.drop(*names).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(events.drop(*names).schema).parquet(src)
    jobs.final_attribution_job(stream, log, checkpoint, once=True, names=lambda touches: A.name_touches(touches, adv, cmp)).awaitTermination()
    got, want = spark.read.parquet(log), A.last_touch(events)
    got = got.select(want.columns)
    assert got.count() == 3 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
