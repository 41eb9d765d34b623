import json
from datetime import datetime
from decimal import Decimal

import pytest

from adlake.operators import enrich, keyed, publishing
from adlake.operators.enrich import lookup_enrich
from adlake.operators.metrics import creative_rolling, metrics_change, window_metrics
from adlake.plans.semantic import CHARTS, query
from adlake.sources import events

GOOD = {"event_id": "e", "ts": "2026-06-01T00:30:00.000+08:00", "advertiser_id": "a", "campaign_id": "c", "unit_id": "u", "creative_id": "k", "media": "m", "region": "r", "user_id": "x", "event_type": "click", "bid_price": 1, "spend": 2.5, "gmv": 0, "order_id": None, "schema_version": 1}


def raw(spark, *cases):
    return spark.createDataFrame([(c if isinstance(c, str) else json.dumps(GOOD | c),) for c in cases], "value string")


def test_parse_valid_event(spark):
    (r,) = events.parse_events(raw(spark, {})).collect()
    assert r.is_valid and r.event_ts == datetime(2026, 5, 31, 16, 30) and r.event_date == "2026-06-01" and r.spend == Decimal("2.5")


def test_parse_dirty_events(spark):
    cases = ["{", "", {"creative_id": None}, {"creative_id": "  "}, {"ts": "yesterday"}, {"ts": "2026-06-01T00:30:00"}]
    valid, dirty = events.split_dirty(events.parse_events(raw(spark, *cases)))
    assert valid.count() == 0 and sorted(r.value for r in dirty.collect())[0] == "" and dirty.count() == len(cases)


def test_money_defaults(spark):
    got = events.parse_events(raw(spark, {"spend": None}, {"spend": "abc"})).select("is_valid", "spend").collect()
    assert [(r.is_valid, r.spend) for r in got] == [(True, 0), (True, 0)]


def test_contract(spark):
    gone = {k: v for k, v in GOOD.items() if k != "region"}
    got = events.contract_violations(raw(spark, {}, {"spend": -1}, {"event_type": "view"}, {"extra": 1}, {"schema_version": 0}, json.dumps(gone), "no")).collect()
    assert [r.violations for r in got] == [[], ["negative_spend"], ["event_type"], ["extra_field"], ["schema_version"], ["missing_field"], ["not_an_object"]]


def test_cdc_apply(spark):
    base = spark.createDataFrame([(9, "old")], "id long, name string")
    changes = spark.createDataFrame(
        [(1, "a", None, "r", 1), (2, "b", None, "r", 2), (3, "c", None, "r", 3), (2, "b3", 1, "u", 9), (2, "b2", 1, "u", 5), (3, "c", None, "d", 6), (4, "d", 2, "c", 7), (5, "e", 1, "d", 8), (5, "e2", 1, "c", 10)],
        "id long, name string, extra int, op string, seq long",
    )
    once = keyed.cdc_apply(base, changes, ["id"])
    want = {(9, "old", None), (1, "a", None), (2, "b3", 1), (4, "d", 2), (5, "e2", 1)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in keyed.cdc_apply(once, changes, ["id"]).collect()} == want
    mixed = changes.selectExpr("*", "IF(id > 2, 'x', 'y') AS table")
    assert keyed.route_changes(mixed, "x").count() == 5 and keyed.route_changes(mixed, "y").count() == 4


def test_changelog_and_partial_update(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d"), (3, None)], "id int, v string")
    assert {tuple(r) for r in keyed.changelog_between(old, new, ["id"]).collect()} == {("-U", 2, "b"), ("+U", 2, "c"), ("+I", 4, "d")}
    assert {tuple(r) for r in keyed.changelog_between(new, old, ["id"]).filter("id = 4").collect()} == {("-D", 4, "d")}
    steps = spark.createDataFrame([(1, "t1", None, None, 1), (1, None, "t2", None, 2), (1, None, None, "t3", 3)], "id int, a string, b string, c string, seq int")
    assert [tuple(r) for r in keyed.partial_update(steps, ["id"], "seq").collect()] == [(1, "t1", "t2", "t3")]


def test_upsert_replay_and_publish(spark, tmp_path):
    path = str(tmp_path / "keyed")
    a, b = (spark.createDataFrame(r, "id int, v string") for r in ([(1, "a"), (2, "a")], [(2, "b")]))
    for batch, n in ((a, 0), (b, 1), (b, 1)):
        keyed.upsert_batch(batch, path, n)
    assert {tuple(r) for r in keyed.read_keyed(spark, path, ["id"]).collect()} == {(1, "a"), (2, "b")}
    keyed.compact(spark, path, ["id"], str(tmp_path / "compact"), 2)
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 2
    out = str(tmp_path / "snapshot")
    rows = spark.createDataFrame([(1, None, None)], "id int, n int, ratio double")
    assert publishing.publish_snapshot(rows, out, ["n"])
    with pytest.raises(ValueError):
        publishing.publish_snapshot(rows.filter("false"), out)
    assert [tuple(r) for r in publishing.read_published(spark, out).collect()] == [(1, 0, None)]
    assert not publishing.publish_snapshot(rows, out, skip_if_present="ratio") and publishing.publish_snapshot(rows, out, skip_if_present="ratio", force=True)


def test_partitioned_write_replaces_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "days")
    keyed.write_partitioned(spark.createDataFrame([(1, "d1"), (2, "d2")], "v int, d string"), path, "d")
    keyed.write_partitioned(spark.createDataFrame([(3, "d2")], "v int, d string"), path, "d")
    assert {tuple(r) for r in spark.read.parquet(path).select("v", "d").collect()} == {(1, "d1"), (3, "d2")}


def test_lookup_defaults(spark):
    df = spark.createDataFrame([("a",), ("b",), (" ",), (None,)], "k string")
    dim = spark.createDataFrame([("a", "A"), ("a", "A"), (" ", "blank")], "k string, name string")
    assert {(r.k, r.name) for r in lookup_enrich(df, dim, "k", {"name": "name"}).collect()} == {("a", "A"), ("b", "UNKNOWN"), (" ", "UNKNOWN"), (None, "UNKNOWN")}


def _event(i, kind, second, spend=0):
    return (i, datetime(2024, 1, 1, 0, 0, second), "a", "c", "u", "k", kind, Decimal(spend), Decimal(0))


METRIC = "event_id string, event_ts timestamp, advertiser_id string, campaign_id string, unit_id string, creative_id string, event_type string, spend decimal(18,4), gmv decimal(18,2)"


def test_window_metrics(spark):
    df = spark.createDataFrame([_event("1", "impression", 1), _event("2", "click", 9, 1), _event("2", "click", 9, 1), _event("3", "error", 9, 5), _event("4", "click", 10, 2)], METRIC)
    first, second = window_metrics(df).orderBy("window_start").collect()
    assert (first.impressions, first.clicks, first.spend, first.ctr) == (1, 2, 7, 2) and first.cvr == 0 and first.roi == 0
    assert second.ctr is None and second.clicks == 1
    assert window_metrics(df, dedupe=True).orderBy("window_start").first().clicks == 1
    a, b = metrics_change(window_metrics(df)).orderBy("window_start").collect()
    assert a.spend_change is None and b.spend_change == -5 and b.gmv_change_rate is None


def test_rolling_week(spark):
    rows = [(f"2024-01-{d:02}", "k", Decimal(1), Decimal(2)) for d in (1, 2, 8, 20)]
    got = {r.stat_date[-2:]: (int(r.cost_7d), int(r.gmv_total)) for r in creative_rolling(spark.createDataFrame(rows, "stat_date string, creative_id string, cost_1d decimal(18,2), gmv_1d decimal(18,2)")).collect()}
    assert got == {"01": (1, 2), "02": (2, 4), "08": (2, 6), "20": (1, 8)}


def test_semantic_ratio_of_sums_share_and_ties(spark):
    rows = [("2024-01-01", "b", 10, 1, Decimal(3)), ("2024-01-02", "a", 100, 90, Decimal(3))]
    df = spark.createDataFrame(rows, "window_start string, advertiser_name string, impressions long, clicks long, gmv decimal(18,2)")
    assert float(query("realtime", df, metrics=["ctr"]).first().ctr) == round(91 / 110, 6)
    assert [r.advertiser_name for r in query("realtime", df, ["advertiser_name"], ["total_gmv"], limit=1).collect()] == ["a"]
    assert {r.share for r in query("realtime", df, ["advertiser_name"], ["total_gmv"], share=True).collect()} == {0.5}
    assert query("realtime", df, metrics=["count"], time_range="2024-01-02 : 2024-02-01").first()[0] == 1
    assert query("realtime", df, metrics=["count"], time_range="Last 14 days", as_of="2024-01-02").first()[0] == 1
    assert query("realtime", df, metrics=["count"], filters={"advertiser_name": ["a"]}).first()[0] == 1
    assert len(CHARTS) == 50


def test_events_are_parsed_once(spark):
    valid, _ = events.split_dirty(events.parse_events(raw(spark, {})))
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("jsontostructs") == 1


def test_last_row_of_a_batch_by_sequence_and_largest_dimension_row(spark, tmp_path):
    rows = spark.createDataFrame([(1, "new", 9), (1, "old", 3)], "id int, v string, seq int")
    keyed.upsert_batch(rows, str(tmp_path / "t"), 0, seq="seq")
    assert [r.v for r in keyed.read_keyed(spark, str(tmp_path / "t"), ["id"]).collect()] == ["new"]
    keyed.upsert_batch(rows.filter("v = 'old'"), str(tmp_path / "t"), 0, run="other")
    assert [r.v for r in keyed.read_keyed(spark, str(tmp_path / "t"), ["id"]).collect()] == ["old"]
    dim = spark.createDataFrame([("a", "x", None), ("a", "y", "z"), ("a", "y", None)], "k string, name string, more string")
    df = spark.createDataFrame([("a",)], "k string")
    assert lookup_enrich(df, dim, "k", {"name": "name", "more": "more"}).first()[1:] == ("y", "z")
    assert lookup_enrich(df, dim, "k", {"name": "name"}).first().name == "y"


def test_a_dimension_is_counted_once_and_shuffled_when_it_has_grown(spark, tmp_path, monkeypatch):
    path, counted = str(tmp_path / "dim"), []
    spark.range(10).write.parquet(path)
    real = type(spark.range(1)).count
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: counted.append(1) or real(self))
    hinted = lambda bound: "broadcast" in enrich.small(spark.read.parquet(path), bound)._jdf.queryExecution().analyzed().toString()
    assert hinted(10) and hinted(10) and len(counted) == 1 and not hinted(9)
    spark.range(30).write.mode("overwrite").parquet(path)
    assert not hinted(10) and len(counted) == 3


@pytest.fixture
def ledger(spark):
    """A JDBC database in memory with a keyed table and its stage."""
    import uuid

    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    make = [f"CREATE TABLE {t} (order_id INT NOT NULL{key}, status VARCHAR(20), gmv DECIMAL(18,2))" for t, key in (("orders_now", " PRIMARY KEY"), ("orders_stage", ""))]
    keyed._execute(spark, url, make, {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    return url


def stored_rows(spark, url):
    return sorted(tuple(r) for r in events.read_dimension_jdbc(spark, url, "orders_now").selectExpr("order_id", "status", "CAST(gmv AS INT)").collect())


def test_jdbc_upsert_bears_replay_and_keeps_the_last_row(spark, ledger):
    first = spark.createDataFrame([(1, "new", 5), (2, "sent", None), (3, "old", 7)], "order_id int, status string, gmv int")
    again = spark.createDataFrame([(3, "paid", 8, 2), (3, "new", 7, 1), (4, "new", None, 1)], "order_id int, status string, gmv int, seq int")
    write = lambda df, **more: keyed.upsert_jdbc(df, ledger, "orders_now", "orders_stage", ["order_id"], **more)
    write(first)
    write(first)
    assert stored_rows(spark, ledger) == [(1, "new", 5), (2, "sent", None), (3, "old", 7)]
    write(first.limit(0))
    keyed._execute(spark, ledger, ["ALTER TABLE orders_stage ADD COLUMN seq INT", "ALTER TABLE orders_now ADD COLUMN seq INT"], {})
    write(again, order="seq")
    assert stored_rows(spark, ledger) == [(1, "new", 5), (2, "sent", None), (3, "paid", 8), (4, "new", None)]


def test_jdbc_upsert_tries_again_and_leaves_the_target_on_failure(spark, ledger, monkeypatch):
    rows = spark.createDataFrame([(1, "new", 5)], "order_id int, status string, gmv int")
    write = lambda df, tries: keyed.upsert_jdbc(df, ledger, "orders_now", "orders_stage", ["order_id"], tries=tries, wait=0.01)
    write(rows, 1)
    calls, real = [], keyed._execute

    def breaks(spark, url, statements, properties):
        calls.append(1)
        bad = [statements[0], "INSERT INTO nowhere VALUES (1)"]
        return real(spark, url, bad if len(calls) < 3 else statements, properties)

    monkeypatch.setattr(keyed, "_execute", breaks)
    paid = spark.createDataFrame([(1, "paid", 9)], "order_id int, status string, gmv int")
    with pytest.raises(Exception, match="NOWHERE"):
        write(paid, 2)
    assert stored_rows(spark, ledger) == [(1, "new", 5)]  # the delete went with the failed insert
    write(paid, 3)
    assert stored_rows(spark, ledger) == [(1, "paid", 9)] and len(calls) == 3


def test_local_times(spark):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP '2024-01-01 20:00:00' AS t UNION ALL SELECT 2, NULL")
    assert [r.t for r in keyed.local_times(df, ["t"]).orderBy("id").collect()] == [datetime(2024, 1, 2, 4), None]
