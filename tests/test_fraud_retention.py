from datetime import datetime, timedelta
from decimal import Decimal

from adlake.operators import fraud as Fr
from adlake.operators.retention import retention

T = datetime(2024, 3, 1, 12)
SCHEMA = "event_id string, event_ts timestamp, event_date string, advertiser_id string, advertiser_name string, creative_id string, media string, user_id string, event_type string, spend decimal(18,4)"


def event(i, kind, ts, user, media="m"):
    return (i, ts, ts.strftime("%Y-%m-%d"), "a", "A", "k", media, user, kind, Decimal(1))


def burst():
    rows = [event(f"b{u}{n}", "click", T, f"b{u}") for u in range(3) for n in range(12)]
    return rows + [event(f"v{u}", "impression", T, f"b{u}") for u in range(3)]


def labels(spark, rows, **rules):
    clicks = Fr.click_features(spark.createDataFrame(rows, SCHEMA))
    return {r.event_id: r for r in Fr.fraud_features(clicks, **rules).collect()}


def test_burst(spark):
    got = labels(spark, burst())
    assert len(got) == 36
    assert {(r.click_cnt_1h, float(r.ctr_deviation), r.fraud_label, float(r.fraud_score), tuple(r.rule_hits)) for r in got.values()} == {(12, 11.9, "HIGH_CLICK_BURST", 0.95, ("HIGH_CLICK_BURST",))}
    clicks = Fr.click_features(spark.createDataFrame(burst(), SCHEMA))
    (signal,) = Fr.fraud_signals(Fr.fraud_features(clicks), clicks).collect()
    assert (signal.click_count, signal.impression_count, signal.unique_users) == (36, 1, 3)
    assert Fr.fraud_signals(Fr.label_clicks(clicks)).collect() == [signal]
    (day,) = Fr.fraud_daily(Fr.fraud_signals(Fr.fraud_features(clicks), clicks)).collect()
    assert (day.suspicious_users, day.suspicious_windows, day.suspicious_clicks) == (3, 1, 36)


def test_rules_in_order(spark):
    rows = [event(f"c{n}", "click", T + timedelta(minutes=n), "five") for n in range(5)]
    rows += [event(f"d{n:02}", "click", T.replace(hour=0) + timedelta(minutes=65 * n), "day") for n in range(20)]
    rows += [event("one", "click", T, "one")]
    got = labels(spark, rows)
    assert [got[f"c{n}"].fraud_label for n in range(5)] == ["NORMAL"] * 4 + ["ABNORMAL_CTR"]
    assert {got[f"d{n:02}"].fraud_label for n in range(20)} == {"HIGH_DAILY_CLICKS"}
    assert (got["one"].fraud_label, float(got["one"].fraud_score), got["one"].rule_hits) == ("NORMAL", 0.1, ["NONE"])


def test_span_ends_night_and_null_keys(spark):
    rows = [event("a", "click", T - timedelta(hours=1), "u"), event("b", "click", T, "u"), event("c", "click", T, "w"), event("d", "click", T - timedelta(hours=1, milliseconds=1), "w")]
    rows += [event(f"n{h}", "click", T.replace(hour=h), f"n{h}") for h in (0, 5, 6)] + [event("x", "click", T, "x", None)]
    got = {r.event_id: r for r in Fr.click_features(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got["b"].click_cnt_1h, got["c"].click_cnt_1h, got["x"].click_cnt_1h) == (2, 1, 0)
    assert [got[f"n{h}"].is_night_burst for h in (0, 5, 6)] == [True, True, False]
    assert got["b"].click_interval_ms == 3_600_000 and got["a"].click_interval_ms is None


def test_sliced_and_window_forms_equal_join_form(spark):
    rows = burst() + [event(f"r{n}", ("click", "impression")[n % 2], T + timedelta(seconds=37 * n), f"u{n % 3}", ("m", None)[n % 7 == 0]) for n in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    b = Fr.click_features(df, strategy="join")
    for a in (Fr.click_features(df), Fr.click_features(df, hot_rows=3), Fr.click_features(df, strategy="window"), *(Fr.click_features(df, strategy="sliced", slice_width=w) for w in ("20 seconds", "1 hour", "3 days"))):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_retention(spark):
    active = {"A": (1, 2, 8), "B": (1, 16, 31), "C": (2,)}
    rows = [(e, (datetime(2024, 1, 1) + timedelta(days=d - 1)).strftime("%Y-%m-%d"), Decimal(1)) for e, days in active.items() for d in days]
    rows += [("A", "2024-01-05", Decimal(0)), (None, "2024-01-01", Decimal(1))]
    got = {r.cohort_date: r for r in retention(spark.createDataFrame(rows, "advertiser_id string, event_date string, spend decimal(18,4)")).collect()}
    assert "2024-01-05" not in got
    pick = lambda d: (got[d].cohort_size, got[d].retained_1d, got[d].retained_7d, got[d].retained_15d, got[d].retained_30d)
    assert pick("2024-01-01") == (2, 1, 1, 1, 1) and pick("2024-01-02") == (2, 0, 0, 0, 0)
    assert float(got["2024-01-01"].rate_1d) == 0.5
