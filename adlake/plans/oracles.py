"""The queries in DuckDB SQL, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from adlake.plans.lattice import cross_filtered
from adlake.plans.semantic import CHARTS, DASHBOARDS, REPORTS, SELECTED, Chart

AS_OF = "2024-01-25"
TS = "'%Y-%m-%d %H:%M:%S.%g'"


def _r(a: str, b: str, scale: int = 6) -> str:
    return f"round(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), {scale})"


def _n(kind: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{kind}')"


COUNTS = f"{_n('impression')} AS impressions, {_n('click')} AS clicks, {_n('conversion')} AS conversions, {_n('order')} AS orders"

CTES: dict[str, str] = {
    "ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "ad_events": """SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
  CASE WHEN k % 10 = 9 THEN 'adv_unlisted' ELSE 'adv_' || (k % 10) END AS advertiser_id, 'cmp_' || (k % 20) AS campaign_id, 'unit_' || (k % 40) AS unit_id, 'crt_' || k AS creative_id,
  ['douyin', 'kuaishou', 'bilibili', 'xiaohongshu', 'toutiao', 'weibo'][k % 6 + 1] AS media, 'user_' || user_id AS user_id,
  CASE event_type WHEN 'view' THEN 'impression' WHEN 'signup' THEN 'conversion' WHEN 'purchase' THEN 'order' ELSE event_type END AS event_type,
  CAST(CASE WHEN event_type = 'click' THEN value ELSE 0 END AS DECIMAL(18,4)) AS spend,
  CAST(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS DECIMAL(18,2)) AS gmv,
  CASE WHEN event_type = 'purchase' THEN 'ord_' || event_id END AS order_id FROM ev""",
    "adv": """SELECT 'adv_' || s_suppkey AS advertiser_id, s_name AS advertiser_name, ['game', 'retail', 'travel'][s_suppkey % 3 + 1] AS industry,
  ['S', 'A', 'B', 'C'][s_suppkey % 4 + 1] AS tier, n_name AS home_region FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "cmp": """SELECT 'cmp_' || c_custkey AS campaign_id, CASE WHEN c_custkey % 10 = 9 THEN 'adv_unlisted' ELSE 'adv_' || (c_custkey % 10) END AS advertiser_id, c_name AS campaign_name,
  ['ROI', 'GMV', 'CTR', 'Retention'][c_custkey % 4 + 1] AS objective, CAST(c_acctbal AS DECIMAL(18,2)) AS budget, ['active', 'paused'][c_custkey % 2 + 1] AS status FROM customer""",
    "unit": """SELECT 'unit_' || p_partkey AS unit_id, 'cmp_' || (p_partkey % 20) AS campaign_id, p_name AS unit_name, ['CPC', 'OCPC', 'CPM'][p_partkey % 3 + 1] AS bid_type,
  CAST(p_retailprice AS DECIMAL(18,4)) AS bid_amount FROM part""",
    "crt": "SELECT 'crt_' || p_partkey AS creative_id, 'unit_' || (p_partkey % 40) AS unit_id, 'cmp_' || (p_partkey % 20) AS campaign_id, p_name AS creative_name, p_type AS format FROM part",
    "hierarchy": "SELECT crt.creative_id, creative_name, format, unit_id, unit_name, bid_type, bid_amount, unit.campaign_id, campaign_name, objective, budget, status, advertiser_id, advertiser_name, industry, tier, home_region FROM crt JOIN unit USING (unit_id) JOIN cmp ON unit.campaign_id = cmp.campaign_id JOIN adv USING (advertiser_id)",
    "dwd": """SELECT e.*, coalesce(adv.advertiser_name, 'UNKNOWN') AS advertiser_name, coalesce(industry, 'UNKNOWN') AS industry, coalesce(tier, 'UNKNOWN') AS advertiser_tier,
  coalesce(campaign_name, 'UNKNOWN') AS campaign_name, coalesce(objective, 'UNKNOWN') AS campaign_objective, coalesce(creative_name, 'UNKNOWN') AS creative_name, coalesce(format, 'UNKNOWN') AS creative_format
  FROM ad_events e LEFT JOIN adv ON e.advertiser_id = adv.advertiser_id LEFT JOIN cmp ON e.campaign_id = cmp.campaign_id LEFT JOIN crt ON e.creative_id = crt.creative_id""",
    "daily": f"""SELECT event_date AS stat_date, creative_id, max(campaign_id) AS campaign_id, max(creative_name) AS creative_name, {_n('impression')} AS imp_cnt_1d, {_n('click')} AS click_cnt_1d,
  {_n('conversion')} AS conv_cnt_1d, {_n('order')} AS order_cnt_1d, CAST(sum(spend) AS DECIMAL(18,2)) AS cost_1d, CAST(sum(gmv) AS DECIMAL(18,2)) AS gmv_1d,
  {_r(_n('click'), _n('impression'))} AS ctr_1d, {_r(_n('conversion'), _n('click'))} AS cvr_1d, {_r('sum(gmv)', 'sum(spend)', 4)} AS roi_1d FROM dwd GROUP BY event_date, creative_id""",
    "cand": """SELECT o.event_date AS stat_date, o.event_id AS outcome_event_id, o.order_id, o.event_ts AS outcome_time, o.user_id, o.advertiser_id AS order_advertiser_id, o.advertiser_name AS order_advertiser_name,
  o.campaign_id AS order_campaign_id, o.campaign_name AS order_campaign_name, o.gmv AS order_gmv, t.event_id AS touch_event_id, t.event_ts AS touch_time, t.creative_id, t.campaign_id, t.campaign_name, t.advertiser_id, t.advertiser_name,
  t.spend AS touch_spend, CAST(row_number() OVER (PARTITION BY o.event_id ORDER BY t.event_ts DESC, t.event_id DESC) AS INT) AS touchpoint_seq, o.event_id || '_' || coalesce(t.event_id, 'organic') AS candidate_id,
  date_sub('minute', t.event_ts, o.event_ts) AS lag_minutes
  FROM (SELECT * FROM dwd WHERE event_type = 'order') o LEFT JOIN (SELECT * FROM dwd WHERE event_type = 'click') t
  ON o.user_id = t.user_id AND o.advertiser_id = t.advertiser_id AND t.event_ts <= o.event_ts AND t.event_ts >= o.event_ts - INTERVAL 30 DAY""",
    "detail": """SELECT stat_date AS event_date, outcome_event_id AS order_event_id, order_id, outcome_time AS order_ts, user_id, order_advertiser_id, order_advertiser_name, order_campaign_id, order_campaign_name, order_gmv,
  touch_event_id AS click_event_id, touch_time AS click_ts, creative_id, campaign_id, campaign_name, advertiser_id, advertiser_name, touch_spend, 'last_click_30d' AS attribution_model,
  CASE WHEN touch_event_id IS NULL THEN 'natural' WHEN lag_minutes <= 30 THEN 'direct' ELSE 'indirect' END AS attribution_type,
  CASE WHEN touch_event_id IS NULL THEN '自然订单' WHEN lag_minutes <= 30 THEN '30分钟直接归因' WHEN lag_minutes <= 1440 THEN '1日间接归因' WHEN lag_minutes <= 4320 THEN '3日间接归因' WHEN lag_minutes <= 10080 THEN '7日间接归因' ELSE '30日间接归因' END AS attribution_period,
  CASE WHEN touch_event_id IS NULL THEN 6 WHEN lag_minutes <= 30 THEN 1 WHEN lag_minutes <= 1440 THEN 2 WHEN lag_minutes <= 4320 THEN 3 WHEN lag_minutes <= 10080 THEN 4 ELSE 5 END AS attribution_sort,
  lag_minutes, touch_event_id IS NOT NULL AS is_attributed FROM cand WHERE touchpoint_seq = 1""",
    "summary": """SELECT event_date, order_advertiser_id AS advertiser_id, coalesce(campaign_id, '__organic__') AS campaign_id, attribution_period, max(order_advertiser_name) AS advertiser_name,
  max(coalesce(campaign_name, '自然订单')) AS campaign_name, CAST(0 AS BIGINT) AS conversions, count(*) AS orders, CAST(sum(order_gmv) AS DECIMAL(18,2)) AS attributed_gmv,
  CAST(sum(coalesce(touch_spend, 0)) AS DECIMAL(18,4)) AS attributed_spend FROM detail GROUP BY ALL""",
    "clicks": """SELECT c.event_date AS stat_date, c.event_id, c.event_ts AS event_time, c.user_id, c.user_id AS device_id, CAST(NULL AS VARCHAR) AS device_ip, c.creative_id, c.media AS slot_id, c.advertiser_id, c.advertiser_name, c.media, c.spend,
  n1.click_cnt_1h, n1.click_cnt_1d, n1.impression_cnt_1h, n1.impression_cnt_1m, n1.click_cnt_1h AS ip_click_cnt_1h, CAST(1 AS INT) AS ip_uv_1h,
  date_sub('second', lag(c.event_ts) OVER (PARTITION BY c.user_id ORDER BY c.event_ts, c.event_id), c.event_ts) * 1000 AS click_interval_ms,
  CAST(round(CASE WHEN n1.impression_cnt_1h = 0 THEN n1.click_cnt_1h ELSE n1.click_cnt_1h::DOUBLE / n1.impression_cnt_1h - 0.1::DOUBLE END, 6) AS DECIMAL(10,6)) AS ctr_deviation, hour(c.event_ts) BETWEEN 0 AND 5 AS is_night_burst
  FROM dwd c JOIN (SELECT c.event_id, CAST(count(*) FILTER (WHERE h.event_type = 'click') AS INT) AS click_cnt_1h, CAST(count(*) FILTER (WHERE h.event_type = 'impression') AS INT) AS impression_cnt_1h,
      CAST(count(*) FILTER (WHERE h.event_type = 'impression' AND h.event_ts >= c.event_ts - INTERVAL 1 MINUTE) AS INT) AS impression_cnt_1m, any_value(d.n) AS click_cnt_1d
    FROM dwd c JOIN dwd h ON h.user_id = c.user_id AND h.event_ts <= c.event_ts AND h.event_ts >= c.event_ts - INTERVAL 1 DAY
      JOIN (SELECT event_date, user_id, CAST(count(*) AS INT) AS n FROM dwd WHERE event_type = 'click' GROUP BY ALL) d ON d.event_date = c.event_date AND d.user_id = c.user_id
    WHERE c.event_type = 'click' GROUP BY c.event_id) n1 ON n1.event_id = c.event_id WHERE c.event_type = 'click'""",
    "fraud": """SELECT stat_date, event_id, user_id, device_id, device_ip, creative_id, slot_id, click_cnt_1h, click_cnt_1d, ip_click_cnt_1h, ip_uv_1h, click_interval_ms, ctr_deviation, CAST(0 AS DECIMAL(10,6)) AS ua_entropy, false AS geo_ip_mismatch, is_night_burst,
  CAST(CASE WHEN click_cnt_1h >= 4 THEN 0.95 WHEN click_cnt_1h >= 3 AND ctr_deviation >= 0.7 THEN 0.85 WHEN click_cnt_1d >= 3 THEN 0.75 ELSE 0.1 END AS DECIMAL(6,4)) AS fraud_score,
  CASE WHEN click_cnt_1h >= 4 THEN 'HIGH_CLICK_BURST' WHEN click_cnt_1h >= 3 AND ctr_deviation >= 0.7 THEN 'ABNORMAL_CTR' WHEN click_cnt_1d >= 3 THEN 'HIGH_DAILY_CLICKS' ELSE 'NORMAL' END AS fraud_label FROM clicks""",
    "signals": """SELECT strftime(w, '%Y-%m-%d') AS event_date, w AS window_start, w + INTERVAL 1 MINUTE AS window_end, advertiser_id, max(advertiser_name) AS advertiser_name, media, fraud_label AS rule_code,
  CASE fraud_label WHEN 'HIGH_CLICK_BURST' THEN 'User click count in the rolling hour exceeds the burst threshold' WHEN 'ABNORMAL_CTR' THEN 'User rolling click-through rate deviates strongly from baseline' ELSE 'User daily click count exceeds the threshold' END AS rule_desc,
  count(*) AS click_count, max(impression_cnt_1m) AS impression_count, count(DISTINCT user_id) AS unique_users, CAST(sum(spend) AS DECIMAL(18,4)) AS suspicious_spend, max(fraud_score) AS risk_score
  FROM (SELECT clicks.*, fraud_label, fraud_score, time_bucket(INTERVAL 1 MINUTE, event_time) AS w FROM clicks JOIN fraud USING (event_id) WHERE fraud_label <> 'NORMAL') GROUP BY w, advertiser_id, media, fraud_label""",
    "fraud_day": """SELECT event_date, advertiser_id, max(advertiser_name) AS advertiser_name, CAST(sum(unique_users) AS BIGINT) AS suspicious_users, count(*) AS suspicious_windows, CAST(sum(click_count) AS BIGINT) AS suspicious_clicks,
  CAST(sum(suspicious_spend) AS DECIMAL(18,4)) AS suspicious_spend, round(avg(CAST(risk_score AS DOUBLE)), 6) AS avg_risk_score FROM signals GROUP BY ALL""",
    "active": "SELECT DISTINCT CAST(event_date AS DATE) AS d, creative_id AS e FROM ad_events WHERE spend > 0",
    "retained": "SELECT CAST(first AS VARCHAR) AS cohort_date, count(DISTINCT e) AS cohort_size, "
    + ", ".join(f"count(DISTINCT CASE WHEN later = {n} THEN e END) AS retained_{n}d" for n in (1, 7, 15, 30))
    + ", "
    + ", ".join(f"{_r(f'count(DISTINCT CASE WHEN later = {n} THEN e END)', 'count(DISTINCT e)')} AS rate_{n}d" for n in (1, 7, 15, 30))
    + " FROM (SELECT x.d AS first, x.e, y.d - x.d AS later FROM active x JOIN active y ON x.e = y.e AND y.d >= x.d) GROUP BY first",
    "creative_rows": f"""SELECT d.stat_date, d.creative_id, coalesce(crt.creative_name, d.creative_name, 'UNKNOWN') AS creative_name, coalesce(format, 'unknown') AS creative_format, d.campaign_id, coalesce(campaign_name, 'UNKNOWN') AS campaign_name,
  coalesce(CASE WHEN objective = 'ROI' THEN 'ROAS' ELSE objective END, 'UNKNOWN') AS campaign_objective, budget AS campaign_budget, coalesce(status, 'UNKNOWN') AS campaign_status, cmp.advertiser_id, coalesce(advertiser_name, 'UNKNOWN') AS advertiser_name,
  coalesce(industry, 'UNKNOWN') AS industry, coalesce(tier, 'UNKNOWN') AS advertiser_tier, crt.unit_id, coalesce(unit_name, 'UNKNOWN') AS unit_name, coalesce(bid_type, 'UNKNOWN') AS bid_type, bid_amount,
  imp_cnt_1d AS impressions, click_cnt_1d AS clicks, conv_cnt_1d AS conversions, order_cnt_1d AS orders, cost_1d AS cost, gmv_1d AS gmv,
  {_r('click_cnt_1d', 'imp_cnt_1d')} AS ctr, {_r('conv_cnt_1d', 'click_cnt_1d')} AS cvr, {_r('cost_1d', 'click_cnt_1d', 4)} AS cpc, {_r('cost_1d', 'conv_cnt_1d', 4)} AS cpa, {_r('gmv_1d', 'cost_1d')} AS roas
  FROM daily d LEFT JOIN crt ON d.creative_id = crt.creative_id LEFT JOIN cmp ON d.campaign_id = cmp.campaign_id LEFT JOIN adv ON cmp.advertiser_id = adv.advertiser_id LEFT JOIN unit ON crt.unit_id = unit.unit_id WHERE d.stat_date < '{AS_OF}'""",
    "creative_latest": "SELECT *, stat_date = (SELECT max(stat_date) FROM creative_rows) AS is_latest_partition FROM creative_rows",
    "m10": f"""SELECT w AS window_start, w + INTERVAL 10 SECOND AS window_end, advertiser_id, campaign_id, unit_id, creative_id, CAST(sum(spend) AS DECIMAL(18,4)) AS spend, CAST(sum(gmv) AS DECIMAL(18,2)) AS gmv, {COUNTS},
  {_r(_n('click'), _n('impression'))} AS ctr, {_r(_n('conversion'), _n('click'))} AS cvr, {_r('sum(gmv)', 'sum(spend)')} AS roi
  FROM (SELECT *, time_bucket(INTERVAL 10 SECOND, event_ts) AS w FROM ad_events) GROUP BY w, advertiser_id, campaign_id, unit_id, creative_id""",
    "m10_named": "SELECT m10.*, coalesce(advertiser_name, 'UNKNOWN') AS advertiser_name FROM m10 LEFT JOIN adv USING (advertiser_id)",
    "m10_change": f"""SELECT *, spend - previous_spend AS spend_change, gmv - previous_gmv AS gmv_change, {_r('(spend - previous_spend)', 'previous_spend')} AS spend_change_rate, {_r('(gmv - previous_gmv)', 'previous_gmv')} AS gmv_change_rate
  FROM (SELECT * EXCLUDE (roi), roi AS roas, lag(spend) OVER k AS previous_spend, lag(gmv) OVER k AS previous_gmv FROM m10_named WINDOW k AS (PARTITION BY advertiser_id, campaign_id, unit_id, creative_id ORDER BY window_start))""",
    "raw": """SELECT *, CAST(event_id AS BIGINT) % 50 AS c FROM ad_events""",
    "changes": """SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS gmv, 'r' AS op, o_orderkey AS seq FROM orders
  UNION ALL SELECT o_orderkey, 'PAID', CAST(o_totalprice AS DECIMAL(18,2)) + 1, 'u', o_orderkey + 1000000000 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)), 'd', o_orderkey + 2000000000 FROM orders WHERE o_orderkey % 10 = 0""",
    "base_orders": "SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS gmv FROM orders",
    "current_orders": "SELECT order_id, status, gmv FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) AS rn FROM changes) WHERE rn = 1 AND op <> 'd'",
}

_D = lambda names: ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names.split())
_T = lambda names: ", ".join(f"strftime({n}, {TS}) AS {n}" for n in names.split())


def _plain(table: str, doubles: str = "", times: str = "", where: str = "") -> str:
    """All columns of a CTE, with decimals as doubles and times as text."""
    parts = [p for p in (_D(doubles) if doubles else "", _T(times) if times else "") if p]
    replace = f" REPLACE ({', '.join(parts)})" if parts else ""
    return f"SELECT *{replace} FROM {table}{where}"


#: Windows that a watermark of five seconds has closed.
_CLOSED = " WHERE window_end <= (SELECT max(event_ts) FROM ad_events) - INTERVAL 5 SECOND"
#: Midnight of a step's day, eight hours on.
_LOCAL = f"strftime(CAST(CAST(o_orderdate AS DATE) + CAST(days AS INT) AS TIMESTAMP) + INTERVAL 8 HOUR, {TS})"
_CLICK_DOUBLES = "spend ctr_deviation"

FINAL: dict[str, str] = {
    "dwd_enrich": _plain("dwd", "spend gmv", "event_ts"),
    "dws_creative_daily": _plain("daily", "cost_1d gmv_1d"),
    "event_validate": "SELECT event_id, event_date, event_type, CAST(CASE WHEN c = 4 THEN -1 ELSE spend END AS DOUBLE) AS spend FROM raw WHERE c NOT IN (1, 2, 3)",
    "event_dirty": "SELECT c IN (1, 2, 3) AS is_dirty, count(*) AS n FROM raw GROUP BY ALL",
    "contract_violations": """SELECT concat_ws(',', CASE WHEN c = 2 THEN 'not_an_object' END, CASE WHEN c = 5 THEN 'extra_field' END, CASE WHEN c <> 2 AND event_type = 'error' THEN 'event_type' END,
  CASE WHEN c = 4 THEN 'negative_spend' END, CASE WHEN c = 6 THEN 'schema_version' END) AS violations, count(*) AS n FROM raw GROUP BY ALL""",
    "ods_check": "SELECT count(*) AS row_count, min(event_date) AS min_date, max(event_date) AS max_date FROM ad_events",
    "table_counts": "SELECT 'events' AS table_name, count(*) AS row_count FROM ad_events UNION ALL SELECT 'advertiser', count(*) FROM adv UNION ALL SELECT 'campaign', count(*) FROM cmp UNION ALL SELECT 'unit', count(*) FROM unit UNION ALL SELECT 'creative', count(*) FROM crt",
    "freshness": f"SELECT count(*) AS row_count, strftime(max(window_start), {TS}) AS latest FROM m10",
    "point_lookup": _plain("ad_events", "spend gmv", "event_ts", " WHERE creative_id = 'crt_7'"),
    "ad_hierarchy": _plain("hierarchy", "bid_amount budget"),
    "attr_candidates": _plain("cand", "order_gmv touch_spend", "outcome_time touch_time"),
    "attr_candidates_banded": _plain("cand", "order_gmv touch_spend", "outcome_time touch_time"),
    "fraud_daily_users": """SELECT event_date, advertiser_id, suspicious_users, different_users FROM fraud_day JOIN (
  SELECT strftime(c.event_time, '%Y-%m-%d') AS event_date, c.advertiser_id, count(DISTINCT c.user_id) AS different_users FROM clicks c JOIN fraud f USING (event_id) WHERE fraud_label <> 'NORMAL' GROUP BY ALL) USING (event_date, advertiser_id)""",
    "retracted_daily": f"""SELECT event_date, creative_id, count(*) AS row_count, {_n('impression')} AS impressions, {_n('click')} AS clicks, sum(spend)::DOUBLE AS spend, sum(gmv)::DOUBLE AS gmv, max(gmv)::DOUBLE AS largest_gmv,
  strftime(max(event_ts), {TS}) AS last_event, count(DISTINCT user_id) AS users
  FROM (SELECT event_date, event_ts, event_type, spend, CASE WHEN i % 33 = 1 THEN 'crt_moved' ELSE creative_id END AS creative_id, CASE WHEN i % 11 = 1 THEN 'user_moved' ELSE user_id END AS user_id, CASE WHEN i % 11 = 1 THEN gmv * 2 ELSE gmv END AS gmv
      FROM (SELECT *, CAST(event_id AS BIGINT) AS i FROM ad_events) WHERE i % 7 <> 0
    UNION ALL SELECT event_date, event_ts, event_type, spend, creative_id, user_id, gmv FROM ad_events WHERE CAST(event_id AS BIGINT) % 13 = 2) GROUP BY event_date, creative_id""",
    "reach_daily": """SELECT a.advertiser_id, a.event_date AS day, count(DISTINCT CASE WHEN b.event_date = a.event_date THEN b.user_id END) AS users, count(DISTINCT b.user_id) AS users_7d
  FROM (SELECT DISTINCT advertiser_id, event_date FROM ad_events WHERE event_type = 'click') a
  JOIN (SELECT DISTINCT advertiser_id, event_date, user_id FROM ad_events WHERE event_type = 'click') b
    ON b.advertiser_id = a.advertiser_id AND CAST(b.event_date AS DATE) BETWEEN CAST(a.event_date AS DATE) - 6 AND CAST(a.event_date AS DATE) GROUP BY ALL""",
    "attr_touchpoints": f"""SELECT candidate_id AS attribution_id, stat_date, outcome_event_id AS conversion_event_id, order_id, user_id, CASE WHEN touch_event_id IS NULL THEN 0 ELSE touchpoint_seq END AS touchpoint_seq,
  CASE WHEN touch_event_id IS NULL THEN 'organic' ELSE 'click' END AS touchpoint_type, strftime(touch_time, {TS}) AS touch_time, creative_id, campaign_id, advertiser_id, l AS is_last_click, 'last_click_30d' AS attribution_model,
  CAST(l AS INT)::DOUBLE AS touch_weight, CASE WHEN l THEN CAST(order_gmv AS DOUBLE) ELSE 0 END AS attributed_gmv, CAST(l AS INT)::DOUBLE AS attributed_conv, CAST(30 AS INT) AS lookback_days
  FROM (SELECT *, touch_event_id IS NOT NULL AND touchpoint_seq = 1 AS l FROM cand)""",
    "attr_order_detail": _plain("detail", "order_gmv touch_spend", "order_ts click_ts"),
    "attr_summary": _plain("summary", "attributed_gmv attributed_spend"),
    "last_touch_asof": f"SELECT * EXCLUDE (touchpoint_seq) REPLACE ({_D('order_gmv touch_spend')}, {_T('outcome_time touch_time')}) FROM cand WHERE touchpoint_seq = 1",
    "stream_attribution": f"SELECT * EXCLUDE (touchpoint_seq) REPLACE ({_D('order_gmv touch_spend')}, {_T('outcome_time touch_time')}) FROM cand WHERE touchpoint_seq = 1",
    "stream_attribution_final": f"""SELECT * EXCLUDE (touchpoint_seq) REPLACE ({_D('order_gmv touch_spend')}, {_T('outcome_time touch_time')}) FROM cand WHERE touchpoint_seq = 1
  AND outcome_time < (SELECT max(event_ts) FROM ad_events WHERE event_type IN ('order', 'click')) - INTERVAL 10 MINUTE""",
    "click_features": _plain("clicks", _CLICK_DOUBLES, "event_time"),
    "fraud_features": f"SELECT * REPLACE ({_D('ctr_deviation ua_entropy fraud_score')}), CASE fraud_label WHEN 'NORMAL' THEN 'NONE' ELSE fraud_label END AS rule_hits FROM fraud",
    "fraud_signals_1m": _plain("signals", "suspicious_spend risk_score", "window_start window_end"),
    "fraud_daily": _plain("fraud_day", "suspicious_spend"),
    "advertiser_retention": _plain("retained"),
    "creative_offline": _plain("creative_rows", "campaign_budget bid_amount cost gmv"),
    "creative_rolling_7d": """SELECT stat_date, creative_id, cost_1d::DOUBLE AS cost_1d, gmv_1d::DOUBLE AS gmv_1d, """
    + ", ".join(
        f"CAST(sum({c}_1d) OVER (PARTITION BY creative_id ORDER BY CAST(stat_date AS DATE) RANGE BETWEEN {f} AND CURRENT ROW) AS DOUBLE) AS {c}_{n}"
        for n, f in (("7d", "INTERVAL 6 DAY PRECEDING"), ("total", "UNBOUNDED PRECEDING"))
        for c in ("cost", "gmv")
    )
    + " FROM daily",
    "creative_backfill": f"""SELECT f.stat_date, f.creative_id, coalesce(h.creative_name, f.creative_id) AS creative_name, f.campaign_id, coalesce(h.campaign_name, f.campaign_id) AS campaign_name, f.advertiser_id,
  coalesce(h.advertiser_name, f.advertiser_id) AS advertiser_name, f.unit_id, coalesce(h.unit_name, f.unit_id) AS unit_name, impressions, clicks, conversions, orders, {_D('cost gmv')},
  {_r('clicks', 'impressions')} AS ctr, {_r('conversions', 'clicks')} AS cvr, {_r('cost', 'clicks', 4)} AS cpc, {_r('cost', 'conversions', 4)} AS cpa, {_r('gmv', 'cost')} AS roas
  FROM (SELECT event_date AS stat_date, creative_id, max(advertiser_id) AS advertiser_id, max(campaign_id) AS campaign_id, max(unit_id) AS unit_id, {COUNTS}, sum(spend) AS cost, sum(gmv) AS gmv FROM ad_events WHERE event_date < '{AS_OF}' GROUP BY ALL) f
  LEFT JOIN hierarchy h ON f.creative_id = h.creative_id""",
    "creative_latest_flag": "SELECT stat_date, creative_id, is_latest_partition FROM creative_latest",
    "metrics_10s": _plain("m10", "spend gmv", "window_start window_end"),
    "metrics_10s_enriched": _plain("m10_named", "spend gmv", "window_start window_end"),
    "metrics_change": _plain("m10_change", "spend gmv previous_spend previous_gmv spend_change gmv_change", "window_start window_end"),
    "stream_metrics_10s": _plain("m10", "spend gmv", "window_start window_end", _CLOSED),
    "stream_metrics_dedupe": _plain("m10", "spend gmv", "window_start window_end", _CLOSED),
    "stream_late_dropped": _plain("m10", "spend gmv", "window_start window_end", _CLOSED),
    "stream_restarted": _plain("m10", "spend gmv", "window_start window_end", _CLOSED),
    "views_sql": "SELECT industry, attribution_period, sum(orders)::BIGINT AS orders, sum(attributed_gmv)::DOUBLE AS gmv FROM summary JOIN adv USING (advertiser_id) GROUP BY ALL",
    "jdbc_upserts": """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment) || ' CHANGED' ELSE c_mktsegment END AS segment, CAST(c_acctbal AS DECIMAL(18,2))::DOUBLE AS balance FROM customer
  UNION ALL SELECT c_custkey + 1000000000, 'NEW', 0.0::DOUBLE FROM customer WHERE c_custkey % 50 = 0""",
    "stream_chain": f"SELECT event_id, strftime(event_ts, {TS}) AS event_ts, event_date, event_type, CASE WHEN CAST(event_id AS BIGINT) % 50 = 4 THEN -1 ELSE spend::DOUBLE END AS spend, gmv::DOUBLE AS gmv, advertiser_name, campaign_name, creative_name FROM dwd WHERE CAST(event_id AS BIGINT) % 50 NOT IN (1, 2, 3)",
    "stream_cdc": _plain("current_orders", "gmv"),
    "stream_tail": "SELECT order_id, status, gmv::DOUBLE AS gmv FROM changes WHERE op = 'u'",
    "cdc_local_times": f"""SELECT o_orderkey AS order_id, CASE WHEN step = 1 THEN {_LOCAL} END AS create_time, CASE WHEN step = 2 THEN {_LOCAL} END AS payment_time, CASE WHEN step = 3 THEN {_LOCAL} END AS refund_time, CASE WHEN step = 4 THEN {_LOCAL} END AS finish_time,
  order_status, CAST(step AS INT) AS seq FROM orders, (VALUES (1, 0, 'created'), (2, 1, 'paid'), (3, 3, 'refunded'), (4, 5, 'finished')) v(step, days, order_status)
  WHERE step = 1 OR (step = 2 AND o_orderkey % 2 = 1) OR (step = 3 AND o_orderkey % 9 = 0) OR (step = 4 AND o_orderkey % 4 = 0)""",
    "published_retention": _plain("retained"),
    "keyed_upserts": "SELECT order_id, status, gmv::DOUBLE AS gmv, op, seq FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) AS rn FROM changes) WHERE rn = 1",
    "published_daily": _plain("daily", "cost_1d gmv_1d"),
    "published_rollback": _plain("summary", "attributed_gmv attributed_spend"),
    "ordered_creatives": "SELECT row_number() OVER (ORDER BY stat_date, creative_id) AS position, stat_date, creative_id, advertiser_name, cost::DOUBLE AS cost FROM creative_rows",
    "ordered_top_orders": "SELECT * FROM (SELECT row_number() OVER (ORDER BY order_gmv DESC, order_event_id) AS position, order_event_id, order_gmv::DOUBLE AS order_gmv, attribution_period FROM detail) WHERE position BETWEEN 101 AND 600",
    "attr_detail_joined": _plain("detail", "order_gmv touch_spend", "order_ts click_ts"),
    "fraud_signals_joined": _plain("signals", "suspicious_spend risk_score", "window_start window_end"),
    "stream_dwd": _plain("dwd", "spend gmv", "event_ts"),
    "reenrich_unknown": "SELECT event_id, advertiser_name FROM dwd",
    "latest_by_key": "SELECT order_id, status, gmv::DOUBLE AS gmv, op, seq FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) AS rn FROM changes) WHERE rn = 1",
    "cdc_apply": _plain("current_orders", "gmv"),
    "changelog_diff": """SELECT '-D' AS row_kind, order_id, status, gmv::DOUBLE AS gmv FROM base_orders WHERE order_id NOT IN (SELECT order_id FROM current_orders)
  UNION ALL SELECT k, b.order_id, CASE k WHEN '-U' THEN b.status ELSE c.status END, CASE k WHEN '-U' THEN b.gmv::DOUBLE ELSE c.gmv::DOUBLE END FROM base_orders b JOIN current_orders c ON b.order_id = c.order_id, (VALUES ('-U'), ('+U')) v(k) WHERE b.status <> c.status OR b.gmv <> c.gmv""",
    "order_lifecycle": """SELECT o_orderkey AS order_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS create_time, CASE WHEN o_orderkey % 2 = 1 THEN CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR) END AS payment_time,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 3 AS VARCHAR) END AS refund_time, CASE WHEN o_orderkey % 4 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 5 AS VARCHAR) END AS finish_time,
  CASE WHEN o_orderkey % 4 = 0 THEN 'finished' WHEN o_orderkey % 9 = 0 THEN 'refunded' WHEN o_orderkey % 2 = 1 THEN 'paid' ELSE 'created' END AS order_status FROM orders""",
    "cdc_evolving": """SELECT o_orderkey AS order_id, o_orderstatus AS status,
  CASE WHEN o_orderkey % 5 = 0 THEN 'c' || o_orderkey WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 7 AS VARCHAR) ELSE CAST(o_orderkey % 10 AS VARCHAR) END AS code,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 100 + 0.5 WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 100 END::DOUBLE AS weight,
  CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END::DOUBLE AS gmv FROM orders WHERE o_orderkey % 35 <> 0""",
    "reconcile": f"""SELECT stat_date, creative_id, n AS clicks_left, CASE WHEN stat_date < '{AS_OF}' THEN n END AS clicks_right, CASE WHEN stat_date < '{AS_OF}' THEN 0.0::DOUBLE ELSE n::DOUBLE END AS clicks_diff, stat_date < '{AS_OF}' AS is_match
  FROM (SELECT event_date AS stat_date, creative_id, {_n('click')} AS n FROM ad_events GROUP BY ALL)""",
    "reconcile_bucketed": f"""SELECT stat_date, creative_id, n AS clicks_left, CASE WHEN stat_date < '{AS_OF}' THEN n END AS clicks_right, CASE WHEN stat_date < '{AS_OF}' THEN 0.0::DOUBLE ELSE n::DOUBLE END AS clicks_diff, stat_date < '{AS_OF}' AS is_match
  FROM (SELECT event_date AS stat_date, creative_id, {_n('click')} AS n FROM ad_events GROUP BY ALL)""",
    "upsert_messages": """SELECT '{"order_id":' || order_id || '}' AS key, '{"order_id":' || order_id || ',"status":"' || status || '"}' AS value FROM current_orders""",
}

_CTR, _CVR = _r("sum(clicks)", "sum(impressions)"), _r("sum(conversions)", "sum(clicks)")
_LATE = "FILTER (WHERE is_latest_partition)"
_ATTRIBUTED = "FILTER (WHERE attribution_period <> '自然订单')"


def _z(x: str) -> str:
    return f"coalesce({x}, 0)"


#: The metrics of the seven datasets, stated a second time.
METRICS: dict[str, dict[str, str]] = {
    "events_detail": {
        "count": "count(*)", "total_spend": "sum(spend)", "total_gmv": "sum(gmv)", "impression_events": _n("impression"), "click_events": _n("click"), "conversion_events": _n("conversion"),
    },
    "realtime": {
        "count": "count(*)", "total_spend": "sum(spend)", "total_gmv": "sum(gmv)", "total_impressions": "sum(impressions)", "total_clicks": "sum(clicks)", "total_conversions": "sum(conversions)", "total_orders": "sum(orders)",
        "ctr": _CTR, "cvr": _CVR, "roas": _r("sum(gmv)", "sum(spend)"), "spend_change": "sum(spend_change)", "gmv_change": "sum(gmv_change)",
    },
    "retention": {
        "count": "count(*)", "cohort_size": "sum(cohort_size)", "retained_1d": "sum(retained_1d)", "retained_7d": "sum(retained_7d)",
        "avg_rate_1d": "round(avg(rate_1d), 6)", "avg_rate_7d": "round(avg(rate_7d), 6)", "avg_rate_15d": "round(avg(rate_15d), 6)", "avg_rate_30d": "round(avg(rate_30d), 6)",
    },
    "attribution": {
        "count": "count(*)", "total_conversions": "sum(conversions)", "total_orders": "sum(orders)", "total_order_gmv": "sum(attributed_gmv)", "attributed_gmv": _z(f"sum(attributed_gmv) {_ATTRIBUTED}"),
        "direct_gmv": _z("sum(attributed_gmv) FILTER (WHERE attribution_period = '30分钟直接归因')"), "indirect_gmv": _z("sum(attributed_gmv) FILTER (WHERE attribution_period IN ('1日间接归因', '3日间接归因', '7日间接归因', '30日间接归因'))"),
        "organic_gmv": _z("sum(attributed_gmv) FILTER (WHERE attribution_period = '自然订单')"), "attributed_orders": _z(f"sum(orders) {_ATTRIBUTED}"), "attributed_order_rate": _r(_z(f"sum(orders) {_ATTRIBUTED}"), "sum(orders)"),
        "attributed_gmv_rate": _r(_z(f"sum(attributed_gmv) {_ATTRIBUTED}"), "sum(attributed_gmv)"), "attributed_spend": "sum(attributed_spend)",
    },
    "order_detail": {"order_count": "count(*)", "order_gmv": "sum(order_gmv)", "avg_lag_minutes": "round(avg(lag_minutes), 6)"},
    "creative": {
        "count": "count(*)", "row_count": "count(*)", "active_creatives": "count(DISTINCT creative_id)", "total_cost": "sum(cost)", "total_gmv": "sum(gmv)", "total_impressions": "sum(impressions)", "total_clicks": "sum(clicks)",
        "total_conversions": "sum(conversions)", "total_orders": "sum(orders)", "ctr": _CTR, "cvr": _CVR, "roas": _r("sum(gmv)", "sum(cost)"), "cpc": _r("sum(cost)", "sum(clicks)"), "cpa": _r("sum(cost)", "sum(conversions)"),
        "latest_cost": _z(f"sum(cost) {_LATE}"), "latest_gmv": _z(f"sum(gmv) {_LATE}"), "latest_impressions": _z(f"sum(impressions) {_LATE}"), "latest_clicks": _z(f"sum(clicks) {_LATE}"),
        "latest_conversions": _z(f"sum(conversions) {_LATE}"), "latest_orders": _z(f"sum(orders) {_LATE}"), "latest_roas": _r(f"sum(gmv) {_LATE}", f"sum(cost) {_LATE}"),
        "latest_ctr": _r(f"sum(clicks) {_LATE}", f"sum(impressions) {_LATE}"), "latest_cvr": _r(f"sum(conversions) {_LATE}", f"sum(clicks) {_LATE}"),
    },
    "fraud": {
        "count": "count(*)", "suspicious_users": "sum(suspicious_users)", "suspicious_windows": "sum(suspicious_windows)", "suspicious_clicks": "sum(suspicious_clicks)", "suspicious_spend": "sum(suspicious_spend)", "avg_risk_score": "round(avg(avg_risk_score), 6)",
    },
}
_TIMES = {"events_detail": "event_ts", "realtime": "window_start", "retention": "cohort_date", "attribution": "event_date", "order_detail": "order_ts", "creative": "stat_date", "fraud": "event_date"}

_SOURCES = {"events_detail": "dwd", "realtime": "m10_change", "retention": "retained", "attribution": "summary", "order_detail": "detail", "creative": "creative_latest", "fraud": "fraud_day"}


def _where(chart: Chart) -> str:
    """Filters and time range of a chart, as a condition."""
    tests = [f"{c} IN ({', '.join(repr(v) for v in values)})" for c, values in chart.filters.items()]
    start, _, end = (chart.time_range or " : ").partition(" : ")
    day = f"substr(CAST({_TIMES[chart.dataset]} AS VARCHAR), 1, 10)"
    if start.startswith("Last"):
        return f" WHERE CAST({day} AS DATE) >= current_date - {int(start.split()[1])} AND CAST({day} AS DATE) < current_date"
    tests += [f"{day} {sign} '{x.strip()}'" for sign, x in ((">=", start), ("<", end)) if x.strip()]
    return f" WHERE {' AND '.join(tests)}" if tests else ""


def _chart(chart: Chart) -> str:
    keys = [*(["day"] if chart.grain else []), *chart.groupby]
    shown = [f"strftime({k}, {TS}) AS {k}" if k.endswith("_ts") else k for k in keys]
    whole = ("count", "orders", "events", "size", "retained_1d", "retained_7d", "impressions", "clicks", "conversions", "users", "windows", "creatives")
    cells = [f"CAST({METRICS[chart.dataset][m]} AS {'BIGINT' if m.endswith(whole) else 'DOUBLE'}) AS {m}" for m in chart.metrics]
    day = f", substr(CAST({_TIMES[chart.dataset]} AS VARCHAR), 1, 10) AS day" if chart.grain else ""
    inner = f"SELECT {', '.join([*keys, *cells])} FROM (SELECT *{day} FROM {_SOURCES[chart.dataset]}{_where(chart)})" + (f" GROUP BY {', '.join(keys)}" if keys else "")
    first = chart.metrics[0]
    share = f", round({first}::DOUBLE / nullif(sum({first}::DOUBLE) OVER (), 0), 6) AS share" if chart.share else ""
    end = f" ORDER BY {first} DESC, {', '.join(f'{k} NULLS FIRST' for k in keys)} LIMIT {chart.limit}" if chart.limit else ""
    return f"SELECT {', '.join([*shown, *chart.metrics])}{share} FROM ({inner}{end})"


def _tall(charts: dict[str, Chart]) -> str:
    """Charts' rows as (chart, keys, metric, value)."""
    parts = []
    for name, chart in charts.items():
        keys = [*(["day"] if chart.grain else []), *chart.groupby]
        text = f"concat_ws('|', {', '.join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)})" if keys else "''"
        parts += [f"SELECT '{name}' AS chart, {text} AS keys, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({_chart(chart)})" for m in [*chart.metrics, *(["share"] if chart.share else [])]]
    return "\nUNION ALL ".join(parts)


def sql() -> dict[str, str]:
    """Name -> whole statement."""
    head = "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in CTES.items()) + "\n"
    boards = {f"dashboard_{d}": head + _tall({n: CHARTS[n] for n in names}) for d, (names, _) in DASHBOARDS.items()}
    boards["dashboard_cross_filter"] = head + _tall(cross_filtered({n: CHARTS[n] for n in DASHBOARDS["attribution"][0]}, SELECTED))
    FINAL["changelog_bucketed"] = FINAL["changelog_diff"]
    return {n: head + q for n, q in FINAL.items()} | boards | {n: head + _chart(c) for n, c in REPORTS.items()} | {f"bi_{n}": head + _chart(c) for n, c in CHARTS.items()}
