"""DuckDB oracle statements for the registered queries.

Written independently of the Spark code (windows with ``lag`` where Spark
telescopes, ``FILTER`` clauses where Spark uses conditional aggregates).
Money is summed as integer cents on both sides so results are exact.
"""

from __future__ import annotations

T = "TIMESTAMP '2024-01-21 00:00:00'"
T_DATE = "DATE '2024-01-21'"
T_END = "TIMESTAMP '2024-01-24 00:00:00'"  # cutoff + 3-day horizon

_CENTS = "CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)"
_E = f"e AS (SELECT *, {_CENTS} AS c, CAST(ts AS DATE) AS day FROM events)"

# around the mean to the nearest cent, so that squares stay small
_Q = "CAST(round(CAST(sum(c) AS DOUBLE) / CAST(count(c) AS DOUBLE)) AS HUGEINT)"
_STD = f"""sqrt((CAST(sum(c * c) - 2 * {_Q} * sum(c) + count(c) * {_Q} * {_Q} AS DOUBLE)
             - CAST(sum(c) - count(c) * {_Q} AS DOUBLE) * CAST(sum(c) - count(c) * {_Q} AS DOUBLE) / CAST(count(c) AS DOUBLE))
            / CAST(count(c) - 1 AS DOUBLE)) / 100.0"""

_ROLLUP = f"""
    count(*) AS n_events,
    CAST(sum(c) AS DOUBLE) / 100.0 AS sum_value,
    CAST(sum(c) AS DOUBLE) / CAST(count(c) * 100 AS DOUBLE) AS mean_value,
    CASE WHEN count(c) >= 2 THEN
      {_STD} END AS std_value,
    quantile_cont(c, 0.5) / 100.0 AS median_value,
    count(DISTINCT day) AS active_days"""

_TYPES = ",\n".join(
    f"    count(*) FILTER (WHERE event_type = '{t}') AS n_{t}"
    for t in ("click", "error", "purchase", "signup", "view"))


def _horizons(days=(1, 3, 7, 14)) -> str:
    parts = []
    for d in days:
        w = f"ts >= {T} - INTERVAL {d} DAY AND ts < {T}"
        parts.append(f"    count(*) FILTER (WHERE {w}) AS n_{d}d")
        parts.append(f"    COALESCE(CAST(sum(c) FILTER (WHERE {w}) AS DOUBLE) / 100.0, 0.0)"
                     f" AS sum_{d}d")
    return ",\n".join(parts)


_GAPS = f"""g AS (
  SELECT user_id,
         epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d
  FROM events WHERE ts < {T})"""

ORACLE: dict[str, str] = {}

ORACLE["p01_load"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

ORACLE["p02_parse_props"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

ORACLE["p02_parse_props_struct"] = ORACLE["p02_parse_props"]

ORACLE["p03_observe"] = f"""
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts < {T}"""

ORACLE["p04_label"] = f"""
SELECT user_id,
       CAST(max(CASE WHEN ts >= {T} AND ts < {T_END} AND event_type = 'purchase'
                     THEN 1 ELSE 0 END) AS INTEGER) AS label
FROM events
WHERE user_id IN (SELECT user_id FROM events WHERE ts < {T})
GROUP BY user_id"""

ORACLE["p05_rollup_features"] = f"""
WITH {_E}
SELECT user_id,{_ROLLUP}
FROM e WHERE ts < {T} GROUP BY user_id"""

ORACLE["p06_type_counts"] = f"""
SELECT user_id,
{_TYPES}
FROM events WHERE ts < {T} GROUP BY user_id"""

ORACLE["p07_horizon_features"] = f"""
WITH {_E}
SELECT user_id,
{_horizons()}
FROM e WHERE ts < {T} GROUP BY user_id"""

ORACLE["p09_recency"] = f"""
SELECT user_id, CAST(date_diff('day', CAST(max(ts) AS DATE), {T_DATE}) AS INTEGER)
       AS days_since_last
FROM events WHERE ts < {T} GROUP BY user_id"""

ORACLE["p10_gaps"] = f"""
WITH {_GAPS}
SELECT user_id, CAST(sum(d) AS DOUBLE) / count(d) / 1e6 AS mean_gap_s
FROM g GROUP BY user_id"""

ORACLE["training_table"] = f"""
WITH {_E}, f AS (
  SELECT user_id,{_ROLLUP},
{_TYPES},
{_horizons()},
    CAST(date_diff('day', CAST(max(ts) AS DATE), {T_DATE}) AS INTEGER) AS days_since_last
  FROM e WHERE ts < {T} GROUP BY user_id),
{_GAPS},
gm AS (SELECT user_id, CAST(sum(d) AS DOUBLE) / count(d) / 1e6 AS mean_gap_s
       FROM g GROUP BY user_id),
lab AS (
  SELECT DISTINCT user_id FROM events
  WHERE ts >= {T} AND ts < {T_END} AND event_type = 'purchase')
SELECT f.*, gm.mean_gap_s,
       CAST(CASE WHEN lab.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS label
FROM f JOIN gm USING (user_id) LEFT JOIN lab USING (user_id)"""

ORACLE["p08_rolling"] = f"""
WITH {_E}
SELECT event_id, user_id, ts,
       count(*) OVER w AS n_7d,
       COALESCE(CAST(sum(c) OVER w AS DOUBLE), 0.0) / 100.0 AS sum_7d
FROM e
WINDOW w AS (PARTITION BY user_id ORDER BY ts
             RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)"""

ORACLE["p11_asof_last_view"] = """
WITH p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
     v AS (SELECT user_id, ts AS prev_ts, value AS prev_value, event_id AS prev_event_id
           FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.ts, p.value, v.prev_ts, v.prev_value, v.prev_event_id
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts > v.prev_ts"""

_SESS = """
l AS (SELECT event_id, user_id, ts, value,
             lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
      FROM events),
s AS (SELECT *, CASE WHEN prev IS NULL OR ts - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END
                AS is_start FROM l),
n AS (SELECT *, sum(is_start) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                    ROWS UNBOUNDED PRECEDING) AS session_idx FROM s)"""

ORACLE["p12_sessionize"] = f"""
WITH {_SESS}
SELECT event_id, user_id, ts, CAST(session_idx AS BIGINT) AS session_idx,
       CAST(is_start AS INTEGER) AS is_start
FROM n"""

ORACLE["p12_sessions"] = f"""
WITH {_SESS}
SELECT user_id, CAST(session_idx AS BIGINT) AS session_idx,
       min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
       count(*) AS n_events,
       CAST(sum({_CENTS}) AS DOUBLE) / 100.0 AS sum_value
FROM n GROUP BY user_id, session_idx"""

ORACLE["p13_enrich"] = f"""
WITH {_E},
u AS (SELECT user_id, count(*) AS n_events, CAST(sum(c) AS DOUBLE) / 100.0 AS sum_value
      FROM e WHERE ts < {T} GROUP BY user_id)
SELECT u.user_id, u.n_events, u.sum_value, c.c_mktsegment, c.c_nationkey, c.c_acctbal,
       n.n_name, r.r_name
FROM u
LEFT JOIN customer c ON u.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

_KY = """x AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events)"""

ORACLE["p14_target_mean"] = f"""
WITH {_KY}
SELECT event_id, k, y,
       CAST(sum(y) OVER (PARTITION BY k) - y AS DOUBLE)
       / NULLIF(CAST(count(y) OVER (PARTITION BY k) - 1 AS DOUBLE), 0) AS te
FROM x"""

ORACLE["p15_clip_and_scale"] = f"""
WITH b AS (SELECT quantile_disc(value, 0.01) AS lo, quantile_disc(value, 0.99) AS hi FROM events),
x AS (SELECT event_id, least(greatest(value, b.lo), b.hi) AS v FROM events, b),
xc AS (SELECT CAST(CAST(v AS DECIMAL(18,2)) * 100 AS BIGINT) AS c FROM x),
s AS (SELECT CAST(sum(c) AS DOUBLE) / CAST(count(c) * 100 AS DOUBLE) AS mean,
             {_STD} AS std
      FROM xc)
SELECT event_id, v AS value_clipped, (v - s.mean) / s.std AS value_z FROM x, s"""

ORACLE["p16_hash_split"] = """
SELECT DISTINCT user_id,
       CAST(CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS INTEGER)
       AS fold
FROM events"""

ORACLE["p17_top_k"] = """
SELECT user_id, event_id, value, CAST(rn AS INTEGER) AS rank
FROM (SELECT user_id, event_id, value,
             row_number() OVER (PARTITION BY user_id
                                ORDER BY value DESC NULLS LAST, event_id NULLS LAST) AS rn
      FROM events)
WHERE rn <= 3"""

ORACLE["p18_metrics"] = f"""
WITH sc AS (
  SELECT user_id, CAST(count(*) FILTER (WHERE event_type = 'purchase') + 1 AS DOUBLE)
                  / CAST(count(*) + 2 AS DOUBLE) AS score
  FROM events WHERE ts < {T} GROUP BY user_id),
lab AS (SELECT DISTINCT user_id FROM events
        WHERE ts >= {T} AND ts < {T_END} AND event_type = 'purchase'),
j AS (SELECT sc.score, CASE WHEN lab.user_id IS NULL THEN 0 ELSE 1 END AS label
      FROM sc LEFT JOIN lab USING (user_id)),
r AS (SELECT label, rank() OVER (ORDER BY score) AS rk,
             count(*) OVER (PARTITION BY score) AS ties FROM j),
cnt AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS n FROM j),
au AS (SELECT CAST(sum(CASE WHEN label = 1 THEN 2 * rk + ties - 1 ELSE 0 END) - cnt.p * (cnt.p + 1)
                   AS DOUBLE) / CAST(2 * cnt.p * cnt.n AS DOUBLE) AS auc
       FROM r, cnt GROUP BY cnt.p, cnt.n),
m AS (SELECT count(*) FILTER (WHERE label = 1) AS n_pos,
             count(*) FILTER (WHERE label <> 1) AS n_neg,
             count(*) FILTER (WHERE score >= 0.2 AND label = 1) AS tp,
             count(*) FILTER (WHERE score >= 0.2 AND label <> 1) AS fp,
             count(*) FILTER (WHERE score < 0.2 AND label = 1) AS fn,
             count(*) AS n
      FROM j),
ls AS (SELECT sum(CAST(-(pos * ln(score) + neg * ln(1.0 - score)) AS DECIMAL(38,12))) AS loss
       FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
                    count(*) FILTER (WHERE label <> 1) AS neg FROM j GROUP BY score))
SELECT n_pos, n_neg,
       CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0) AS precision,
       CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS recall,
       round(CAST(ls.loss AS DOUBLE) / CAST(n AS DOUBLE), 9) AS logloss, au.auc
FROM m, au, ls"""

ORACLE["p19_leaderboard"] = """
WITH t AS (SELECT user_id, max(value) AS best_score, count(*) AS n_submissions
           FROM events GROUP BY user_id)
SELECT user_id, best_score, n_submissions,
       rank() OVER (ORDER BY best_score DESC) AS rank,
       count(*) OVER () AS n_teams,
       CAST(rank() OVER (ORDER BY best_score DESC) AS DOUBLE)
       / CAST(count(*) OVER () AS DOUBLE) AS rank_frac
FROM t"""


def _report(kind: str) -> str:
    return f"""
WITH {_E}
SELECT event_type, day,
       CAST(GROUPING(event_type) AS INTEGER) AS g_event_type,
       CAST(GROUPING(day) AS INTEGER) AS g_day,
       count(*) AS n_events, CAST(sum(c) AS DOUBLE) / 100.0 AS sum_value
FROM e GROUP BY {kind} (event_type, day)"""


ORACLE["p20_report_cube"] = _report("CUBE")
ORACLE["p20_report_rollup"] = _report("ROLLUP")

ORACLE["p21_cohort_diff"] = """
WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'
           AND ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-03 00:00:00'),
     b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'
           AND ts >= TIMESTAMP '2024-01-28 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00')
SELECT user_id, 'lost' AS status FROM (SELECT user_id FROM a EXCEPT SELECT user_id FROM b)
UNION ALL
SELECT user_id, 'kept' AS status FROM (SELECT user_id FROM a INTERSECT SELECT user_id FROM b)
UNION ALL
SELECT user_id, 'new' AS status FROM (SELECT user_id FROM b EXCEPT SELECT user_id FROM a)"""

_HOURLY = f"""
WITH {_E},
w AS (SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events,
             CAST(sum(c) AS DOUBLE) / 100.0 AS sum_value
      FROM e GROUP BY 1, 2)"""

ORACLE["p23_hourly_counts_batch"] = _HOURLY + """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n_events, sum_value
FROM w"""

ORACLE["p23_hourly_counts_stream"] = ORACLE["p23_hourly_counts_batch"]

ORACLE["p24_stream_sessions"] = f"""
WITH {_SESS},
sess AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
                count(*) AS n_events,
                CAST(sum({_CENTS}) AS DOUBLE) / 100.0 AS sum_value
         FROM n GROUP BY user_id, session_idx)
SELECT user_id, session_start, session_end, n_events, sum_value FROM sess"""

ORACLE["p25_stream_dedup"] = """
SELECT event_id, ts, user_id, event_type, value, props
FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1"""

ORACLE["p26_partitioned_features"] = f"""
WITH {_E}
SELECT user_id, day, count(*) AS n_events, CAST(sum(c) AS DOUBLE) / 100.0 AS sum_value
FROM e GROUP BY user_id, day"""

ORACLE["p26_submission_csv"] = f"""
SELECT user_id, CAST(count(*) FILTER (WHERE event_type = 'purchase') + 1 AS DOUBLE)
                / CAST(count(*) + 2 AS DOUBLE) AS score
FROM events WHERE ts < {T} GROUP BY user_id"""

ORACLE["p25_dedup_batch"] = """
WITH a AS (SELECT event_id, ts, user_id, event_type, value, props FROM events
           UNION ALL
           SELECT event_id, ts + INTERVAL 1 HOUR, user_id, event_type, value, props FROM events
           WHERE event_type = 'purchase')
SELECT * FROM a WHERE event_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_id
                           ORDER BY ts, user_id, event_type, value, props) = 1
UNION ALL
SELECT * FROM a WHERE event_id IS NULL"""

ORACLE["p22_fit_score_check"] = f"""
WITH f AS (SELECT user_id,
                  CAST(max(CASE WHEN ts >= {T} AND ts < {T_END} AND event_type = 'purchase'
                                THEN 1 ELSE 0 END) AS INTEGER) AS label,
                  count(*) FILTER (WHERE ts < {T}) AS seen,
                  CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS fold
           FROM events GROUP BY user_id)
SELECT user_id, label, true AS in_range FROM f WHERE seen > 0 AND fold = 0"""

ORACLE["vector_search_exact"] = """
WITH pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id AS id,
         sqrt(list_sum(list_transform(list_zip(q.embedding, x.embedding),
                                      lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))) AS d
  FROM embeddings q JOIN embeddings x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS INTEGER) AS rank, id,
       round(d, 6) AS distance
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d, id) <= 10"""

ORACLE["interval_join_state"] = """
WITH valid AS (
  SELECT event_id AS signup_id, user_id, ts AS a,
         coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '2100-01-01') AS z
  FROM events WHERE event_type = 'signup')
SELECT e.event_id, e.user_id, signup_id
FROM events e LEFT JOIN valid v ON e.user_id = v.user_id AND v.a <= e.ts AND e.ts < v.z
WHERE e.event_type = 'purchase'"""

ORACLE["interval_join_any"] = """
SELECT p.event_id, x.event_id AS error_id
FROM events p JOIN events x ON x.ts <= p.ts AND p.ts < x.ts + INTERVAL 10 MINUTE
WHERE p.event_type = 'purchase' AND x.event_type = 'error'"""

ORACLE["overlap_join"] = """
WITH v AS (SELECT event_id, user_id, ts AS a, ts + INTERVAL 3 HOUR AS z FROM events WHERE event_type = 'view'),
     x AS (SELECT event_id AS error_id, user_id, ts AS b, ts + INTERVAL 1 DAY AS y FROM events WHERE event_type = 'error')
SELECT event_id, error_id, greatest(a, b) AS overlap_start,
       CAST(epoch_us(least(z, y)) - epoch_us(greatest(a, b)) AS DOUBLE) / 1000000.0 AS overlap_seconds
FROM v JOIN x ON v.user_id = x.user_id AND a < y AND b < z"""

ORACLE["funnel"] = """
WITH e AS (SELECT user_id, event_type, ts, event_id FROM events WHERE event_type IN ('view', 'click', 'purchase')),
s2 AS (
  SELECT b.user_id, b.ts, b.event_id, max(a.ts) AS start
  FROM e a JOIN e b ON a.user_id = b.user_id AND (a.ts < b.ts OR a.ts = b.ts AND a.event_id < b.event_id)
  WHERE a.event_type = 'view' AND b.event_type = 'click' AND b.ts <= a.ts + INTERVAL 3 DAY GROUP BY 1, 2, 3),
s3 AS (
  SELECT c.user_id, c.ts
  FROM s2 JOIN e c ON s2.user_id = c.user_id AND (s2.ts < c.ts OR s2.ts = c.ts AND s2.event_id < c.event_id)
  WHERE c.event_type = 'purchase' AND c.ts <= start + INTERVAL 3 DAY)
SELECT user_id,
       CAST(CASE WHEN user_id IN (SELECT user_id FROM s3) THEN 3 WHEN user_id IN (SELECT user_id FROM s2) THEN 2
            WHEN count(*) FILTER (WHERE event_type = 'view') > 0 THEN 1 ELSE 0 END AS INTEGER) AS depth,
       (SELECT min(s3.ts) FROM s3 WHERE s3.user_id = e.user_id) AS completed_at
FROM e GROUP BY user_id"""

ORACLE["p25_stream_late"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE event_id % 10 <> 0
   OR ts > (SELECT max(ts) FROM events WHERE event_id % 10 <> 0 AND ts < TIMESTAMP '2024-01-16') - INTERVAL 1 HOUR"""

ORACLE["stream_attribution"] = """
SELECT p.event_id, p.user_id, c.event_id AS click_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
  ON p.user_id = c.user_id AND c.ts <= p.ts AND c.ts >= p.ts - INTERVAL 6 HOUR"""

_SNAPSHOTS = """
s AS (
  SELECT 1 AS v, c_custkey, c_acctbal, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 10 <> 3
  UNION ALL
  SELECT 2, c_custkey, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 100 ELSE c_acctbal END,
         CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END, c_nationkey FROM customer WHERE c_custkey % 10 <> 5
  UNION ALL
  SELECT 3, c_custkey, c_acctbal, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 13 <> 0),
marked AS (
  SELECT *, v - 1 IS DISTINCT FROM lag(v) OVER k OR c_acctbal IS DISTINCT FROM lag(c_acctbal) OVER k
         OR c_mktsegment IS DISTINCT FROM lag(c_mktsegment) OVER k
         OR c_nationkey IS DISTINCT FROM lag(c_nationkey) OVER k AS begins
  FROM s WINDOW k AS (PARTITION BY c_custkey ORDER BY v)),
runs AS (SELECT *, sum(begins::INT) OVER (PARTITION BY c_custkey ORDER BY v) AS run FROM marked)"""

ORACLE["scd_history"] = f"""
WITH {_SNAPSHOTS}
SELECT c_custkey, any_value(c_acctbal) AS c_acctbal, any_value(c_mktsegment) AS c_mktsegment,
       any_value(c_nationkey) AS c_nationkey, make_timestamp(2024, min(v)::BIGINT, 1, 0, 0, 0.0) AS valid_from,
       CASE WHEN max(v) < 3 THEN make_timestamp(2024, max(v)::BIGINT + 1, 1, 0, 0, 0.0) END AS valid_to
FROM runs GROUP BY c_custkey, run"""

ORACLE["scd_state_at"] = f"""
WITH {_SNAPSHOTS},
e AS (SELECT event_id, user_id AS c_custkey, ts + INTERVAL 15 DAY AS ts FROM events WHERE event_type = 'purchase')
SELECT e.event_id, e.c_custkey, s.c_acctbal, s.c_mktsegment
FROM e LEFT JOIN s ON e.c_custkey = s.c_custkey
     AND s.v = CASE WHEN ts < TIMESTAMP '2024-01-01' THEN 0 WHEN ts < TIMESTAMP '2024-02-01' THEN 1 ELSE 2 END"""

ORACLE["sketch_rollup"] = """
SELECT event_type, a AS first_day, z AS last_day, count(*) AS n_events, true AS users_ok, true AS median_ok
FROM events JOIN (VALUES (DATE '2024-01-01', DATE '2024-01-07'), (DATE '2024-01-10', DATE '2024-01-10'),
                         (DATE '2024-01-01', DATE '2024-01-31')) r(a, z) ON CAST(ts AS DATE) BETWEEN a AND z
GROUP BY 1, 2, 3"""

ORACLE["clustered_read"] = """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31' AND l_partkey BETWEEN 100 AND 500"""

ORACLE["incremental_training_table"] = ORACLE["training_table"]
