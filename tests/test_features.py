import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensa.operators import features as feat

CUT = dt.datetime(2024, 1, 21)

ROWS = [
    (1, "2024-01-10 08:00:00", 1, "view", 10.10),
    (2, "2024-01-15 09:30:00", 1, "purchase", 20.25),
    (3, "2024-01-20 23:59:59.999999", 1, "click", 0.35),
    (4, "2024-01-21 00:00:00", 1, "purchase", 1.0),     # cutoff edge: label only
    (5, "2024-01-12 00:00:00", 2, "view", 5.0),
    (6, "2024-01-24 00:00:00", 2, "purchase", 1.0),     # horizon edge: outside label
    (7, "2024-01-22 00:00:00", 3, "purchase", 3.0),     # no history: not a row
    (8, "2024-01-18 10:00:00", 4, None, None),          # nulls
    (9, "2024-01-19 10:00:00", 4, "view", 2.5),
]


def rows_by_user(df):
    return {r["user_id"]: r for r in df.collect()}


def test_cutoff_and_horizon_edges(make_events):
    ev = make_events(ROWS)
    lab = rows_by_user(feat.label(ev, CUT, 3))
    assert set(lab) == {1, 2, 4}
    assert lab[1]["label"] == 1 and lab[2]["label"] == 0 and lab[4]["label"] == 0
    t = rows_by_user(feat.training_table(ev, CUT, 3, scale=2))
    assert t[1]["n_events"] == 3                      # the 00:00:00 purchase is not seen
    assert t[1]["n_purchase"] == 1 and t[1]["label"] == 1
    assert t[1]["sum_value"] == pytest.approx(30.70, abs=0)  # exact cents


def test_nulls_are_ignored_by_sums_and_form_no_type(make_events):
    t = rows_by_user(feat.training_table(make_events(ROWS), CUT, 3))
    assert t[4]["n_events"] == 2
    assert t[4]["sum_value"] == 2.5 and t[4]["mean_value"] == 2.5
    assert sum(t[4][f"n_{k}"] for k in ("click", "error", "purchase", "signup", "view")) == 1
    assert t[4]["std_value"] is None                  # one non-null value


def test_rollup_matches_pandas(make_events):
    ev = make_events(ROWS)
    got = rows_by_user(feat.rollup_features(feat.observe(ev, CUT)))
    pdf = pd.DataFrame(ROWS, columns=["event_id", "ts", "user_id", "event_type", "value"])
    pdf["ts"] = pd.to_datetime(pdf["ts"], format="ISO8601")
    pdf = pdf[pdf.ts < CUT]
    for uid, g in pdf.groupby("user_id"):
        r = got[uid]
        assert r["n_events"] == len(g)
        assert r["median_value"] == pytest.approx(g.value.median())
        assert r["active_days"] == g.ts.dt.date.nunique()
        if g.value.count() > 1:
            assert r["std_value"] == pytest.approx(g.value.std(), rel=1e-12)


def test_features_do_not_see_the_future(make_events):
    """Leakage: changing rows at or after the cutoff changes only the label."""
    base = ROWS[:]
    changed = [r if dt.datetime.fromisoformat(r[1]) < CUT else (r[0], r[1], r[2], "view", 999.0)
               for r in base]
    cols = [c for c in feat.training_table(make_events(base), CUT).columns if c != "label"]
    a = feat.training_table(make_events(base), CUT).select(cols).orderBy("user_id").collect()
    b = feat.training_table(make_events(changed), CUT).select(cols).orderBy("user_id").collect()
    assert a == b


def test_gaps_telescope_equals_lag(make_events):
    ev = make_events(ROWS)
    got = rows_by_user(feat.gaps(ev))
    pdf = pd.DataFrame(ROWS, columns=["event_id", "ts", "user_id", "event_type", "value"])
    pdf["ts"] = pd.to_datetime(pdf["ts"], format="ISO8601")
    for uid, g in pdf.sort_values(["ts", "event_id"]).groupby("user_id"):
        d = g.ts.diff().dropna().dt.total_seconds()
        exp = d.mean() if len(d) else None
        assert (got[uid]["mean_gap_s"] is None) if exp is None else \
            got[uid]["mean_gap_s"] == pytest.approx(exp)


def test_results_do_not_depend_on_partitioning(make_events, spark):
    import random
    rnd = random.Random(7)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(30 * 86400)),
             rnd.randrange(5), rnd.choice(["view", "purchase", "click"]),
             rnd.randrange(0, 50000) / 100) for i in range(3000)]
    one = feat.training_table(make_events(rows, 1), scale=2).orderBy("user_id").collect()
    many = feat.training_table(make_events(rows, 13), scale=2).orderBy("user_id").collect()
    assert one == many   # bit-for-bit, thanks to integer-cent aggregation


def test_recency_and_horizons(make_events):
    ev = make_events(ROWS)
    rec = rows_by_user(feat.recency(ev, CUT))
    assert rec[1]["days_since_last"] == 1 and rec[2]["days_since_last"] == 9
    hz = rows_by_user(feat.horizon_features(ev, CUT, [1, 7]))
    assert hz[1]["n_1d"] == 1 and hz[1]["sum_1d"] == 0.35
    assert hz[1]["n_7d"] == 2 and hz[2]["n_7d"] == 0 and hz[2]["sum_7d"] == 0.0


def test_parse_props(spark):
    from propensa.functions import parse_prop
    df = spark.createDataFrame([('{"k": 69}',), ('{"j": 1}',), (None,)], "props string")
    assert [r.k for r in df.select(parse_prop("props", "k").alias("k")).collect()] == [69, None, None]


def test_dedup_keeps_earliest_copy_and_null_keys(make_events):
    from propensa.operators.clean import dedup
    rows = [(1, "2024-01-02 00:00:00", 1, "view", 2.0),
            (1, "2024-01-01 00:00:00", 1, "view", 9.0),      # earliest copy wins
            (None, "2024-01-01 00:00:00", 2, "view", 1.0),   # null keys pass through
            (None, "2024-01-01 00:00:00", 2, "view", 1.0)]
    rows += [(7, "2024-01-05 00:00:00", 3, "click", float(i % 5)) for i in range(500)]  # hot group
    got = dedup(make_events(rows, 6)).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.event_id, []).append(r)
    assert by_id[1][0].value == 9.0 and len(by_id[1]) == 1
    assert len(by_id[None]) == 2
    assert len(by_id[7]) == 1 and by_id[7][0].value == 0.0


def test_lookback_and_date_partitions_prune_the_scan(spark, make_events):
    from propensa.session import shared_dir
    ev = make_events(ROWS).withColumn("dt", F.to_date("ts"))
    path = shared_dir(spark, "test_events_by_day")
    ev.write.partitionBy("dt").parquet(path)
    stored = spark.read.parquet(path)
    t = feat.training_table(stored, CUT, 3, lookback_days=7, date_col="dt")
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-14" in plan
    got = rows_by_user(t)
    assert got[1]["n_events"] == 2          # the 2024-01-10 view is outside the lookback
    assert rows_by_user(feat.training_table(stored, CUT, 3))[1]["n_events"] == 3


def test_parse_props_struct(spark):
    from propensa.functions import parse_props
    df = spark.createDataFrame([('{"k": 69, "src": "app"}',), ('{"k": 1}',), ("not json",), (None,)],
                               "props string")
    got = [tuple(r) for r in df.select(parse_props("props", "k int, src string").alias("p"))
           .select("p.k", "p.src").collect()]
    assert got == [(69, "app"), (1, None), (None, None), (None, None)]
