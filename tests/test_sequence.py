import datetime as dt
import random

import pandas as pd
import pytest

from propensa.operators import sequence as seq


def _random_rows(n=1500, users=3, days=20, seed=3, hot=0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        u = hot if rnd.random() < 0.6 else rnd.randrange(users)     # one hot key
        t = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(days * 86400))
        rows.append((i, t, u, rnd.choice(["view", "purchase"]), rnd.randrange(1, 9999) / 100))
    # ties in time within a key
    rows.append((n, rows[0][1], rows[0][2], "view", 1.0))
    return rows


def _pdf(rows):
    p = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value"])
    return p.sort_values(["user_id", "ts", "event_id"]).reset_index(drop=True)


@pytest.mark.parametrize("bucket_hours,max_rows", [(1, None), (24, None), (24 * 9, None),
                                                   (24, 25), (24 * 9, 40)])
def test_rolling_matches_brute_force(make_events, bucket_hours, max_rows):
    rows = _random_rows()
    got = {r.event_id: (r.n_2d, r.sum_2d) for r in
           seq.rolling(make_events(rows, 5), days=2, bucket_hours=bucket_hours,
                       max_bucket_rows=max_rows).collect()}
    p = _pdf(rows)
    for _, r in p.iterrows():
        g = p[(p.user_id == r.user_id) & (p.ts <= r.ts) & (p.ts >= r.ts - pd.Timedelta(days=2))]
        n, s = got[r.event_id]
        assert n == len(g)
        assert s == pytest.approx(round(g.value.sum(), 2), abs=1e-9)
    assert len(got) == len(rows)


@pytest.mark.parametrize("bucket_hours,max_rows", [(1, None), (24, None), (24 * 30, None),
                                                   (24, 20), (24, 10 ** 6)])
def test_asof_matches_brute_force(make_events, bucket_hours, max_rows):
    rows = _random_rows(seed=5)
    ev = make_events(rows, 4)
    left = ev.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = ev.filter("event_type = 'view'").select("user_id", "ts", "value", "event_id")
    got = {r.event_id: (r.prev_ts, r.prev_event_id) for r in
           seq.asof_last(left, right, right_cols=["value", "event_id"],
                         right_order="event_id", bucket_hours=bucket_hours,
                         max_bucket_rows=max_rows).collect()}
    p = _pdf(rows)
    views = p[p.event_type == "view"]
    for _, r in p[p.event_type == "purchase"].iterrows():
        c = views[(views.user_id == r.user_id) & (views.ts < r.ts)]
        if c.empty:
            assert got[r.event_id] == (None, None)
        else:
            best = c.sort_values(["ts", "event_id"]).iloc[-1]
            assert got[r.event_id][1] == best.event_id


def test_asof_is_strict_and_left_first_on_ties(make_events):
    ev = make_events([
        (1, "2024-01-01 10:00:00", 1, "view", 1.0),
        (2, "2024-01-01 11:00:00", 1, "view", 2.0),
        (3, "2024-01-01 11:00:00", 1, "purchase", 5.0),   # same ts as view 2
        (4, "2024-01-01 09:00:00", 1, "purchase", 5.0),   # nothing earlier
        (5, "2024-01-01 12:00:00", None, "purchase", 5.0),
        (6, "2024-01-01 11:30:00", None, "view", 5.0),    # null keys never match
    ])
    left = ev.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = ev.filter("event_type = 'view'").select("user_id", "ts", "value")
    got = {r.event_id: r.prev_value for r in seq.asof_last(left, right).collect()}
    assert got == {3: 1.0, 4: None, 5: None}


@pytest.mark.parametrize("second,expected", [("10:30:00", 1), ("10:30:01", 2)])
def test_session_gap_edge(make_events, second, expected):
    ev = make_events([(1, "2024-01-01 10:00:00", 2, "view", 1.0),
                      (2, f"2024-01-01 {second}", 2, "view", 1.0)])
    got = seq.sessionize(ev).orderBy("event_id").collect()
    assert got[-1].session_idx == expected


@pytest.mark.parametrize("bucket_hours,max_rows", [(1, None), (24, None), (24 * 40, None),
                                                   (24, 30), (24 * 40, 50), (24, 10 ** 6)])
def test_sessionize_matches_brute_force(make_events, bucket_hours, max_rows):
    rows = _random_rows(n=2000, days=5, seed=11)
    got = {r.event_id: (r.session_idx, r.is_start) for r in
           seq.sessionize(make_events(rows, 6), bucket_hours=bucket_hours,
                          max_bucket_rows=max_rows).collect()}
    p = _pdf(rows)
    gap = p.groupby("user_id").ts.diff()
    p["start"] = (gap.isna() | (gap > pd.Timedelta(minutes=30))).astype(int)
    p["idx"] = p.groupby("user_id").start.cumsum()
    for _, r in p.iterrows():
        assert got[r.event_id] == (r.idx, r.start)


def test_session_counts_sum_to_rows(make_events):
    rows = _random_rows(n=800, days=3, seed=2)
    s = seq.sessions(make_events(rows, 3)).collect()
    assert sum(r.n_events for r in s) == len(rows)


@pytest.mark.parametrize("most", [None, 1, 10 ** 6])
def test_null_keys_and_times_keep_their_rows(make_events, most):
    rows = [(1, "2024-01-01 10:00:00", 1, "view", 1.0),
            (2, "2024-01-01 10:10:00", None, "view", 2.0),
            (3, "2024-01-01 10:20:00", None, "purchase", 3.0),
            (4, None, 1, "purchase", 4.0),
            (5, "2024-01-02 10:20:00", 1, "purchase", 5.0)]
    ev = make_events(rows, 3)
    assert seq.rolling(ev, days=2).count() == 5
    got = {r.event_id: r.n_2d for r in seq.rolling(ev, days=2).collect()}
    assert got[3] == 2 and got[5] == 2          # null keys form one group
    numbers = {r.event_id: (r.session_idx, r.is_start) for r in seq.sessionize(ev, max_bucket_rows=most).collect()}
    assert numbers == {1: (2, 1), 2: (1, 1), 3: (1, 0), 4: (1, 1), 5: (3, 1)}
    left = ev.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = ev.filter("event_type = 'view'").select("user_id", "ts", "value")
    out = {r.event_id: r.prev_value for r in seq.asof_last(left, right, max_bucket_rows=most).collect()}
    assert out == {3: None, 4: None, 5: 1.0}


def test_sessions_agree_with_builtin_session_window(make_events):
    from pyspark.sql import functions as F
    rows = _random_rows(n=1500, days=4, seed=8)
    ev = make_events(rows, 5)
    ours = {(r.user_id, r.session_start, r.session_end, r.n_events)
            for r in seq.sessions(ev).collect()}
    builtin = {(r.user_id, r.s.start, r.s.end, r.n)
               for r in ev.groupBy("user_id", F.session_window("ts", "30 minutes").alias("s"))
               .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert ours == builtin


def test_hot_cells_are_split(make_events, spark):
    """A burst (one key, one day) is cut into several buckets."""
    from pyspark.sql import functions as F
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=7 * i), 0, "view", 1.0)
            for i in range(3000)]
    base = seq._keyed(make_events(rows), "user_id", "ts", "event_id")
    hot = seq._hot_cells(seq._cells(base, seq.US_PER_DAY, "_us"), 500)
    b = seq._with_bucket(base, "_us", seq.US_PER_DAY, hot)
    sizes = [r["count"] for r in b.groupBy("_b").count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 600 and sum(sizes) == 3000
