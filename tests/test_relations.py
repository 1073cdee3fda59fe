"""Vector search, interval joins and funnels against brute force."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensa.operators import vectors
from propensa.operators.funnel import funnel
from propensa.operators.intervals import interval_join, overlap_join

DAY = dt.datetime(2024, 1, 1)


# --- vectors ---

def clustered(n, d=12, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d)) * 2
    return [(i, (centres[i % 6] + rng.normal(size=d)).astype("float32").tolist()) for i in range(n)]


def brute(rows, queries, k, scaled=False):
    def unit(v):
        v = np.array(v, float)
        return v / np.sqrt((v * v).sum()) if scaled else v

    found = set()
    for q, v in queries:
        near = sorted((float(np.sqrt(((unit(v) - unit(x)) ** 2).sum())), i) for i, x in rows if i != q)[:k]
        found |= {(q, n + 1, i, round(x, 9)) for n, (x, i) in enumerate(near)}
    return found


def rows_of(df):
    return {(r["query_id"], r["rank"], r["id"], round(r["distance"], 9)) for r in df.collect()}


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_exact_search_equals_all_pairs(spark, metric):
    rows = clustered(400)
    rows += [(1000 + i, rows[7][1]) for i in range(130)]        # a third are copies of one vector
    items = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = vectors.build_index(items, metric=metric)
    queries = [r for r in rows if r[0] % 40 == 7 or r[0] == 1003]
    asked = items.where("vec_id % 40 = 7 or vec_id = 1003")
    got = rows_of(vectors.nearest(asked, index, 5, probes=2, exact=True))
    assert got == brute(rows, queries, 5, metric == "cosine")


def test_blocks_of_hot_cells_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ITEMS", 30)
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 4)
    rows = clustered(200)
    items = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = vectors.build_index(items, cells=3)
    got = rows_of(vectors.nearest(items.where("vec_id % 5 = 0"), index, 4, probes=1, exact=True))
    assert got == brute(rows, [r for r in rows if r[0] % 5 == 0], 4)


def test_probing_finds_most_neighbours(spark):
    rows = clustered(600, seed=9)
    items = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = vectors.build_index(items)
    asked = items.where("vec_id % 10 = 0")
    share = vectors.recall(vectors.nearest(asked, index, 10), vectors.nearest(asked, index, 10, exact=True))
    total = share.agg(F.sum("found"), F.sum("wanted"), F.count("*")).first()
    assert total[1] == 600 and total[2] == 60 and total[0] >= 0.9 * total[1]


def test_search_leaves_unusable_vectors_out(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [1.0]), (5, [float("nan"), 0.0]), (6, [1.0, None]),
            (None, [1.0, 0.0]), (7, [1.0, 0.0]), (8, []), (7, [1.0, 0.1])]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = vectors.build_index(items, cells=2)
    assert index.members.count() == 4
    got = {(r["query_id"], r["rank"], r["id"]) for r in vectors.nearest(items, index, 2, exact=True).collect()}
    assert {r for r in got if r[0] == 1} == {(1, 1, 7), (1, 2, 7)}
    assert {r for r in got if r[0] is None} == {(None, 1, 1), (None, 2, 7)}
    assert not {r for r in got if r[0] in (3, 4, 5, 6, 8)}
    none = vectors.build_index(items.limit(0))
    assert vectors.nearest(items, none, 2, exact=True).collect() == []
    with pytest.raises(ValueError):
        vectors.build_index(items, metric="dot")


# --- intervals ---

def some_intervals(n, seed, keys=3):
    rng = random.Random(seed)
    found = []
    for i in range(n):
        start = DAY + dt.timedelta(seconds=rng.randrange(0, 200_000), microseconds=rng.choice([0, 0, 1]))
        length = rng.choice([0, 1, 59, 3600, 100_000, 10_000_000])
        end = start + dt.timedelta(seconds=length)
        found.append((i, rng.choice([None, *range(keys)]), rng.choice([start] * 9 + [None]), rng.choice([end] * 9 + [None])))
    return found


def frames(spark, n, seed):
    points = [(i, k, t) for i, k, t, _ in some_intervals(n, seed)]
    spans = some_intervals(n, seed + 1)
    points += [(n + 2 * i + j, s[1], s[j]) for i, s in enumerate(spans[:20]) for j in (2, 3)]     # on the edges
    return (points, spans, spark.createDataFrame(points, "id long, user long, ts timestamp_ntz"),
            spark.createDataFrame(spans, "id long, user long, start timestamp_ntz, end timestamp_ntz"))


def holds(s, t):
    return None not in (t, s[2], s[3]) and s[2] <= t < s[3]


@pytest.mark.parametrize("hot", [None, 5])
def test_interval_join_equals_brute_force(spark, hot):
    points, spans, left, right = frames(spark, 120, 1)
    for keys in ([], ["user"]):
        plain = [(p[0], s[0]) for p in points for s in spans if holds(s, p[2]) and (not keys or p[1] == s[1])]
        got = interval_join(left, right, keys, hot=hot)
        assert Counter((r["id"], r["right_id"]) for r in got.collect()) == Counter(plain)
        rest = [(p[0], None) for p in points if p[0] not in {x for x, _ in plain}]
        got = interval_join(left, right, keys, how="left", hot=hot)
        assert got.columns == ["id", "user", "ts", "right_id"] + ([] if keys else ["right_user"]) + ["start", "end"]
        assert Counter((r["id"], r["right_id"]) for r in got.collect()) == Counter(plain) + Counter(rest)


@pytest.mark.parametrize("hot", [None, 5])
def test_overlap_join_equals_brute_force(spark, hot):
    a, b = some_intervals(90, 5), some_intervals(90, 6)
    schema = "id long, user long, start timestamp_ntz, end timestamp_ntz"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    for keys in ([], ["user"]):
        plain = Counter()
        for x in a:
            for y in b:
                if None in (*x[2:], *y[2:]) or keys and x[1] != y[1]:
                    continue
                low, high = max(x[2], y[2]), min(x[3], y[3])
                if low < high and x[2] < x[3] and y[2] < y[3]:
                    plain[x[0], y[0], low, (high - low) / dt.timedelta(seconds=1)] += 1
        got = overlap_join(left, right, keys, hot=hot).collect()
        assert Counter((r["id"], r["right_id"], r["overlap_start"], r["overlap_seconds"]) for r in got) == plain


def test_interval_joins_without_rows_and_plans(spark):
    _, _, left, right = frames(spark, 10, 2)
    assert interval_join(left, right.limit(0)).collect() == []
    assert interval_join(left, right.limit(0), how="left").count() == left.count()
    assert overlap_join(right, right.limit(0)).collect() == []
    plan = interval_join(left, right)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        interval_join(left, right, how="outer")


# --- funnel ---

def plain_funnel(rows, steps, limit):
    """rows: id, ts, user, type."""
    found = {}
    for user in {r[2] for r in rows if r[1] is not None and r[3] is not None and any(r[3] in s for s in steps)}:
        mine = sorted((r[1], r[0] is not None, r[0] or 0, r[3]) for r in rows if r[2] == user and r[1] is not None)
        chains = [[None] * len(mine) for _ in steps]          # latest start per row and step
        for i, (t, _, _, kind) in enumerate(mine):
            for s, wanted in enumerate(steps):
                if kind is not None and kind in wanted:
                    before = [t] if s == 0 else [x for x in chains[s - 1][:i] if x is not None and t - x <= limit]
                    chains[s][i] = max(before, default=None)
        depth = max([s + 1 for s in range(len(steps)) if any(x is not None for x in chains[s])], default=0)
        first = min((mine[i][0] for i, x in enumerate(chains[-1]) if x is not None), default=None)
        found[user] = depth, first
    return found


@pytest.mark.parametrize("hours,most", [(24, None), (1, None), (6, 3), (24 * 40, 5)])
def test_funnel_equals_brute_force(spark, make_events, hours, most):
    rng = random.Random(hours)
    rows = []
    for i in range(900):
        user = rng.choice([1, 1, 1, 2, 3, None] + list(range(4, 40)))
        at = DAY + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 9))
        if user == 2:      # a burst, with ties
            at = DAY + dt.timedelta(minutes=rng.randrange(0, 8))
        rows.append((i, rng.choice([at] * 30 + [None]), user, rng.choice(["view", "click", "purchase", "x", None]), 1.0))
    df = make_events(rows)
    kind = F.col("event_type")
    for steps, limit in (([["view"], ["click"], ["purchase"]], dt.timedelta(hours=30)), ([["view"]], dt.timedelta(0)),
                         ([["view", "click"], ["click"], ["click", "x"], ["x"]], dt.timedelta(hours=5))):
        got = funnel(df, [kind.isin(s) for s in steps], limit.total_seconds(), bucket_hours=hours, max_bucket_rows=most)
        assert {r["user_id"]: (r["depth"], r["completed_at"]) for r in got.collect()} == plain_funnel(
            [r[:4] for r in rows], steps, limit)


def test_funnel_limits_its_steps(spark, make_events):
    df = make_events([(1, "2024-01-01 00:00:00", 1, "view", 1.0)])
    with pytest.raises(ValueError):
        funnel(df, [], 1)
    assert funnel(df.limit(0), [F.col("event_type") == "view"], 1).collect() == []
