"""Histories, sketches, the clustered sink and incremental states."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from propensa.operators import features, history, incremental, sketches
from propensa.session import shared_dir
from propensa.sources import read_clustered, write_clustered
from propensa.sources.clustered import QUANTILE_ERROR, kept_files, z_order

D = [dt.datetime(2024, 1, d) for d in range(1, 9)]
SCHEMA = "k long, a string, b double"


# --- history ---

def plain_history(snapshots):
    rows = {}
    open_rows = {}
    for at, found in snapshots:
        states = {}
        for k, a, b in found:
            if k is not None:
                states.setdefault(k, (a, b))
        for k in set(open_rows) - {k for k in states if open_rows.get(k, (None,))[0] == states[k]}:
            state, start = open_rows.pop(k)
            rows[k, state, start] = at
        for k, state in states.items():
            open_rows.setdefault(k, (state, at))
    return {(k, *state, start, rows.get((k, state, start))) for k, state, start in
            [*rows, *((k, *v) for k, v in open_rows.items())]}


def as_set(df):
    return {tuple(r) for r in df.select("k", "a", "b", "valid_from", "valid_to").collect()}


def test_replay_equals_plain_history(spark):
    rng = random.Random(2)
    snapshots = []
    for at in D[:5]:
        keys = rng.sample(range(30), 20)
        snapshots.append((at, [(k, rng.choice(["x", "y", None, ""]), rng.choice([1.0, None])) for k in keys]
                          + [(None, "lost", 1.0)]))
    frames = [(at, spark.createDataFrame(rows, SCHEMA)) for at, rows in snapshots]
    got = history.replay(frames, "k", ["a", "b"])
    assert as_set(got) == plain_history(snapshots)
    again = history.apply_snapshot(got, frames[-1][1], "k", D[4])
    assert as_set(again) == as_set(got)
    with pytest.raises(ValueError):
        history.apply_snapshot(got, frames[0][1], "k", D[0])


def test_history_of_repeated_keys_does_not_depend_on_order(spark):
    rows = [(1, "x", 1.0), (1, "y", 2.0), (2, "z", None)]
    a, b = (spark.createDataFrame(r, SCHEMA) for r in (rows, rows[::-1]))
    first = history.first_history(a, "k", ["a", "b"], D[0])
    assert first.count() == 2
    assert as_set(history.apply_snapshot(first, b, "k", D[1])) == as_set(first)
    empty = history.apply_snapshot(first, a.limit(0), "k", D[1])
    assert {r["valid_to"] for r in empty.collect()} == {D[1]}
    points = spark.createDataFrame([(1, D[0]), (1, D[1]), (3, D[0]), (None, D[0])], "k long, ts timestamp_ntz")
    found = {(r["k"], r["ts"]): r["a"] for r in history.state_at(points, empty, "k").collect()}
    assert found[1, D[0]] in ("x", "y") and found[1, D[1]] is None and found[3, D[0]] is None


# --- sketches ---

def test_sketch_rollups_are_within_their_errors(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 3).cast("string").alias("g"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("u"),
        F.when(F.col("id") % 10 > 0, F.pmod(F.hash("id"), F.lit(1_000_003)).cast("double")).alias("x"),
        F.expr("timestampadd(HOUR, cast(id % 240 as int), timestamp_ntz'2024-01-01 00:00:00')").alias("ts"))
    daily = sketches.daily_sketches(rows, ["g"], "u", "x").cache()
    assert daily.count() == 30
    for first, last in ((0, 9), (2, 4)):
        low, high = dt.date(2024, 1, 1 + first), dt.date(2024, 1, 1 + last)
        got = {r["g"]: r for r in sketches.rollup(daily, ["g"], low, high, (0.1, 0.5)).collect()}
        inside = rows.where(F.to_date("ts").between(F.lit(low), F.lit(high)))
        for r in inside.groupBy("g").agg(F.count("*"), F.count_distinct("u"), F.sort_array(F.collect_list("x"))).collect():
            g, n, users, values = r
            assert got[g]["n"] == n
            assert abs(got[g]["n_distinct"] - users) <= sketches.distinct_error() * users + 1
            for q in (0.1, 0.5):
                rank = sum(v <= got[g][f"q{round(100 * q)}"] for v in values) / len(values)
                assert abs(rank - q) <= 2 * sketches.KLL_RANK_ERROR
    none = rows.limit(5).withColumn("x", F.lit(None).cast("double"))
    assert {r["q50"] for r in sketches.rollup(sketches.daily_sketches(none, ["g"], "u", "x"), ["g"],
                                              dt.date(2024, 1, 1), dt.date(2024, 1, 31)).collect()} == {None}


# --- clustered sink ---

def test_clustered_reads_fewer_files_and_the_same_rows(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, *range(1000)]), rng.random() * 50, D[0] + dt.timedelta(hours=rng.randrange(800)))
            for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, a int, b double, t timestamp_ntz")
    path = write_clustered(df, shared_dir(spark, "t"), ["a", "t"], 32)
    whole = len(kept_files(spark, path, {}))
    ranges = {"a": (100, 200), "t": (D[2], D[5])}
    some = kept_files(spark, path, ranges)
    got = read_clustered(spark, path, ranges)
    assert len(some) <= whole / 3 and len(got.inputFiles()) == len(some)
    assert {r["id"] for r in got.collect()} == {i for i, a, _, t in rows if a is not None and 100 <= a <= 200 and D[2] <= t <= D[5]}
    # either column alone skips files, too
    for one in ranges:
        assert len(kept_files(spark, path, {one: ranges[one]})) < whole * 0.8
    assert read_clustered(spark, path, {"a": (5000, None)}).collect() == []
    assert read_clustered(spark, path, {}).count() == 4000


def test_places_take_a_comparison_a_bit(spark):
    """The parts are those of a plain count of bounds, without going through
    all bounds for each row."""
    values = [None, float("nan"), float("inf"), -float("inf"), 0.0, 0.0, 1.5, 2.5, 2.5, 9.0, -4.0, 7.0]
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, x double")
    placed = z_order(df, ["x"], bits=3)
    assert placed.columns == ["id", "x", "_place"]
    bounds = sorted(set(df.approxQuantile("x", [k / 8 for k in range(1, 8)], QUANTILE_ERROR)))
    want = {i: 0 if x is None else sum(b <= x or math.isnan(x) for b in bounds) for i, x in enumerate(values)}
    assert {r["id"]: r["_place"] for r in placed.collect()} == want
    assert "lambda" not in placed._jdf.queryExecution().optimizedPlan().toString()
    assert z_order(df.where("x is null"), ["x"], bits=3).first()["_place"] == 0


def test_clustered_sink_of_strings_and_of_nothing(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "é"), (4, "a")], "id long, s string")
    path = write_clustered(df, shared_dir(spark, "t"), ["s", "id"], 2)
    assert {r["id"] for r in read_clustered(spark, path, {"s": ("b", None)}).collect()} == {1, 3}
    path = write_clustered(df.limit(0), shared_dir(spark, "t"), ["s"], 2)
    assert read_clustered(spark, path, {"s": ("a", "b")}).collect() == []
    with pytest.raises(ValueError):
        write_clustered(df, shared_dir(spark, "t"), ["s"] * 8)


# --- incremental ---

CUT = D[5]


def some_events(make_events, seed, n=400):
    rng = random.Random(seed)
    return make_events([(i, rng.choice([D[0] + dt.timedelta(seconds=rng.randrange(8 * 86_400))] * 20 + [None]),
                         rng.choice([1, 1, 1, None, 2, *range(3, 30)]), rng.choice(["click", "purchase", "view", None]),
                         rng.choice([None, 1.005, 19.99, 250.0, float("nan")])) for i in range(n)])


def same(spark, ev, manifest):
    got = incremental.training_table(spark, manifest, CUT, 2)
    want = features.training_table(ev, CUT, 2, scale=2)
    assert got.columns == want.columns
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert order(got) == order(want)


def test_state_equals_the_full_rebuild_after_each_update(spark, make_events):
    base = shared_dir(spark, "state")
    ev = some_events(make_events, 1)
    day = F.to_date("ts")
    part = ev.where((day < D[6].date()) & ~((day == D[2].date()) & (F.col("event_id") % 3 == 0)))
    first = incremental.update(part, base)
    same(spark, part, first)
    second = incremental.update(ev, base, first)
    same(spark, ev, second)
    folders = {m: {r["day"]: r["folder"] for r in spark.read.parquet(m).collect()} for m in (first, second)}
    changed = {d for d, f in folders[second].items() if folders[first].get(d) != f}
    assert changed == {D[2].date(), D[6].date(), D[7].date()}
    # nothing new: nothing is written; a day that is gone is gone
    assert {r["folder"] for r in spark.read.parquet(incremental.update(ev, base, second)).collect()} == set(
        folders[second].values())
    fewer = ev.where(day != D[1].date())
    same(spark, fewer, incremental.update(fewer, base, second))
    same(spark, part, first)      # the first manifest still holds


def test_state_of_no_events(spark, make_events):
    base = shared_dir(spark, "state")
    none = some_events(make_events, 1).limit(0)
    assert incremental.training_table(spark, incremental.update(none, base), CUT) is None
    with pytest.raises(ValueError):
        incremental.training_table(spark, "x", dt.datetime(2024, 1, 1, 5))
