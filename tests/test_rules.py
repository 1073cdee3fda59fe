"""Values, nulls, ties and skew that the fixture tables do not have."""

import datetime as dt
import math
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from propensa.functions import exact_std, exact_sum, fold_of, parse_prop, parse_props, ts_lit, units
from propensa.operators import encode, evaluate, rank, report
from propensa.operators import features as feat
from propensa.operators import sequence as seq
from propensa.operators.joins import bounded_broadcast

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_values_below_a_cent_are_kept(make_events):
    ev = make_events([(i, f"2024-01-01 10:0{i}:00", 1, "view", 0.004) for i in range(3)])
    row = feat.rollup_features(ev).first()
    assert row.sum_value == pytest.approx(0.012) and row.mean_value == pytest.approx(0.004)
    assert row.median_value == pytest.approx(0.004)
    assert sorted(r.sum_2d for r in seq.rolling(ev, days=2).collect()) == pytest.approx([0.004, 0.008, 0.012])
    assert seq.sessions(ev).first().sum_value == pytest.approx(0.012)
    assert report.report(ev, ["event_type"], "rollup").agg(F.max("sum_value")).first()[0] == pytest.approx(0.012)


def test_rates_are_scaled(spark):
    df = spark.createDataFrame([(i, i / 10000) for i in range(1, 21)], "id int, rate double")
    rows = encode.clip_and_scale(df, "rate", 0.05).collect()
    z = [r.rate_z for r in rows]
    assert None not in z and sum(z) == pytest.approx(0, abs=1e-9)


def test_nan_and_infinity_do_not_stop_a_job(make_events):
    ev = make_events([(1, "2024-01-01 10:00:00", 1, "view", math.nan), (2, "2024-01-01 10:01:00", 1, "view", math.inf),
                      (3, "2024-01-01 10:02:00", 1, "view", 2.5), (4, "2024-01-01 10:03:00", 1, "view", 1e300)])
    assert feat.rollup_features(ev, scale=2).first().sum_value == 2.5
    assert math.isnan(feat.rollup_features(ev).first().sum_value)
    assert max(r.sum_2d for r in seq.rolling(ev, days=2, scale=2).collect()) == 2.5
    assert max(r.sum_2d for r in seq.rolling(ev, days=2).collect()) == 1e300


def test_standard_deviation_of_large_values(spark):
    df = spark.range(1000).select((F.col("id") % 2 * 1e11 + 1e12).alias("v"))
    exact, plain = df.agg(exact_std(units("v", 2), 2), F.stddev_samp("v")).first()
    assert exact == pytest.approx(plain, rel=1e-12)
    # n * sum(x^2) would pass 1e38
    big = spark.range(8).select(F.lit(2e16).alias("v"))
    assert big.agg(exact_std(units("v", 2), 2)).first()[0] == 0.0
    assert df.agg(exact_sum(units("v", 2), 2)).first()[0] == 1000 * 1e12 + 500 * 1e11


def test_null_keys_have_a_fold(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    folds = [r.fold for r in encode.hash_split(df, "k", 5).collect()]
    assert None not in folds and len(folds) == 3
    assert spark.range(1).select(fold_of(F.lit(None), 5)).first()[0] is not None


def test_both_property_forms_agree(spark):
    texts = ['{"k": 69}', '{"k": 69.5}', '{"k": "abc"}', '{"x": 1}', "abc", None, '{"k": null}']
    df = spark.createDataFrame([(t,) for t in texts], "props string")
    got = df.select(parse_prop("props", "k").alias("a"), parse_props("props", "k int")["k"].alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] == [69] + [None] * 6


def test_aware_times_are_rejected():
    with pytest.raises(ValueError):
        ts_lit(dt.datetime(2024, 1, 21, tzinfo=dt.timezone.utc))


def _untimed(make_events):
    rows = [(i, None if i % 4 == 0 else f"2024-01-0{1 + i % 3} 10:{10 + i}:00", None if i % 5 == 0 else i % 2, "view", float(i))
            for i in range(24)]
    return make_events(rows, 3)


def test_rolling_without_times_is_the_range_frame(make_events):
    ev = _untimed(make_events)
    ev.createOrReplaceTempView("untimed")
    plain = ev.sparkSession.sql("""
        select event_id, count(1) over w as n, coalesce(sum(value) over w, 0.0) as s from untimed
        window w as (partition by user_id order by ts range between interval 2 days preceding and current row)""")
    assert {r.event_id: (r.n_2d, r.sum_2d) for r in seq.rolling(ev, days=2).collect()} == {
        r.event_id: (r.n, r.s) for r in plain.collect()}


def test_sessions_have_one_start_each(make_events):
    got = seq.sessionize(_untimed(make_events)).groupBy("user_id").agg(
        F.sum("is_start").alias("starts"), F.max("session_idx").alias("last")).collect()
    assert all(r.starts == r["last"] for r in got)


def test_asof_does_not_depend_on_partitions(make_events):
    left = make_events([(100, "2024-01-02 00:00:00", 1, "purchase", 0.0)])
    right = [(i, "2024-01-01 00:00:00", 1, "view", float(i * 7 % 10)) for i in range(10)]
    found = {seq.asof_last(left, make_events(right, n).select("user_id", "ts", "value", "event_id"),
                           right_cols=["value", "event_id"]).first().prev_value for n in (1, 2, 3, 5, 7)}
    assert found == {9.0}


def test_rank_of_large_integers_and_nan(spark):
    df = spark.createDataFrame([(2 ** 53,), (2 ** 53 + 1,), (5,), (None,)], "s bigint")
    assert {r.s: r["rank"] for r in rank.global_rank(df, "s").collect()} == {2 ** 53 + 1: 1, 2 ** 53: 2, 5: 3, None: None}
    rnd = random.Random(3)
    values = [rnd.choice([1.0, 2.5, math.nan, -math.inf, math.inf, 0.0, -3.0]) for _ in range(60)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s double")
    for down in (True, False):
        w = Window.orderBy(F.col("s").desc() if down else F.col("s").asc())
        plain = {r.i: r.r for r in df.withColumn("r", F.rank().over(w)).collect()}
        for buckets in (1, 4):
            got = rank.global_rank(df, "s", down, buckets=buckets)
            assert dict(got.dtypes)["rank"] == "bigint"
            assert {r.i: r["rank"] for r in got.collect()} == plain


def test_log_loss_does_not_depend_on_order(spark):
    rnd = random.Random(5)
    rows = [(rnd.random(), rnd.randrange(2)) for _ in range(2000)]
    found = set()
    for n in (1, 3, 8):
        rnd.shuffle(rows)
        found.add(tuple(evaluate.metrics(spark.createDataFrame(rows, "score double, label int").repartition(n)).first()))
    assert len(found) == 1


def test_percentiles_of_ties_and_nulls(spark):
    values = [1.0] * 50 + [2.0] * 30 + [float(i) for i in range(20)] + [None] * 7
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for p in (0.0, 0.01, 0.3, 0.5, 0.51, 0.99, 1.0):
        plain = df.selectExpr(f"percentile_disc({p}) within group (order by v)").first()[0]
        assert encode.percentiles(df, "v", [p]).first()[0] == plain


def test_wide_rows_are_not_broadcast(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 100_000).alias("t"))
    assert "broadcast" not in bounded_broadcast(wide, 1000, 1 << 20)._jdf.queryExecution().logical().toString()
    narrow = spark.range(100)
    assert "broadcast" in bounded_broadcast(narrow, 1000)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in bounded_broadcast(narrow, 99)._jdf.queryExecution().logical().toString()


def _largest_bucket(ev, limit):
    base = seq._keyed(ev, "user_id", "ts", "event_id")
    width = seq.US_PER_DAY
    hot = seq._hot_cells(seq._cells(base, width, "_us"), limit)
    return seq._with_bucket(base, "_us", width, hot).groupBy("_k", "_b").count().agg(F.max("count")).first()[0]


def test_a_burst_is_cut_into_bounded_slices(make_events):
    start = dt.datetime(2024, 1, 1, 0, 30)
    rows = [(i, start + dt.timedelta(microseconds=300 * i), 1, "view", 1.0) for i in range(3000)]
    rows.append((3000, start + dt.timedelta(hours=23), 1, "view", 1.0))
    ev = make_events(rows, 4)
    assert _largest_bucket(ev, 500) <= 1000
    got = {r.event_id: r.n_2d for r in seq.rolling(ev, days=2, max_bucket_rows=500).collect()}
    assert got == {i: i + 1 for i in range(3001)}
    assert seq.sessions(ev, max_bucket_rows=500).count() == 2


FOLDER = """
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from propensa.session import ensure_checkpoint_dir, shared_dir, written
b = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
if {conf!r}: b = b.config("spark.checkpoint.dir", {conf!r})
s = b.getOrCreate()
if {api!r}: s.sparkContext.setCheckpointDir({api!r})
base = ensure_checkpoint_dir(s)
assert shared_dir(s, "x").startswith(base) and written(s.range(3), "t").count() == 3
print("BASE", base)
"""


@pytest.mark.parametrize("conf, api", [(True, False), (False, True), (True, True), (False, False)])
def test_one_base_folder(tmp_path, conf, api):
    names = str(tmp_path / "conf") if conf else "", str(tmp_path / "api") if api else ""
    empty = tmp_path / "empty"
    empty.mkdir()
    done = subprocess.run([sys.executable, "-c", FOLDER.format(root=ROOT, conf=names[0], api=names[1])], capture_output=True,
                          text=True, env=os.environ | {"SPARK_CONF_DIR": str(empty), "TMPDIR": str(tmp_path)}, timeout=300)
    assert done.returncode == 0, done.stderr[-1500:]
    base = done.stdout.split("BASE ")[1].strip()
    wanted = names[1] or names[0] or str(tmp_path / "propensa-ckpt-")
    assert base.removeprefix("file:").startswith(wanted)
