import pytest
from pyspark.sql import functions as F

from propensa.operators import encode, report


def test_target_mean_leave_one_out(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "a", 1), (4, "lone", 1),
                                (5, None, 1), (6, None, 0)], "id long, cat string, y int")
    got = {r.id: r.te for r in encode.target_mean(df, "cat", "y").collect()}
    assert got[1] == 0.5 and got[2] == 1.0 and got[3] == 0.5
    assert got[4] is None                      # lone category: nothing to learn from
    assert got[5] == 0.0 and got[6] == 1.0     # nulls are one group


def test_clip_and_scale(spark):
    vals = [float(v) for v in range(1, 101)] + [10_000.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    out = encode.clip_and_scale(df, "v", 0.05).collect()
    clipped = [r.v_clipped for r in out]
    assert max(clipped) in vals and min(clipped) in vals      # bounds are data values
    assert max(clipped) < 10_000.0
    assert sum(r.v_z for r in out) == pytest.approx(0.0, abs=1e-9)


def test_hash_split_is_stable_disjoint_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "user_id")
    a = encode.hash_split(df, "user_id", 5)
    b = encode.hash_split(df.repartition(7), "user_id", 5)
    ja = {r.user_id: r.fold for r in a.collect()}
    assert ja == {r.user_id: r.fold for r in b.collect()}
    assert set(ja.values()) == set(range(5)) and len(ja) == 1000


def test_report_flags(spark):
    df = spark.createDataFrame([("x", 1, 1.0), ("x", 2, 2.0), ("y", 1, 3.0)],
                               "t string, d int, value double")
    rows = report.report(df, ["t", "d"], "cube").collect()
    total = [r for r in rows if r.g_t == 1 and r.g_d == 1]
    assert len(total) == 1 and total[0].n_events == 3 and total[0].sum_value == 6.0
    assert len(rows) == 3 + 2 + 2 + 1
    assert len(report.report(df, ["t", "d"], "rollup").collect()) == 3 + 2 + 1


def test_cohort_diff(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "user_id long")
    b = spark.createDataFrame([(3,), (4,)], "user_id long")
    got = {r.user_id: r.status for r in report.cohort_diff(a, b, "user_id").collect()}
    assert got == {1: "lost", 2: "lost", 3: "kept", 4: "new"}
    # same sets as SQL EXCEPT / INTERSECT
    assert {k for k, v in got.items() if v == "lost"} == {r.user_id for r in a.subtract(b).collect()}
    assert {k for k, v in got.items() if v == "kept"} == {r.user_id for r in a.intersect(b).collect()}


def test_approximate_options_stay_close(spark):
    from propensa.operators import features as feat
    vals = [(i % 7, float(i % 101)) for i in range(2000)]
    df = spark.createDataFrame(vals, "user_id long, value double") \
        .withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    ex = {r.user_id: r.median_value for r in feat.rollup_features(df, exact_median=True).collect()}
    ap = {r.user_id: r.median_value for r in feat.rollup_features(df, exact_median=False).collect()}
    assert all(abs(ex[k] - ap[k]) <= 1.0 for k in ex)
    a = encode.clip_and_scale(df, "value", 0.05, exact=False).agg(F.max("value_clipped")).first()[0]
    e = encode.clip_and_scale(df, "value", 0.05).agg(F.max("value_clipped")).first()[0]
    assert abs(a - e) <= 1.0


def test_cohort_diff_with_an_empty_side(spark):
    a = spark.createDataFrame([(1,), (2,)], "user_id long")
    empty = spark.createDataFrame([], "user_id long")
    assert {r.status for r in report.cohort_diff(a, empty, "user_id").collect()} == {"lost"}
    assert {r.status for r in report.cohort_diff(empty, a, "user_id").collect()} == {"new"}


def test_report_keeps_null_dimension_values_apart_from_rollups(spark):
    df = spark.createDataFrame([(None, 1.0), ("x", 2.0)], "t string, value double")
    rows = report.report(df, ["t"], "rollup").collect()
    null_group = [r for r in rows if r.t is None and r.g_t == 0]
    total = [r for r in rows if r.g_t == 1]
    assert null_group[0].n_events == 1 and total[0].n_events == 2


def test_target_mean_ignores_null_targets(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, "a", 0)], "id long, cat string, y int")
    got = {r.id: r.te for r in encode.target_mean(df, "cat", "y").collect()}
    assert got[1] == 0.0 and got[3] == 1.0 and got[2] is None
