import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensa.operators import evaluate, rank


@pytest.fixture
def scored(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([0.1, 0.2, 0.35, 0.5, 0.9]) if i % 3 else rnd.random(),
             int(rnd.random() < 0.4)) for i in range(400)]
    return rows, spark.createDataFrame(rows, "user_id long, score double, label int")


def brute_auc(rows):
    pos = [s for _, s, y in rows if y == 1]
    neg = [s for _, s, y in rows if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_auc_matches_all_pairs(scored, buckets):
    rows, df = scored
    got = evaluate.auc(df, buckets=buckets).first().auc
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_of_negated_score_is_complement(scored):
    rows, df = scored
    a = evaluate.auc(df).first().auc
    b = evaluate.auc(df.withColumn("score", -F.col("score"))).first().auc
    assert a + b == pytest.approx(1.0, abs=1e-12)


def test_metrics(scored):
    rows, df = scored
    m = evaluate.metrics(df, threshold=0.35).first()
    tp = sum(1 for _, s, y in rows if s >= 0.35 and y == 1)
    fp = sum(1 for _, s, y in rows if s >= 0.35 and y == 0)
    fn = sum(1 for _, s, y in rows if s < 0.35 and y == 1)
    assert m.precision == tp / (tp + fp) and m.recall == tp / (tp + fn)
    assert m.n_pos + m.n_neg == len(rows)
    assert m.logloss > 0


@pytest.mark.parametrize("buckets", [1, 4, 50])
def test_global_rank_equals_sql_rank(scored, buckets):
    rows, df = scored
    got = {r.user_id: r["rank"] for r in rank.global_rank(df, "score", buckets=buckets).collect()}
    p = pd.DataFrame(rows, columns=["user_id", "score", "label"])
    p["r"] = p.score.rank(method="min", ascending=False).astype(int)
    assert got == dict(zip(p.user_id, p.r))


def test_prefix_before(spark):
    df = spark.createDataFrame([(float(v), v % 3) for v in range(50)], "x double, c long")
    got = {r.x: r.c_before for r in rank.prefix_before(df, "x", ["c"], buckets=6).collect()}
    acc = 0
    for v in range(50):
        assert got[float(v)] == acc
        acc += v % 3


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([(1, 10, 5.0), (1, 11, 5.0), (1, 12, 7.0), (1, 13, 1.0),
                                (2, 20, 1.0)], "user_id long, event_id long, value double")
    got = [(r.user_id, r.event_id, r["rank"]) for r in
           rank.top_k(df, "user_id", "value", 2, tiebreak="event_id").orderBy("user_id", "rank").collect()]
    assert got == [(1, 12, 1), (1, 10, 2), (2, 20, 1)]


def test_leaderboard(spark):
    subs = spark.createDataFrame([("a", 0.5), ("a", 0.9), ("b", 0.9), ("c", 0.1)],
                                 "team string, score double")
    got = {r.team: (r.best_score, r["rank"], r.rank_frac) for r in
           rank.leaderboard(subs, "team", "score").collect()}
    assert got == {"a": (0.9, 1, 1 / 3), "b": (0.9, 1, 1 / 3), "c": (0.1, 3, 1.0)}


def test_top_k_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, 10, None), (1, 11, 2.0), (1, 12, 1.0)],
                               "user_id long, event_id long, value double")
    best = [r.event_id for r in rank.top_k(df, "user_id", "value", 3).orderBy("rank").collect()]
    worst = [r.event_id for r in rank.top_k(df, "user_id", "value", 3, descending=False)
             .orderBy("rank").collect()]
    assert best == [11, 12, 10] and worst == [12, 11, 10]


def test_global_rank_ascending_and_null_scores(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 1.0), (4, None)],
                               "user_id long, score double")
    got = {r.user_id: r["rank"] for r in rank.global_rank(df, "score", descending=False).collect()}
    assert got == {2: 1, 3: 1, 1: 3, 4: None}     # null scores keep their row, unranked


def test_auc_is_null_without_both_classes(spark):
    df = spark.createDataFrame([(0.3, 1), (0.9, 1)], "score double, label int")
    assert evaluate.auc(df).first().auc is None
