import random

from propensa.operators import evaluate
from propensa.operators.model import fit_score


def test_fit_score_separates_an_easy_signal(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(600):
        y = int(rnd.random() < 0.5)
        rows.append((i, y, rnd.gauss(2.0 if y else -2.0, 1.0), rnd.gauss(0, 1), None))
    df = spark.createDataFrame(rows, "user_id long, label int, x1 double, x2 double, x3 double")
    train, test = df.filter("user_id % 4 != 0"), df.filter("user_id % 4 = 0")
    scored = fit_score(train, test, ["x1", "x2", "x3"])
    got = scored.collect()
    assert len(got) == 150 and all(0.0 < r.score < 1.0 for r in got)
    assert evaluate.auc(scored).first().auc > 0.95


def test_fit_score_on_one_class_or_none_gives_the_smoothed_share(spark):
    schema = "user_id long, label int, x1 double"
    rows = [(i, 1, float(i)) for i in range(9)]
    df, unknown = spark.createDataFrame(rows, schema), spark.createDataFrame([(20, None, 1.0)], schema)
    test = df.union(unknown)
    got = fit_score(df, test, ["x1"]).collect()
    assert len(got) == 10 and {r.score for r in got} == {10 / 11}
    zeros = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0)], schema)
    assert {r.score for r in fit_score(zeros, test, ["x1"]).collect()} == {0.25}
    assert {r.score for r in fit_score(unknown, test, ["x1"]).collect()} == {0.5}
