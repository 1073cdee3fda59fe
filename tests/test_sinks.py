import datetime as dt

from pyspark.sql import functions as F

from propensa.session import shared_dir
from propensa.sources import write_csv, write_partitioned


def test_partitioned_write_prunes_on_read(spark):
    df = spark.createDataFrame(
        [(u, dt.date(2024, 1, 1 + d), float(u * d)) for u in range(20) for d in range(5)],
        "user_id long, day date, v double")
    path = write_partitioned(df, shared_dir(spark, "test_daily"), "day")
    back = spark.read.parquet(path)
    assert back.count() == 100
    one = back.filter(F.col("day") == F.lit(dt.date(2024, 1, 3)))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-03" in plan
    assert one.count() == 20


def test_csv_round_trip_keeps_doubles(spark):
    df = spark.createDataFrame([(1, 0.1 + 0.2), (2, 1 / 3)], "user_id long, score double")
    path = write_csv(df, shared_dir(spark, "test_csv"))
    back = spark.read.option("header", True).schema("user_id long, score double").csv(path)
    assert sorted(back.collect()) == sorted(df.collect())
