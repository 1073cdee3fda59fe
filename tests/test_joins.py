from pyspark.sql import functions as F

from propensa.operators import joins


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounded_broadcast_hints_only_under_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        dim = spark.range(50).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
        small = big.join(joins.bounded_broadcast(dim, 100), "k")
        assert "BroadcastHashJoin" in _plan(small)
        over = big.join(joins.bounded_broadcast(dim, 10), "k")
        assert "BroadcastHashJoin" not in _plan(over) and "SortMergeJoin" in _plan(over)
        assert small.count() == over.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_enrich_keeps_unmatched_rows(spark):
    region = spark.createDataFrame([(0, "AFRICA")], "r_regionkey int, r_name string")
    nation = spark.createDataFrame([(7, "GERMANY", 0)], "n_nationkey int, n_name string, n_regionkey int")
    customer = spark.createDataFrame([(1, "BUILDING", 7, 10.0), (2, "MACHINERY", 99, 5.0)],
                                     "c_custkey long, c_mktsegment string, c_nationkey int, c_acctbal double")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    dim = joins.customer_dimension(customer, nation, region)
    got = {r.user_id: (r.c_mktsegment, r.n_name, r.r_name)
           for r in joins.enrich(users, dim).collect()}
    assert got == {1: ("BUILDING", "GERMANY", "AFRICA"), 2: ("MACHINERY", None, None),
                   3: (None, None, None)}
