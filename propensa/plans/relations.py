"""Vectors, intervals, funnels, histories, sketches and stored states."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensa import defaults
from propensa.operators import history, incremental, sketches, vectors
from propensa.operators.funnel import funnel
from propensa.operators.intervals import interval_join, overlap_join
from propensa.plans.registry import register
from propensa.session import shared_dir, written
from propensa.sources import events, load, read_clustered, write_clustered

#: Neighbours per query.
NEIGHBOURS = 10


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All vectors, and every hundredth as a query."""
    items = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return items, items.where("vec_id % 100 = 0")


@register("vector_search")
def q_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, queries = _vectors(spark, sf_dir)
    return vectors.nearest(queries, vectors.build_index(items), NEIGHBOURS).withColumn("distance", F.round("distance", 6))


@register("vector_search_exact")
def q_vector_search_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, queries = _vectors(spark, sf_dir)
    return vectors.nearest(queries, vectors.build_index(items), NEIGHBOURS, exact=True).withColumn(
        "distance", F.round("distance", 6))


@register("vector_search_recall")
def q_vector_search_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, queries = _vectors(spark, sf_dir)
    index = vectors.build_index(items)
    return vectors.recall(vectors.nearest(queries, index, NEIGHBOURS),
                          vectors.nearest(queries, index, NEIGHBOURS, exact=True))


def _spans(rows: DataFrame, length: str) -> DataFrame:
    """Intervals of one length, from the rows' times on."""
    return rows.select("event_id", "user_id", F.col("ts").alias("start"), F.expr(f"ts + interval {length}").alias("end"))


@register("interval_join_state")
def q_interval_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the signup that was the user's latest then: a signup
    is valid until the user's next one."""
    e = events(spark, sf_dir)
    following = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    valid = e.where("event_type = 'signup'").select(
        F.col("event_id").alias("signup_id"), "user_id", F.col("ts").alias("start"),
        F.coalesce(following, F.expr("timestamp_ntz'2100-01-01 00:00:00'")).alias("end"))
    bought = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return interval_join(bought, valid, ["user_id"], how="left").select("event_id", "user_id", "signup_id")


@register("interval_join_any")
def q_interval_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases within ten minutes after an error of whatever user."""
    e = events(spark, sf_dir)
    errors = _spans(e.where("event_type = 'error'"), "10 minutes").select(F.col("event_id").alias("error_id"), "start", "end")
    bought = e.where("event_type = 'purchase'").select("event_id", "ts")
    return interval_join(bought, errors).select("event_id", "error_id")


@register("overlap_join")
def q_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hours after a view and a day after an error, of the same user."""
    e = events(spark, sf_dir)
    views = _spans(e.where("event_type = 'view'"), "3 hours")
    errors = _spans(e.where("event_type = 'error'"), "1 day").withColumnRenamed("event_id", "error_id")
    return overlap_join(views, errors, ["user_id"]).select("event_id", "error_id", "overlap_start", "overlap_seconds")


@register("funnel")
def q_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View, then click, then purchase, within three days of the view."""
    steps = [F.col("event_type") == kind for kind in ("view", "click", "purchase")]
    return funnel(events(spark, sf_dir), steps, 3 * 86_400)


def _snapshots(spark: SparkSession, sf_dir: str) -> list[tuple[dt.datetime, DataFrame]]:
    """Three states of ``customer``: rows come, go, return and change."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    key = F.col("c_custkey")
    second = customer.where(key % 10 != 5).withColumns({
        "c_acctbal": F.when(key % 7 == 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")),
        "c_mktsegment": F.when(key % 11 != 0, F.col("c_mktsegment"))})
    return [(dt.datetime(2024, 1, 1), customer.where(key % 10 != 3)), (dt.datetime(2024, 2, 1), second),
            (dt.datetime(2024, 3, 1), customer.where(key % 13 != 0))]


@register("scd_history")
def q_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.replay(_snapshots(spark, sf_dir), "c_custkey", ["c_acctbal", "c_mktsegment", "c_nationkey"]).drop(
        "state_hash")


@register("scd_state_at")
def q_state_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer's segment at each purchase."""
    past = history.replay(_snapshots(spark, sf_dir)[:2], "c_custkey", ["c_acctbal", "c_mktsegment", "c_nationkey"])
    bought = events(spark, sf_dir).where("event_type = 'purchase'").select(
        "event_id", F.col("user_id").alias("c_custkey"), F.expr("ts + interval 15 days").alias("ts"))
    return history.state_at(bought, past, "c_custkey").select("event_id", "c_custkey", "c_acctbal", "c_mktsegment")


#: Ranges of days that the sketch rollup is asked for.
RANGES = [(dt.date(2024, 1, 1), dt.date(2024, 1, 7)), (dt.date(2024, 1, 10), dt.date(2024, 1, 10)),
          (dt.date(2024, 1, 1), dt.date(2024, 1, 31))]


@register("sketch_rollup")
def q_sketch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per type and range: events, and whether distinct users and the median's
    rank from stored daily sketches are within the stated errors."""
    ev = events(spark, sf_dir)
    daily = written(sketches.daily_sketches(ev, ["event_type"], "user_id", "value"), "sketches")
    out = None
    for first, last in RANGES:
        got = sketches.rollup(daily, ["event_type"], first, last).withColumnRenamed("event_type", "kind")
        inside = ev.where(F.to_date("ts").between(F.lit(first), F.lit(last)))
        both = inside.join(got.select("kind", "n_distinct", "q50", F.col("n").alias("n_events")), F.col("event_type") == F.col("kind"))
        # the least and greatest rank that the quantile's value may have
        exact = both.groupBy("event_type", "n_events", "n_distinct", "q50").agg(
            F.count_distinct("user_id").alias("users"), F.count("value").alias("values"),
            F.count_if(F.col("value") < F.col("q50")).alias("below"), F.count_if(F.col("value") <= F.col("q50")).alias("upto"))
        slack = sketches.KLL_RANK_ERROR * F.col("values") + 1
        row = exact.select(
            "event_type", F.lit(first).alias("first_day"), F.lit(last).alias("last_day"), "n_events",
            (F.abs(F.col("n_distinct") - F.col("users")) <= sketches.distinct_error() * F.col("users") + 1).alias("users_ok"),
            ((F.col("below") <= F.col("values") / 2 + slack) & (F.col("upto") >= F.col("values") / 2 - slack)).alias("median_ok"))
        out = row if out is None else out.unionByName(row)
    return out


@register("clustered_read")
def q_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a range of dates and parts, from a table clustered on both."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    path = write_clustered(lines, shared_dir(spark, "clustered"), ["l_shipdate", "l_partkey"], 64)
    return read_clustered(spark, path, {"l_shipdate": (dt.datetime(1997, 1, 1), dt.datetime(1997, 12, 31)),
                                        "l_partkey": (100, 500)})


@register("incremental_training_table")
def q_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training table from daily states, of which some days came late or
    were corrected after the first update."""
    ev = events(spark, sf_dir)
    base = shared_dir(spark, "state")
    late = (F.to_date("ts") >= F.lit(dt.date(2024, 1, 28))) | (F.to_date("ts") == F.lit(dt.date(2024, 1, 10))) & (
        F.col("event_id") % 5 == 0)
    first = incremental.update(ev.where(~F.coalesce(late, F.lit(False))), base)
    return incremental.training_table(spark, incremental.update(ev, base, first), defaults.CUTOFF)
