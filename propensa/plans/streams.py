"""Streaming (P23-P25) and sink (P26) queries.

Each streaming query writes the events as slices in time order, drains them
through a stream, one slice a micro-batch, into a fresh folder under the
shared checkpoint folder and returns the sink read back as a table.  A slice
has as many files as it has rows for (``FILE_ROWS`` each), so no task writes or
reads a slice whole.  Rows without a time are in the first one.  A last slice
holds one row far ahead, which closes all windows and sessions.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa import defaults
from propensa.functions import exact_sum, ts_lit, units
from propensa.plans.batch import baseline_scored
from propensa.plans.registry import register
from propensa.session import shared_dir
from propensa.sources import events, write_csv, write_partitioned
from propensa.streaming import (
    attribute, event_stream, hourly_counts, run_available_now, stream_dedup, stream_sessions,
)


def _money_sum(c: str) -> Column:
    return exact_sum(units(c, defaults.MONEY_SCALE), defaults.MONEY_SCALE).alias("sum_value")


#: Rows of one file.
FILE_ROWS = 5_000_000


def _deliver(slices: list[DataFrame], rows: int, path: str) -> int:
    """Write the slices one after the other; the number of files of each."""
    files = max(1, -(-rows // FILE_ROWS))
    for part in slices:
        # coalescing would make the scan itself one task; few rows need no shuffle
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.mode("append").parquet(path)
    return files


def _closing(ev: DataFrame, last: datetime) -> DataFrame:
    # with a key: a join drops rows without one before it looks at their time
    row = {"ts": last + timedelta(days=2), "user_id": -1}
    return ev.sparkSession.createDataFrame([tuple(row.get(c) for c in ev.columns)], ev.schema)


def _drain(ev: DataFrame, build, name: str, cuts: int = 2, slices: list[DataFrame] | None = None) -> DataFrame:
    """``build`` of the stream of ``ev``, in ``cuts`` slices of equal time or
    the given ones."""
    spark = ev.sparkSession
    base = shared_dir(spark, name)
    first, last, rows = ev.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
    if slices is None and first is not None:
        edges = [first + (last - first) * k / cuts for k in range(1, cuts)]
        time, slices = F.col("ts"), []
        for low, high in zip([None, *edges], [*edges, None]):
            inside = F.lit(True) if high is None else time < ts_lit(high)
            # the first slice also has the rows without a time
            slices.append(ev.filter(time.isNull() | inside if low is None else (time >= ts_lit(low)) & inside))
    slices = [*(slices or [ev]), *([_closing(ev, last)] if last is not None else [])]
    files = _deliver(slices, rows, f"{base}/in")
    out = build(event_stream(spark, f"{base}/in", max_files_per_trigger=files))
    run_available_now(out, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{base}/out")


@register("p23_hourly_counts_stream")
def q_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drain(events(spark, sf_dir), partial(hourly_counts, scale=defaults.MONEY_SCALE), "hourly")


@register("p23_hourly_counts_batch")
def q_hourly_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    agg = (ev.groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
             .agg(F.count(F.lit(1)).alias("n_events"), _money_sum("value")))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "event_type", "n_events", "sum_value")


@register("p24_stream_sessions")
def q_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drain(events(spark, sf_dir), partial(stream_sessions, scale=defaults.MONEY_SCALE), "sessions")


@register("p25_stream_dedup")
def q_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # purchases are delivered twice; the closing row has no event
    ev = events(spark, sf_dir)
    twice = ev.unionByName(ev.filter(F.col("event_type") == defaults.TARGET_TYPE))
    return _drain(twice, stream_dedup, "dedup").filter(F.col("event_id").isNotNull())


#: Events from here on come in the second slice of the late stream.
LATE_CUT = datetime(2024, 1, 16)


@register("p25_stream_late")
def q_late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth event comes in the third slice, after all others.  It is
    judged by the watermark that the first slice has set, and dropped as late
    if it lies behind."""
    ev = events(spark, sf_dir)
    tenth = F.coalesce(F.col("event_id") % 10 == 0, F.lit(False))
    early = F.col("ts") < ts_lit(LATE_CUT)
    slices = [ev.filter(~tenth & (early | F.col("ts").isNull())), ev.filter(~tenth & ~early), ev.filter(tenth)]
    return _drain(ev, stream_dedup, "late", slices=slices).filter(F.col("event_id").isNotNull())


@register("stream_attribution")
def q_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's clicks of the six hours before it."""
    def build(stream: DataFrame) -> DataFrame:
        clicks, bought = (stream.filter((F.col("event_type") == kind) | F.col("event_type").isNull()).select(
            "event_id", "user_id", "ts") for kind in ("click", defaults.TARGET_TYPE))
        return attribute(bought, clicks, "6 hours")
    return _drain(events(spark, sf_dir), build, "attribution").filter(F.col("event_id").isNotNull()).select(
        "event_id", "user_id", F.col("cause_event_id").alias("click_id"))


@register("p26_partitioned_features")
def q_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = (events(spark, sf_dir)
             .groupBy("user_id", F.to_date("ts").alias("day"))
             .agg(F.count(F.lit(1)).alias("n_events"), _money_sum("value")))
    path = write_partitioned(daily, shared_dir(spark, "daily_features"), "day")
    return spark.read.parquet(path).select("user_id", "day", "n_events", "sum_value")


@register("p26_submission_csv")
def q_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = baseline_scored(spark, sf_dir).select("user_id", "score")
    path = write_csv(scores, shared_dir(spark, "submission"))
    return (spark.read.option("header", True)
            .schema("user_id bigint, score double").csv(path))
