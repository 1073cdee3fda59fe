"""Structured Streaming counterparts.

Event time must be a ``timestamp`` for ``withWatermark``.  The stream reads
each ``timestamp_ntz`` wall-clock value as a UTC instant on the way in and
turns instants back into UTC wall-clock values on the way out, through
epoch microseconds: no session time zone is involved, so windows align to
wall-clock hours and values round-trip in any zone.  Outputs are in
append mode: a window or session is written once, when the watermark
(max event time seen, in milliseconds, minus the delay) passes its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa import defaults
from propensa.functions import epoch_us, exact_sum, units

EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, "
                "event_type string, value double, props string")


def event_stream(spark: SparkSession, source_dir: str, glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of event files landing in ``source_dir`` (parquet)."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir).withColumn("ts", as_instant("ts"))


def as_instant(ts: str) -> F.Column:
    """``timestamp_ntz`` -> ``timestamp``, reading the wall clock as UTC."""
    return F.timestamp_micros(epoch_us(ts))


def _ntz(c: F.Column) -> F.Column:
    """``timestamp`` -> ``timestamp_ntz`` holding its UTC wall clock."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch)


def hourly_counts(stream: DataFrame, watermark: str = "1 hour",
                  window: str = "1 hour", type_col: str = "event_type",
                  value: str = "value", scale: int | None = None) -> DataFrame:
    """Tumbling event-time windows per type: event count and value sum.

    A streaming aggregate keeps one state row per (window, type) and
    combines rows map-side before the shuffle.
    """
    agg = (stream.withWatermark("ts", watermark)
                 .groupBy(F.window("ts", window).alias("w"), type_col)
                 .agg(F.count(F.lit(1)).alias("n_events"),
                      exact_sum(units(value, scale), scale).alias("sum_value")))
    return agg.select(_ntz(F.col("w.start")).alias("window_start"),
                      _ntz(F.col("w.end")).alias("window_end"), type_col,
                      "n_events", "sum_value")


def stream_sessions(stream: DataFrame, gap: str = f"{defaults.SESSION_GAP_MINUTES} minutes",
                    watermark: str = "1 hour", key: str = "user_id",
                    value: str = "value", scale: int | None = None) -> DataFrame:
    """Event-time sessions per key (a gap of exactly ``gap`` stays in)."""
    agg = (stream.withWatermark("ts", watermark)
                 .groupBy(F.session_window("ts", gap).alias("s"), key)
                 .agg(F.count(F.lit(1)).alias("n_events"),
                      exact_sum(units(value, scale), scale).alias("sum_value")))
    return agg.select(key, _ntz(F.col("s.start")).alias("session_start"),
                      _ntz(F.col("s.end")).alias("session_end"), "n_events", "sum_value")


def stream_dedup(stream: DataFrame, key: str = "event_id",
                 watermark: str = "1 hour") -> DataFrame:
    """Drop repeats of ``key`` seen within the watermark; rows older than
    the watermark are dropped as late.  As for every stateful operator since
    Spark 3.4, "late" is judged against the watermark of the previous
    micro-batch.  State is one row per live key."""
    out = stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark([key])
    return out.withColumn("ts", _ntz(F.col("ts")))


def attribute(effects: DataFrame, causes: DataFrame, within: str, key: str = "user_id", ts: str = "ts",
              watermark: str = "1 hour") -> DataFrame:
    """Stream-stream join: each effect with every cause of its key in
    ``[ts - within, ts]``, and effects without one, once no cause can come any
    more.

    Both sides are watermarked and the condition bounds the times of a pair,
    so Spark drops state that can match nothing.  An effect without a cause is
    written when both watermarks have passed it.  Effects or causes without a
    key or a time match nothing; such effects are written, too.  The cause's
    columns are called cause_...
    """
    left = effects.withWatermark(ts, watermark)
    right = causes.select([F.col(c).alias(f"cause_{c}") for c in causes.columns]).withWatermark(f"cause_{ts}", watermark)
    near = F.expr(f"{key} = cause_{key} AND cause_{ts} <= {ts} AND cause_{ts} >= {ts} - INTERVAL {within}")
    return left.join(right, near, "left_outer")


def run_available_now(df: DataFrame, sink_dir: str, checkpoint_dir: str,
                      fmt: str = "parquet") -> str:
    """Drain everything available in micro-batches into an append-only file
    sink, then stop.  The checkpoint makes a restart resume exactly-once."""
    q = (df.writeStream.format(fmt).outputMode("append")
           .option("checkpointLocation", checkpoint_dir)
           .trigger(availableNow=True)
           .start(sink_dir))
    q.awaitTermination()
    return sink_dir
