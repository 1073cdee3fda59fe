"""Hot-key experiment: naive per-user window vs the bucketed operators.

Derives a skewed event table from the fixture: the events are replicated
``copies`` times (each copy shifted by 30 days, ids offset), and every third
event is reassigned to user 0, so one key holds a third of all rows.  Runs
sessionize and rolling both ways, checks the results are identical and
prints wall times.

usage: python tools/skew_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from propensa.functions import epoch_us  # noqa: E402
from propensa.operators import sequence as seq  # noqa: E402
from propensa.session import build_session, materialize  # noqa: E402
from propensa.sources import events  # noqa: E402


def skewed(spark, sf_dir: str, copies: int):
    ev = events(spark, sf_dir)
    n = ev.agg(F.max("event_id")).first()[0] + 1
    big = ev.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    big = big.select(
        (F.col("event_id") + F.col("_copy") * F.lit(n)).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.col("_copy") * F.lit(30))).alias("ts"),
        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
        "event_type", "value")
    return materialize(big)


def naive_sessionize(df, gap_minutes=30):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    us = epoch_us("ts")
    prev = F.lag(us).over(w)
    start = F.when(prev.isNull() | (us - prev > gap_minutes * 60_000_000), 1).otherwise(0)
    return (df.withColumn("is_start", start)
              .withColumn("session_idx", F.sum("is_start").over(w.rowsBetween(
                  Window.unboundedPreceding, 0)).cast("bigint"))
              .select("event_id", "session_idx"))


def timed(label, df):
    t = time.time()
    df.write.format("noop").mode("overwrite").save()
    print(f"{label:34s} {time.time() - t:7.2f}s")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = build_session(app="skew-check", shuffle_partitions=64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = skewed(spark, sf_dir, copies)
    total = df.count()
    hot = df.filter("user_id = 0").count()
    print(f"rows {total}, hot key rows {hot} ({hot / total:.0%})")

    a = naive_sessionize(df)
    b = seq.sessionize(df, keep=["event_id"]).select("event_id", "session_idx")
    diff = a.exceptAll(b).count() + b.exceptAll(a).count()
    print("sessionize results identical:", diff == 0)
    for _ in range(2):
        timed("sessionize, Window.partitionBy(user)", a)
        timed("sessionize, (user, 24h bucket)", b)

    w = (Window.partitionBy("user_id").orderBy(epoch_us("ts"))
         .rangeBetween(-7 * 86_400_000_000, 0))
    ra = df.select("event_id", F.count(F.lit(1)).over(w).alias("n_7d"))
    rb = seq.rolling(df, days=7).select("event_id", "n_7d")
    print("rolling results identical:", ra.exceptAll(rb).count() + rb.exceptAll(ra).count() == 0)
    for _ in range(2):
        timed("rolling 7d, Window.partitionBy(user)", ra)
        timed("rolling 7d, (user, 24h bucket)", rb)
    # burst: the hot key's third of the rows squeezed into one day
    t0 = df.filter("user_id = 0").agg(F.min("ts")).first()[0]
    span_us = (df.filter("user_id = 0").agg(F.max("ts")).first()[0] - t0).total_seconds() * 1e6
    squeeze = F.lit(86_400_000_000 / span_us)
    us0 = epoch_us(F.lit(t0).cast("timestamp_ntz"))
    burst = materialize(df.withColumn("ts", F.when(
        F.col("user_id") == 0,
        F.timestamp_add("MICROSECOND", ((epoch_us("ts") - us0) * squeeze).cast("bigint"),
                        F.lit(t0).cast("timestamp_ntz"))).otherwise(F.col("ts"))))
    a = naive_sessionize(burst)
    b = seq.sessionize(burst, keep=["event_id"], max_bucket_rows=50_000).select(
        "event_id", "session_idx")
    print("burst sessionize identical:", a.exceptAll(b).count() + b.exceptAll(a).count() == 0)
    for _ in range(2):
        timed("burst sessionize, partitionBy(user)", a)
        timed("burst sessionize, split cells", b)
    spark.stop()


if __name__ == "__main__":
    main()
