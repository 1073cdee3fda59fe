"""The training table from stored daily states: only changed days are read again.

A state is two tables by key and day.  ``days`` has what adds up or takes an
extreme (counts, exact sums and squares of whole units, first and last time),
``values`` how often each value occurs, for the exact median.  Merging days
gives what one pass over all events gives, bit for bit, because every part is
an integer.

A manifest names, for each day, the folder that holds its state and a
fingerprint of its events.  ``update`` compares fingerprints, writes the states
of days that are new or differ into a folder of their own, and a new manifest:
an interrupted update leaves the old one as it was, and days whose events are
all gone are not in the new one.

Cutoff and horizons are whole days, as the state is.  Events without a time are
in no day and ignored, as the training table does.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa import defaults
from propensa.functions import epoch_us, std_of, ts_lit, units, unscaled

FINGERPRINT = "day date, n bigint, hashes string"


def fingerprints(events: DataFrame, ts: str = "ts") -> DataFrame:
    """day, n, hashes: count and sum of hashes of each day's events, a row per
    calendar day."""
    rows = events.where(F.col(ts).isNotNull()).select(F.to_date(ts).alias("day"), F.xxhash64(*events.columns).alias("h"))
    return rows.groupBy("day").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("hashes"))


def daily_state(events: DataFrame, key: str = "user_id", ts: str = "ts", value: str = "value", type_col: str = "event_type",
                types: Sequence[str] = defaults.EVENT_TYPES, scale: int = defaults.MONEY_SCALE) -> tuple[DataFrame, DataFrame]:
    """The tables ``days`` and ``values`` of ``events``."""
    unit = units(value, scale)
    d = unit.cast("decimal(20,0)")
    us = epoch_us(ts)
    timed = events.where(F.col(ts).isNotNull()).withColumn("day", F.to_date(ts))
    days = timed.groupBy(key, "day").agg(
        F.count("*").alias("n"), F.count(unit).alias("n_values"), F.sum(d).alias("total"), F.sum(d * d).alias("squares"),
        F.min(us).alias("first_us"), F.max(us).alias("last_us"),
        *[F.count_if(F.col(type_col) == F.lit(t)).alias(f"n_{t}") for t in types])
    values = timed.select(key, "day", unit.alias("unit")).where("unit is not null").groupBy(key, "day", "unit").agg(
        F.count("*").alias("n"))
    return days, values


def update(events: DataFrame, base: str, before: str | None = None, **columns) -> str:
    """Bring the state up to date and return the path of its manifest.
    ``before``: the manifest of the last update, if there is one."""
    spark = events.sparkSession
    ts = columns.get("ts", "ts")
    # a row per calendar day
    known = {r["day"]: r for r in spark.read.parquet(before).collect()} if before else {}
    now = {r["day"]: r for r in fingerprints(events, ts).collect()}
    changed = sorted(d for d, r in now.items()
                     if d not in known or (known[d]["n"], known[d]["hashes"]) != (r["n"], r["hashes"]))
    folder = f"{base}/state-{uuid.uuid4().hex}"
    if changed:
        day = F.to_date(ts)
        low, high = changed[0], changed[-1] + dt.timedelta(days=1)
        part = events.where((F.col(ts) >= ts_lit(dt.datetime.combine(low, dt.time())))
                            & (F.col(ts) < ts_lit(dt.datetime.combine(high, dt.time()))) & day.isin(changed))
        for name, table in zip(("days", "values"), daily_state(part, **columns)):
            table.write.partitionBy("day").parquet(f"{folder}/{name}")
    rows = [(d, r["n"], r["hashes"], folder if d in set(changed) else known[d]["folder"]) for d, r in sorted(now.items())]
    path = f"{base}/manifest-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, f"{FINGERPRINT}, folder string").coalesce(1).write.parquet(path)
    return path


def _state(spark: SparkSession, manifest: str, name: str, end: dt.date) -> DataFrame | None:
    """The table of all days before ``end``; partitions of other days are not
    read."""
    folders: dict[str, list[dt.date]] = {}
    for r in spark.read.parquet(manifest).where(F.col("day") < F.lit(end)).collect():
        folders.setdefault(r["folder"], []).append(r["day"])
    tables = [spark.read.parquet(f"{folder}/{name}").where(F.col("day").isin(days)) for folder, days in sorted(folders.items())]
    whole = None
    for table in tables:
        whole = table if whole is None else whole.unionByName(table)
    return whole


def training_table(spark: SparkSession, manifest: str, cutoff: dt.datetime = defaults.CUTOFF,
                   horizon_days: int = defaults.HORIZON_DAYS, key: str = "user_id",
                   types: Sequence[str] = defaults.EVENT_TYPES, horizons: Sequence[int] = defaults.HORIZONS,
                   target: str = defaults.TARGET_TYPE, scale: int = defaults.MONEY_SCALE) -> DataFrame | None:
    """The table of :func:`features.training_table`, from the state; None if
    the manifest has no day before the end of the label."""
    if cutoff.time() != dt.time():
        raise ValueError("the state is daily: the cutoff must be a midnight")
    end, at = (cutoff + dt.timedelta(days=horizon_days)).date(), cutoff.date()
    days, values = _state(spark, manifest, "days", end), _state(spark, manifest, "values", at)
    if days is None:
        return None
    seen = F.col("day") < F.lit(at)

    def total(column: str, inside: Column) -> Column:
        return F.sum(F.when(inside, F.col(column)))

    n, n_values, wide = total("n", seen), total("n_values", seen), total("total", seen)
    aggs = [F.coalesce(n, F.lit(0)).cast("bigint").alias("n_events"), unscaled(wide, scale).alias("sum_value"),
            (wide.cast("double") / F.nullif(n_values * F.lit(10 ** scale), F.lit(0)).cast("double")).alias("mean_value"),
            std_of(n_values, wide, total("squares", seen).cast("decimal(38,0)"), scale).alias("std_value"),
            F.count_if(seen).cast("bigint").alias("active_days")]
    aggs += [F.coalesce(total(f"n_{t}", seen), F.lit(0)).cast("bigint").alias(f"n_{t}") for t in types]
    for d in horizons:
        inside = seen & (F.col("day") >= F.lit(at - dt.timedelta(days=d)))
        aggs += [F.coalesce(total("n", inside), F.lit(0)).cast("bigint").alias(f"n_{d}d"),
                 F.coalesce(unscaled(total("total", inside), scale), F.lit(0.0)).alias(f"sum_{d}d")]
    span = (F.max(F.when(seen, F.col("last_us"))) - F.min(F.when(seen, F.col("first_us")))).cast("double")
    aggs += [F.datediff(F.lit(at), F.max(F.when(seen, F.col("day")))).cast("int").alias("days_since_last"),
             (F.try_divide(span, (n - F.lit(1)).cast("double")) / F.lit(1e6)).alias("mean_gap_s"),
             F.max(F.when(~seen & (F.col(f"n_{target}") > 0), 1).otherwise(0)).cast("int").alias("label")]
    table = days.groupBy(key).agg(*aggs).where(F.col("n_events") > 0)
    if values is None:
        return table.withColumn("median_value", F.lit(None).cast("double"))
    middle = values.groupBy(key).agg(unscaled(F.percentile("unit", F.lit(0.5), F.col("n")), scale).alias("median_value"))
    # null keys are one key
    joined = table.join(middle.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    order = [key, "n_events", "sum_value", "mean_value", "std_value", "median_value"]
    return joined.select(*order, *[c for c in joined.columns if c not in order])
