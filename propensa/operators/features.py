"""Point-in-time features and labels around a cutoff.

Each feature family is a list of aggregate expressions conditioned on the
rows it may see, so several families share one scan and one
``groupBy(key)``.  Every aggregate here is algebraic (or, for the median, a
frequency map of values), so Spark runs it as a partial aggregate
before the shuffle: a key holding a third of all rows is combined on the map
side and never reaches one task whole.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa import defaults
from propensa.functions import epoch_us, exact_mean, exact_std, exact_sum, ts_lit, units, unscaled


def _when(cond: Column | None, c: Column) -> Column:
    return c if cond is None else F.when(cond, c)


def _count(cond: Column | None) -> Column:
    return F.count(F.lit(1)) if cond is None else F.count_if(cond)


def _before(ts: str, cutoff: _dt.datetime) -> Column:
    return F.col(ts) < ts_lit(cutoff)


def time_range(ts: str, start: _dt.datetime | None, end: _dt.datetime,
               date_col: str | None = None) -> Column:
    """``start <= ts < end`` (``start`` optional).

    Pushed into the parquet reader.  With ``date_col``, the table's date
    partition column, the same range is also stated on it, so Spark skips
    whole date directories instead of only row groups.
    """
    cond = F.col(ts) < ts_lit(end)
    if start is not None:
        cond = cond & (F.col(ts) >= ts_lit(start))
    if date_col is not None:
        cond = cond & (F.col(date_col) <= F.lit(end.date()))
        if start is not None:
            cond = cond & (F.col(date_col) >= F.lit(start.date()))
    return cond


def _lookback_start(cutoff: _dt.datetime, lookback_days: int | None) -> _dt.datetime | None:
    return None if lookback_days is None else cutoff - _dt.timedelta(days=lookback_days)


def observe(df: DataFrame, cutoff: _dt.datetime = defaults.CUTOFF,
            ts: str = "ts", lookback_days: int | None = None,
            date_col: str | None = None) -> DataFrame:
    """Rows strictly before the cutoff (and within ``lookback_days`` of it,
    if given), pushed into the parquet scan."""
    return df.filter(time_range(ts, _lookback_start(cutoff, lookback_days), cutoff, date_col))


# ---------------------------------------------------------------- aggregates

def rollup_aggs(cond: Column | None = None, ts: str = "ts",
                value: str = "value", exact_median: bool | None = None,
                scale: int | None = None) -> list[Column]:
    """count, sum, mean, stddev, median of ``value`` and active days.

    The exact median's buffer is a map from distinct value to its count,
    merged map-side: with a ``scale`` its size is bounded by the distinct
    units of a key, not by its rows.  ``exact_median=False`` uses a fixed-size
    sketch instead (``percentile_approx``) for value domains with no such
    bound, and is the default where no scale is declared.
    """
    c = _when(cond, units(value, scale))
    day = _when(cond, F.to_date(F.col(ts)))
    exact = scale is not None if exact_median is None else exact_median
    median = (F.percentile(c, F.lit(0.5)) if exact
              else F.percentile_approx(c, 0.5, 10_000).cast("double"))
    return [
        _count(cond).cast("bigint").alias("n_events"),
        exact_sum(c, scale).alias("sum_value"),
        exact_mean(c, scale).alias("mean_value"),
        exact_std(c, scale).alias("std_value"),
        unscaled(median, scale).alias("median_value"),
        # distinct days as a set: one aggregation level (count(distinct)
        # would add a second shuffle), and the set holds at most one entry
        # per calendar day of the key's history, however hot the key
        F.size(F.collect_set(day)).cast("bigint").alias("active_days"),
    ]


def type_count_aggs(cond: Column | None = None, type_col: str = "event_type",
                    types: Sequence[str] = defaults.EVENT_TYPES) -> list[Column]:
    """One count per known event type; 0 when a key has none."""
    out = []
    for t in types:
        is_t = F.col(type_col) == F.lit(t)
        out.append(_count(is_t if cond is None else cond & is_t)
                   .cast("bigint").alias(f"n_{t}"))
    return out


def horizon_aggs(cutoff: _dt.datetime = defaults.CUTOFF,
                 days: Sequence[int] = defaults.HORIZONS, ts: str = "ts",
                 value: str = "value", scale: int | None = None) -> list[Column]:
    """Counts and sums over the last ``d`` days before the cutoff, one pass."""
    out = []
    for d in days:
        inside = (F.col(ts) >= ts_lit(cutoff - _dt.timedelta(days=d))) & _before(ts, cutoff)
        out.append(F.count_if(inside).cast("bigint").alias(f"n_{d}d"))
        out.append(F.coalesce(exact_sum(F.when(inside, units(value, scale)), scale), F.lit(0.0))
                   .alias(f"sum_{d}d"))
    return out


def recency_aggs(cutoff: _dt.datetime = defaults.CUTOFF, cond: Column | None = None,
                 ts: str = "ts") -> list[Column]:
    """Whole days from the last observed event to the cutoff."""
    last = F.max(_when(cond, F.col(ts)))
    return [F.datediff(F.lit(cutoff.date()), F.to_date(last))
            .cast("int").alias("days_since_last")]


def gap_aggs(cond: Column | None = None, ts: str = "ts") -> list[Column]:
    """Mean seconds between consecutive events.

    The gaps of a sorted sequence telescope: their sum is last - first.  So
    the mean needs no ordering or window, only min, max and count, which are
    partial aggregates.
    """
    us = _when(cond, epoch_us(ts))
    n = F.count(us)
    span = (F.max(us) - F.min(us)).cast("double")
    return [(F.try_divide(span, (n - F.lit(1)).cast("double")) / F.lit(1e6))
            .alias("mean_gap_s")]


def label_agg(cutoff: _dt.datetime = defaults.CUTOFF,
              horizon_days: int = defaults.HORIZON_DAYS,
              target: str = defaults.TARGET_TYPE, ts: str = "ts",
              type_col: str = "event_type") -> Column:
    """1 if the key has a ``target`` event in [cutoff, cutoff + horizon)."""
    hit = ((F.col(ts) >= ts_lit(cutoff))
           & (F.col(ts) < ts_lit(cutoff + _dt.timedelta(days=horizon_days)))
           & (F.col(type_col) == F.lit(target)))
    return F.max(F.when(hit, 1).otherwise(0)).cast("int").alias("label")


# ---------------------------------------------------------------- operators

def label(df: DataFrame, cutoff: _dt.datetime = defaults.CUTOFF,
          horizon_days: int = defaults.HORIZON_DAYS,
          target: str = defaults.TARGET_TYPE, key: str = "user_id",
          ts: str = "ts", lookback_days: int | None = None,
          date_col: str | None = None) -> DataFrame:
    """0/1 label per key seen before the cutoff (keys without future rows get 0)."""
    end = cutoff + _dt.timedelta(days=horizon_days)
    start = _lookback_start(cutoff, lookback_days)
    return (df.filter(time_range(ts, start, end, date_col))
              .groupBy(key)
              .agg(F.count_if(_before(ts, cutoff)).alias("_seen"),
                   label_agg(cutoff, horizon_days, target, ts))
              .filter(F.col("_seen") > 0)
              .drop("_seen"))


def rollup_features(df: DataFrame, key: str = "user_id", ts: str = "ts",
                    value: str = "value", exact_median: bool | None = None,
                    scale: int | None = None) -> DataFrame:
    return df.groupBy(key).agg(*rollup_aggs(None, ts, value, exact_median, scale))


def type_counts(df: DataFrame, key: str = "user_id", type_col: str = "event_type",
                types: Sequence[str] = defaults.EVENT_TYPES) -> DataFrame:
    return df.groupBy(key).agg(*type_count_aggs(None, type_col, types))


def horizon_features(df: DataFrame, cutoff: _dt.datetime = defaults.CUTOFF,
                     days: Sequence[int] = defaults.HORIZONS, key: str = "user_id",
                     ts: str = "ts", value: str = "value",
                     scale: int | None = None) -> DataFrame:
    """Per key seen before the cutoff, counts/sums over the trailing windows."""
    return (observe(df, cutoff, ts)
            .groupBy(key)
            .agg(*horizon_aggs(cutoff, days, ts, value, scale)))


def recency(df: DataFrame, cutoff: _dt.datetime = defaults.CUTOFF,
            key: str = "user_id", ts: str = "ts") -> DataFrame:
    return observe(df, cutoff, ts).groupBy(key).agg(*recency_aggs(cutoff, None, ts))


def gaps(df: DataFrame, key: str = "user_id", ts: str = "ts") -> DataFrame:
    return df.groupBy(key).agg(*gap_aggs(None, ts))


def training_table(df: DataFrame, cutoff: _dt.datetime = defaults.CUTOFF,
                   horizon_days: int = defaults.HORIZON_DAYS,
                   key: str = "user_id", ts: str = "ts", value: str = "value",
                   type_col: str = "event_type",
                   types: Sequence[str] = defaults.EVENT_TYPES,
                   horizons: Sequence[int] = defaults.HORIZONS,
                   target: str = defaults.TARGET_TYPE,
                   lookback_days: int | None = None,
                   date_col: str | None = None, exact_median: bool | None = None,
                   scale: int | None = None) -> DataFrame:
    """One row per key seen before the cutoff: all features plus the label.

    One scan (rows at or after cutoff + horizon, and before the lookback if
    one is given, are pruned in the reader; see :func:`time_range` for
    ``date_col``), one hash aggregate with a map-side partial step, one
    shuffle.
    """
    end = cutoff + _dt.timedelta(days=horizon_days)
    start = _lookback_start(cutoff, lookback_days)
    obs = _before(ts, cutoff)
    aggs = (rollup_aggs(obs, ts, value, exact_median, scale)
            + type_count_aggs(obs, type_col, types)
            + horizon_aggs(cutoff, horizons, ts, value, scale)
            + recency_aggs(cutoff, obs, ts)
            + gap_aggs(obs, ts)
            + [label_agg(cutoff, horizon_days, target, ts, type_col)])
    return (df.filter(time_range(ts, start, end, date_col))
              .groupBy(key).agg(*aggs)
              .filter(F.col("n_events") > 0))
