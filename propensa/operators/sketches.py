"""Rollups of any range from stored daily sketches.

Per group and day, one row holds the count of rows, a HyperLogLog sketch of a
column's distinct values and a KLL sketch of another column's distribution.
Counts add up and sketches merge, so a range of days is answered from these
rows without the data; a new day adds rows and changes none.

Stated errors: the distinct count is off by more than ``3 * 1.04 / sqrt(2 **
LG_K)`` in about 3 of 1000 cases, and a quantile's rank by more than
``KLL_RANK_ERROR`` in about 1 of 100.  Nulls are not sketched; a range without
values has distinct count 0 and null quantiles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of the HyperLogLog's registers; size of the KLL sketch and the
#: rank error its authors state for it.
LG_K, KLL_K, KLL_RANK_ERROR = 12, 400, 0.0075


def distinct_error() -> float:
    return 3 * 1.04 / 2 ** (LG_K / 2)


def daily_sketches(df: DataFrame, by: Sequence[str], distinct: str, value: str, ts: str = "ts") -> DataFrame:
    """by, day, n, distinct_sketch, value_sketch.  One hash aggregate with a
    partial step: a hot group is merged as sketches."""
    return df.groupBy(*by, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(distinct, LG_K).alias("distinct_sketch"),
        F.kll_sketch_agg_double(value, KLL_K).alias("value_sketch"))


def rollup(daily: DataFrame, by: Sequence[str], first: dt.date, last: dt.date,
           quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """by, n, n_distinct and a column per quantile (q50 ...), of the days
    ``first`` to ``last``, both included."""
    merged = daily.where(F.col("day").between(F.lit(first), F.lit(last))).groupBy(*by).agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("d"),
        F.kll_merge_agg_double("value_sketch").alias("v"))
    empty = F.kll_sketch_get_n_double("v") == 0
    return merged.select(*by, "n", F.hll_sketch_estimate("d").alias("n_distinct"), *[
        F.when(~empty, F.kll_sketch_get_quantile_double("v", F.lit(q))).alias(f"q{round(100 * q)}") for q in quantiles])
