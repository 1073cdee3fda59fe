"""Grouping-set reports and cohort comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.functions import exact_sum, units


def report(df: DataFrame, dims: Sequence[str], how: str = "cube",
           value: str = "value", scale: int | None = None) -> DataFrame:
    """Counts and sums over a cube or rollup of ``dims``, with one
    ``g_<dim>`` flag per dimension (1 where the dimension is rolled up)."""
    grouped = {"cube": df.cube, "rollup": df.rollup}[how](*dims)
    return grouped.agg(*[F.grouping(d).cast("int").alias(f"g_{d}") for d in dims],
                       F.count(F.lit(1)).cast("bigint").alias("n_events"),
                       exact_sum(units(value, scale), scale).alias("sum_value"))


def cohort_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Entities of two cohorts labelled ``lost`` (a only), ``kept`` (both) or
    ``new`` (b only): SQL's ``EXCEPT`` and ``INTERSECT`` in one aggregate.

    Both inputs are unioned with a side flag and grouped once, so the whole
    comparison is a single shuffle with a map-side partial step.
    """
    u = (a.select(F.col(key), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
          .unionByName(b.select(F.col(key), F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    g = u.groupBy(key).agg(F.max("_a").alias("_in_a"), F.max("_b").alias("_in_b"))
    status = (F.when((F.col("_in_a") == 1) & (F.col("_in_b") == 1), "kept")
               .when(F.col("_in_b") == 1, "new").otherwise("lost"))
    return g.select(key, status.alias("status"))
