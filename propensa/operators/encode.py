"""Leakage-safe encodings, winsorising and stable folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa import defaults
from propensa.functions import exact_mean, exact_std, fold_of, units
from propensa.operators.joins import bounded_broadcast
from propensa.operators.rank import prefix_before
from propensa.session import materialize


def target_mean(df: DataFrame, cat: str, y: str, out: str = "te",
                max_broadcast_rows: int = 1_000_000,
                max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Leave-one-out mean of ``y`` within ``cat``: ``(sum - y) / (count - 1)``.

    Null for the only row of its category (no other rows to learn from).
    Per-category sums come from a partial aggregate, so a hot category is
    combined map-side.  The stats table is checkpointed once (so its size
    check costs no second pass over ``df``) and joined back: broadcast when
    it has at most ``max_broadcast_rows`` rows and bytes, else a shuffle join that
    AQE's skew handling may split.  Null categories form their own group, as
    in ``GROUP BY``.
    """
    stats = materialize(df.groupBy(F.col(cat).alias("_cat"))
                          .agg(F.sum(F.col(y)).alias("_sy"), F.count(F.col(y)).alias("_ny")))
    stats = bounded_broadcast(stats, max_broadcast_rows, max_broadcast_bytes)
    j = df.join(stats, df[cat].eqNullSafe(stats["_cat"]), "left")
    te = F.try_divide((F.col("_sy") - F.col(y)).cast("double"),
                      (F.col("_ny") - F.lit(1)).cast("double"))
    return j.withColumn(out, te).drop("_cat", "_sy", "_ny")


def percentiles(df: DataFrame, col: str, shares: Sequence[float]) -> DataFrame:
    """One row: the smallest values (p0, p1, ...) whose cumulative share is at
    least each of ``shares``.

    Values are counted, and a two-level global prefix over the counts gives
    each value's cumulative share, so no task holds all distinct values.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    pre = materialize(prefix_before(counts, "_v", ["_n"]))
    total = pre.select(F.sum("_n")).scalar()
    share = (F.col("_n_before") + F.col("_n")).cast("double") / total.cast("double")
    return pre.agg(*[F.min(F.when(share >= F.lit(p), F.col("_v"))).alias(f"p{i}") for i, p in enumerate(shares)])


def clip_and_scale(df: DataFrame, col: str, p: float = defaults.CLIP_P,
                   prefix: str | None = None, exact: bool = True,
                   scale: int | None = None) -> DataFrame:
    """Winsorise ``col`` at its ``p`` and ``1-p`` discrete percentiles, then
    z-score the clipped values (in whole units of a declared ``scale``).

    The statistics are scalar subqueries, evaluated once per query, with no
    join; ``exact=False`` uses a fixed-size sketch for the percentiles, whose
    result is still a value of the column.
    """
    prefix = prefix or col
    if exact:
        ends = percentiles(df, col, [p, 1 - p])
    else:
        ends = df.select(F.percentile_approx(col, p, 10_000).alias("p0"),
                         F.percentile_approx(col, 1 - p, 10_000).alias("p1"))
    bounds = ends.select(F.struct(F.col("p0").cast("double").alias("lo"),
                                  F.col("p1").cast("double").alias("hi"))).scalar()
    clipped = F.least(F.greatest(F.col(col), bounds["lo"]), bounds["hi"])
    c = units(clipped, scale)
    stats = df.select(F.struct(exact_mean(c, scale).alias("mean"),
                               exact_std(c, scale).alias("std"))).scalar()
    out = df.withColumn(f"{prefix}_clipped", clipped)
    return out.withColumn(
        f"{prefix}_z",
        F.try_divide(F.col(f"{prefix}_clipped") - stats["mean"], stats["std"]))


def hash_split(df: DataFrame, key: str, k: int = defaults.N_FOLDS,
               out: str = "fold") -> DataFrame:
    """A stable fold per entity: equal keys always land in the same fold."""
    return df.withColumn(out, fold_of(key, k))
