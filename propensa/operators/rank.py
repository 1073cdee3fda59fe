"""Global order statistics without a single-task window.

``rank() OVER (ORDER BY x)`` with no partition moves every row to one task.
Here a global prefix is built in two levels instead: the distinct values are
cut into quantile ranges (bounds from a bounded sketch), prefixes are taken
inside each range by a partitioned window, and a table with one row per range
supplies each range's offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensa import defaults
from propensa.session import materialize


def top_k(df: DataFrame, key: str, order: str, k: int = defaults.TOP_K,
          tiebreak: str | None = None, descending: bool = True,
          rank_col: str = "rank") -> DataFrame:
    """The best ``k`` rows per key, numbered 1..k; null values rank last in
    either direction.

    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit``
    before the shuffle, so each map task forwards at most ``k`` rows per key.
    """
    o = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last()
    orders = [o] + ([F.col(tiebreak).asc_nulls_last()] if tiebreak else [])
    w = Window.partitionBy(key).orderBy(*orders)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) <= k))


def prefix_before(df: DataFrame, order: str, sums: Sequence[str],
                  buckets: int | None = None, rel_err: float = 1e-4,
                  checkpoint: bool = True, descending: bool = False) -> DataFrame:
    """Add ``<c>_before`` = sum of ``c`` over rows with a smaller ``order``
    (a larger one if ``descending``; NaN is the largest).

    ``df`` must hold one row per distinct, non-null ``order`` value (an
    aggregate).  The quantile bounds and the prefixes both read it, so it is
    checkpointed first; pass ``checkpoint=False`` when it is cheap to
    recompute (derived from an already materialised table).
    """
    spark = df.sparkSession
    b = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df = df.filter(F.col(order).isNotNull())
    if checkpoint:
        df = materialize(df)
    bounds: list[float] = []
    if b > 1:
        qs = (df.select(F.col(order).cast("double").alias("_q"))
                .stat.approxQuantile("_q", [i / b for i in range(1, b)], rel_err))
        bounds = sorted({float(x) for x in qs if abs(x) < float("inf")})
    # ranges are cut on doubles; inside a range the column's own type orders
    if bounds:
        splits = [float("-inf")] + bounds + [float("inf")]
        tagged = Bucketizer(splits=splits, inputCol="_q", outputCol="_bk", handleInvalid="keep").transform(
            df.withColumn("_q", F.col(order).cast("double"))).drop("_q")
    else:
        tagged = df.withColumn("_bk", F.lit(0.0))

    def ordered(c: str):
        return F.col(c).desc() if descending else F.col(c).asc()

    w = (Window.partitionBy("_bk").orderBy(ordered(order))
         .rowsBetween(Window.unboundedPreceding, -1))
    inner = tagged.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_in_{c}")
                                 for c in sums])
    # one row per bucket (at most `b`): a single-task window over it is bounded
    wb = Window.orderBy(ordered("_bk")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy("_bk").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
                     .select("_bk", *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0))
                                      .alias(f"_off_{c}") for c in sums]))
    out = inner.join(F.broadcast(offsets), "_bk")
    return out.select(*df.columns,
                      *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"{c}_before")
                        for c in sums])


def global_rank(df: DataFrame, score: str, descending: bool = True,
                rank_col: str = "rank", buckets: int | None = None,
                checkpoint: bool = True) -> DataFrame:
    """SQL ``rank()`` over the whole frame: 1 + rows with a strictly better score.

    Rows are first counted per distinct score (a partial aggregate), ranked
    with :func:`prefix_before` in the score's own type (NaN is the largest),
    and joined back on the score.  The ranked side has one row per score, so
    AQE may split the rows of a hot one.  Null scores have no rank.
    """
    counts = (df.filter(F.col(score).isNotNull())
                .groupBy(F.col(score).alias("_s")).agg(F.count(F.lit(1)).alias("_n")))
    ranked = prefix_before(counts, "_s", ["_n"], buckets, checkpoint=checkpoint, descending=descending)
    ranked = ranked.select("_s", (F.col("_n_before") + F.lit(1)).cast("bigint").alias(rank_col))
    return df.join(ranked, F.col(score) == ranked["_s"], "left").drop("_s")


def leaderboard(submissions: DataFrame, team: str, score: str,
                higher_is_better: bool = True, buckets: int | None = None) -> DataFrame:
    """Best score per team, its rank among teams and rank / number of teams."""
    best = F.max(score) if higher_is_better else F.min(score)
    # materialised once: the ranking, the join back and the team count read it
    teams = materialize(submissions.groupBy(team)
                        .agg(best.alias("best_score"),
                             F.count(F.lit(1)).cast("bigint").alias("n_submissions")))
    ranked = global_rank(teams, "best_score", higher_is_better, "rank", buckets,
                         checkpoint=False)
    n_teams = teams.select(F.count(F.lit(1))).scalar()
    return (ranked.withColumn("n_teams", n_teams.cast("bigint"))
                  .withColumn("rank_frac", F.col("rank").cast("double")
                              / F.col("n_teams").cast("double")))
