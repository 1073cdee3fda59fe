"""Scoring metrics on a (score, label) table.

AUC is computed exactly from per-score counts of positives and negatives
(ties merge into one row, so a score shared by many rows costs nothing) and
a two-level global prefix of negatives, never from a single-task sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa import defaults
from propensa.operators.rank import prefix_before
from propensa.session import materialize

EPS = 1e-15


def score_counts(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``_s``, ``_pos``, ``_neg``: positives and negatives of each score."""
    return (scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
                  .groupBy(F.col(score).cast("double").alias("_s"))
                  .agg(F.count_if(F.col(label) == 1).alias("_pos"),
                       F.count_if(F.col(label) != 1).alias("_neg")))


def _auc(per: DataFrame, buckets: int | None, checkpoint: bool) -> DataFrame:
    pre = prefix_before(per, "_s", ["_neg"], buckets, checkpoint=checkpoint)
    two_u = F.sum(F.col("_pos").cast("decimal(38,0)")
                  * (F.lit(2) * F.col("_neg_before") + F.col("_neg")))
    pos, neg = F.sum("_pos"), F.sum("_neg")
    return pre.agg(
        F.try_divide(two_u.cast("double"),
                     (F.lit(2) * pos.cast("decimal(38,0)") * neg).cast("double")).alias("auc"))


def auc(scored: DataFrame, score: str = "score", label: str = "label",
        buckets: int | None = None, checkpoint: bool = True) -> DataFrame:
    """One row: ``auc`` (midrank / Mann-Whitney, ties count one half).

    ``checkpoint=False`` skips materialising the per-score counts when
    ``scored`` is itself materialised.
    """
    return _auc(score_counts(scored, score, label), buckets, checkpoint)


def metrics(scored: DataFrame, score: str = "score", label: str = "label",
            threshold: float = defaults.THRESHOLD, buckets: int | None = None) -> DataFrame:
    """One row: n_pos, n_neg, precision and recall at ``threshold``
    (predict 1 when score >= threshold), log loss (score clipped to
    [1e-15, 1 - 1e-15], rounded to 9 decimals) and AUC.

    All follow from the counts per score, the only table that is written.
    The log loss sums fixed-point terms, so it does not depend on row order.
    """
    per = materialize(score_counts(scored, score, label))
    pos, neg = F.col("_pos"), F.col("_neg")
    picked = F.col("_s") >= F.lit(threshold)
    p = F.least(F.greatest(F.col("_s"), F.lit(EPS)), F.lit(1 - EPS))
    loss = -(pos * F.log(p) + neg * F.log(F.lit(1.0) - p))
    tp, fp = F.sum(F.when(picked, pos)), F.sum(F.when(picked, neg))
    n = F.sum(pos + neg)
    base = per.agg(
        F.coalesce(F.sum(pos), F.lit(0)).cast("bigint").alias("n_pos"),
        F.coalesce(F.sum(neg), F.lit(0)).cast("bigint").alias("n_neg"),
        F.try_divide(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
        F.try_divide(F.coalesce(tp, F.lit(0)).cast("double"), F.sum(pos).cast("double")).alias("recall"),
        F.round(F.try_divide(F.sum(loss.cast("decimal(38,12)")).cast("double"), n.cast("double")), 9).alias("logloss"))
    return base.withColumn("auc", _auc(per, buckets, checkpoint=False).scalar())
