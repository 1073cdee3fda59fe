"""Baseline classifier (P22): MLlib logistic regression on the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_score(train: DataFrame, test: DataFrame, features: Sequence[str],
              label: str = "label", key: str = "user_id",
              max_iter: int = 50, reg: float = 0.01) -> DataFrame:
    """Fit on ``train`` and return ``key, label, score`` for ``test``.

    Null features are read as 0, and rows without a label are not fitted on.
    Where the training rows have one class, or there are none, nothing can be
    separated: every row then scores (positives + 1) / (rows + 2).
    Checkpoint the inputs first when they have a long lineage (the registered
    query does), so a lost executor re-reads the checkpoint instead of
    recomputing the features.
    """
    def prep(df: DataFrame) -> DataFrame:
        return df.select(key, F.col(label).cast("double").alias(label),
                         *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                           for c in features])

    train_p = prep(train).filter(F.col(label).isNotNull()).cache()   # the optimiser makes many passes
    rows, positives = train_p.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0.0))).first()
    if positives in (0, rows):
        train_p.unpersist()
        return test.select(key, F.col(label).cast("int").alias(label),
                           F.lit((positives + 1) / (rows + 2)).alias("score"))
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True),
        LogisticRegression(featuresCol="_x", labelCol=label, maxIter=max_iter,
                           regParam=reg, probabilityCol="_prob"),
    ])
    model = pipe.fit(train_p)
    train_p.unpersist()
    scored = model.transform(prep(test))
    return scored.select(key, F.col(label).cast("int").alias(label),
                         vector_to_array("_prob")[1].alias("score"))
