"""Deterministic de-duplication of a batch (the batch side of P25)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, key: str = "event_id", order: Sequence[str] = ("ts",)) -> DataFrame:
    """One row per ``key``: the copy with the smallest ``order`` values, the
    remaining columns breaking ties, so reruns keep the same copy.

    ``min`` over a struct is a partial aggregate: a group of copies holding a
    third of all rows collapses map-side before the shuffle.  Rows with a
    null key are not copies of each other and pass through unchanged.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    kept = (df.filter(F.col(key).isNotNull())
              .groupBy(key).agg(F.min(packed).alias("_row"))
              .select(key, *[F.col(f"_row.{c}").alias(c) for c in list(order) + rest]))
    return kept.unionByName(df.filter(F.col(key).isNull())).select(*df.columns)
