"""Consecutive numbers for ordered rows, without a single sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensa.session import written


def numbered(rows: DataFrame, order: list[Column], group: list[str], row_id: str) -> DataFrame:
    """``rows`` with ``at`` (0, 1, 2 ... within ``group``, by ``order``) and
    ``n`` (rows of the group).

    ``row_id`` names a column with different values in a written table; it
    decides between ties, so that equal rows of any number can be cut into
    ranges.  The rows are sorted into ranges over all groups; a range starts
    where the counts of the ranges before it end.  No task has more than a
    range, however large a group is, and a group has at most one count a range.
    """
    ranges = written(rows.repartitionByRange(*group, *order, row_id).withColumn("_range", F.spark_partition_id()),
                     "ranges")
    counts = ranges.groupBy(*group, "_range").agg(F.count("*").alias("_here"))
    of_group = Window.partitionBy(*group)
    starts = counts.withColumns({
        "_before": F.sum("_here").over(of_group.orderBy("_range")) - F.col("_here"),
        "n": F.sum("_here").over(of_group)}).drop("_here")
    keys = [*group, "_range"]
    right = starts.withColumnsRenamed({k: f"_of{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in keys]
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, row_id)).cast("bigint")
    placed = ranges.withColumn("_within", within).join(right, same)
    return placed.withColumn("at", F.col("_before") + F.col("_within") - 1).drop(
        "_before", "_within", *keys[len(group):], *[f"_of{k}" for k in keys])
