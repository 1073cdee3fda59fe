"""Typed scans of the parquet tables.

Scans stay lazy so Catalyst pushes filters and column pruning into the
parquet reader; callers select columns and filter after ``load``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    if table not in TABLES:
        raise ValueError(f"unknown table {table!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with its types pinned (ts as timestamp_ntz)."""
    df = load(spark, sf_dir, "events")
    return df.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("event_type").cast("string").alias("event_type"),
        F.col("value").cast("double").alias("value"),
        F.col("props").cast("string").alias("props"),
    )
