"""Dimension joins with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int = 16 << 20) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows and their
    text form at most ``max_bytes`` bytes.

    Rows and bytes are counted where they lie (a partial aggregate), so give a
    table that is written or cheap to read.  Above a bound the frame is
    returned unhinted, and Spark plans a shuffle join (AQE may still turn it
    into a broadcast from runtime sizes, within its own threshold).
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and total <= max_bytes else df


def customer_dimension(customer: DataFrame, nation: DataFrame,
                       region: DataFrame | None = None,
                       max_dim_rows: int = 10_000) -> DataFrame:
    """customer + nation (+ region) attributes, one row per customer.

    nation and region are tiny by definition and broadcast behind a row
    check; customer grows with the data and is never hinted.
    """
    nat = nation.select("n_nationkey", "n_name", "n_regionkey")
    if region is not None:
        reg = bounded_broadcast(region.select("r_regionkey", "r_name"), max_dim_rows)
        nat = nat.join(reg, nat.n_regionkey == reg.r_regionkey, "left").drop("r_regionkey")
    nat = bounded_broadcast(nat, max_dim_rows)
    cust = customer.select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    return (cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left")
                .drop("n_nationkey", "n_regionkey"))


def enrich(df: DataFrame, dim: DataFrame, key: str = "user_id",
           dim_key: str = "c_custkey") -> DataFrame:
    """Left join of entity rows to a dimension keyed by ``dim_key``."""
    return df.join(dim, df[key] == dim[dim_key], "left").drop(dim_key)
