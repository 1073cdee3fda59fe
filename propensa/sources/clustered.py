"""A Parquet sink clustered on several columns at once, and its reader.

Each column is cut at quantiles into ``2 ** BITS`` parts; the bits of the part
numbers are interleaved to a place on a space-filling (Z-order) curve, and rows
are written in ranges of it.  A file so holds a small range of *every* column.
A table beside the files has each file's least and greatest values; the reader
leaves out files that no filter can match before Spark plans the scan, and
Parquet's own statistics then skip row groups.

Nulls of a column are its lowest part; a filter on the column never matches
them, and files are not kept for their sake.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.functions import epoch_us, ts_lit

#: Bits of each column's part number; error of the quantiles.
BITS, QUANTILE_ERROR = 8, 0.001


def _number(df: DataFrame, column: str) -> Column:
    """The column as a number that sorts alike."""
    kind = df.schema[column].dataType.simpleString()
    c = F.col(column)
    if kind in ("timestamp", "timestamp_ntz"):
        return epoch_us(column).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind == "string":    # the first six bytes
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return c.cast("double")


def z_order(df: DataFrame, columns: Sequence[str], place: str = "_place", bits: int = BITS) -> DataFrame:
    """``df`` with interleaved bits of the columns' quantile parts, as a bigint."""
    if bits * len(columns) > 62:
        raise ValueError("too many bits for a bigint")
    numbers, parts = [f"_z{i}" for i in range(len(columns))], [f"_part{i}" for i in range(len(columns))]
    table = df.withColumns({n: _number(df, c) for c, n in zip(columns, numbers)})
    shares = [k / 2 ** bits for k in range(1, 2 ** bits)]
    bounds = [sorted(set(cut)) for cut in
              table.select(numbers).approxQuantile(numbers, shares, QUANTILE_ERROR)]     # 2 ** bits numbers a column
    cuts = [F.array(*map(F.lit, cut)).cast("array<double>") for cut in bounds]
    # how many bounds are at most the number, by halves: one comparison a bit;
    # beyond the last bound ``get`` is null, and a null number is above none
    table = table.withColumns({p: F.lit(0) for p in parts})
    for step in (1 << bit for bit in reversed(range(bits))):
        table = table.withColumns({
            p: F.col(p) + F.when(F.get(cut, F.col(p) + (step - 1)) <= F.col(n), step).otherwise(0)
            for p, cut, n in zip(parts, cuts, numbers)})
    found = F.lit(0).cast("bigint")
    for i, part in enumerate(parts):
        for bit in range(bits):
            one = F.shiftright(F.col(part).cast("bigint"), bit).bitwiseAND(F.lit(1))
            found = found.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    return table.withColumn(place, found).drop(*numbers, *parts)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> str:
    """Write ``df`` to ``path``/data and the files' limits to ``path``/limits.
    ``files``: how many ranges; by default Spark's shuffle partitions."""
    placed = z_order(df, columns)
    ranged = placed.repartitionByRange(files, "_place") if files else placed.repartitionByRange("_place")
    ranged.sortWithinPartitions("_place").drop("_place").write.parquet(f"{path}/data")
    data = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    limits = [f(c).alias(f"{name}_{c}") for c in columns for f, name in ((F.min, "min"), (F.max, "max"))]
    data.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"), *limits).write.parquet(
        f"{path}/limits")
    return path


def _limit(df: DataFrame, column: str, value: Any) -> Column:
    """A limit in the column's type; wall-clock times without a time zone."""
    return ts_lit(value) if df.schema[column].dataType.simpleString() == "timestamp_ntz" else F.lit(value)


def kept_files(spark: SparkSession, path: str, ranges: dict[str, tuple[Any, Any]]) -> list[str]:
    """Files that may hold rows in all the ranges (least, greatest; both
    included, None: open)."""
    limits = spark.read.parquet(f"{path}/limits")
    for column, (least, greatest) in ranges.items():
        if least is not None:
            limits = limits.where(F.col(f"max_{column}") >= _limit(limits, f"max_{column}", least))
        if greatest is not None:
            limits = limits.where(F.col(f"min_{column}") <= _limit(limits, f"min_{column}", greatest))
    return sorted(r["file"] for r in limits.select("file").collect())     # a name per file that is read


def read_clustered(spark: SparkSession, path: str, ranges: dict[str, tuple[Any, Any]]) -> DataFrame:
    """The rows in all the ranges, read from the files that may hold some."""
    files = kept_files(spark, path, ranges)
    schema = spark.read.parquet(f"{path}/data").schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for column, (least, greatest) in ranges.items():
        if least is not None:
            rows = rows.where(F.col(column) >= _limit(rows, column, least))
        if greatest is not None:
            rows = rows.where(F.col(column) <= _limit(rows, column, greatest))
    return rows
