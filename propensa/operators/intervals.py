"""Joins on intervals of time: a point in an interval, and two that overlap.

A range condition alone makes Spark compare all rows of a key with each other
(or, without a key, all rows).  Here time is cut into bins, so that the joins
are equi-joins on (key, level, bin) followed by the exact condition.

An interval is put on the *level* whose bins are as wide as it is long, or up
to ``STEP`` times wider, where it touches at most two bins.  Long intervals so
cost no more rows than short ones.  A point is looked up on each level that the
intervals use, at most ``LEVELS``.  Of two overlapping intervals, the finer one
is looked up on the coarser one's level, and a pair that shares two bins counts
in the one where the overlap starts.

Rows of one (key, level, bin) may be a large part of all.  Cells with more than
``hot`` rows of the left side are cut into slices by a hash of the row, and
the right rows of these cells, and only these, are given to each slice.

Intervals are half open, ``start <= t < end``.  Those without a start or an end,
and empty ones, match nothing, nor do points without a time.  Null keys are
equal to each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.functions import epoch_us
from propensa.operators.joins import bounded_broadcast
from propensa.session import materialize, written

#: Width of the finest bins (a second), ratio of neighbouring levels, and how
#: many there are: the coarsest holds over 100,000 years.
FINEST_US, STEP, LEVELS = 1_000_000, 8, 15
#: Left rows of a cell that one task compares, and hot cells that are broadcast.
HOT, MAX_HOT = 1_000_000, 1_000_000


def _width(level: Column) -> Column:
    widths = F.array(*[F.lit(FINEST_US * STEP ** k) for k in range(LEVELS)])
    return F.element_at(widths, level + 1)


def _level(length: Column) -> Column:
    """The finest level whose bins are as wide as the interval is long."""
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(length <= FINEST_US * STEP ** k, F.lit(k)).otherwise(level)
    return level


def _bin(us: Column, level: Column) -> Column:
    width = _width(level)
    return F.floor((us - F.pmod(us, width)) / width).cast("bigint")


def _keyed(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """Columns renamed apart, and ``_k``, never null."""
    renamed = df.select([F.col(c).alias(f"{side}{i}") for i, c in enumerate(df.columns)])
    at = [F.col(f"{side}{df.columns.index(c)}").alias(f"k{n}") for n, c in enumerate(keys)]
    return renamed.withColumn("_k", F.struct(*at, F.lit(0).alias("none")))


def _times(df: DataFrame, side: str, columns: list[str], names: dict[str, str]) -> DataFrame:
    """Times as microseconds; ``names``: new column by old one."""
    return df.withColumns({n: epoch_us(f"{side}{columns.index(c)}") for n, c in names.items()})


def _levels(df: DataFrame) -> list[int]:
    # at most LEVELS rows
    return sorted(r[0] for r in df.select("_level").distinct().collect())


def _sliced(left: DataFrame, right: DataFrame, hot: int | None) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_s``, the slice in a hot cell (0 elsewhere)."""
    cell = ["_k", "_level", "_bin"]
    none = left.withColumn("_s", F.lit(0)), right.withColumn("_s", F.lit(0))
    if hot is None:
        return none
    crowded = materialize(left.groupBy(*cell).agg(F.count("*").alias("_n")).where(F.col("_n") > hot))
    if crowded.isEmpty():
        return none
    slices = bounded_broadcast(crowded.withColumn("_slices", F.ceil(F.col("_n") / hot).cast("int")).drop("_n"),
                               MAX_HOT, 64 << 20)
    own = F.xxhash64(*[c for c in left.columns if not c.startswith("_")])
    dealt = left.join(slices, cell, "left").withColumn(
        "_s", F.pmod(own, F.coalesce("_slices", F.lit(1))).cast("int")).drop("_slices")
    given = right.join(slices, cell, "left").withColumn(
        "_s", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))).drop("_slices")
    return dealt, given


def _named(df: DataFrame, left: DataFrame, right: DataFrame, drop: Sequence[str]) -> DataFrame:
    """Own names again; ``drop``: columns of the right side that equal the
    left's keys.  Other clashing names of the right side get ``right_``."""
    out = [F.col(f"l{i}").alias(c) for i, c in enumerate(left.columns)]
    out += [F.col(f"r{i}").alias(f"right_{c}" if c in left.columns else c)
            for i, c in enumerate(right.columns) if c not in drop]
    return df.select(out)


def interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
                  start: str = "start", end: str = "end", how: str = "inner", hot: int | None = HOT) -> DataFrame:
    """``points`` with each interval that holds them: same ``keys`` (none: any)
    and ``start <= ts < end``.  ``how``: inner, or left, which keeps points
    without an interval."""
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    left = _times(_keyed(points, keys, "l"), "l", points.columns, {"_t": ts})
    if how == "left":    # a number for each point, so that the others can be told
        left = written(left.withColumn("_p", F.monotonically_increasing_id()), "points")
    right = _times(_keyed(intervals, keys, "r"), "r", intervals.columns, {"_a": start, "_z": end}).where("_a < _z")
    right = right.withColumn("_level", _level(F.col("_z") - F.col("_a")))
    levels = _levels(right)
    last = _bin(F.col("_z") - 1, F.col("_level"))
    right = right.withColumn("_bin", F.explode(F.sequence(_bin(F.col("_a"), F.col("_level")), last)))
    looked = left.where("_t is not null").withColumn(
        "_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).withColumn(
        "_bin", _bin(F.col("_t"), F.col("_level")))
    a, b = _sliced(looked, right, hot)
    found = a.join(b, ["_k", "_level", "_bin", "_s"]).where("_a <= _t and _t < _z")
    drop = [c for c in keys if c in points.columns]
    if how == "inner":
        return _named(found, points, intervals, drop)
    found = written(found, "found")
    rest = left.join(found.select("_p").distinct(), "_p", "left_anti")
    empty = {f"r{i}": F.lit(None).cast(intervals.schema[c].dataType) for i, c in enumerate(intervals.columns)}
    return _named(found, points, intervals, drop).unionByName(
        _named(rest.withColumns(empty), points, intervals, drop))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), start: str = "start", end: str = "end",
                 hot: int | None = HOT) -> DataFrame:
    """Pairs of a left and a right interval of the same ``keys`` that share
    time, with ``overlap_start`` and ``overlap_seconds``; the right interval's
    limits are called right_..."""
    sides = []
    for df, side, a, z in ((left, "l", "_a", "_z"), (right, "r", "_b", "_y")):
        timed = _times(_keyed(df, keys, side), side, df.columns, {a: start, z: end}).where(f"{a} < {z}")
        sides.append(timed.withColumn("_own", _level(F.col(z) - F.col(a))))
    levels = sorted({r for s in sides for r in _levels(s.withColumnRenamed("_own", "_level"))})
    every = F.array(*[F.lit(k) for k in levels]).cast("array<int>")
    placed = []
    for df, a, z, own in ((sides[0], "_a", "_z", "_own"), (sides[1], "_b", "_y", "_other")):
        df = df.withColumnRenamed("_own", own)
        own_level = F.col(own)
        df = df.withColumn("_level", F.explode(F.filter(every, lambda k: k >= own_level)))
        placed.append(df.withColumn("_bin", F.explode(F.sequence(
            _bin(F.col(a), F.col("_level")), _bin(F.col(z) - 1, F.col("_level"))))))
    a, b = _sliced(placed[0], placed[1], hot)
    first, last = F.greatest("_a", "_b"), F.least("_z", "_y")
    found = a.join(b, ["_k", "_level", "_bin", "_s"]).where(
        (F.greatest("_own", "_other") == F.col("_level")) & (first < last) & (F.col("_bin") == _bin(first, F.col("_level"))))
    kept = _named(found, left, right, [c for c in keys if c in left.columns])
    # the overlap from the named columns, which hold both limits
    names = [start, f"right_{start}" if start in left.columns else start]
    ends = [end, f"right_{end}" if end in left.columns else end]
    begin, until = F.greatest(*names), F.least(*ends)
    return kept.withColumns({"overlap_start": begin, "_u": until}).withColumn(
        "overlap_seconds", (epoch_us("_u") - epoch_us("overlap_start")) / 1e6).drop("_u")
