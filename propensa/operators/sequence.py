"""Ordered per-key operators: rolling frames, as-of lookups, sessions.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; a
key holding a third of the data would stall the whole job.  These operators
partition by ``(key, time bucket)`` instead, so a hot key is spread over as
many tasks as its history has buckets.  What a bucket needs from earlier
buckets arrives as a *carry*: a per-(key, bucket) summary (a few values per
bucket), scanned per key with a window and joined back.  The summary has one
row per non-empty bucket, so even a hot key's summary is small (history
length / bucket width), and the bucket width can be as fine as the skew
demands: no row is ever copied.

A bucket can be hot too (a burst: one key, one day, a third of the data).
Before bucketing, rows are counted per (key, bucket) as a partial aggregate;
cells above ``max_bucket_rows`` (at most rows / ``max_bucket_rows`` of them;
broadcast only after a check of rows and bytes) are cut at quantiles of their
times.  Slices stay contiguous in time, so the carries work unchanged; where
no cell is hot there is nothing to join.  Rows that share key and time, or
have no time, are not cut.

Where no key has more than ``max_bucket_rows`` rows, as-of lookups and sessions
are plain windows per key: one shuffle of the rows and one scan besides the
count.  The results are the same.

The wide rows are shuffled once on ``(key, bucket)`` and the carry join
reuses that partitioning; summary branches re-read only a narrow projection
and aggregate it map-side.  Keys are handled through ``_k = struct(key)``,
which is never null and compares null keys as equal, so null keys form one
group (as in ``PARTITION BY``) without null-safe join conditions, which
would force the wide side to be shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensa import defaults
from propensa.functions import epoch_us, exact_sum, units, unscaled
from propensa.operators.joins import bounded_broadcast
from propensa.session import materialize

US_PER_MINUTE = 60_000_000
US_PER_HOUR = 60 * US_PER_MINUTE
US_PER_DAY = 24 * US_PER_HOUR
NULL_BUCKET = -(2 ** 63)   # rows without a time: one bucket, ordered first
QUANTILES = 1024           # slices per hot cell, at most
MAX_HOT = 1_000_000        # hot cells that are broadcast, at most
MAX_BUCKET_ROWS = 5_000_000


def _floor_div(us: Column, width_us: int) -> Column:
    """Exact floor division of a bigint (no detour through double)."""
    w = F.lit(width_us)
    return ((us - F.pmod(us, w)) / w).cast("bigint")


def _keyed(df: DataFrame, key: str, ts: str, *cols) -> DataFrame:
    """``cols`` plus ``_k`` (non-null key surrogate) and ``_us``."""
    return df.select(*cols, F.struct(F.col(key).alias("k")).alias("_k"),
                     epoch_us(ts).alias("_us"))


def _hot_cells(cells: DataFrame, max_rows: int | None) -> DataFrame | None:
    """``(_k, _cell, _bounds)`` for cells with more than ``max_rows`` rows;
    None if there are none.

    ``cells`` has one row per row to place: ``_k``, ``_cell`` and its time
    ``_t``.  Rows are counted per cell (a partial aggregate) and the hot ones,
    at most rows / ``max_rows``, are written.  Only for these are quantiles of
    the time taken: the cell is cut at ``_bounds`` into slices of about
    ``max_rows`` rows each (a 1/``QUANTILES`` of the cell at least), so a
    burst inside the cell is spread, too.  Rows of one time stay together.
    """
    if max_rows is None:
        return None
    hot = materialize(cells.groupBy("_k", "_cell").agg(F.count("_t").alias("_n"))
                           .filter(F.col("_n") > F.lit(max_rows)))
    if hot.isEmpty():
        return None
    shares = [i / QUANTILES for i in range(1, QUANTILES)]
    split = F.least(F.ceil(F.col("_n") / F.lit(max_rows)), F.lit(QUANTILES)).cast("int")
    cut = (cells.join(bounded_broadcast(hot, MAX_HOT), ["_k", "_cell"])
                .groupBy("_k", "_cell", "_n").agg(F.percentile_approx("_t", shares, 10_000).alias("_q"))
                .withColumn("_split", split)
                .select("_k", "_cell", F.expr(
                    "array_distinct(transform(sequence(1, _split - 1), "
                    f"i -> _q[cast(floor(i * {QUANTILES} / _split) as int) - 1]))").alias("_bounds")))
    return bounded_broadcast(materialize(cut), MAX_HOT, 64 << 20)


def _all_small(rows: DataFrame, max_rows: int | None) -> bool:
    """Whether every key has at most ``max_rows`` rows (a partial aggregate
    of the keys alone).  A plain window per key is then no larger than a
    bucket may be, and needs neither buckets nor carries."""
    if max_rows is None:
        return False
    return rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > F.lit(max_rows)).limit(1).isEmpty()


def _cells(df: DataFrame, width_us: int, *times: str) -> DataFrame:
    """One ``(_k, _cell, _t)`` row per time column per row of ``df``."""
    pts = [F.struct(_cell(F.col(t), width_us).alias("_cell"), F.col(t).alias("_t"))
           for t in times]
    return df.select("_k", F.explode(F.array(*pts)).alias("_p")).select("_k", "_p.*")


def _cell(us: Column, width_us: int) -> Column:
    return _floor_div(us, width_us)


def _with_bucket(df: DataFrame, us: str, width_us: int, hot: DataFrame | None,
                 out: str = "_b") -> DataFrame:
    """Add bucket ``out`` for time ``us``: ``cell * QUANTILES + sub``, where
    ``sub`` is the slice of a hot cell and 0 in any other.  Rows without a
    time share ``NULL_BUCKET``."""
    d = df.withColumn("_cell", _cell(F.col(us), width_us))
    sub = F.lit(0).cast("bigint")
    if hot is not None:
        d = d.join(hot, ["_k", "_cell"], "left")
        at = F.col(us)
        sub = F.coalesce(F.size(F.filter("_bounds", lambda b: b <= at)), F.lit(0)).cast("bigint")
    b = F.when(F.col(us).isNull(), F.lit(NULL_BUCKET)).otherwise(
        F.col("_cell") * F.lit(QUANTILES) + sub)
    return d.withColumn(out, b).drop("_cell", "_bounds")


def _per_key(order: str = "_b") -> Window:
    """Earlier buckets of the same key."""
    return Window.partitionBy("_k").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _with_carry(df: DataFrame, carry: DataFrame) -> DataFrame:
    return df.join(carry, ["_k", "_b"], "left")


def rolling(df: DataFrame, key: str = "user_id", ts: str = "ts",
            value: str = "value", days: int = defaults.ROLLING_DAYS,
            bucket_hours: int = 24, keep: list[str] | None = None,
            max_bucket_rows: int | None = MAX_BUCKET_ROWS,
            scale: int | None = None) -> DataFrame:
    """Per row, count and sum of ``value`` over ``[ts - days, ts]`` of its key.

    The frame is a RANGE frame (rows with the same ``ts`` are peers and all
    count; rows without a time are peers of each other).  NaN and infinite
    values count as null in the sum, which is 0 if the frame has no value.
    It is computed as a difference of cumulative sums,
    ``S(<= ts) - S(< ts - days)``, so the bucket width is free of the frame
    length: a hot key can be cut into buckets as fine as ``bucket_hours``
    with no row copied.  Both cumulative sums are a bucket-local window plus
    a carry of earlier buckets' totals.  Two passes: the first finds
    ``S(<= ts)`` in the row's bucket, the second ``S(< ts - days)`` in the
    bucket of ``ts - days``, with each output row travelling once.
    """
    keep = keep if keep is not None else [c for c in ("event_id",) if c in df.columns]
    span = days * US_PER_DAY
    width = bucket_hours * US_PER_HOUR
    c = units(value, scale)
    if scale is None:
        c = F.when(F.abs(c) < F.lit(float("inf")), c)     # neither NaN nor infinite
    base = _keyed(df, key, ts, *keep, key, ts, c.alias("_c"))
    c_type = base.schema["_c"].dataType
    base = base.withColumn("_lus", F.col("_us") - F.lit(span))    # lookup time
    # a cell is hot if rows and lookups landing in it are many
    hot = _hot_cells(_cells(base, width, "_us", "_lus"), max_bucket_rows)
    base = _with_bucket(_with_bucket(base, "_us", width, hot), "_lus", width, hot, out="_lb")

    # totals of earlier buckets, for every bucket a row or a lookup falls in
    marks = (base.select("_k", F.explode(F.array(
                 F.struct(F.col("_b").alias("_b"), F.lit(1).alias("_n"), F.col("_c").alias("_c")),
                 F.struct(F.col("_lb").alias("_b"), F.lit(0).alias("_n"),
                          F.lit(None).cast(c_type).alias("_c")))).alias("_m"))
                 .select("_k", "_m.*"))
    wc = _per_key()
    carry = (marks.groupBy("_k", "_b").agg(F.sum("_n").alias("_tn"), F.sum("_c").alias("_tc"))
                  .select("_k", "_b",
                          F.coalesce(F.sum("_tn").over(wc), F.lit(0)).alias("_cn"),
                          F.coalesce(F.sum("_tc").over(wc), F.lit(0)).alias("_cc")))

    # pass 1: S(<= ts), peers included
    w_le = (Window.partitionBy("_k", "_b").orderBy("_us")
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    le = (_with_carry(base.withColumn("_ln", F.count(F.lit(1)).over(w_le))
                          .withColumn("_lc", F.coalesce(F.sum("_c").over(w_le), F.lit(0))),
                      carry)
          .select(*keep, key, ts, "_k",
                  (F.col("_cn") + F.col("_ln")).alias("_sn"),
                  (F.col("_cc") + F.col("_lc")).alias("_sc"),
                  F.col("_lus").alias("_us"), F.col("_lb").alias("_b")))

    # pass 2: S(< ts - days), looked up among the key's rows
    probes = (le.withColumn("_side", F.lit(0)).withColumn("_c", F.lit(None).cast(c_type)))
    rows = base.select("_k", "_us", "_b", "_c", F.lit(1).alias("_side"))
    u = probes.unionByName(rows, allowMissingColumns=True)
    w_lt = (Window.partitionBy("_k", "_b").orderBy("_us")
            .rangeBetween(Window.unboundedPreceding, -1))
    lt = _with_carry(u.withColumn("_ln", F.coalesce(F.sum("_side").over(w_lt), F.lit(0)))
                      .withColumn("_lc", F.coalesce(F.sum("_c").over(w_lt), F.lit(0)))
                      .filter(F.col("_side") == 0),
                     carry)
    # nothing lies before the frame of a row without a time
    timed = F.col(ts).isNotNull()
    n = F.col("_sn") - F.when(timed, F.col("_cn") + F.col("_ln")).otherwise(0)
    total = F.col("_sc") - F.when(timed, F.col("_cc") + F.col("_lc")).otherwise(0)
    return lt.select(*keep, key, ts, n.cast("bigint").alias(f"n_{days}d"),
                     unscaled(total, scale).alias(f"sum_{days}d"))


def asof_last(left: DataFrame, right: DataFrame, key: str = "user_id",
              ts: str = "ts", right_cols: list[str] | None = None,
              right_order: str | None = None, prefix: str = "prev_",
              bucket_hours: int = 24,
              max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """For every left row, the latest right row of the same key with
    ``right.ts < left.ts`` (strict).  Left rows without one keep nulls.

    ``right_order`` breaks ties between right rows with equal ``ts`` (the
    larger one wins), then the right columns in order; without it they alone
    do.  The result has the left columns plus
    ``prefix + ts`` and ``prefix + c`` for each right column.  Right rows
    with a null key or time can never match and are left out.
    """
    right_cols = right_cols if right_cols is not None else [
        c for c in right.columns if c not in (key, ts)]
    width = bucket_hours * US_PER_HOUR
    payload = F.struct(F.col(ts).alias("ts"), *[F.col(c).alias(c) for c in right_cols])
    payload_type = right.select(payload).schema[0].dataType
    tie = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(
        ([right_order] if right_order else []) + list(right_cols))] or [F.lit(0).alias("t0")])
    tie_type = right.select(tie).schema[0].dataType

    lside = _keyed(left, key, ts, *left.columns,
                   F.lit(0).alias("_side"), F.lit(None).cast(payload_type).alias("_p"),
                   F.lit(None).cast(tie_type).alias("_tie"))
    right = right.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    rside = _keyed(right, key, ts,
                   *[(F.col(c) if c in (key, ts) else F.lit(None).cast(left.schema[c].dataType))
                     .alias(c) for c in left.columns],
                   F.lit(1).alias("_side"), payload.alias("_p"), tie.alias("_tie"))
    u = lside.unionByName(rside)
    found = [*[F.col(c) for c in left.columns], *[F.col(f"_m.{f}").alias(prefix + f) for f in ["ts"] + right_cols]]
    if _all_small(u, max_bucket_rows):
        w = (Window.partitionBy("_k").orderBy("_us", "_side", "_tie").rowsBetween(Window.unboundedPreceding, -1))
        return u.withColumn("_m", F.last("_p", ignorenulls=True).over(w)).filter(F.col("_side") == 0).select(found)
    hot = _hot_cells(_cells(u, width, "_us"), max_bucket_rows)
    u = _with_bucket(u, "_us", width, hot)

    # latest right row strictly earlier in the same bucket; left rows sort
    # first among equal timestamps so an equal-time right row is not "earlier"
    w = (Window.partitionBy("_k", "_b").orderBy("_us", "_side", "_tie")
         .rowsBetween(Window.unboundedPreceding, -1))
    local = u.withColumn("_local", F.last("_p", ignorenulls=True).over(w))

    # per bucket: its last right row (a partial aggregate of the unsorted
    # rows); carried forward to later buckets
    summary = (u.groupBy("_k", "_b")
                    .agg(F.max_by("_p", F.when(F.col("_side") == 1,
                                               F.struct("_us", "_tie"))).alias("_last")))
    carry = summary.select("_k", "_b",
                           F.last("_last", ignorenulls=True).over(_per_key()).alias("_carry"))

    res = (_with_carry(local.filter(F.col("_side") == 0), carry)
           .withColumn("_m", F.coalesce("_local", "_carry")))
    return res.select(found)


def sessionize(df: DataFrame, key: str = "user_id", ts: str = "ts",
               order: str = "event_id",
               gap_minutes: int = defaults.SESSION_GAP_MINUTES,
               bucket_hours: int = 24, keep: list[str] | None = None,
               max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """Session number per row: a new session starts when the time since the
    key's previous row exceeds ``gap_minutes`` (a gap of exactly
    ``gap_minutes`` stays in the session).  Sessions are numbered from 1 per
    key in time order; ``order`` breaks ties in ``ts``.

    Within a bucket ``lag`` finds the previous row; for a bucket's first row
    the carry supplies the last time of earlier buckets and the number of
    sessions they started.  A key's rows without a time form one session
    before all others.
    """
    keep = keep if keep is not None else [c for c in df.columns if c not in (key, ts)]
    gap = gap_minutes * US_PER_MINUTE
    width = bucket_hours * US_PER_HOUR
    base = _keyed(df, key, ts, *keep, key, ts)
    if _all_small(base, max_bucket_rows):
        w = Window.partitionBy("_k").orderBy("_us", order)
        before = F.lag("_us").over(w)
        # the first row with a time starts a session, and so does a key's first row
        starts = F.when((F.row_number().over(w) == 1) | F.col("_us").isNotNull() & (
            before.isNull() | (F.col("_us") - before > gap)), 1).otherwise(0)
        return base.withColumn("_start", starts).select(
            *keep, key, ts, F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint").alias("session_idx"),
            F.col("_start").cast("int").alias("is_start"))
    hot = _hot_cells(_cells(base, width, "_us"), max_bucket_rows)
    base = _with_bucket(base, "_us", width, hot)
    w = Window.partitionBy("_k", "_b").orderBy("_us", order)
    local = (base
             .withColumn("_prev", F.lag("_us").over(w))
             .withColumn("_rn", F.row_number().over(w))
             .withColumn("_ls", F.when(F.col("_us") - F.col("_prev") > gap, 1).otherwise(0))
             .withColumn("_rl", F.sum("_ls").over(w.rowsBetween(Window.unboundedPreceding, 0))))

    summary = local.groupBy("_k", "_b").agg(F.min("_us").alias("_first"),
                                            F.max("_us").alias("_lastus"),
                                            F.sum("_ls").alias("_nl"))
    wc = _per_key()
    prev_last = F.max("_lastus").over(wc)
    carry = (summary
             .withColumn("_fs", F.when(prev_last.isNull() | (F.col("_first") - prev_last > gap), 1)
                               .otherwise(0))
             .withColumn("_cs", F.coalesce(F.sum(F.col("_fs") + F.col("_nl")).over(wc), F.lit(0)))
             .select("_k", "_b", "_fs", "_cs"))

    res = _with_carry(local, carry)
    return res.select(
        *keep, key, ts,
        (F.col("_cs") + F.col("_fs") + F.col("_rl")).cast("bigint").alias("session_idx"),
        F.when(F.col("_rn") == 1, F.col("_fs")).otherwise(F.col("_ls"))
         .cast("int").alias("is_start"))


def sessions(df: DataFrame, key: str = "user_id", ts: str = "ts",
             order: str = "event_id", value: str | None = "value",
             gap_minutes: int = defaults.SESSION_GAP_MINUTES,
             bucket_hours: int = 24,
             max_bucket_rows: int | None = MAX_BUCKET_ROWS,
             scale: int | None = None) -> DataFrame:
    """One row per session: start, end (last event + gap), events, value.

    A session holding a third of all rows is still one partial aggregate.
    """
    keep = [order] + ([value] if value else [])
    s = sessionize(df, key, ts, order, gap_minutes, bucket_hours, keep=keep,
                   max_bucket_rows=max_bucket_rows)
    aggs = [F.min(ts).alias("session_start"),
            (F.max(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(gap_minutes)))
            .alias("session_end"),
            F.count(F.lit(1)).cast("bigint").alias("n_events")]
    if value:
        aggs.append(exact_sum(units(value, scale), scale).alias("sum_value"))
    return s.groupBy(key, "session_idx").agg(*aggs)
