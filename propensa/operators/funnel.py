"""How far each key gets through ordered steps within a time limit.

Step 1 starts a chain; step i continues one that has reached step i - 1 by an
earlier row, if no more than the limit has passed since its start.  It is best
to know, for each step, the *latest* start of a chain that has reached it, so a
key's state is one start per step.

Rows are cut by (key, time bucket), hot buckets at quantiles of their times, as
in ``sequence``: no task gets a whole key.  A bucket is summarised as what it
does to any state that may come in: the earliest time at which steps j + 1 to
i can be done inside it, for all j < i, and the latest starts of its own
chains.  A key's summaries, one row a bucket, are then applied in order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.functions import epoch_us
from propensa.operators.sequence import (MAX_BUCKET_ROWS, US_PER_HOUR, _cells, _hot_cells, _with_bucket)

#: Steps that fit the bits of a row's mask.
MOST_STEPS = 30
NEVER, NONE = np.int64(2 ** 62), np.int64(-(2 ** 62))


def summary(time: np.ndarray, mask: np.ndarray, steps: int, limit: int) -> tuple[np.ndarray, np.ndarray, np.int64]:
    """Of rows in order: earliest completion of steps j + 1 to i (``steps + 1``
    squared, NEVER if it cannot be), latest start for each step reached by own
    chains (NONE if none), and the first time an own chain is complete."""
    places = [np.flatnonzero(mask >> i & 1) for i in range(steps)]
    done = np.full((steps + 1, steps + 1), NEVER)
    for j in range(steps):
        at = -1
        for i in range(j, steps):
            k = np.searchsorted(places[i], at, side="right")
            if k == len(places[i]):
                break
            at = places[i][k]
            done[j, i + 1] = time[at]
    latest = np.full(steps + 1, NONE)
    complete = NEVER
    start = time[places[0]]                      # starts of chains that have reached a step
    at = places[0]
    for i in range(steps):
        if len(at):
            latest[i + 1] = start.max()
            if i + 1 == steps:
                complete = time[at].min()
        if i + 1 < steps:
            best = np.maximum.accumulate(start) if len(start) else start
            k = np.searchsorted(at, places[i + 1], side="left") - 1       # chains of earlier rows
            ok = k >= 0
            at, start = places[i + 1][ok], best[k[ok]]
            ok = time[at] - start <= limit
            at, start = at[ok], start[ok]
    return done, latest, complete


def follow(state: np.ndarray, done: np.ndarray, latest: np.ndarray, complete: np.int64,
           limit: int) -> tuple[np.ndarray, np.int64]:
    """The state after a bucket, and the first completion in it."""
    steps = len(state) - 1
    new = np.maximum(state, latest)
    for j in range(1, steps):
        if state[j] > NONE:
            for i in range(j + 1, steps + 1):
                if done[j, i] < NEVER and done[j, i] - state[j] <= limit:
                    new[i] = max(new[i], state[j])
                    if i == steps:
                        complete = min(complete, done[j, i])
    return new, complete


def funnel(df: DataFrame, steps: Sequence[Column], within_seconds: float, key: str = "user_id", ts: str = "ts",
           order: str = "event_id", bucket_hours: int = 24, max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """Per key with a row of any step: ``depth``, the furthest step reached
    (0 to the number of steps), and ``completed_at``, when the last one was
    first reached.

    ``steps`` are conditions; null counts as false, and a row may meet
    several, but continues only chains of earlier rows.  Rows of equal time
    are in the order of ``order`` (nulls first).  Rows without a time are
    ignored; null keys are one key.
    """
    if not 1 <= len(steps) <= MOST_STEPS:
        raise ValueError(f"1 to {MOST_STEPS} steps, not {len(steps)}")
    n, limit = len(steps), round(within_seconds * 1_000_000)
    mask = sum((F.when(s, F.lit(1 << i)).otherwise(F.lit(0)) for i, s in enumerate(steps)), F.lit(0))
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.struct(F.col(key).alias("k")).alias("_k"), epoch_us(ts).alias("_us"), F.col(order).alias("_o"),
                     mask.cast("int").alias("mask")).where("mask > 0 and _us is not null")
    width = bucket_hours * US_PER_HOUR
    hot = _hot_cells(_cells(rows, width, "_us"), max_bucket_rows)
    cut = _with_bucket(rows, "_us", width, hot).select(
        F.col("_k.k").alias("k"), "_b", "_us", F.col("_o").alias("o"), "mask")

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by key, bucket and time, a bucket in one piece."""
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            done, latest, complete = summary(table.column("_us").to_numpy(), table.column("mask").to_numpy(), n, limit)
            return pa.RecordBatch.from_arrays(
                [held[0].column("k").slice(0, 1), held[0].column("_b").slice(0, 1), pa.array([done.tobytes()], pa.binary()),
                 pa.array([latest.tobytes()], pa.binary()), pa.array([int(complete)], pa.int64())],
                ["k", "_b", "done", "latest", "complete"])

        for batch in batches:
            if not batch.num_rows:
                continue
            changed = np.ones(batch.num_rows, bool)
            bucket, keys = batch.column("_b").to_numpy(), batch.column("k")
            code = np.array(keys.dictionary_encode(null_encoding="encode").indices)
            changed[1:] = (bucket[1:] != bucket[:-1]) | (code[1:] != code[:-1])
            if held:
                last = held[-1]
                changed[0] = not (last.column("_b")[-1].as_py() == bucket[0]
                                  and last.column("k")[-1].as_py() == keys[0].as_py())
            else:
                changed[0] = False
            edges = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                if changed[a] and held:
                    yield close()
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield close()

    summed = cut.repartition("k", "_b").sortWithinPartitions("k", "_b", "_us", F.col("o").asc_nulls_first()).drop(
        "o").mapInArrow(summarise, f"k {kind}, _b bigint, done binary, latest binary, complete bigint")

    def walk(table: pa.Table) -> pa.Table:
        """One key's summaries, in order of the buckets."""
        table = table.sort_by("_b")
        state, first = np.full(n + 1, NONE), NEVER
        for done, latest, complete in zip(*(table.column(c).to_pylist() for c in ("done", "latest", "complete"))):
            state, found = follow(state, np.frombuffer(done, np.int64).reshape(n + 1, n + 1),
                                  np.frombuffer(latest, np.int64), np.int64(complete), limit)
            first = min(first, found)
        reached = np.flatnonzero(state > NONE)
        return pa.table({"k": table.column("k").slice(0, 1), "depth": pa.array([int(reached.max(initial=0))], pa.int32()),
                         "at": pa.array([None if first == NEVER else int(first)], pa.int64())})

    done = summed.groupBy("k").applyInArrow(walk, f"k {kind}, depth int, at bigint")
    when = F.timestamp_micros("at")
    if df.schema[ts].dataType.simpleString() == "timestamp_ntz":
        when = F.expr("timestampadd(MICROSECOND, at, timestamp_ntz'1970-01-01 00:00:00')")
    return done.select(F.col("k").alias(key), "depth", when.alias("completed_at"))
