"""Slowly changing dimensions: validity ranges from successive snapshots.

A history has a row for each state that a key has had, with the half-open range
``[valid_from, valid_to)`` in which it held; ``valid_to`` is null for what holds
now.  A snapshot is merged with one full outer join on the key against the rows
that hold now; closed rows are never read by the join.  States are compared by
``state_hash``, a SHA-256 of the tracked columns, so the join moves no wide
columns of the old side twice and null and missing are told apart.

A key that leaves a snapshot ends, and one that comes back begins anew.
Snapshot rows without a key are ignored; of several rows of a key the one with
the greatest hash counts, whatever the order of the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.functions import ts_lit
from propensa.operators.intervals import interval_join
from propensa.session import written

FOREVER = dt.datetime(9999, 1, 1)


def _states(snapshot: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    state = F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"})
    rows = snapshot.where(F.col(key).isNotNull()).select(key, *tracked, F.sha2(state, 256).alias("state_hash"))
    best = rows.groupBy(key).agg(F.max(F.struct("state_hash", *tracked)).alias("s"))     # combined before the shuffle
    return best.select(key, *[F.col(f"s.{c}").alias(c) for c in tracked], "s.state_hash")


def first_history(snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: dt.datetime) -> DataFrame:
    """The history after one snapshot."""
    return _states(snapshot, key, tracked).withColumns({
        "valid_from": ts_lit(as_of), "valid_to": F.lit(None).cast("timestamp_ntz")})


def apply_snapshot(history: DataFrame, snapshot: DataFrame, key: str, as_of: dt.datetime) -> DataFrame:
    """``history`` after a further snapshot, taken at ``as_of``.

    Applying the latest snapshot once more changes nothing; one older than
    what the history has seen is an error.
    """
    tracked = [c for c in history.columns if c not in (key, "state_hash", "valid_from", "valid_to")]
    last = history.agg(F.max(F.greatest("valid_from", F.coalesce("valid_to", "valid_from")))).first()[0]
    if last is not None and last > as_of:
        raise ValueError(f"history has changes of {last}, after {as_of}")
    now = ts_lit(as_of)
    open_rows = history.where("valid_to is null")
    own = [key, *tracked, "state_hash", "valid_from"]
    old = open_rows.select([F.col(c).alias(f"old_{c}") for c in own])
    new = _states(snapshot, key, tracked)
    both = old.join(new, F.col(f"old_{key}") == F.col(key), "full_outer")
    same = F.col("old_state_hash").eqNullSafe(F.col("state_hash"))
    names = [*own, "valid_to"]

    def row(prefix: str, start, end):
        return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in own[:-1]], start.alias("valid_from"),
                        end.cast("timestamp_ntz").alias("valid_to"))

    kept = row("old_", F.col("old_valid_from"), F.when(same, F.lit(None)).otherwise(now))
    begun = row("", now, F.lit(None))
    rows = F.array(F.when(F.col(f"old_{key}").isNotNull(), kept), F.when(F.col(key).isNotNull() & ~same, begun))
    merged = both.select(F.explode(F.array_compact(rows)).alias("r")).select([f"r.{c}" for c in names])
    return history.where("valid_to is not null").select(names).unionByName(merged)


def replay(snapshots: Sequence[tuple[dt.datetime, DataFrame]], key: str, tracked: Sequence[str]) -> DataFrame:
    """The history of snapshots in order; each step is written, so the next
    reads a table."""
    (at, first), *rest = snapshots
    history = written(first_history(first, key, tracked, at), "history")
    for at, snapshot in rest:
        history = written(apply_snapshot(history, snapshot, key, at), "history")
    return history


def state_at(points: DataFrame, history: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """``points`` with the tracked columns that held at their time (null where
    the key had no state)."""
    valid = history.withColumn("valid_to", F.coalesce("valid_to", ts_lit(FOREVER))).drop("state_hash")
    return interval_join(points, valid, [key], ts, "valid_from", "valid_to", "left").drop("valid_from", "valid_to")
