import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from propensa.session import build_session  # noqa: E402

EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, "
                "event_type string, value double, props string")


@pytest.fixture(scope="session")
def spark():
    s = build_session(app="propensa-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def make_events(spark):
    """Rows (event_id, ts, user_id, event_type, value[, props]) -> events frame."""
    def _make(rows, partitions: int | None = None):
        full = [tuple(r) + ((None,) if len(r) == 5 else ()) for r in rows]
        full = [(r[0], T(r[1]) if isinstance(r[1], str) else r[1], *r[2:]) for r in full]
        df = spark.createDataFrame(full, EVENT_SCHEMA)
        return df.repartition(partitions) if partitions else df
    return _make
