import os

import pytest

import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="fixtures not present")

NAMES = ["training_table", "p08_rolling", "p12_sessionize", "p20_report_cube",
         "p23_hourly_counts_stream", "p24_stream_sessions", "p25_stream_late", "funnel", "interval_join_state",
         "scd_state_at", "clustered_read", "incremental_training_table"]


def test_results_do_not_depend_on_session_time_zone(spark):
    q = entry.queries()
    utc = {n: sorted(map(tuple, q[n](spark, SMOKE).collect()), key=repr) for n in NAMES}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        other = {n: sorted(map(tuple, q[n](spark, SMOKE).collect()), key=repr) for n in NAMES}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for n in NAMES:
        assert utc[n] == other[n], n
