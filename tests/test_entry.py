import os

import duckdb
import pytest

import __spark_entry__ as entry
from propensa.sources import TABLES

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="fixtures not present")


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert entry.entry(spark).schema == df.schema


def test_every_query_has_columns_matching_its_oracle(spark):
    from tools.oracle_check import compare, type_issues
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    sql = entry.oracle_sql()
    failures = {}
    for name, fn in entry.queries().items():
        sdf = fn(spark, SMOKE)
        a = sdf.toPandas()
        if name in sql:
            rel = con.sql(sql[name])
            issues = type_issues({f.name: f.dataType.simpleString() for f in sdf.schema.fields},
                                 dict(zip(rel.columns, [str(t) for t in rel.types])))
            issues += compare(a, rel.df())
            if issues:
                failures[name] = issues
    assert not failures, failures
