"""Every registered query of the core against its SQL twin, on the smallest driver tables."""

import glob
import os

import pytest

from siltlake.plans import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


def shown(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else str(v) if v is not None and not isinstance(v, (int, str)) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    got = catalog.QUERIES[name](spark, DATA)
    sql = con.sql(catalog.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(sql.columns)
    expected = sorted((tuple(shown(dict(zip(sql.columns, r))[c]) for c in got.columns) for r in sql.fetchall()), key=repr)
    assert sorted((tuple(map(shown, r)) for r in got.collect()), key=repr) == expected


def test_driver_contract_without_the_training_subpackage(spark):
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries()) and entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
