"""Every registered catalog query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from catalink.plans import registry

TABLES = os.environ.get("CATALINK_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")


def rows_of(frame):
    columns = sorted(frame.columns)
    frame = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted(tuple(repr(int(x)) if isinstance(x, float) and x == int(x) else repr(x) for x in r) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{TABLES}/orders.parquet'")
    assert rows_of(registry.queries()[name](spark, TABLES).toPandas()) == rows_of(con.execute(registry.oracle_sql()[name]).df())
