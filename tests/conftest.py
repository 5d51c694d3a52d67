import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clauseforge.session import build_session

    session = build_session("tests", cores=4, partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(DATA):
        pytest.skip("test tables are not there")
    return DATA


@pytest.fixture(scope="session")
def compare(spark, sf):
    """Run a query and its SQL over the smallest tables; both must give the same rows."""
    import duckdb

    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for name in os.listdir(sf):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{name}'")

    def norm(x):
        return round(x, 6) if isinstance(x, float) else x

    def check(query, sql):
        df = query(spark, sf)
        relation = con.sql(sql)
        columns = sorted(df.columns)
        assert columns == sorted(relation.columns)
        order = [list(relation.columns).index(c) for c in columns]
        got = sorted(tuple(str(norm(r[c])) for c in columns) for r in df.collect())
        want = sorted(tuple(str(norm(r[i])) for i in order) for r in relation.fetchall())
        assert got == want

    return check
