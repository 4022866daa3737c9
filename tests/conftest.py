import pytest

from corundum.session import local_session

TESTDATA = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def views(directory):
    import glob
    import os

    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{directory}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def comparison(spark, directory):
    """Compares a query with its SQL over a directory: column names, and rows in any order."""
    import numbers

    import pandas as pd

    duck = views(directory)

    def rows(df):
        df = df[sorted(df.columns)].astype(object)
        clean = lambda v: None if not hasattr(v, "__len__") and pd.isna(v) else repr(round(float(v), 9)) if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)
        return sorted([tuple(clean(v) for v in r) for r in df.itertuples(index=False)], key=repr)

    def compare(query, sql):
        a, b = query(spark, directory).toPandas(), duck.sql(sql).df()
        assert sorted(a.columns) == sorted(b.columns)
        assert rows(a) == rows(b)

    return compare


@pytest.fixture(scope="session")
def same(spark):
    return comparison(spark, TESTDATA)


@pytest.fixture(scope="session")
def same_larger(spark):
    return comparison(spark, LARGER)
