import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("SPARK_DRIVER_MEMORY", "4g")

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quillspan.session import local_session

    session = local_session(4, 4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    import glob

    import duckdb

    db = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return db


def shown(value):
    """A value so that Spark's and DuckDB's rows compare."""
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return f"{value:.6g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(shown, value)) + "]"
    return str(value)


@pytest.fixture(scope="session")
def same_rows(spark, duck, data):
    def check(query, sql):
        frame = query(spark, data)
        names = sorted(frame.columns)
        mine = sorted("|".join(shown(r[n]) for n in names) for r in frame.collect())
        other = duck.sql(sql)
        assert sorted(other.columns) == names
        at = [other.columns.index(n) for n in names]
        theirs = sorted("|".join(shown(r[i]) for i in at) for r in other.fetchall())
        assert mine == theirs

    return check
