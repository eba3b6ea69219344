import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kinograph import session

    folder = tmp_path_factory.mktemp("spark")
    made = session.build(
        "tests",
        spark__master="local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__local__dir=str(folder / "local"),
        spark__checkpoint__dir=str(folder / "shared"),
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def duck():
    import glob

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples of the named columns (all, in order, by default)."""

    def get(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)

    return get
