import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sojourn.session import local_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


@pytest.fixture(scope="session")
def feeds(spark):
    """Both raw feeds of the smallest tables, stored once."""
    from sojourn.sources.feeds import end_feed, start_feed
    from sojourn.sources.scratch import materialize

    return (
        materialize(start_feed(spark, TABLES), "test-starts"),
        materialize(end_feed(spark, TABLES), "test-ends"),
    )
