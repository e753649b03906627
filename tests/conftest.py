import contextlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vigor.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture
def no_broadcast(spark):
    """A context in which every join of a plan made and run inside it is shuffled."""
    @contextlib.contextmanager
    def off():
        names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
        for n in names:
            spark.conf.set(n, "-1")
        try:
            yield
        finally:
            for n in names:
                spark.conf.unset(n)
    return off


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from vigor.sources.catalog import SUPPLIED_TABLES
    con = duckdb.connect()
    for t in SUPPLIED_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
