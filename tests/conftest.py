import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkforge.plans.session import local_session, ship  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return c


def rows(columns, values):
    clean = lambda v: round(v, 6) if isinstance(v, float) else v
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(clean(r[i]) for i in order) for r in values), key=repr)


@pytest.fixture(scope="session")
def same(spark, duck, sf_dir):
    """Asserts that a query and its SQL give the same rows."""

    def check(query, sql):
        df = query(spark, sf_dir)
        got = rows(df.columns, [tuple(r) for r in df.collect()])
        cur = duck.execute(sql)
        want = rows([d[0] for d in cur.description], cur.fetchall())
        assert got == want

    return check
