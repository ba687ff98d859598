"""Every registered query equals its DuckDB oracle on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import VIEWS, digest

#: The training-data subpackage, where it is installed, brings its own tests.
OTHERS = set(E._training_data()[0])
KEYS = sorted(set(E.queries()) - OTHERS)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for v in VIEWS:
        c.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF_SMALL}/{v}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) - OTHERS == set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    orows = cur.fetchall()
    ocols = [x[0] for x in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    assert E.entry(spark).count() > 0
