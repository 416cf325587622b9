"""Every query of the catalogue beside its SQL."""

import duckdb
import pytest

from confluo.plans.catalogue import QUERIES
from confluo.plans.oracle import ORACLE_SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    ours, theirs = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    rows = lambda df: sorted(map(repr, df[columns].astype(object).to_numpy().tolist()))
    assert rows(ours) == rows(theirs)
