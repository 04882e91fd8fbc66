"""Registered queries against their SQL."""

import duckdb
import pytest

from starfold.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    result = con.sql(SQL[name])
    own = QUERIES[name](spark, FOLDER)
    assert sorted(own.columns) == sorted(result.columns)
    assert sorted(map(str, (tuple(r) for r in own.select(*result.columns).collect()))) == sorted(map(str, result.fetchall()))
