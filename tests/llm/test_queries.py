import os

import duckdb
import pytest

from tierflow.llm.oracle import SQL
from tierflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    rows = sorted(want.fetchall(), key=repr)
    got = QUERIES[name](spark, SF).select(*names)
    assert sorted(map(tuple, got.collect()), key=repr) == rows and rows
