"""The queries whose result SQL can express, against their DuckDB SQL."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from tests.conftest import SF001
from touchline.llm import queries
from touchline.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF001}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    out = queries.registry()[name](spark, SF001)
    assert sorted(out.columns) == sorted(columns)
    assert Counter(tuple(r) for r in out.select(columns).collect()) == Counter(want.fetchall())
