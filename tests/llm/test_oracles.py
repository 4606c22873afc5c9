"""The SQL of the training-data queries against their results."""

import duckdb
import pytest

from spotweave.llm.oracles import ORACLES
from spotweave.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "clicks", "embeddings"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got, want = QUERIES[name](spark, sf), con.sql(ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    place = [want.columns.index(c) for c in cols]
    assert sorted(repr(tuple(r[c] for c in cols)) for r in got.collect()) == sorted(repr(tuple(r[i] for i in place)) for r in want.fetchall())
