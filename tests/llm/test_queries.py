"""The training-data queries that SQL can express, against their oracles."""

import os

import duckdb
import pytest

import __spark_entry__ as ent
import corpus_pipeline
from lapmart.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_registered():
    names = list(ent.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(queries.ORACLE_SQL[name]).fetchall()
    place = [d[0] for d in con.description]
    assert sorted(place) == cols
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r[place.index(c)] for c in cols) for r in want), key=repr)
