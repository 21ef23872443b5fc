"""The driver contract: entry() on sf0.001 and every query against its oracle."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as ent
from lapmart.plans import contract

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert set(df.columns) >= {"race_year", "driver_name", "total_points", "rank"}
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(contract.ORACLE_SQL) == set(contract.QUERIES)
    assert set(ent.queries()) >= set(contract.QUERIES) and set(ent.oracle_sql()) >= set(contract.ORACLE_SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = ent.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    odf = duck.execute(ent.oracle_sql()[name]).fetchall()
    ocols = [d[0] for d in duck.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in odf), key=repr)
    assert got == exp


BAD_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query_plan_has_no_cross_join_or_python(spark, name):
    df = ent.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in BAD_NODES:
        assert bad not in plan, (name, bad)


def test_team_trend_follows_the_standings(spark):
    """RPT-01 for teams: every season of the constructor standings, with the season before."""
    trend = ent.queries()["season_trend_team"](spark, SF).collect()
    standings = ent.queries()["constructor_standings"](spark, SF).collect()
    points = {(r.team, r.race_year): r.total_points for r in standings}
    assert {(r.team, r.race_year): r.total_points for r in trend} == points and len(trend) == len(points)
    for r in trend:
        before = max((y for t, y in points if t == r.team and y < r.race_year), default=None)
        assert r.prev_points == (points[r.team, before] if before is not None else None)
