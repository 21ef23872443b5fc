"""End-to-end: two raw snapshots → bronze → silver → gold, against FIXTURES.md."""

from __future__ import annotations

import datetime as dt

import pytest

from lapmart.plans import bronze, gold, silver
from lapmart.sinks import tables
from raw_fixture import write_all

BRONZE_ROWS = dict(circuits=3, races=4, drivers=4, constructors=4, results=11, pitstops=2,
                   laptimes=3, qualifying=2)
SILVER_ROWS = dict(circuits=2, races=3, drivers=3, constructors=2, results=10, pitstops=1,
                   laptimes=2, qualifying=1)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw = root / "raw"
    write_all(raw)
    paths = dict(raw=str(raw), bronze=str(root / "bronze"), silver=str(root / "silver"),
                 gold=str(root / "gold"))
    bronze.ingest_bronze(spark, paths["raw"], paths["bronze"])
    silver.build_all_silver(spark, paths["bronze"], paths["silver"])
    gold.build_gold(spark, paths["silver"], paths["gold"])
    return paths


def test_bronze_counts(spark, lake):
    for e, n in BRONZE_ROWS.items():
        assert bronze.read_bronze(spark, lake["bronze"], e).count() == n, e


def test_silver_counts(spark, lake):
    for e, n in SILVER_ROWS.items():
        assert silver.read_silver(spark, lake["silver"], e).count() == n, e


def _one(df, **eq):
    for k, v in eq.items():
        df = df.where(df[k] == v)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_silver_spot_checks(spark, lake):
    s = lambda e: silver.read_silver(spark, lake["silver"], e)
    assert _one(s("circuits"), circuit_id=1).altitude == 627
    assert _one(s("races"), race_id=11).race_timestamp.replace(tzinfo=None) == dt.datetime(
        2020, 4, 5, 5, 10)
    assert _one(s("drivers"), driver_id=101).number == 77
    assert _one(s("results"), result_id=1002).points == 1.0
    assert _one(s("pitstops"), stop=1).milliseconds == 22600
    assert _one(s("laptimes"), lap=2).milliseconds == 96500
    assert _one(s("qualifying"), qualify_id=1).q3 == "1:28.0"


def test_bronze_parsing_edge_values(spark, lake):
    b = lambda e: bronze.read_bronze(spark, lake["bronze"], e)
    c1 = b("circuits").where("circuit_id = 1 AND file_date = '2021-03-21'").collect()[0]
    assert c1.altitude is None                     # \N in a CSV int column
    r11 = b("races").where("race_id = 11 AND file_date = '2021-03-21'").collect()[0]
    assert r11.race_timestamp is None              # time \N → NULL timestamp, row kept
    d101 = b("drivers").where("driver_id = 101 AND file_date = '2021-03-21'").collect()[0]
    assert d101.number is None and d101.code == "\\N"   # quoted \N in int → NULL, in str stays
    assert d101.name == "Bo Sud"
    q = b("qualifying").where("file_date = '2021-03-21'").collect()[0]
    assert q.q3 == "\\N"


RACE_RESULTS = {
    (2020, "Norland GP", "Ada Nord"): ("Alpha", 1, 25.0),
    (2020, "Norland GP", "Bo Sud"): ("Beta", 2, 18.0),
    (2020, "Norland GP", "Cy West"): ("Beta", 10, 1.0),
    (2020, "Sudland GP", "Ada Nord"): ("Alpha", 2, 18.0),
    (2020, "Sudland GP", "Bo Sud"): ("Beta", 1, 25.0),
    (2020, "Sudland GP", "Cy West"): ("Beta", 3, 15.0),
    (2021, "Sudland GP", "Ada Nord"): ("Beta", 1, 25.0),
    (2021, "Sudland GP", "Cy West"): ("Alpha", 2, 25.0),
}


def test_gold_race_results(spark, lake):
    rows = gold.read_gold(spark, lake["gold"], "race_results").collect()
    got = {(r.race_year, r.race_name, r.driver_name): (r.team, r.race_position, r.points)
           for r in rows}
    assert got == RACE_RESULTS
    assert len(rows) == 8


def test_gold_driver_standings(spark, lake):
    rows = gold.read_gold(spark, lake["gold"], "driver_standings").collect()
    got = {(r.race_year, r.driver_name): (r.driver_nationality, r.total_points,
                                          r.number_of_wins, r.rank) for r in rows}
    assert got == {
        (2020, "Ada Nord"): ("Norlander", 43.0, 1, 1),
        (2020, "Bo Sud"): ("Sudlander", 43.0, 1, 1),
        (2020, "Cy West"): ("Westlander", 16.0, 0, 3),
        (2021, "Ada Nord"): ("Norlander", 25.0, 1, 1),
        (2021, "Cy West"): ("Westlander", 25.0, 0, 1),
    }


def test_gold_constructor_standings(spark, lake):
    rows = gold.read_gold(spark, lake["gold"], "constructor_standings").collect()
    got = {(r.race_year, r.team): (r.total_points, r.number_of_wins, r.rank) for r in rows}
    assert got == {
        (2020, "Beta"): (59.0, 1, 1),
        (2020, "Alpha"): (43.0, 1, 2),
        (2021, "Beta"): (25.0, 1, 1),
        (2021, "Alpha"): (25.0, 0, 1),
    }


def test_rerun_changes_nothing_but_audit(spark, lake, tmp_path):
    before = {e: silver.read_silver(spark, lake["silver"], e).drop("ingestion_date",
                                                                    "processed_at")
              for e in SILVER_ROWS}
    snap = {e: sorted(map(tuple, df.collect()), key=repr) for e, df in before.items()}
    bronze.ingest_bronze(spark, lake["raw"], lake["bronze"])      # same folders again
    silver.build_all_silver(spark, lake["bronze"], lake["silver"])
    for e in SILVER_ROWS:
        after = silver.read_silver(spark, lake["silver"], e).drop("ingestion_date",
                                                                 "processed_at")
        assert sorted(map(tuple, after.collect()), key=repr) == snap[e], e
    assert tables.current_version(spark, lake["silver"] + "/races").endswith("_v000002")
