"""Negative and edge fixtures (FIXTURES.md §4) on small raw snapshots."""

from __future__ import annotations

import json

import os

import pytest
from pyspark.sql import functions as F

from lapmart.plans import bronze, gold, silver
from lapmart.sinks import tables
from lapmart.sources.snapshots import MissingSnapshotFile, read_snapshots
from lapmart.streaming.incremental import ingest_incremental
from raw_fixture import CIRCUITS_HEADER, FILES, RACES_HEADER, SNAP1, SNAP2, write_snapshot


def _lake(tmp_path):
    return {k: str(tmp_path / k) for k in ("raw", "bronze", "silver", "gold")}


def test_null_key_gate_blocks_publish(spark, tmp_path):
    p = _lake(tmp_path)
    write_snapshot(p["raw"], SNAP1, {"races.csv": RACES_HEADER + "\n"
                                     "10,2020,1,,Norland GP,2020-03-15,14:00:00,r10\n"})
    bronze.ingest_bronze(spark, p["raw"], p["bronze"], entities=["races"])
    with pytest.raises(tables.QualityGateError):
        silver.build_silver(spark, p["bronze"], p["silver"], "races")
    assert not tables.table_exists(spark, p["silver"] + "/races")


def test_bad_times_give_null_timestamp(spark, tmp_path):
    p = _lake(tmp_path)
    body = "\n".join(f"{i},2020,{i},1,GP,2020-03-15,{t},u" for i, t in
                     enumerate(["05:00:00Z", "5:06:07", "", "\\N", "14:00:00"]))
    write_snapshot(p["raw"], SNAP1, {"races.csv": RACES_HEADER + "\n" + body + "\n"})
    df = bronze.bronze_frame(spark, p["raw"], "races")
    got = {r.race_id: r.race_timestamp for r in df.collect()}
    assert [got[i] is None for i in range(5)] == [True, True, True, True, False]


def test_missing_surname_and_quoted_number(spark, tmp_path):
    p = _lake(tmp_path)
    d = {"driverId": 5, "driverRef": "n", "name": {"forename": "N"}, "number": "1",
         "nationality": "X"}
    write_snapshot(p["raw"], SNAP1, {"drivers.json": json.dumps(d) + "\n"})
    r = bronze.bronze_frame(spark, p["raw"], "drivers").collect()[0]
    assert r.name is None and r.number is None and r.nationality == "X"


def test_multiline_file_read_as_lines_fails_gate(spark, tmp_path):
    p = _lake(tmp_path)
    text = '[\n {"raceId":1,"driverId":2,"stop":1,\n  "lap":3}\n]\n'
    write_snapshot(p["raw"], SNAP1, {"pit_stops.json": text})
    df = bronze.bronze_frame(spark, p["raw"], "pitstops")
    assert df.where("race_id IS NULL").count() >= 1
    bronze.ingest_bronze(spark, p["raw"], p["bronze"], entities=["pitstops"])
    with pytest.raises(tables.QualityGateError) as err:
        silver.build_silver(spark, p["bronze"], p["silver"], "pitstops")
    # the message reports the raw NULL-key rows, not only the collapsed one
    assert "'violations': 4" in str(err.value) or "violations=4" in str(err.value)
    # with multiline the same file parses
    ok = bronze.bronze_frame(spark, p["raw"], "pitstops", multiline=True).collect()
    assert [(r.race_id, r.stop, r.lap) for r in ok] == [(1, 1, 3)]


def test_missing_entity_file(spark, tmp_path):
    p = _lake(tmp_path)
    write_snapshot(p["raw"], SNAP1, {"circuits.csv": FILES[SNAP1]["circuits.csv"],
                                     "races.csv": FILES[SNAP1]["races.csv"]})
    write_snapshot(p["raw"], SNAP2, {"circuits.csv": FILES[SNAP2]["circuits.csv"]})
    with pytest.raises(MissingSnapshotFile):
        read_snapshots(spark, p["raw"], "races", require_all=True)
    assert read_snapshots(spark, p["raw"], "races").count() == 2


def test_csv_surplus_column_and_positional_binding(spark, tmp_path):
    p = _lake(tmp_path)
    write_snapshot(p["raw"], SNAP1, {"circuits.csv": "a,b,c,d,e,f,g,h,i,extra\n"
                                     "1,r,N,L,C,1.5,2.5,3,u,zzz\n"})
    r = bronze.bronze_frame(spark, p["raw"], "circuits").collect()[0]
    assert (r.circuit_id, r.latitude, r.altitude, r.file_date) == (1, 1.5, 3, SNAP1)


def test_snapshot_folder_with_spaces(spark, tmp_path):
    raw = tmp_path / "raw data"
    write_snapshot(str(raw), "snap 1", {"circuits.csv": FILES[SNAP1]["circuits.csv"]})
    got = {r.file_date for r in bronze.bronze_frame(spark, str(raw), "circuits").collect()}
    assert got == {"snap 1"}


def test_late_old_snapshot_batch(spark, tmp_path):
    p = _lake(tmp_path)
    write_snapshot(p["raw"], SNAP1)
    write_snapshot(p["raw"], SNAP2)
    bronze.ingest_bronze(spark, p["raw"], p["bronze"])
    silver.build_all_silver(spark, p["bronze"], p["silver"])
    # an older folder arrives after the newer ones, with other values
    write_snapshot(p["raw"], "2021-03-14", {
        "circuits.csv": CIRCUITS_HEADER + "\n1,north,North Ring,Northtown,Norland,0,0,1,u\n"})
    bronze.ingest_bronze(spark, p["raw"], p["bronze"], entities=["circuits"])
    silver.build_silver(spark, p["bronze"], p["silver"], "circuits")
    c1 = silver.read_silver(spark, p["silver"], "circuits").where("circuit_id = 1").collect()
    assert len(c1) == 1 and c1[0].altitude == 627


def test_incremental_and_late_snapshot(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    write_snapshot(raw, SNAP1)
    first = ingest_incremental(spark, raw, lake, "circuits")
    assert first["rows"] == 2
    again = ingest_incremental(spark, raw, lake, "circuits")
    assert again["rows"] == 0                                    # nothing new
    write_snapshot(raw, SNAP2)
    assert ingest_incremental(spark, raw, lake, "circuits")["rows"] == 1
    write_snapshot(raw, "2021-03-14", {
        "circuits.csv": CIRCUITS_HEADER + "\n1,north,Old Ring,Northtown,Norland,0,0,1,u\n"})
    assert ingest_incremental(spark, raw, lake, "circuits")["rows"] == 1
    cur = tables.read_current(spark, lake + "/silver/circuits")
    c1 = cur.where("circuit_id = 1").collect()
    assert len(c1) == 1 and c1[0].altitude == 627 and c1[0].name == "North Ring"
    assert spark.read.parquet(lake + "/bronze/circuits").count() == 4


def test_partition_move_and_race_date_not_updated(spark, tmp_path):
    p = _lake(tmp_path)
    write_snapshot(p["raw"], SNAP1)
    bronze.ingest_bronze(spark, p["raw"], p["bronze"])
    silver.build_all_silver(spark, p["bronze"], p["silver"])
    gold.build_gold(spark, p["silver"], p["gold"])
    # race 10 moves to another season and changes date
    write_snapshot(p["raw"], SNAP2, {"races.csv": RACES_HEADER + "\n"
                                     "10,2019,1,1,Norland GP,2019-03-10,14:00:00,r10\n"})
    bronze.ingest_bronze(spark, p["raw"], p["bronze"], entities=["races"])
    silver.build_silver(spark, p["bronze"], p["silver"], "races")
    races = silver.read_silver(spark, p["silver"], "races").where("race_id = 10").collect()
    assert [r.race_year for r in races] == [2019]
    cur = tables.current_version(spark, p["silver"] + "/races")
    years = {r.race_year for r in spark.read.parquet(cur).where("race_id = 10").collect()}
    assert years == {2019}
    gold.build_gold(spark, p["silver"], p["gold"])
    t = gold.read_gold(spark, p["gold"], "race_results", table=True)
    # the 2020 rows stay (merges never delete); new 2019 rows are inserted
    assert t.where("race_year = 2019").count() == 3
    assert t.where("race_year = 2020 AND race_name = 'Norland GP'").count() == 3


def test_gold_table_merge_keeps_race_date(spark, tmp_path):
    p = _lake(tmp_path)
    write_snapshot(p["raw"], SNAP1)
    bronze.ingest_bronze(spark, p["raw"], p["bronze"])
    silver.build_all_silver(spark, p["bronze"], p["silver"])
    gold.build_gold(spark, p["silver"], p["gold"])
    write_snapshot(p["raw"], SNAP2, {"races.csv": RACES_HEADER + "\n"
                                     "10,2020,1,1,Norland GP,2020-03-16,15:00:00,r10\n"})
    bronze.ingest_bronze(spark, p["raw"], p["bronze"], entities=["races"])
    silver.build_silver(spark, p["bronze"], p["silver"], "races")
    gold.build_gold(spark, p["silver"], p["gold"])
    path_copy = gold.read_gold(spark, p["gold"], "race_results").where(
        "race_name = 'Norland GP'").select(F.dayofmonth("race_date").alias("d")).collect()
    table_copy = gold.read_gold(spark, p["gold"], "race_results", table=True).where(
        "race_name = 'Norland GP'").select(F.dayofmonth("race_date").alias("d")).collect()
    assert {r.d for r in path_copy} == {16}
    assert {r.d for r in table_copy} == {15}


def test_replayed_batch_is_idempotent(spark, tmp_path):
    from lapmart.streaming.incremental import apply_batch

    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    write_snapshot(raw, SNAP1)
    write_snapshot(raw, SNAP2)
    batch = bronze.bronze_frame(spark, raw, "results")
    apply_batch(spark, batch, lake + "/bronze/results", lake + "/silver/results", "results")
    first = sorted(tuple(r) for r in tables.read_current(spark, lake + "/silver/results")
                   .drop("ingestion_date", "processed_at").collect())
    # the same micro-batch again, as after a failure between publish and commit
    apply_batch(spark, batch, lake + "/bronze/results", lake + "/silver/results", "results")
    again = sorted(tuple(r) for r in tables.read_current(spark, lake + "/silver/results")
                   .drop("ingestion_date", "processed_at").collect())
    assert again == first and len(first) == 10
    assert spark.read.parquet(lake + "/bronze/results").count() == 11   # a replay replaces its load


def test_incremental_takes_files_with_old_times(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    write_snapshot(raw, SNAP1)
    assert ingest_incremental(spark, raw, lake, "circuits")["rows"] == 2
    write_snapshot(raw, SNAP2)
    for f in (tmp_path / "raw" / SNAP2).rglob("*"):
        old = f.stat().st_mtime - 30 * 86400
        os.utime(f, (old, old))
    assert ingest_incremental(spark, raw, lake, "circuits") == {"batches": 1, "rows": 1}
    assert ingest_incremental(spark, raw, lake, "circuits") == {"batches": 0, "rows": 0}


def test_poison_batch_changes_nothing_however_often(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    write_snapshot(raw, SNAP1)
    ingest_incremental(spark, raw, lake, "circuits")
    base = lake + "/silver/circuits"
    before = spark.read.parquet(lake + "/bronze/circuits").count()
    versions = sorted(p.name for p in (tmp_path / "lake" / "silver" / "circuits").iterdir())
    write_snapshot(raw, SNAP2, {"circuits.csv": CIRCUITS_HEADER + "\n,north,No Key,N,N,0,0,1,u\n"})
    for _ in range(3):
        with pytest.raises(Exception, match="quality gate"):
            ingest_incremental(spark, raw, lake, "circuits")
    assert spark.read.parquet(lake + "/bronze/circuits").count() == before
    assert sorted(p.name for p in (tmp_path / "lake" / "silver" / "circuits").iterdir()) == versions
    assert tables.read_current(spark, base).count() == 2
