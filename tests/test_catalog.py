"""Named tables over published versions; CTAS-once; managed tables (SNK-06..09, 15, SRC-09..11)."""

from __future__ import annotations

import pytest

from lapmart.plans.pipeline import run_pipeline
from lapmart.sinks import fs, tables
from raw_fixture import write_all


def test_pipeline_registers_named_tables(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    write_all(raw)
    run_pipeline(spark, raw, lake, ("t_bronze", "t_silver", "t_gold"))
    assert spark.table("t_bronze.circuits").count() == 3
    assert spark.table("t_silver.races").count() == 3
    assert spark.table("t_gold.driver_standings").count() == 5
    cols = [r.col_name for r in tables.describe(spark, "t_silver.drivers").collect()]
    assert "driver_id" in cols and "processed_at" in cols
    # a second pipeline run republishes; the named table follows the new version
    run_pipeline(spark, raw, lake, ("t_bronze", "t_silver", "t_gold"))
    assert spark.table("t_silver.races").count() == 3
    assert spark.table("t_bronze.circuits").count() == 6       # bronze history grows


def test_ctas_once_and_managed_tables(spark, tmp_path):
    tables.create_database(spark, "t_cat")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    tables.overwrite(spark.range(3), a)
    tables.overwrite(spark.range(5), b)
    tables.create_table_once_as(spark, "t_cat.x", a)
    tables.create_table_once_as(spark, "t_cat.x", b)          # no-op
    assert spark.table("t_cat.x").count() == 3
    assert tables.scan_path_sql(spark, b).count() == 5
    tables.save_as_new_table(spark.range(2), "t_cat.y")
    with pytest.raises(Exception):
        tables.save_as_new_table(spark.range(2), "t_cat.y")   # exists → error
    tables.replace_table(spark.range(4), "t_cat.y")
    assert spark.table("t_cat.y").count() == 4


def test_partition_pruning_and_clustered_layout(spark, tmp_path):
    from pyspark.sql import functions as F

    base = str(tmp_path / "races")
    df = spark.range(0, 2000).select(F.col("id").cast("int").alias("race_id"),
                                     (F.lit(2000) + F.col("id") % 5).cast("int")
                                     .alias("race_year"))
    tables.publish(spark, df, base, partition_by=["race_year"], cluster_by=["race_id"])
    cur = tables.read_current(spark, base).where("race_year = 2003 AND race_id < 100")
    plan = cur._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(race_year" in plan and "2003" in plan
    assert "PushedFilters" in plan and "LessThan(race_id,100)" in plan
    assert cur.count() == 20


def test_vacuum_keeps_newest_versions(spark, tmp_path):
    base = str(tmp_path / "t")
    for i in range(4):
        tables.publish(spark, spark.range(i + 1), base)
    removed = tables.vacuum(spark, base, keep=2)
    assert len(removed) == 2
    assert tables.read_current(spark, base).count() == 4


def test_republish_at_a_reused_path(spark, tmp_path):
    base = str(tmp_path / "t")
    for n in (10, 3):
        df = spark.range(n).selectExpr("id AS k", "id % 2 AS race_year")
        tables.publish(spark, df, base, partition_by=("race_year",))
        assert tables.read_current(spark, base).count() == n
        fs.delete(spark, base)


def test_two_writers_get_versions_of_their_own(spark, tmp_path):
    base = str(tmp_path / "t")
    a, b = tables._claim(spark, base), tables._claim(spark, base)
    assert a != b
    assert tables.current_version(spark, base) is None
    tables.publish(spark, spark.range(4), base)
    assert tables.read_current(spark, base).count() == 4


def test_gate_without_metric_fails_closed(spark, tmp_path):
    from pyspark.sql import Observation

    class Silent(Observation):
        get = {}

    base = str(tmp_path / "t")
    with pytest.raises(tables.QualityGateError):
        tables.publish(spark, spark.range(4), base, gate_observations=[(Silent("x"), "k")])
    assert tables.current_version(spark, base) is None
    assert not [n for n in fs.list_dirs(spark, base) if n.startswith("_v")]


def test_range_filter_skips_files_of_silver_races(spark, tmp_path):
    from raw_fixture import write_all

    from lapmart.plans import bronze, silver

    raw, b, s = str(tmp_path / "raw"), str(tmp_path / "bronze"), str(tmp_path / "silver")
    write_all(raw)
    bronze.ingest_bronze(spark, raw, b, entities=["races"])
    silver.build_silver(spark, b, s, "races")
    races = silver.read_silver(spark, s, "races")
    plan = races.where("race_id BETWEEN 1 AND 2").selectExpr("name")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(race_id,1)" in plan and "LessThanOrEqual(race_id,2)" in plan
    # files hold narrow ranges of race_id within a season
    for r in races.groupBy("race_year").agg({"race_id": "count"}).collect():
        ranges = sorted((x.lo, x.hi) for x in races.where(f"race_year = {r.race_year}")
                        .selectExpr("race_id", "_metadata.file_path AS f").groupBy("f")
                        .agg({"race_id": "min", "f": "max"}).selectExpr("`min(race_id)` AS lo", "`min(race_id)` AS hi").collect())
        assert ranges == sorted(set(ranges))


def test_named_table_moves_without_being_dropped(spark, tmp_path):
    base, db = str(tmp_path / "t"), "moves"
    tables.create_database(spark, db)
    for n in (3, 5):
        tables.publish(spark, spark.range(n), base, table_name=f"{db}.t")
        assert spark.table(f"{db}.t").count() == n
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_checkpoint_folder_is_required_off_a_local_master():
    from types import SimpleNamespace

    from lapmart.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_view_as_merge_source_in_sql(spark):
    # SNK-16 + FLT-02: a registered view used from SQL with a string predicate
    from pyspark.sql import functions as F

    from lapmart.operators.dedup import latest_by

    df = spark.createDataFrame([(1, "a", "d1"), (1, "b", "d2"), (2, "c", "d1")],
                               "k int, v string, file_date string")
    tables.register_view(latest_by(df, ["k"], [F.col("file_date").desc()]), "src_view")
    got = sorted(tuple(r) for r in spark.sql("SELECT k, v FROM src_view").filter("k = 1")
                 .collect())
    assert got == [(1, "b")]
