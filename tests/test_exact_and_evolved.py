"""Order-free sums, evolving histories, corrupt records, clustering on two columns."""

from __future__ import annotations

import math
import os
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapmart.functions.columns import exact_sum
from lapmart.plans import bronze, gold
from lapmart.sinks import tables
from lapmart.sources.snapshots import corrupt_counts
from raw_fixture import FILES, SNAP1, SNAP2, write_snapshot

points = st.one_of(st.floats(-2**39, 2**39), st.sampled_from([0.1, 0.2, 0.3, 25.0, 12.5, 1e-9, -0.1, 1 / 3]), st.none())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(points, min_size=1, max_size=40), st.randoms())
def test_exact_sum_does_not_depend_on_order(spark, values, rng):
    got = set()
    for n in (1, 3, 7):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "points double").repartition(n)
        got.add(df.agg(exact_sum("points").alias("s")).first()["s"])
    assert len(got) == 1
    known = [Fraction(v) for v in values if v is not None]
    s = got.pop()
    if not known:
        assert s is None
    else:
        # bits under 2**-62 are cut; putting the three parts together rounds twice
        assert abs(Fraction(s) - sum(known)) <= Fraction(len(known), 2**61) + abs(sum(known)) / 2**51


def test_exact_sum_of_values_out_of_range(spark):
    df = spark.createDataFrame([(1, math.inf), (1, 2.0), (2, math.nan), (3, 1e300), (3, 1e300), (4, None)], "g int, points double")
    got = {r.g: r.s for r in df.groupBy("g").agg(exact_sum("points").alias("s")).collect()}
    assert got[1] == math.inf and math.isnan(got[2]) and got[3] == 2e300 and got[4] is None


def test_ranks_of_equal_points_in_any_order_tie(spark):
    """0.1 + 0.2 + 0.3 has two values as a sum of doubles; two drivers with these points share a rank."""
    rows = [(2020, d, "N", p, 2) for d, ps in (("Ann", (0.1, 0.2, 0.3)), ("Bea", (0.3, 0.2, 0.1))) for p in ps]
    schema = "race_year int, driver_name string, driver_nationality string, points double, race_position int"
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, schema).repartition(1 + seed)
        assert {r["rank"] for r in gold.driver_standings(df, stamp=False).collect()} == {1}


def test_history_is_read_by_the_schema_its_writer_keeps(spark, tmp_path):
    path = str(tmp_path / "h")
    tables.append(spark.createDataFrame([(1, 1.5)], "k int, f float"), path)
    tables.append(spark.createDataFrame([(2, 2.5, "x")], "k int, f float, s string"), path)
    tables.append(spark.createDataFrame([(2**40, 0.1, "y")], "k long, f double, s string"), path)
    tables.append(spark.createDataFrame([(7,)], "k int"), path)                  # narrower: the history's type stays
    df = tables.read_appended(spark, path)
    assert df.dtypes == [("k", "bigint"), ("f", "double"), ("s", "string")]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [(1, 1.5, None), (2, 2.5, "x"), (2**40, 0.1, "y"), (7, None, None)], key=str)
    n = len(os.listdir(path))
    with pytest.raises(tables.SchemaConflict):
        tables.append(spark.createDataFrame([("a",)], "k string"), path)
    assert len(os.listdir(path)) == n


def test_no_job_reads_footers(spark, tmp_path):
    path = str(tmp_path / "h")
    tables.append(spark.range(3), path)
    tables.append(spark.range(3).withColumn("a", F.lit(1)), path)
    sc = spark.sparkContext
    sc.setJobGroup("footers", "footers")
    try:
        tables.read_appended(spark, path)
        assert list(sc.statusTracker().getJobIdsForGroup("footers")) == []
        spark.read.option("mergeSchema", "true").parquet(path)
        assert len(sc.statusTracker().getJobIdsForGroup("footers")) == 1
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_corrupt_records_are_counted_by_file(spark, tmp_path):
    raw = str(tmp_path / "raw")
    good = '{"constructorId":1,"constructorRef":"a","name":"A","nationality":"N","url":"u"}\n'
    write_snapshot(raw, SNAP1, {"constructors.json": good + good.replace(":1", ':"1"') + '{"constructorId":3,"nam\n'})
    write_snapshot(raw, SNAP2, {"constructors.json": good, "circuits.csv":
                                "h,h,h,h,h,h,h,h,h\n1,r,N,L,C,1.5,2.5,x,u\n2,r,N,L,C,1.5,2.5,3,u\n"})
    got = {r.file_date: (r.file, r.n_rows, r.n_corrupt) for r in corrupt_counts(spark, raw, "constructors").collect()}
    assert got == {SNAP1: ("constructors.json", 3, 2), SNAP2: ("constructors.json", 1, 0)}
    assert corrupt_counts(spark, raw, "circuits").select("n_rows", "n_corrupt").collect() == [(2, 1)]
    assert corrupt_counts(spark, raw, "drivers").collect() == []
    lake = str(tmp_path / "bronze")
    with pytest.raises(tables.QualityGateError, match="2 of 4 records"):
        bronze.ingest_bronze(spark, raw, lake, ["constructors"], max_corrupt=1)
    assert not os.listdir(lake + "/constructors")
    bronze.ingest_bronze(spark, raw, lake, ["constructors"], max_corrupt=2)
    rows = bronze.read_bronze(spark, lake, "constructors").collect()
    assert sorted((r.constructor_id or 0, r.name) for r in rows if r.name) == [(0, "A"), (1, "A"), (1, "A")]
    assert len(rows) == 4


def test_fixture_has_no_corrupt_records(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_snapshot(raw, SNAP1)
    for entity in ("races", "constructors", "drivers", "laptimes", "qualifying"):
        if any(f.split("/")[0].split(".")[0].startswith(entity[:3]) for f in FILES[SNAP1]):
            assert corrupt_counts(spark, raw, entity).agg(F.sum("n_rows")).first()[0] > 0


def test_filters_on_either_column_skip_files(spark, tmp_path):
    path = str(tmp_path / "results")
    df = spark.range(40_000).selectExpr("(id * 7919) % 200 AS race_id", "(id * 104729) % 193 AS driver_id", "id AS v")
    tables.z_clustered(df, ["race_id", "driver_id"], 64).write.parquet(path)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert len(files) > 32
    read = spark.read.parquet(path)
    spans = read.groupBy(F.col("_metadata.file_name")).agg(*(f(c).alias(f"{c}_{n}") for c in ("race_id", "driver_id")
                                                         for n, f in (("a", F.min), ("b", F.max)))).collect()
    for c, value in (("race_id", 120), ("driver_id", 55)):
        hit = sum(r[f"{c}_a"] <= value <= r[f"{c}_b"] for r in spans)
        assert hit <= len(spans) / 3, (c, hit, len(spans))       # the statistics rule the others out
        assert read.where(F.col(c) == value).count() == df.where(F.col(c) == value).count()
    assert read.count() == 40_000


def test_z_value_of_nulls_dates_and_one_value(spark):
    df = spark.createDataFrame([(None, "2020-01-01"), (5, "2021-01-01"), (5, None)], "a int, d string").withColumn(
        "d", F.to_date("d"))
    assert tables.z_clustered(df, ["a", "d"], 2).count() == 3
    assert tables.z_clustered(df.limit(0), ["a", "d"], 2).count() == 0
