"""Unit tests per operator id on hand-written rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lapmart.operators.dedup import latest_by, latest_by_version
from lapmart.operators.joins import broadcast_if_bounded, input_bytes
from lapmart.operators.quality import assert_no_null_keys, null_key_counts
from lapmart.operators.ranking import rank_desc, rank_desc_window
from lapmart.operators.upsert import (
    MergeCardinalityError,
    upsert_all,
    upsert_columns,
    upsert_newest,
)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# --------------------------------------------------------------------------- WIN-01..03

def test_latest_by_version_newest_folder_wins(spark):
    df = spark.createDataFrame(
        [(1, "a", "2021-03-21"), (1, "b", "2021-03-28"), (2, "c", "2021-03-21"),
         (None, "x", "2021-03-21"), (None, "y", "2021-03-28")],
        "k int, v string, file_date string")
    out = latest_by_version(df, ["k"])
    # NULL keys form one group, as in the reference's window
    assert rows(out, "k", "v") == sorted([(1, "b"), (2, "c"), (None, "y")], key=repr)


def test_latest_by_tie_is_deterministic(spark):
    # same snapshot loaded twice: the tie on file_date is broken by row content
    df = spark.createDataFrame([(1, "b", "d1"), (1, "a", "d1"), (1, "c", "d1")],
                               "k int, v string, file_date string")
    for _ in range(3):
        assert rows(latest_by_version(df.repartition(3), ["k"]), "k", "v") == [(1, "a")]


def test_latest_by_hot_key_many_copies(spark):
    # one key holds most rows (a group of copies); result is still one row
    df = spark.range(0, 20000).select(
        F.when(F.col("id") < 15000, F.lit(7)).otherwise(F.col("id")).cast("long").alias("k"),
        F.col("id").alias("v"))
    out = latest_by(df.repartition(8), ["k"], [F.col("v").desc()], [])
    assert out.count() == 5001
    assert out.where("k = 7").collect()[0]["v"] == 14999


def test_latest_by_plan_limits_before_shuffle(spark):
    df = spark.range(0, 100).select((F.col("id") % 5).alias("k"), "id")
    plan = latest_by(df, ["k"], [F.col("id").desc()], [])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan


# --------------------------------------------------------------------------- WIN-04

@pytest.mark.parametrize("buckets", [1, 2, 4, 64])
def test_rank_desc_bucketed_equals_window(spark, buckets):
    data = []
    for y in (2019, 2020, None):
        for i in range(60):
            v = None if i % 17 == 0 else float((i * 7) % 13)   # ties and NULLs
            data.append((y, f"d{i}", v))
    df = spark.createDataFrame(data, "y int, d string, v double")
    got = rank_desc(df, ["y"], "v", buckets=buckets)
    exp = rank_desc_window(df, ["y"], "v")
    assert rows(got, "y", "d", "rank") == rows(exp, "y", "d", "rank")


def test_rank_desc_plain_window_when_bounded(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 3.0), (1, 1.0)], "y int, v double")
    got = rank_desc(df, ["y"], "v", partition_rows_bound=10)
    assert sorted(r["rank"] for r in got.collect()) == [1, 1, 3]


# --------------------------------------------------------------------------- joins

def test_broadcast_only_when_bounded(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(10).withColumnRenamed("id", "k").write.parquet(path)
    small = spark.read.parquet(path)
    big = spark.range(1000).withColumnRenamed("id", "k")
    plan = big.join(broadcast_if_bounded(small), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan.lower()
    plan2 = big.join(broadcast_if_bounded(small, max_bytes=5), "k")._jdf.queryExecution().optimizedPlan()
    assert "broadcast" not in plan2.toString().lower()


def test_a_table_replaced_in_place_is_sized_anew(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(3).write.parquet(path)
    before = input_bytes(spark.read.parquet(path))
    spark.range(300_000).write.mode("overwrite").parquet(path)
    grown = spark.read.parquet(path)
    assert input_bytes(grown) > 100 * before
    plan = spark.range(9).join(broadcast_if_bounded(grown, max_bytes=before * 20), "id")
    assert "broadcast" not in plan._jdf.queryExecution().optimizedPlan().toString().lower()


def test_gold_plans_start_no_job(spark, tmp_path):
    """Choosing broadcasts looks at file sizes alone."""
    path = str(tmp_path / "dim")
    spark.range(3).write.parquet(path)
    df = spark.read.parquet(path)
    spark.sparkContext.setJobGroup("probe", "probe")
    broadcast_if_bounded(df.selectExpr("id", "id + 1 AS x"))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("probe")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# --------------------------------------------------------------------------- FLT

def test_null_key_counts_and_gate(spark):
    df = spark.createDataFrame([(1, 2020, 1), (2, None, 1), (None, 2020, 3)],
                               "race_id int, race_year int, circuit_id int")
    r = null_key_counts(df, ["race_id", "race_year", "circuit_id"]).first()
    assert (r["n_rows"], r["null_key_rows"]) == (3, 2)
    with pytest.raises(ValueError):
        assert_no_null_keys(df, ["race_id"], "races")


# --------------------------------------------------------------------------- SNK-10..12

T_SCHEMA = "k int, a string, b int"


def test_upsert_all_semantics(spark):
    t = spark.createDataFrame([(1, "t1", 1), (2, "t2", 2), (None, "tn", 0)], T_SCHEMA)
    s = spark.createDataFrame([(2, "s2", 20), (3, "s3", 30), (None, "sn", 9)], T_SCHEMA)
    out = upsert_all(t, s, ["k"])
    # matched replaced, unmatched kept/inserted, NULL keys never match
    assert rows(out, "k", "a", "b") == sorted(
        [(1, "t1", 1), (2, "s2", 20), (3, "s3", 30), (None, "tn", 0), (None, "sn", 9)], key=repr)


def test_upsert_columns_leaves_unlisted(spark):
    t = spark.createDataFrame([(1, "t1", 1), (2, "t2", 2)], T_SCHEMA)
    s = spark.createDataFrame([(2, "s2", 20), (3, "s3", 30)], T_SCHEMA)
    out = upsert_columns(t, s, ["k"], update=["b"])
    # race_date-style column "a" is not updated on a match, inserted rows take all
    assert rows(out, "k", "a", "b") == [(1, "t1", 1), (2, "t2", 20), (3, "s3", 30)]


def test_upsert_double_match_raises(spark):
    # two nationalities, one driver name and season: two source rows, one target key
    t = spark.createDataFrame([(2020, "Ann", "X", 10.0)], "y int, n string, nat string, p double")
    s = spark.createDataFrame([(2020, "Ann", "X", 5.0), (2020, "Ann", "Y", 6.0)],
                              "y int, n string, nat string, p double")
    with pytest.raises(MergeCardinalityError):
        upsert_columns(t, s, ["y", "n"], update=["nat", "p"])
    # on create (no target match) both rows go in
    empty = t.limit(0)
    assert upsert_columns(empty, s, ["y", "n"], update=["nat", "p"]).count() == 2


def test_upsert_keeps_rows_gone_from_source(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], T_SCHEMA)
    s = spark.createDataFrame([(2, "b2", 2)], T_SCHEMA)
    assert rows(upsert_all(t, s, ["k"]), "k", "a") == [(1, "a"), (2, "b2")]


def test_upsert_newest_rejects_late_older_row(spark):
    sch = "k int, v string, file_date string, ingestion_date string"
    t = spark.createDataFrame([(1, "new", "2021-03-28", "x"), (2, "keep", "2021-03-28", "x")], sch)
    late = spark.createDataFrame([(1, "old", "2021-03-14", "z"), (3, "ins", "2021-03-14", "z")],
                                 sch)
    order = [F.col("file_date").desc(), F.col("ingestion_date").desc()]
    out = upsert_newest(t, late, ["k"], order)
    assert rows(out, "k", "v") == [(1, "new"), (2, "keep"), (3, "ins")]


def test_upsert_missing_column_and_repeated_target_key(spark):
    t = spark.createDataFrame([(1, "t1", 1), (2, "t2", 2), (2, "t3", 3)], T_SCHEMA)
    s = spark.createDataFrame([(2, "s2"), (4, "s4")], "k int, a string")
    # matched rows keep the column that the source lacks, each target row is updated
    assert rows(upsert_all(t, s, ["k"]), "k", "a", "b") == sorted(
        [(1, "t1", 1), (2, "s2", 2), (2, "s2", 3), (4, "s4", None)], key=repr)


def test_upsert_all_double_match_raises_by_default(spark):
    t = spark.createDataFrame([(1, "t1", 1)], T_SCHEMA)
    s = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], T_SCHEMA)
    with pytest.raises(MergeCardinalityError):
        upsert_all(t, s, ["k"])
    assert upsert_all(t.limit(0), s, ["k"]).count() == 2


def test_rank_desc_hot_season_with_ties(spark):
    # one season holds most rows, a third of them tied on one value
    df = spark.range(0, 6000).select(
        F.when(F.col("id") < 5500, F.lit(2020)).otherwise(F.lit(2021)).alias("y"),
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise((F.col("id") % 997).cast("double"))
        .alias("v"), F.col("id"))
    got = rank_desc(df, ["y"], "v", buckets=16)
    exp = rank_desc_window(df, ["y"], "v")
    assert rows(got, "id", "rank") == rows(exp, "id", "rank")


def test_dimensions_beyond_a_small_driver_are_not_broadcast(spark, tmp_path):
    """Tables of 4 MB of Parquet are 100 MB and more as a hash table; several stand in the driver at once."""
    path = str(tmp_path / "d")
    spark.range(1_200_000).selectExpr("id", "xxhash64(id) AS x").coalesce(1).write.parquet(path)
    assert "ResolvedHint" not in broadcast_if_bounded(spark.read.parquet(path))._jdf.queryExecution().analyzed().toString()


def test_large_dimensions_are_never_broadcast_by_the_size_of_their_files(spark, tmp_path):
    """Two columns of well compressed files count as a few MB for Spark's planner and as hundreds for the driver."""
    from lapmart.operators.joins import is_bounded, race_results_star

    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    spark.range(1_200_000).selectExpr("id AS constructor_id", "concat('Team', id % 9) AS name", "uuid() AS pad") \
        .write.parquet(f"{tmp_path}/constructors")
    spark.range(1_200_000).selectExpr("id AS circuit_id", "concat('L', id % 9) AS location", "'c' AS country",
                                      "uuid() AS pad").write.parquet(f"{tmp_path}/circuits")
    races = spark.createDataFrame([(1, 2020, "A", 7), (2, 2020, "B", 8), (3, 2020, "C", -1)],
                                  "race_id bigint, race_year int, name string, circuit_id bigint") \
        .withColumn("race_timestamp", F.lit(None).cast("timestamp"))
    results = spark.createDataFrame([(1, 1, 5, 3), (2, 2, 5, 1_199_999), (3, 3, 5, 3), (4, 1, 5, None)],
                                    "result_id bigint, race_id bigint, driver_id bigint, constructor_id bigint") \
        .selectExpr("*", "1 AS grid", "1 AS fastest_lap", "1 AS position", "'t' AS time", "2.0 AS points")
    drivers = spark.createDataFrame([(5, "d")], "driver_id bigint, name string")
    cons, circuits = read("constructors"), read("circuits")
    assert not is_bounded(cons) and not is_bounded(circuits)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(conf)
    try:
        spark.conf.set(conf, str(1 << 40))
        for team in (True, False):
            star = race_results_star(results, races, circuits, drivers, cons, team=team, race_attributes=team)
            plan = star._jdf.queryExecution().sparkPlan().toString()
            for key in ("constructor_id", "circuit_id"):
                lines = [x for x in plan.split("\n") if "Join" in x and key in x]
                assert lines and all("SortMergeJoin" in x for x in lines)
            assert rows(star, "result_id", "race_id", *(["team"] if team else [])) == (
                [(1, 1, "Team3"), (2, 2, "Team2")] if team else [(1, 1), (2, 2)])
    finally:
        spark.conf.set(conf, old)


def test_rows_joined_by_race_are_deduplicated_where_they_lie(spark, monkeypatch):
    """Beyond the broadcast bound, unless two races share year and name, or one race has very many of the facts."""
    from lapmart.operators import joins
    from lapmart.plans.gold import race_results_deduped

    kind = "race_id bigint, race_year int, name string, circuit_id bigint"
    apart = [(1, 2020, "A", 1), (2, 2020, "B", 1), (3, 2021, "A", 1), (3, 2021, "C", 1), (4, None, "N", 1),
             (None, 2020, "A", 1)]
    drivers = spark.createDataFrame([(5, "d"), (6, "d"), (7, "e"), (7, None)], "driver_id bigint, name string")
    facts = spark.createDataFrame(
        [(i, r, d, 9) for i, (r, d) in enumerate([(1, 5), (1, 6), (2, 5), (3, 7), (3, 7), (1, 5), (4, 7), (2, 8), (5, 6)])]
        + [(20, None, 5, 9), (21, 1, None, 9)],
        "result_id bigint, race_id bigint, driver_id bigint, constructor_id bigint") \
        .selectExpr("*", "1 AS grid", "1 AS fastest_lap", "1 AS position", "'t' AS time", "2.0 AS points").repartition(3)
    circuits = spark.createDataFrame([(1,)], "circuit_id bigint")
    cons = spark.createDataFrame([(9, "t")], "constructor_id bigint, name string")
    cols = ["result_id", "race_id", "race_year", "race_name", "driver_name", "team"]

    def run(races):
        races = spark.createDataFrame(races, kind).withColumn("race_timestamp", F.lit(None).cast("timestamp"))
        told = joins.names_tell_races(facts, races, circuits)
        out = race_results_deduped(facts, races, circuits, drivers, cons, team=True)
        text = out._jdf.queryExecution().executedPlan().toString()
        return told, rows(out, *cols), "driver_name" in "".join(x for x in text.split("\n") if "Exchange hash" in x)

    clash, twice = [*apart, (5, 2020, "A", 1)], [*apart, *apart]
    monkeypatch.setattr(joins, "is_bounded", lambda df, max_bytes=0: True)
    expected = {len(x): run(x) for x in (apart, clash, twice)}
    assert not any(told for told, _, _ in expected.values())           # within the bound nothing is shuffled by race
    monkeypatch.setattr(joins, "is_bounded", lambda df, max_bytes=0: False)
    assert run(apart) == (True, expected[len(apart)][1], False)
    for x in (clash, twice):
        assert run(x) == (False, expected[len(x)][1], True)
    monkeypatch.setattr(joins, "MOST_FACTS_OF_A_RACE", 2)
    assert run(apart) == (False, expected[len(apart)][1], True)
