"""Merges that write only what they touch, and loads that are merged on read."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lapmart.operators.upsert import MergeCardinalityError, merge_rows
from lapmart.sinks import fs, merge, tables
from raw_fixture import FILES, SNAP1, SNAP2, write_snapshot

RACES = "race_id int, race_year int, name string"


def files(base):
    out = {}
    for folder, _, names in os.walk(base):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.relpath(os.path.join(folder, n), base)] = os.stat(os.path.join(folder, n)).st_mtime_ns
    return out


def races(spark, base):
    return sorted((r.race_id, r.race_year, r.name) for r in tables.read_current(spark, base).collect())


def test_one_season_leaves_the_others_alone(spark, tmp_path):
    base, name = str(tmp_path / "races"), "t_merge.races"
    tables.create_database(spark, "t_merge")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = [(i, 2000 + i % 5, f"r{i}") for i in range(50)]
    first = merge.merge_into(spark, base, spark.createDataFrame(rows, RACES), ["race_id"],
                             partition_by=["race_year"], table_name=name)
    before = files(base)
    # race 7 of season 2002 changes, and 2002 gets a new race
    batch = spark.createDataFrame([(7, 2002, "new"), (99, 2002, "more")], RACES)
    second = merge.merge_into(spark, base, batch, ["race_id"], partition_by=["race_year"], table_name=name)
    after = files(base)
    assert {k: after[k] for k in before} == before               # nothing written over
    assert {k.split("/")[1] for k in after.keys() - before.keys()} == {"race_year=2002"}
    want = sorted([r for r in rows if r[0] != 7] + [(7, 2002, "new"), (99, 2002, "more")])
    assert races(spark, base) == want
    assert sorted(map(tuple, spark.table(name).select("race_id", "race_year", "name").collect())) == want
    where = {r["race_year"]: r["p"].rsplit("/", 2)[0] for r in spark.table(name).select(
        "race_year", F.col("_metadata.file_path").alias("p")).distinct().collect()}
    assert where[2002].endswith(second.rsplit("/", 1)[1]) and where[2003].endswith(first.rsplit("/", 1)[1])
    # the only season-2004 races move away: the partition goes
    gone = spark.createDataFrame([(r[0], 2003, r[2]) for r in want if r[1] == 2004], RACES)
    merge.merge_into(spark, base, gone, ["race_id"], partition_by=["race_year"], table_name=name)
    want = sorted((i, 2003 if y == 2004 else y, n) for i, y, n in want)
    assert races(spark, base) == want
    assert sorted(map(tuple, spark.table(name).select("race_id", "race_year", "name").collect())) == want
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 4


def test_files_without_a_match_are_neither_read_nor_rewritten(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "results")
    rows = spark.range(4000).selectExpr("id AS k", "id * 2 AS v").repartitionByRange(8, "k")
    tables.publish(spark, rows, base)
    before = files(base)
    assert len(before) == 8
    read = []
    whole = tables.read_units
    monkeypatch.setattr(tables, "read_units", lambda s, u, **kw: read.append((u, kw)) or whole(s, u, **kw))
    batch = spark.createDataFrame([(10, -1), (20, -2), (9000, -3)], "k long, v long")
    merge.merge_into(spark, base, batch, ["k"])
    touched = [u for u, kw in read if not kw]
    assert [len(x) for u in touched for x in u.values()] == [1]  # one file was read for the merge
    after = files(base)
    assert {k: after[k] for k in before} == before
    live = tables.live_units(spark, base)
    assert sum(len(u) for d, u in live.items() if d.endswith("_v000001")) == 7
    got = {r.k: r.v for r in tables.read_current(spark, base).collect()}
    assert got == {**{i: 2 * i for i in range(4000)}, 10: -1, 20: -2, 9000: -3}
    assert tables.read_current(spark, base).count() == 4001


def test_look_up_pushes_the_batch_s_key_range(spark, tmp_path):
    base = str(tmp_path / "t")
    tables.publish(spark, spark.range(1000).selectExpr("id AS k", "id AS v"), base)
    units = tables.live_units(spark, base)
    plans = []
    batch = spark.createDataFrame([(5, 1), (9, 1)], "k long, v long")
    path = str(tmp_path / "batch")
    batch.write.parquet(path)
    real = merge.key_hint
    try:
        merge.key_hint = lambda staged, side: plans.append(side) or real(staged, side)
        merge._touched(spark, units, spark.read.parquet(path), ["k"], [])
    finally:
        merge.key_hint = real
    near = tables.read_units(spark, units).where(F.col("k").between(5, 9))
    assert "GreaterThanOrEqual(k,5), LessThanOrEqual(k,9)" in near._jdf.queryExecution().executedPlan().toString()
    assert len(plans) == 1


@pytest.mark.parametrize("seed", range(4))
def test_a_row_of_merges_is_that_of_a_dictionary(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(merge, "MOST_VERSIONS", 3)
    rng = random.Random(seed)
    base, parts = str(tmp_path / "t"), ["race_year"] if seed % 2 else []
    model = {}
    for _ in range(6):
        batch = {rng.randrange(60): (rng.choice([2000, 2001, 2002, None]), f"n{rng.randrange(1000)}")
                 for _ in range(rng.randrange(0, 15))}
        df = spark.createDataFrame([(k, y, n) for k, (y, n) in batch.items()], RACES).coalesce(2)
        update = rng.choice([None, ["race_year"]])
        merge.merge_into(spark, base, df, ["race_id"], update, partition_by=parts)
        for k, (y, n) in batch.items():
            model[k] = (y, n) if update is None or k not in model else (y, model[k][1])
        assert sorted(races(spark, base), key=str) == sorted(((k, *v) for k, v in model.items()), key=str)
        assert len(tables.live_units(spark, base)) <= 3
    kept = races(spark, base) if not parts else None
    tables.vacuum(spark, base, keep=1)
    if kept is not None:
        assert races(spark, base) == kept


def test_a_merge_that_was_overtaken_fails(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2000, "a"), (2, 2001, "b")], RACES)
    merge.merge_into(spark, base, df, ["race_id"], partition_by=["race_year"])
    write = tables.write_claimed

    def overtaken(spark, merged, *a, **kw):
        folder = write(spark, merged, *a, **kw)
        monkeypatch.setattr(tables, "write_claimed", write)
        tables.publish(spark, df.where("race_id = 1"), base, partition_by=["race_year"])
        return folder

    monkeypatch.setattr(tables, "write_claimed", overtaken)
    with pytest.raises(merge.PublishConflict):
        merge.merge_into(spark, base, df.withColumn("name", F.lit("x")), ["race_id"], partition_by=["race_year"])
    assert races(spark, base) == [(1, 2000, "a")]
    assert not fs.exists(spark, f"{base}/_publish_lock")


def test_gate_and_cardinality_stop_a_merge(spark, tmp_path):
    base = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2000, "a"), (2, 2001, "b")], RACES)
    merge.merge_into(spark, base, df, ["race_id"], partition_by=["race_year"])
    before = files(base)
    bad, obs, what = tables.null_gate(["race_id"])(spark.createDataFrame([(None, 2000, "c")], RACES))
    with pytest.raises(tables.QualityGateError):
        merge.merge_into(spark, base, bad, ["race_id"], partition_by=["race_year"], gate_observations=[(obs, what)])
    twice = spark.createDataFrame([(1, 2000, "c"), (1, 2001, "d")], RACES)
    with pytest.raises(MergeCardinalityError):
        merge.merge_into(spark, base, twice, ["race_id"], partition_by=["race_year"])
    assert files(base) == before and isinstance(obs, Observation)


def test_hot_target_key_is_split(spark, tmp_path):
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    target, source = str(tmp_path / "t"), str(tmp_path / "s")
    n = 200_000
    spark.range(n).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v", "uuid() AS pad").write.parquet(target)
    spark.range(0, 2 * n, 2).selectExpr("id + 1 AS k", "-id AS v").write.parquet(source)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        from lapmart.operators import upsert
        limit, upsert.DEFAULT_MAX_BYTES = upsert.DEFAULT_MAX_BYTES, 0
        out = merge_rows(spark.read.parquet(target), spark.read.parquet(source), ["k"], ["v"])
        upsert.DEFAULT_MAX_BYTES = limit
        got = out.agg(F.count("*").alias("n"), F.count_if(F.col("k") == 7).alias("hot"),
                      F.count_if((F.col("k") == 7) & (F.col("v") == -6)).alias("changed")).first()
        out.collect()
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hot = (n + 2) // 3 + 1
    assert got["hot"] == got["changed"] == hot
    assert "FullOuter" not in text and "SortMergeJoin(skew=true)" in text


def test_pending_loads_are_merged_on_read(spark, tmp_path):
    from lapmart.streaming import incremental

    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    bronze, silver = f"{lake}/bronze/results", f"{lake}/silver/results"
    write_snapshot(raw, SNAP1)
    assert incremental.ingest_incremental(spark, raw, lake, "results")["batches"] == 1
    before = files(silver)
    write_snapshot(raw, SNAP2, {k: v for k, v in FILES[SNAP2].items()})
    done = incremental.ingest_incremental(spark, raw, lake, "results", compacted=False)
    assert done["batches"] == 1 and incremental.pending_loads(spark, silver) == ["stream-1"]
    assert files(silver) == before                               # the batch's rows are in its load alone
    show = lambda df: sorted(map(tuple, df.drop("processed_at", "ingestion_date").select(
        "result_id", "race_id", "driver_id", "points", "file_date").collect()))
    pending = show(incremental.read_newest(spark, bronze, silver, "results"))
    assert incremental.compact(spark, bronze, silver, "results").endswith("_v000002")
    assert incremental.pending_loads(spark, silver) == []
    assert incremental.compact(spark, bronze, silver, "results") is None
    assert show(tables.read_current(spark, silver)) == pending
    assert show(incremental.read_newest(spark, bronze, silver, "results")) == pending


@pytest.mark.parametrize("update", [["v", "w"], ["v"]])
def test_large_source_merges_like_a_full_outer_join(spark, monkeypatch, tmp_path, update):
    """Null keys, target rows of one key and keys of one side alone, with a source beyond the broadcast bound."""
    from lapmart.operators import upsert

    kind = "k bigint, v string, w string"
    spark.createDataFrame([(1, "a", "a"), (1, "b", "b"), (2, "c", "c"), (3, None, "d"), (None, "e", "e")], kind) \
        .write.parquet(f"{tmp_path}/t")
    spark.createDataFrame([(1, "A", "A"), (3, "B", None), (7, "C", "C"), (7, "D", "D"), (None, "E", "E")], kind) \
        .write.parquet(f"{tmp_path}/s")
    target, source = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    expected = rows(upsert.upsert_columns(target, source, ["k"], update, check_cardinality=False))
    monkeypatch.setattr(upsert, "DEFAULT_MAX_BYTES", 0)
    out = merge_rows(target, source, ["k"], update, True, f"{tmp_path}/keys")
    assert out.columns == target.columns and rows(out) == expected
    twice = spark.read.parquet(f"{tmp_path}/s").withColumn("k", F.lit(1).cast("long"))
    with pytest.raises(MergeCardinalityError):
        merge_rows(target, twice, ["k"], update, True, f"{tmp_path}/keys2")


def test_whole_rows_of_a_large_source_are_not_shuffled(spark, monkeypatch, tmp_path):
    from lapmart.operators import upsert

    spark.range(100).selectExpr("id AS k", "id AS v").write.parquet(f"{tmp_path}/t")
    spark.range(120).selectExpr("id AS k", "-id AS v").write.parquet(f"{tmp_path}/s")
    monkeypatch.setattr(upsert, "DEFAULT_MAX_BYTES", 0)
    out = merge_rows(spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s"), ["k"], ["v"])
    assert sorted(map(tuple, out.collect())) == [(i, -i) for i in range(120)]
    out.write.parquet(f"{tmp_path}/o")
    assert "Exchange hashpartitioning(k" not in out._jdf.queryExecution().sparkPlan().toString()
    hinted = upsert.key_hint(spark.read.parquet(f"{tmp_path}/s"), spark.read.parquet(f"{tmp_path}/s").select("k"))
    assert "strategy=merge" in hinted._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("update", [["v"], ["v", "w"]])
def test_a_large_source_is_never_broadcast_by_the_size_of_its_files(spark, monkeypatch, tmp_path, update):
    from lapmart.operators import joins, upsert

    spark.range(100).selectExpr("id AS k", "id AS v", "1 AS w").write.parquet(f"{tmp_path}/t")
    spark.range(50, 120).selectExpr("id AS k", "-id AS v", "2 AS w").write.parquet(f"{tmp_path}/s")
    monkeypatch.setattr(upsert, "DEFAULT_MAX_BYTES", 0)
    monkeypatch.setattr(joins, "is_bounded", lambda df, max_bytes=0: False)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(conf)
    try:
        spark.conf.set(conf, str(1 << 40))
        out = merge_rows(spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s"), ["k"], update)
        assert "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()
        w = 2 if "w" in update else 1
        assert sorted(map(tuple, out.collect())) == [(i, i, 1) for i in range(50)] + [
            (i, -i, w if i < 100 else 2) for i in range(50, 120)]
    finally:
        spark.conf.set(conf, old)
