"""Incremental snapshot ingestion (INC-01) with Structured Streaming.

The reference re-reads every snapshot folder on every run.  Here a file
stream over ``raw/*/<entity file>`` with a checkpoint processes each file
once: ``trigger(availableNow=True)`` drains what is new and stops, so a rerun
without new folders does no work, and a new folder contributes only its own
rows.  Each micro-batch is merged on read: it

1. is written straight to its load ``stream-<batch>`` of the bronze history;
2. passes the null-key gate, or the load goes and nothing has changed;
3. is marked as pending for silver by an empty file: no row is written twice.

``read_newest`` shows silver with the pending loads, newest row per key.
``compact`` merges them into silver with *newest wins*: a matched key keeps
the row with the larger (``file_date``, ``ingestion_date``), so an old
snapshot that arrives late cannot overwrite newer data; it writes only the
partitions or files that the loads concern (``sinks.merge``).  A run ends with
one compaction, however many batches it had.

A batch replayed after a failure replaces its own load, and a load merged
twice changes nothing under newest-wins.  Files count as new by name alone:
``maxFileAge`` is set beyond any file's age, so a file copied with an old time
is not passed over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapmart.functions.columns import any_null, snapshot_version
from lapmart.operators.dedup import latest_by_version
from lapmart.plans.bronze import bronze_schema, to_bronze
from lapmart.schemas import ENTITIES, FILE_DATE, INGESTION_DATE, PROCESSED_AT
from lapmart.sinks import fs, tables
from lapmart.sinks.merge import merge_into


# Longer than any file can be old: a file is new if its name is.
MAX_FILE_AGE = "36500d"
# Folder of a silver table with the names of the loads that it doesn't hold yet.
PENDING = "_pending"


def _order():
    return [F.col(FILE_DATE).desc_nulls_last(), F.col(INGESTION_DATE).desc_nulls_last()]


def append_batch(spark: SparkSession, batch: DataFrame, bronze_path: str, silver_base: str,
                 entity: str, load: str) -> int:
    """Writes one micro-batch of bronze-shaped rows as a load, pending for silver; returns its rows."""
    spec = ENTITIES[entity]
    target = f"{bronze_path.rstrip('/')}/{tables.LOAD}={load}"
    tables.append_load(batch, bronze_path, load)
    seen = (spark.read.schema(batch.schema).parquet(target)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(any_null(spec.gate)).alias("bad")).first())
    if seen["bad"]:
        fs.delete(spark, target)
        raise tables.QualityGateError(
            f"quality gate failed for {entity}: {seen['bad']} of {seen['n']} rows of load {load} "
            f"have NULL in ({', '.join(spec.gate)}); nothing was changed")
    fs.mkdirs(spark, f"{silver_base.rstrip('/')}/{PENDING}")
    fs.touch(spark, f"{silver_base.rstrip('/')}/{PENDING}/{load}")
    return int(seen["n"])


def pending_loads(spark: SparkSession, silver_base: str) -> list[str]:
    return fs.list_names(spark, f"{silver_base.rstrip('/')}/{PENDING}")


def _pending(spark: SparkSession, bronze_path: str, entity: str, loads: list[str]) -> DataFrame:
    """The newest row per key of the loads, stamped."""
    schema = bronze_schema(spark, entity)
    rows = spark.read.schema(schema).parquet(*(f"{bronze_path.rstrip('/')}/{tables.LOAD}={x}" for x in loads))
    return latest_by_version(rows.select(*schema.names), ENTITIES[entity].keys).withColumn(
        PROCESSED_AT, F.current_timestamp())


def read_newest(spark: SparkSession, bronze_path: str, silver_base: str, entity: str) -> DataFrame:
    """Silver as it will be after the next compaction: published rows and pending loads, newest per key."""
    loads = pending_loads(spark, silver_base)
    if not loads:
        return tables.read_current(spark, silver_base)
    rows = _pending(spark, bronze_path, entity, loads)
    if tables.table_exists(spark, silver_base):
        rows = tables.read_current(spark, silver_base).unionByName(rows, allowMissingColumns=True)
    return latest_by_version(rows, ENTITIES[entity].keys)


def compact(spark: SparkSession, bronze_path: str, silver_base: str, entity: str) -> str | None:
    """Merges the pending loads into silver; returns the new version, or None when nothing was pending."""
    spec = ENTITIES[entity]
    loads = pending_loads(spark, silver_base)
    if not loads:
        return None
    version = merge_into(spark, silver_base, _pending(spark, bronze_path, entity, loads), spec.keys, newest=_order(),
                         partition_by=spec.partition_by, cluster_by=spec.cluster_by)
    for load in loads:
        fs.delete(spark, f"{silver_base.rstrip('/')}/{PENDING}/{load}")
    return version


def apply_batch(spark: SparkSession, batch: DataFrame, bronze_path: str, silver_base: str,
                entity: str, load: str = "stream-0") -> int:
    """One micro-batch appended and merged at once (also usable in batch jobs); returns its rows."""
    n = append_batch(spark, batch, bronze_path, silver_base, entity, load)
    compact(spark, bronze_path, silver_base, entity)
    return n


def ingest_incremental(spark: SparkSession, raw_root: str, lake_root: str, entity: str,
                       checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                       compacted: bool = True) -> dict:
    """Drain new snapshot files of one entity into bronze and silver; returns progress.

    ``compacted=False`` leaves the loads pending, for ``read_newest`` and a later ``compact``.
    """
    spec = ENTITIES[entity]
    root = raw_root.rstrip("/")
    lake = lake_root.rstrip("/")
    bronze_path = f"{lake}/bronze/{entity}"
    silver_base = f"{lake}/silver/{entity}"
    ckpt = checkpoint or f"{lake}/_checkpoints/{entity}"
    reader = spark.readStream.schema(spec.schema).options(**spec.options).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.format(spec.fmt).load(f"{root}/*/{spec.path}")
    stream = stream.withColumn(FILE_DATE, snapshot_version(fs.qualify(spark, root)))
    bronze = to_bronze(stream, entity)

    done = {"batches": 0, "rows": 0}

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        done["rows"] += append_batch(spark, batch_df, bronze_path, silver_base, entity, f"stream-{batch_id}")
        done["batches"] += 1

    q = (bronze.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", ckpt)
         .trigger(availableNow=True)
         .queryName(f"lapmart_incremental_{entity}")
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if compacted:
        compact(spark, bronze_path, silver_base, entity)
    return done
