"""Silver layer (DS-S1..8): newest row per key, null-key gate, upsert, publish.

One table-driven function serves all eight entities (keys, gate columns and
layout come from ``schemas``).  Per run:

1. read the bronze history (one scan);
2. newest row per key: ``file_date`` desc, ``ingestion_date`` desc, then row
   content (deterministic where the reference picks arbitrarily);
3. stamp ``processed_at``;
4. stage these rows; the null-key gate is observed during that write, and
   nothing else happens unless no key column was NULL;
5. merge them into the current silver version (merges never delete): only the
   partitions or files that they concern are written (``sinks.merge``).

The dedup is evaluated once (the reference evaluates it three times and
stamps the path and table copies differently).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapmart.operators.dedup import latest_by_version
from lapmart.plans.bronze import read_bronze
from lapmart.schemas import ENTITIES, PROCESSED_AT
from lapmart.sinks import tables
from lapmart.sinks.merge import merge_into


def silver_frame(bronze: DataFrame, entity: str) -> DataFrame:
    """Deduplicated, stamped silver rows for one entity (no gate, no write)."""
    spec = ENTITIES[entity]
    return latest_by_version(bronze, spec.keys).withColumn(PROCESSED_AT, F.current_timestamp())


def build_silver(spark: SparkSession, bronze_root: str, silver_root: str, entity: str,
                 table_name: str | None = None) -> str:
    """Run the silver step for one entity; returns the published version path."""
    spec = ENTITIES[entity]
    base = f"{silver_root.rstrip('/')}/{entity}"
    raw = read_bronze(spark, bronze_root, entity)
    # NULL keys collapse to one row per table in the dedup window; count the
    # raw rows too so a silent bad read shows its real size in the error
    raw, raw_obs, _ = tables.null_gate(spec.gate, "null_keys_before_dedup")(raw)
    staged = silver_frame(raw, entity)
    staged, obs, what = tables.null_gate(spec.gate)(staged)
    # the dedup has left one row per key
    return merge_into(spark, base, staged, spec.keys, partition_by=spec.partition_by, cluster_by=spec.cluster_by,
                      gate_observations=[(obs, what)], info_observations=[raw_obs], table_name=table_name,
                      check_cardinality=False)


def build_all_silver(spark: SparkSession, bronze_root: str, silver_root: str,
                     database: str | None = None) -> dict[str, str]:
    if database:
        tables.create_database(spark, database)
    return {e: build_silver(spark, bronze_root, silver_root, e,
                            f"`{database}`.`{e}`" if database else None)
            for e in ENTITIES}


def read_silver(spark: SparkSession, silver_root: str, entity: str) -> DataFrame:
    return tables.read_current(spark, f"{silver_root.rstrip('/')}/{entity}")
