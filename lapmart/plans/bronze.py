"""Bronze layer (DS-B1..8): raw snapshots → renamed, audited, append-only history.

Differences to the reference, on purpose:

* one scan over all snapshot folders per entity instead of one per folder;
* every entity keeps ``file_date`` (pit stops, lap times and qualifying too),
  because one scan stamps all folders with the same ``ingestion_date`` and the
  newest folder must still win in silver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lapmart.functions.columns import full_name, race_timestamp
from lapmart.schemas import ENTITIES, FILE_DATE, INGESTION_DATE, EntitySpec
from lapmart.sinks import fs, tables
from lapmart.sources.snapshots import CORRUPT, read_snapshots

# Bronze columns that are computed rather than renamed.
_DERIVED: dict[tuple[str, str], Callable[[], Column]] = {
    ("races", "race_timestamp"): lambda: race_timestamp("date", "time"),
    ("drivers", "name"): lambda: full_name(F.col("name.forename"), F.col("name.surname")),
}


def to_bronze(raw: DataFrame, entity: str | EntitySpec) -> DataFrame:
    """Rename raw columns to bronze names, derive columns, add audit columns."""
    spec = ENTITIES[entity] if isinstance(entity, str) else entity
    cols = []
    for src, dst in spec.select:
        make = _DERIVED.get((spec.name, dst))
        cols.append((make() if make else F.col(src)).alias(dst))
    return raw.select(*cols, F.current_timestamp().alias(INGESTION_DATE), F.col(FILE_DATE))


def bronze_frame(spark: SparkSession, raw_root: str, entity: str, **read_opts) -> DataFrame:
    return to_bronze(read_snapshots(spark, raw_root, entity, **read_opts), entity)


def ingest_bronze(spark: SparkSession, raw_root: str, bronze_root: str,
                  entities=None, max_corrupt: int | None = None, **read_opts) -> dict[str, str]:
    """Append every snapshot of each entity to ``<bronze_root>/<entity>`` (SNK-01).

    With ``max_corrupt``, records that don't fit the declared schema are
    counted during the write, and a load with more of them is taken back;
    without it they are read as NULLs, as in the reference.

    As in the reference, each run appends all folders again; silver removes
    the copies.  For "only new folders" use ``streaming.incremental``.
    """
    out = {}
    for name in entities or ENTITIES:
        path = f"{bronze_root.rstrip('/')}/{name}"
        load = f"batch-{uuid.uuid4().hex[:16]}"
        if max_corrupt is None:
            tables.append_load(bronze_frame(spark, raw_root, name, **read_opts), path, load)
        else:
            _append_gated(read_snapshots(spark, raw_root, name, corrupt=CORRUPT, **read_opts), name, path, load, max_corrupt)
        out[name] = path
    return out


def _append_gated(raw: DataFrame, entity: str, path: str, load: str, most: int) -> None:
    spark = raw.sparkSession
    seen = Observation("corrupt_records")
    counted = raw.observe(seen, F.count("*").alias("rows"), F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"))
    tables.append_load(to_bronze(counted, entity), path, load)
    m = seen.get
    if m.get("corrupt") is None or m["corrupt"] > most:
        fs.delete(spark, f"{path}/{tables.LOAD}={load}")
        raise tables.QualityGateError(f"{entity}: {m.get('corrupt')} of {m.get('rows')} records don't fit the declared "
                                      f"schema, {most} allowed; the load was taken back")


def bronze_schema(spark: SparkSession, entity: str) -> StructType:
    """Columns of an entity's history, as declared."""
    spec = ENTITIES[entity]
    raw = spark.createDataFrame([], StructType([*spec.schema.fields, StructField(FILE_DATE, StringType())]))
    return to_bronze(raw, entity).schema


def read_bronze(spark: SparkSession, bronze_root: str, entity: str) -> DataFrame:
    """An entity's history by its declared schema (no footers are merged)."""
    schema = bronze_schema(spark, entity)
    return spark.read.schema(schema).parquet(f"{bronze_root.rstrip('/')}/{entity}").select(*schema.names)
