"""Raw snapshot folders → typed DataFrames (SRC-01..07).

Raw data arrives as dated folders below one root, each holding one file (or
a file group) per entity::

    raw/2021-03-21/circuits.csv
    raw/2021-03-21/lap_times/lap_times_split_1.csv
    raw/2021-03-28/...

All folders of an entity are read by **one** glob scan with the declared
schema; the folder name becomes ``file_date`` from the hidden
``_metadata.file_path`` column.  No driver-side loop over folders, one job
per entity instead of one per folder.

Reads are permissive as in the reference: a value that does not parse as its
declared type becomes NULL and the row is kept; CSV header names are ignored
(columns bind by position); surplus columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lapmart.functions.columns import snapshot_version
from lapmart.schemas import ENTITIES, FILE_DATE, EntitySpec
from lapmart.sinks import fs


CORRUPT = "_corrupt_record"


class MissingSnapshotFile(FileNotFoundError):
    """A snapshot folder lacks an entity's file while ``require_all`` is set."""


def snapshot_folders(spark: SparkSession, raw_root: str) -> list[str]:
    """SRC-01: snapshot folder names, ascending as strings (metadata listing only)."""
    return fs.list_dirs(spark, raw_root)


def read_snapshots(spark: SparkSession, raw_root: str, entity: str | EntitySpec,
                   require_all: bool = False, multiline: bool | None = None,
                   options: dict | None = None, corrupt: str | None = None) -> DataFrame:
    """Every snapshot of one entity as a DataFrame with its raw columns + ``file_date``.

    ``multiline`` overrides the entity's JSON mode (the reference reads the
    pit-stop file as JSON Lines and qualifying as multi-line).
    ``require_all`` fails when some snapshot folder lacks the entity's file,
    as the reference's per-folder read does; by default such folders are
    skipped.
    ``corrupt`` names a column that holds the raw text of each record that
    doesn't fit the declared schema (a value of another type, a broken line,
    surplus CSV fields), and NULL for all others.
    """
    spec = ENTITIES[entity] if isinstance(entity, str) else entity
    root = raw_root.rstrip("/")
    if require_all:
        have = set(fs.snapshot_folders_with(spark, root, spec.path))
        missing = [f for f in snapshot_folders(spark, root) if f not in have]
        if missing:
            raise MissingSnapshotFile(
                f"{spec.name}: no {spec.path} in snapshot folder(s) {missing}")
    opts = dict(spec.options)
    if multiline is not None:
        opts["multiLine"] = "true" if multiline else "false"
    opts.update(options or {})
    schema = spec.schema
    if corrupt:
        schema = StructType([*schema.fields, StructField(corrupt, StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt
    reader = spark.read.schema(schema).options(**opts)
    path = f"{root}/*/{spec.path}"
    if not fs.snapshot_folders_with(spark, root, spec.path):
        return spark.createDataFrame([], schema).withColumn(FILE_DATE, F.lit(None).cast("string"))
    df = reader.csv(path) if spec.fmt == "csv" else reader.json(path)
    return df.withColumn(FILE_DATE, snapshot_version(fs.qualify(spark, root)))


def corrupt_counts(spark: SparkSession, raw_root: str, entity: str | EntitySpec, **read_opts) -> DataFrame:
    """Per raw file: file_date, file, n_rows, n_corrupt records that don't fit the declared schema, and a
    checksum of the records read, whatever their order."""
    raw = read_snapshots(spark, raw_root, entity, corrupt=CORRUPT, **read_opts)
    if not raw.inputFiles():
        return raw.select(FILE_DATE, F.lit("").alias("file"), F.lit(0).cast("long").alias("n_rows"),
                          F.lit(0).cast("long").alias("n_corrupt"), F.lit(0).cast("long").alias("checksum"))
    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    # a scan that is asked for nothing but the corrupt record parses nothing: the checksum needs all columns
    each = [c for c in raw.columns if c != FILE_DATE]
    return (raw.select(FILE_DATE, file.alias("file"), F.col(CORRUPT).isNotNull().alias("bad"),
                       F.xxhash64(*each).alias("h"))
            .groupBy(FILE_DATE, "file")
            .agg(F.count("*").alias("n_rows"), F.count_if("bad").alias("n_corrupt"), F.bit_xor("h").alias("checksum"))
            .where(F.col("checksum").isNotNull()))     # always so; keeps the checksum in whatever is asked of this
