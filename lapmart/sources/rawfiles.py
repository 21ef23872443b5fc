"""Write a DataFrame as raw snapshot folders (``<root>/<folder>/<entity file>``).

Used to turn any table into the raw layout the bronze readers expect (test
inputs, replays, the contract queries).  All rows are written by one Spark
job with ``partitionBy(folder)``; the produced folder directories are then
renamed into place (metadata operations, one per snapshot folder).  The
entity file becomes a directory of part files, which the snapshot glob reads
the same way as a single file.

Multi-line JSON (whole-file arrays) is produced as bounded chunks: runs of
at most ``records_per_file`` consecutive rows of one task (and one folder)
are grouped into one JSON array, and each array becomes one file.

All files are compressed, a few times smaller than the plain text; readers
tell by the file name.  A compressed file is read by one task, so files hold
at most ``MOST_RECORDS`` lines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapmart.sinks import fs

_FOLDER = "__snapshot_folder"
CODEC = "snappy"
MOST_RECORDS = 500_000


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh directory below the session's shared checkpoint folder."""
    from lapmart.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lapmart-{name}-{uuid.uuid4().hex[:12]}"


def _file_name(rel_path: str) -> str:
    # a glob in the entity path ("lap_times_split*.csv") gets a concrete name
    return rel_path.replace("*", "_1")


def _move_into_place(spark: SparkSession, staging: str, raw_root: str, rel_path: str) -> list[str]:
    moved = []
    prefix = f"{_FOLDER}="
    for d in fs.list_dirs(spark, staging):
        if not d.startswith(prefix):
            continue
        folder = d[len(prefix):]
        dst = f"{raw_root.rstrip('/')}/{folder}/{_file_name(rel_path)}"
        if not fs.rename(spark, f"{staging}/{d}", dst):
            raise OSError(f"could not move {staging}/{d} to {dst}")
        moved.append(folder)
    fs.delete(spark, staging)
    return sorted(moved)


def write_snapshots(df: DataFrame, raw_root: str, rel_path: str, fmt: str, folder_col: str,
                    header: bool = False, multiline: bool = False,
                    records_per_file: int = 50_000) -> list[str]:
    """Write ``df`` (raw columns + ``folder_col``) below ``raw_root``; returns folders."""
    spark = df.sparkSession
    staging = f"{raw_root.rstrip('/')}/_staging_{uuid.uuid4().hex[:12]}"
    data_cols = [c for c in df.columns if c != folder_col]

    def writer(rows: DataFrame, most: int = MOST_RECORDS):
        return (rows.write.partitionBy(_FOLDER).option("compression", CODEC)
                .option("maxRecordsPerFile", most))

    lines = df.select(*data_cols, F.col(folder_col).alias(_FOLDER))
    if fmt == "csv":
        writer(lines).option("header", str(header).lower()).option("nullValue", "").csv(staging)
    elif fmt == "json" and not multiline:
        writer(lines).json(staging)
    elif fmt == "text":                        # lines as they are, in the one data column
        writer(lines).text(staging)
    elif fmt == "json":
        rec = F.to_json(F.struct(*data_cols))
        # consecutive ids within a task: each (folder, c) group holds at most
        # records_per_file rows, whatever the key distribution
        chunk = F.floor(F.monotonically_increasing_id() / F.lit(records_per_file))
        chunks = (df.select(F.col(folder_col).alias(_FOLDER), chunk.alias("c"), rec.alias("r"))
                  .groupBy(_FOLDER, "c")
                  .agg(F.concat(F.lit("[\n "), F.array_join(F.collect_list("r"), ",\n "),
                                F.lit("\n]")).alias("value")))
        writer(chunks.select(_FOLDER, "value"), 1).text(staging)
    else:
        raise ValueError(f"unsupported raw format {fmt}")
    return _move_into_place(spark, staging, raw_root, rel_path)
