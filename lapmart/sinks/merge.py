"""Merges into versioned tables that write only what they touch (SNK-10, 11, 12, 14; INC-01's compaction).

A merge of a batch into a keyed table

1. writes the batch once to a staging folder, its gate observed on that
   write; all that follows reads the staged rows;
2. finds the units of the table that the batch concerns.  In a partitioned
   table a unit is a partition directory: the partitions of the batch's own
   rows, and those in which the table holds a row of the same key (a row may
   move).  Else a unit is a file that holds a key of the batch.  The look-up
   reads key columns only, within the range of the batch's keys, which is
   pushed down to the files' statistics;
3. merges the rows of these units, and no others, with the batch, and writes
   them as the next version, whose ``_REPLACES`` names the units it stands
   for.  Other units are read where they are: readers of the path go by that
   file, a partitioned named table by the ``LOCATION`` of each partition.

What is collected are names of units and partition values, never rows.  After
``MOST_VERSIONS`` such versions the next merge rewrites the table as a whole,
so reads never join up more than that many folders.  Two merges at a time:
the one that ends later finds that the table has moved on, and fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lapmart.operators.upsert import key_hint, merge_rows, upsert_newest
from lapmart.sinks import fs, tables
from lapmart.sources.rawfiles import scratch_dir

MOST_VERSIONS = 16
# A publish lock older than this was left by a writer that died between two metadata calls.
LOCK_SECONDS = 600
_UNIT = "__unit"


class PublishConflict(RuntimeError):
    """The table has got a newer version since the merge read it."""


def merge_into(spark: SparkSession, base: str, source: DataFrame, keys: Sequence[str],
               update: Sequence[str] | None = None, newest: Sequence[Column] | None = None,
               partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
               gate_observations: Sequence[tuple[Observation, str]] = (),
               info_observations: Sequence[Observation] = (),
               table_name: str | None = None, check_cardinality: bool = True, stage: bool = True) -> str:
    """Merges ``source`` into the keyed table at ``base`` and publishes the result; returns its version directory.

    Matched rows take the ``update`` columns (all of the source's by
    default), or with ``newest`` whichever row comes first in that order;
    other rows of the source are inserted.  The first merge creates the table.
    An unpartitioned table with a ``table_name`` is written as a whole, since
    the catalog gives a table without partitions one location.  ``stage=False``
    is for a source that is a table on disk already.
    """
    keys, parts = list(keys), list(partition_by)
    parent = tables.current_version(spark, base)
    if parent is None:
        return tables.publish(spark, source, base, partition_by, cluster_by, gate_observations, table_name,
                              info_observations)
    staging = scratch_dir(spark, "merge-source")
    try:
        staged = source
        if stage:
            source.write.parquet(staging, compression=tables.CODEC)
            tables.check_gates(gate_observations, base, info_observations)
            staged = spark.read.schema(source.schema).parquet(staging)
        units = tables.live_units(spark, base)
        whole = len(units) >= MOST_VERSIONS or (table_name is not None and not parts)
        touched = units if whole else _touched(spark, units, staged, keys, parts)
        target = tables.read_units(spark, touched)
        if target is None:
            merged = staged
        elif newest is not None:
            merged = upsert_newest(target, staged, keys, newest)
        else:
            merged = merge_rows(target, staged, keys, source.columns if update is None else update,
                                check_cardinality, f"{staging}-keys")
        if whole:
            return tables.publish(spark, merged, base, partition_by, cluster_by, table_name=table_name)
        replaced = [f"{d.rsplit('/', 1)[1]}/{u}" for d, names in touched.items() for u in names]
        return _publish_part(spark, merged, base, parent, replaced, parts, cluster_by, table_name)
    finally:
        fs.delete(spark, staging)
        fs.delete(spark, f"{staging}-keys")


def _touched(spark: SparkSession, units: dict, staged: DataFrame, keys: list[str], parts: list[str]) -> dict:
    """The units that the staged rows concern, by version directory."""
    table = tables.read_units(spark, units, unit_col=_UNIT)
    if table is None:
        return {}
    ends = staged.agg(*(f(k).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("a", F.min), ("b", F.max)))).first()
    near = F.lit(True)
    for i, k in enumerate(keys):
        near = near & F.col(k).between(F.lit(ends[f"a_{i}"]), F.lit(ends[f"b_{i}"]))
    same = table.where(near).select(*keys, *(p for p in parts if p not in keys), _UNIT).join(
        key_hint(staged, staged.select(*keys)), keys, "left_semi")
    if parts:
        moved = same.select(*parts) if not set(parts) <= set(keys) else staged.select(*parts)
        values = staged.select(*parts).union(moved).distinct()
        rows = table.select(*parts, _UNIT).distinct().join(
            F.broadcast(values.select(*(F.col(p).alias(f"_{p}") for p in parts))),  # partition values, one row each
            _all(F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts), "left_semi").select(_UNIT).collect()
    else:
        rows = same.select(_UNIT).distinct().collect()
    out: dict[str, list[str]] = {d: [] for d in units}
    root = next(iter(units)).rsplit("/", 1)[0]
    for r in rows:
        version, unit = unquote(r[_UNIT]).split("/", 1)
        out[f"{root}/{version}"].append(unit.rsplit("/", 1)[0] if parts else unit)
    return {d: sorted(set(names)) for d, names in out.items()}


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _publish_part(spark: SparkSession, df: DataFrame, base: str, parent: str, replaced: list[str], parts: list[str],
                  cluster_by: Sequence[str], table_name: str | None) -> str:
    folder = tables.write_claimed(spark, df, base, parts, cluster_by)
    lock = f"{base.rstrip('/')}/_publish_lock"
    try:
        fs.write_text(spark, f"{folder}/{tables.REPLACES}", "\n".join([parent.rsplit("/", 1)[1], *replaced]))
        age = fs.age_seconds(spark, lock)
        if age is not None and age > LOCK_SECONDS:
            fs.delete(spark, lock)
        if not fs.create_new(spark, lock):
            raise PublishConflict(f"another writer publishes {base} at this moment")
        try:
            now = tables.current_version(spark, base)
            if now != parent:
                raise PublishConflict(f"{base} went from {parent} to {now} during the merge")
            fs.touch(spark, f"{folder}/{tables.MARKER}")
        finally:
            fs.delete(spark, lock)
    except Exception:
        fs.delete(spark, folder)
        raise
    if table_name:
        relocate(spark, table_name, folder, replaced)
    return folder


def relocate(spark: SparkSession, name: str, folder: str, replaced: Sequence[str]) -> None:
    """Points the partitions of a named table that ``folder`` holds at it, and drops those it has emptied."""
    if not spark.catalog.tableExists(name):
        tables.register_live(spark, name, folder.rsplit("/", 1)[0])
        return
    written = fs.list_units(spark, folder)
    for unit in written:
        spec = tables.partition_spec(unit)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}/{unit}'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{folder}/{unit}'")
    for unit in {r.split("/", 1)[1] for r in replaced} - set(written):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({tables.partition_spec(unit)})")
    spark.catalog.refreshTable(name)

