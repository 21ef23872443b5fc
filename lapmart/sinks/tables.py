"""Table writes: append, overwrite, versioned publish, layout, catalog (SNK-01..17).

A *keyed table* (silver entities, gold datasets) lives at a base path as a
series of immutable version directories::

    <base>/_v000001/part-*.parquet      (+ _PUBLISHED marker once valid)
    <base>/_v000002/...

Readers take the highest version carrying ``_PUBLISHED``.  A run claims the
next number (a file created only if absent, so two writers never share a
directory), writes it (never the directory it is reading, which Spark cannot
do), checks its quality gate, and only then drops the marker.  A failed gate
removes its version; a crash leaves an unmarked directory that no reader
sees.  Names starting with ``_`` are skipped by Spark's file listing, so a
plain ``spark.read.parquet(base)`` sees no half-written data.

A version may also hold only what a merge has touched (``sinks.merge``): its
file ``_REPLACES`` names the version it was made from and the units of older
versions, partition directories or files, that its own stand for.  All other
units are read where they are.

This replaces the reference's row-level MERGE on a transactional table
format, which plain Parquet does not offer.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lapmart.sinks import fs

MARKER = "_PUBLISHED"
LOAD = "load_id"                 # partition folder of one load of a history
REPLACES = "_REPLACES"
SCHEMA = "_schema.json"           # columns of an append-only history
CODEC = "zstd"                    # of loads and versions, which are written once and read often
_CLAIM = "_claim_v"
_PREFIX = "_v"


class QualityGateError(RuntimeError):
    """Raised when a staged write violates its gate; nothing is published."""


# --------------------------------------------------------------------------- plain writes

class SchemaConflict(ValueError):
    """An append has a column of a type that the history's can't be widened to."""


# What files of the first type can be read as, in order of width (fixed values of the Parquet reader).
_WIDER = {"byte": ("short", "integer", "long"), "short": ("integer", "long"), "integer": ("long",),
          "float": ("double",), "date": ("timestamp_ntz",)}


def evolved(old: StructType | None, new: StructType) -> StructType:
    """The union of two schemas: the old columns, widened where the new ones are wider, then those that are new."""
    if old is None:
        return StructType([StructField(f.name, f.dataType, True) for f in new.fields])
    add = {f.name: f.dataType for f in new.fields}
    out = []
    for f in old.fields:
        kind, other = f.dataType, add.pop(f.name, f.dataType)
        if kind != other:
            if other.typeName() in _WIDER.get(kind.typeName(), ()):
                kind = other
            elif kind.typeName() not in _WIDER.get(other.typeName(), ()):
                raise SchemaConflict(f"column {f.name}: {other.simpleString()} does not go into {kind.simpleString()}")
        out.append(StructField(f.name, kind, True))
    return StructType([*out, *(StructField(n, t, True) for n, t in add.items())])


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """SNK-01/02: append to a history whose columns may grow.

    The union of all batches' columns is kept beside the files, so that a
    reader need not look into them.  It is written before the batch: a batch
    that fails leaves a column that no row has yet.  A batch whose types don't
    go with the history's raises, and nothing is written.
    """
    spark = df.sparkSession
    file = f"{path.rstrip('/')}/{SCHEMA}"
    said = fs.read_text(spark, file)
    old = StructType.fromJson(json.loads(said)) if said else None
    schema = evolved(old, df.schema)
    if schema != old:
        fs.write_text(spark, file, schema.json())
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """SNK-05: replace a path from a *different* input."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_load(df: DataFrame, path: str, load: str) -> None:
    """Write one load of an append-only history; a repeated load replaces itself."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{LOAD}={load}", compression=CODEC)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """A history whose batches may differ in columns, by the schema that ``append`` keeps: no footer is read.

    A path that was not written by ``append`` has its files' schemas merged.
    """
    said = fs.read_text(spark, f"{path.rstrip('/')}/{SCHEMA}")
    if said is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(StructType.fromJson(json.loads(said))).parquet(path)


def clustered(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str],
              num_partitions: int | None = None) -> DataFrame:
    """SNK-17: write layout that co-locates keys (replaces ``OPTIMIZE … ZORDER BY``).

    Range partitioning on (partition columns, cluster columns) gives each
    output file a narrow key range, so Parquet min/max statistics skip files
    for key lookups; sorting inside each task keeps row groups tight.
    """
    cols = [*partition_by, *cluster_by]
    if not cols:
        return df
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions
              else df.repartitionByRange(*cols))
    return ranged.sortWithinPartitions(*cols)


# Quantiles that place a column's values, and with them the bits of its part of a Z value.
Z_BITS = 8


def _rank(value: Column, ends: list[float]) -> Column:
    """How many of the ends a value reaches."""
    if not ends:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, ends)), lambda x: x <= value)), F.lit(0))


def z_value(df: DataFrame, cols: Sequence[str], bits: int = Z_BITS) -> Column:
    """A number that interleaves the bits of the columns' quantile ranks.

    Ranks go by ``2**bits`` approximate quantiles of each column (numbers,
    dates and timestamps), the only values that come to the driver; a NULL has rank 0.
    """
    numeric = {c: F.col(c).cast("timestamp").cast("double") if df.schema[c].dataType.typeName() in (
        "date", "timestamp", "timestamp_ntz") else F.col(c).cast("double") for c in cols}
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(*(F.percentile_approx(e, steps, 10_000).alias(c) for c, e in numeric.items())).first()
    z = F.lit(0).cast("long")
    for j, (c, e) in enumerate(numeric.items()):
        rank = _rank(e, sorted(set(bounds[c] or ())))
        for b in range(bits):
            bit = F.shiftright(rank.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            z = z + F.shiftleft(bit, b * len(cols) + j)
    return z


def z_clustered(df: DataFrame, cols: Sequence[str], num_partitions: int | None = None,
                bits: int = Z_BITS) -> DataFrame:
    """SNK-17 on several columns: files are ranges of the Z value, so a filter on any of ``cols`` skips files."""
    name = "__z"
    keyed = df.withColumn(name, z_value(df, cols, bits))
    ranged = keyed.repartitionByRange(num_partitions, name) if num_partitions else keyed.repartitionByRange(name)
    return ranged.sortWithinPartitions(name).drop(name)


# --------------------------------------------------------------------------- versions

def _versions(spark: SparkSession, base: str) -> list[int]:
    out = []
    for name in fs.list_dirs(spark, base):
        if name.startswith(_PREFIX) and name[len(_PREFIX):].isdigit():
            out.append(int(name[len(_PREFIX):]))
    return sorted(out)


def _vdir(base: str, v: int) -> str:
    return f"{base.rstrip('/')}/{_PREFIX}{v:06d}"


def current_version(spark: SparkSession, base: str) -> str | None:
    """Directory of the newest published version, or None."""
    for v in reversed(_versions(spark, base)):
        d = _vdir(base, v)
        if fs.exists(spark, f"{d}/{MARKER}"):
            return d
    return None


def table_exists(spark: SparkSession, base: str) -> bool:
    """SNK-13 for path tables: is there a published version?"""
    return current_version(spark, base) is not None


def live_units(spark: SparkSession, base: str) -> dict[str, list[str] | None]:
    """Per version directory the units that the newest published version consists of, newest first.

    None stands for a whole directory.  Only names are listed.
    """
    out: dict[str, list[str] | None] = {}
    at, gone = current_version(spark, base), set()
    while at is not None:
        said = fs.read_text(spark, f"{at}/{REPLACES}")
        name = at.rsplit("/", 1)[1]
        if said is None and not gone:
            out[at] = None
        else:
            out[at] = [u for u in fs.list_units(spark, at) if f"{name}/{u}" not in gone]
        if said is None:
            break
        parent, *replaced = said.split("\n")
        gone |= set(replaced)
        at = f"{base.rstrip('/')}/{parent}"
    return out


def read_units(spark: SparkSession, units: dict[str, list[str] | None], unit_col: str | None = None) -> DataFrame | None:
    """One scan per version directory, of the units listed; with ``unit_col`` each row's "version/path of its file"."""
    out = None
    for folder, names in units.items():
        if names is not None and not names:
            continue
        reader = spark.read.option("basePath", folder)
        df = reader.parquet(folder) if names is None else reader.parquet(*(f"{folder}/{u}" for u in names))
        if unit_col:
            df = df.select("*", F.regexp_extract(F.col("_metadata.file_path"), r"/(_v\d{6,}/.*)$", 1).alias(unit_col))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_current(spark: SparkSession, base: str) -> DataFrame:
    """The newest published version; partition columns follow the others."""
    units = live_units(spark, base)
    if not units:
        raise FileNotFoundError(f"no published version under {base}")
    if list(units.values()) == [None]:
        # one version is written by one job with one schema: no footer merging
        return spark.read.parquet(next(iter(units)))
    df = read_units(spark, units)
    return df if df is not None else spark.read.parquet(next(iter(units)))


def null_gate(cols: Sequence[str], name: str = "null_key_gate"
              ) -> Callable[[DataFrame], tuple[DataFrame, Observation, str]]:
    """FLT-03..05: gate spec counting rows whose key columns hold a NULL."""
    def attach(df: DataFrame):
        obs = Observation(name)
        pred = F.lit(False)
        for c in cols:
            pred = pred | F.col(c).isNull()
        observed = df.observe(obs, F.count_if(pred).alias("violations"),
                              F.count(F.lit(1)).alias("rows"))
        return observed, obs, ", ".join(cols)
    return attach


def _claim(spark: SparkSession, base: str) -> int:
    """A version number that no other writer has or gets."""
    taken = [int(n[len(_CLAIM):]) for n in fs.list_names(spark, base) if n.startswith(_CLAIM)]
    v = max([0, *taken, *_versions(spark, base)]) + 1
    while not fs.create_new(spark, f"{base.rstrip('/')}/{_CLAIM}{v:06d}"):
        v += 1
    return v


def check_gates(gates: Sequence[tuple[Observation, str]], what_for: str, info: Sequence[Observation] = ()) -> None:
    """Raises unless the write just done has reported 0 violations for each gate."""
    for obs, what in gates:
        m = obs.get
        if m.get("violations") is None:
            raise QualityGateError(f"quality gate of {what_for}: the write reported no metric for ({what}); "
                                   "not published")
        if int(m["violations"]) > 0:
            extra = "".join(f"; {o.get}" for o in info)
            raise QualityGateError(
                f"quality gate failed for {what_for}: {m['violations']} of {m.get('rows')} rows "
                f"have NULL in ({what}); not published{extra}")


def write_claimed(spark: SparkSession, df: DataFrame, base: str, partition_by: Sequence[str] = (),
                  cluster_by: Sequence[str] = (), check: Callable[[], None] = lambda: None) -> str:
    """Writes ``df`` to a version directory of its own, unpublished; one that fails, or whose check does, goes."""
    target = _vdir(base, _claim(spark, base))
    try:
        out = clustered(df, partition_by, cluster_by) if cluster_by else df
        w = out.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(target, compression=CODEC)
        check()
    except Exception:
        fs.delete(spark, target)
        raise
    return target


def publish(spark: SparkSession, df: DataFrame, base: str,
            partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
            gate_observations: Sequence[tuple[Observation, str]] = (),
            table_name: str | None = None,
            info_observations: Sequence[Observation] = ()) -> str:
    """SNK-14: write ``df`` as the next version of ``base`` and publish it.

    ``gate_observations`` are Observations attached to (parts of) ``df`` whose
    plan no other action has run: their metrics are those of this write.
    ``violations`` must be there and 0, else :class:`QualityGateError` is
    raised and the version is removed.  ``info_observations`` (e.g. NULL keys
    before a dedup collapsed them) are only reported in the error message.
    ``table_name`` (optional) is pointed at the new version afterwards.
    """
    target = write_claimed(spark, df, base, partition_by, cluster_by,
                           lambda: check_gates(gate_observations, base, info_observations))
    fs.touch(spark, f"{target}/{MARKER}")
    if table_name:
        register_external(spark, table_name, target, replace=True)
    return target


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` published versions, what these are made from, and stale unpublished ones."""
    cur = current_version(spark, base)
    if cur is None:
        return []
    published = [v for v in _versions(spark, base)
                 if fs.exists(spark, f"{_vdir(base, v)}/{MARKER}")]
    keep_set = {_vdir(base, v) for v in published[-keep:]}
    for d in list(keep_set):
        said = fs.read_text(spark, f"{d}/{REPLACES}")
        while said is not None:
            d = f"{base.rstrip('/')}/{said.split(chr(10), 1)[0]}"
            keep_set.add(d)
            said = fs.read_text(spark, f"{d}/{REPLACES}")
    newest = max(_versions(spark, base))
    removed = []
    for v in _versions(spark, base):
        if _vdir(base, v) in keep_set or v > published[-1] or v == newest:
            continue
        fs.delete(spark, _vdir(base, v))
        removed.append(_vdir(base, v))
    return removed


# --------------------------------------------------------------------------- catalog

def create_database(spark: SparkSession, name: str) -> None:
    """SNK-15 (names are always qualified afterwards; no ``USE``)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def register_external(spark: SparkSession, name: str, path: str, replace: bool = False) -> None:
    """A named table over a path; it always shows the files, never a stale copy.

    ``replace`` moves an existing table of the same columns to the path with
    ``SET LOCATION``, so readers never miss it; a partitioned table, whose
    partitions keep their own locations, and one of other columns are made
    anew.
    """
    if replace and spark.catalog.tableExists(name):
        same = [(f.name, f.dataType) for f in spark.table(name).schema] == [
            (f.name, f.dataType) for f in spark.read.parquet(path).schema]
        if same and not _is_partitioned(spark, name):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if _is_partitioned(spark, name):
        # partition directories written by Spark are registered in the catalog
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def partition_spec(unit: str) -> str:
    """SQL of a partition from its directory, ``race_year=2020``."""
    out = []
    for part in unit.split("/"):
        k, _, v = part.partition("=")
        value = unquote(v).replace("\\", "\\\\").replace("'", "\\'")
        out.append(f"`{k}`=" + ("null" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{value}'"))
    return ", ".join(out)


def register_live(spark: SparkSession, name: str, base: str) -> None:
    """A named table over the newest version of a partitioned table, each partition at its own location."""
    units = live_units(spark, base)
    newest = next(iter(units))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    register_external(spark, name, newest)
    for folder, names in list(units.items())[1:]:
        for unit in fs.list_units(spark, folder) if names is None else names:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({partition_spec(unit)}) "
                      f"LOCATION '{folder}/{unit}'")
    spark.catalog.refreshTable(name)


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE {name}").collect()
    return any((r["col_name"] or "").startswith("# Partition") for r in rows)


def create_table_once_as(spark: SparkSession, name: str, path: str) -> None:
    """SNK-06: ``CREATE TABLE IF NOT EXISTS … AS SELECT * FROM parquet.`path```;
    later calls leave the table as it is."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet AS "
              f"SELECT * FROM parquet.`{path}`")


def save_as_new_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """SNK-07/08: create a managed table; fails if it already exists."""
    w = df.write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def replace_table(df: DataFrame, name: str) -> None:
    """SNK-09: create or replace a managed table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def register_view(df: DataFrame, name: str) -> None:
    """SNK-16: a session view (e.g. to express an upsert source in SQL)."""
    df.createOrReplaceTempView(name)


def scan_path_sql(spark: SparkSession, path: str) -> DataFrame:
    """SRC-09: ``SELECT * FROM parquet.`path```."""
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def describe(spark: SparkSession, name: str) -> DataFrame:
    """SRC-11: column names and types of a named table."""
    return spark.sql(f"DESCRIBE TABLE {name}")
