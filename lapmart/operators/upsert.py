"""Keyed upserts as pure DataFrame functions (SNK-10, SNK-11, SNK-12, JN-06).

Semantics of ``MERGE INTO t USING s ON t.k = s.k WHEN MATCHED THEN UPDATE …
WHEN NOT MATCHED THEN INSERT *`` (no delete clause):

* a target row whose key matches a source row is replaced (all columns) or
  takes the listed columns from the source;
* unmatched source rows are inserted, unmatched target rows are kept;
* keys compare with ``=``: a NULL key never matches, so a NULL-key source
  row is inserted again on every run;
* more than one source row matching one target row is an error (checked by default);
* a column that the source lacks keeps its value in matched rows.

Each function returns the merged table as a DataFrame; writing it is the
caller's job (``sinks.tables.publish``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapmart.operators.dedup import latest_by
from lapmart.sources.rawfiles import scratch_dir
from lapmart.operators.joins import DEFAULT_MAX_BYTES, EXPANSION, broadcast_or_merge, input_bytes


class MergeCardinalityError(RuntimeError):
    """Several source rows match the same target row."""


def check_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs more than once in ``source`` and also in ``target``.

    One aggregation over the source keys (map-side combined); the target is
    looked at only if a key repeats, by a semi join with the repeated keys.
    """
    dup = (source.where(_all_not_null(keys))
           .groupBy(*keys).count().where(F.col("count") > 1).select(*keys))
    if dup.isEmpty():
        return
    hit = dup.join(target.select(*keys), list(keys), "left_semi").limit(1).collect()
    if hit:
        raise _several(keys, hit[0])


def _several(keys: Sequence[str], row) -> MergeCardinalityError:
    return MergeCardinalityError(f"several source rows match one target row on {list(keys)}: {row.asDict()}")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_dir(spark, "upsert-source")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_hint(source: DataFrame, side: DataFrame) -> DataFrame:
    """``side``, a projection of the staged ``source``, marked for broadcast if its files' sizes allow; else it is
    never broadcast (Spark takes a few columns for their share of the compressed files)."""
    return F.broadcast(side) if input_bytes(source) * EXPANSION <= DEFAULT_MAX_BYTES else side.hint("merge")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str],
               check_cardinality: bool = False, scratch: str | None = None) -> DataFrame:
    """The merge of a staged ``source`` (a table: it is read twice) into ``target``, safe against hot target keys.

    A full outer join can't be split, so it is taken apart: the target left
    outer joined with the source, whose skewed partitions AQE splits on the
    target's side, and the source's rows without a match.  A source within
    the checked size is broadcast, and the target is not shuffled at all.
    For a larger one keys alone are compared first, combined before the
    shuffle, so whole rows go through no shuffle that doesn't need them: of
    the source those to insert; and where it brings all columns, of the target
    those that it lacks.  What the keys have shown is written to ``scratch``,
    by default a scratch folder, which the caller may delete afterwards.
    """
    keys, upd = list(keys), set(update)
    if input_bytes(source) * EXPANSION <= DEFAULT_MAX_BYTES:
        if check_cardinality:
            check_single_match(target, source, keys)
        updated = _updated(target, source, keys, upd, F.broadcast)
        asked = source.select(*keys)
        hits = target.select(*keys).join(F.broadcast(asked), keys, "left_semi").distinct()
        inserted = source.join(F.broadcast(hits), keys, "left_anti")    # no more keys than the source has
        return updated.unionByName(inserted.select(*source.columns), allowMissingColumns=True)
    known = _all_not_null(keys)
    every = _brings_all(target, source, keys, upd)
    n, m = "__in_target", "__in_source"
    seen = (target.where(known).select(*keys, F.lit(1).alias(n), F.lit(0).alias(m))
            .union(source.where(known).select(*keys, F.lit(0).alias(n), F.lit(1).alias(m)))
            .groupBy(*keys).agg(F.sum(n).alias(n), F.sum(m).alias(m)))
    clash = (F.col(n) > 0) & (F.col(m) > 1)
    if every:
        seen = seen.where((F.col(n) > 0) & ((F.col(m) == 0) | (F.col(n) > 1) | (F.col(m) > 1)))
    else:
        seen = seen.where((F.col(n) == 0) | clash)
    path = scratch or scratch_dir(source.sparkSession, "merge-keys")
    seen.write.parquet(path)
    seen = source.sparkSession.read.schema(seen.schema).parquet(path)
    if check_cardinality:
        hit = seen.where(clash).select(*keys).limit(1).collect()
        if hit:
            raise _several(keys, hit[0])

    def of(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
        return rows.join(broadcast_or_merge(found), keys, how)

    if not every:
        inserted = of(source, seen.where(F.col(n) == 0).select(*keys), "left_semi").unionByName(source.where(~known))
        return _updated(target, source, keys, upd, lambda s: s.hint("merge")).unionByName(
            inserted.select(*source.columns), allowMissingColumns=True)
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    repeated = seen.where((F.col(n) > 1) & (F.col(m) > 0)).select(*keys, n)
    rows = source
    if not repeated.isEmpty():                 # each of the target's rows takes the source's columns
        rows = of(source, repeated, "left").withColumn(m, F.explode(F.sequence(F.lit(1), F.coalesce(n, F.lit(1)))))
    kept = of(target, seen.where(F.col(m) == 0).select(*keys), "left_semi").unionByName(target.where(~known))
    return rows.select(*cols).unionByName(kept, allowMissingColumns=True)


def _brings_all(target: DataFrame, source: DataFrame, keys: Sequence[str], update: set[str]) -> bool:
    """Whether a matched row is the source's row: it takes all columns, keys aside that are equal in all bits, and
    types are alike."""
    same = {k for k in keys if source.schema[k].dataType.typeName() not in ("float", "double")}
    types = {f.name: f.dataType for f in source.schema}
    new = {c for c in source.columns if c not in target.columns}
    return new <= update and all(f.name in update | same and types.get(f.name) == f.dataType for f in target.schema)


def _updated(target: DataFrame, source: DataFrame, keys: Sequence[str], update: set[str],
             mark: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The target's rows, those that the source matches with its columns."""
    s = source.where(_all_not_null(keys)).select(
        *[F.col(c).alias("s__" + c) for c in source.columns], F.lit(True).alias("s__present"))
    t = target.select(*[F.col(c).alias("t__" + c) for c in target.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col("t__" + k) == F.col("s__" + k))
    j = t.join(mark(s), cond, "left_outer")
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    return j.select(*[
        F.when(F.col("s__present"), F.col("s__" + c)).otherwise(F.col("t__" + c) if c in target.columns else F.lit(None))
        .alias(c) if c in update and c in source.columns
        else (F.col("t__" + c) if c in target.columns else F.lit(None).cast(source.schema[c].dataType)).alias(c)
        for c in cols])


def upsert_all(target: DataFrame, source: DataFrame, keys: Sequence[str],
               check_cardinality: bool = True) -> DataFrame:
    """MATCHED → UPDATE SET *, NOT MATCHED → INSERT * (SNK-10/11).

    One full outer join on the key, whatever the sizes: every matching target
    row takes the source's columns, and a target column that the source lacks
    keeps its value.  ``check_cardinality=False`` is for a source that the
    caller has just reduced to one row per key.
    """
    return upsert_columns(target, source, keys, update=list(source.columns),
                          check_cardinality=check_cardinality)


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def upsert_columns(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   update: Sequence[str], check_cardinality: bool = True) -> DataFrame:
    """MATCHED → UPDATE SET only ``update``, NOT MATCHED → INSERT * (SNK-12).

    One full outer join on the key with presence markers; per column a
    ``CASE`` picks the source value for matched rows when the column is in
    the update list, else keeps the target value.  Inserted rows take all
    source columns; columns missing in the source come out NULL.
    """
    keys = list(keys)
    if check_cardinality:
        source = staged(source)                # the check and the join both read what one run has written
        check_single_match(target, source, keys)
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    t = target.select(*[F.col(c).alias("t__" + c) for c in target.columns],
                      F.lit(True).alias("t__present"))
    s = source.select(*[F.col(c).alias("s__" + c) for c in source.columns],
                      F.lit(True).alias("s__present"))
    cond = None
    for k in keys:
        c = F.col("t__" + k) == F.col("s__" + k)
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    matched = F.col("t__present").isNotNull() & F.col("s__present").isNotNull()
    only_src = F.col("t__present").isNull()
    upd = set(update)
    out = []
    for c in cols:
        tc = F.col("t__" + c) if c in target.columns else F.lit(None)
        sc = F.col("s__" + c) if c in source.columns else F.lit(None)
        if c in upd:
            expr = F.when(matched | only_src, sc).otherwise(tc)
        else:
            expr = F.when(only_src, sc).otherwise(tc)
        out.append(expr.alias(c))
    return j.select(*out)


def upsert_newest(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[Column]) -> DataFrame:
    """Upsert where a matched key keeps whichever row is newer under ``order``.

    Used by incremental ingestion: a snapshot arriving late must not
    overwrite a newer row.  Only target rows whose key occurs in the batch
    are re-ranked; the rest pass through the anti join untouched.
    """
    keys = list(keys)
    src_keys = source.select(*keys).dropDuplicates(keys)
    untouched = target.join(src_keys, keys, "left_anti")
    touched = target.join(src_keys, keys, "left_semi")
    cand = touched.unionByName(source, allowMissingColumns=True)
    merged = latest_by(cand.where(_all_not_null(keys)), keys, order)
    # NULL keys never match: such source rows are plain inserts.
    null_keyed = source.where(~_all_not_null(keys))
    return (untouched.unionByName(merged, allowMissingColumns=True)
            .unionByName(null_keyed, allowMissingColumns=True))
