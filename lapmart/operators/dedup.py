"""Newest row per business key (WIN-01, WIN-02, WIN-03)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType, MapType, StructType

_RN = "__rn"


def orderable_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns usable as a sort tie-break (maps cannot be ordered)."""
    skip = set(exclude)
    out = []
    for f in df.schema.fields:
        if f.name in skip or isinstance(f.dataType, MapType):
            continue
        if isinstance(f.dataType, (ArrayType, StructType)) and "map<" in f.dataType.simpleString():
            continue
        out.append(f.name)
    return out


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
              tiebreak: Sequence[Column] | None = None, spread: bool = True) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order`` then ``tiebreak``.

    ``order`` lists the reference's ordering (e.g. ``file_date`` desc).  When
    ``tiebreak`` is None every remaining column is appended ascending, which
    makes the choice a total order on row content: reruns pick the same row
    and an SQL engine can reproduce it.

    The ``row_number() ... = 1`` shape is kept on purpose: Catalyst turns it
    into a WindowGroupLimit that already keeps one row per key and map
    partition *before* the shuffle, so a hot key (many copies of one record)
    is collapsed map-side instead of landing whole in one task.
    """
    keys = list(keys)
    if tiebreak is None:
        tiebreak = [F.col(c).asc_nulls_first() for c in orderable_columns(df, exclude=keys)]
    # For non-integral keys a 64-bit hash of the key leads the partition spec.
    # It is a function of the key, so the groups are unchanged, but the sorts
    # (map-side limit and reduce side) compare a well-spread long prefix
    # instead of falling through to string comparisons.  Integral keys are
    # their own good prefix and keep the plain hash partitioning on the key,
    # which a table bucketed by that key can join without a shuffle.
    # ``spread=False`` is for a first key that is such a prefix, and by which
    # the rows lie and a join that follows wants them sorted.
    integral = not spread or all(isinstance(df.schema[k].dataType, IntegralType) for k in keys)
    spec = keys if integral else [F.xxhash64(*keys), *keys]
    w = Window.partitionBy(*spec).orderBy(*order, *tiebreak)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_by_version(df: DataFrame, keys: Sequence[str], file_date: str = "file_date",
                      ingestion_date: str = "ingestion_date") -> DataFrame:
    """Silver dedup for every entity: newest snapshot folder, then newest load."""
    order = [F.col(file_date).desc_nulls_last()]
    if ingestion_date in df.columns:
        order.append(F.col(ingestion_date).desc_nulls_last())
    return latest_by(df, keys, order)
