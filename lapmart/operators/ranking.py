"""``rank()`` within a partition, computed without one task per partition (WIN-04).

``rank() OVER (PARTITION BY p ORDER BY v DESC)`` is ``1 + #{rows of p with a
larger v}`` (NULLs last, ties share a rank, gaps follow).  A plain window
sends every row of one partition value (a season) to one task.  Here:

1. ``V``  = distinct ``(p, v)`` with their multiplicity ``n`` — a hash
   aggregate with map-side combine, so a hot tie (many rows with the same
   value) collapses before the shuffle.
2. Per ``p``, approximate quantiles of ``v`` split ``V`` into ordered buckets;
   a bucket is a function of the value, so ties never straddle buckets.
3. Inside each ``(p, bucket)``: number of rows with a larger value
   (running sum of ``n`` over the bucket, values descending).
4. Per ``p``: rows in all higher buckets (a running sum over at most
   ``buckets + 1`` rows per ``p``).
5. ``rank = 1 + (3) + (4)``, joined back to the rows on ``(p, v)``.

Quantiles only steer the balance; any boundaries give the exact rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Rows of a bucket, one task's work; the number of buckets follows the rows.
ROWS_PER_BUCKET = 1_000_000
LEAST_BUCKETS = 16
MOST_BUCKETS = 5_000             # finer quantiles than the sketch's accuracy don't help
# A partition proven to hold at most this many rows is ranked with a plain
# window (one task per partition value is then a bounded amount of work).
PLAIN_WINDOW_MAX_ROWS = 2_000_000


def _null_safe_on(left: DataFrame, right: DataFrame, pairs):
    cond = None
    for lc, rc in pairs:
        c = left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    return cond


def rank_desc(df: DataFrame, partition_cols: Sequence[str], value_col: str,
              out_col: str = "rank", buckets: int | None = None,
              partition_rows_bound: int | None = None) -> DataFrame:
    """Add ``out_col`` = ``rank()`` over ``partition_cols`` ordered by ``value_col`` desc.

    ``partition_rows_bound`` is a proven upper bound of the rows sharing one
    partition value (e.g. a season holds at most one row per driver, so the
    measured size of the drivers dimension bounds it).  Within
    ``PLAIN_WINDOW_MAX_ROWS`` the plain window is used; without a bound, or
    beyond it, the bucketed form spreads one partition value over many tasks.
    """
    p = list(partition_cols)
    v = value_col
    small = partition_rows_bound is not None and partition_rows_bound <= PLAIN_WINDOW_MAX_ROWS
    if small or not isinstance(df.schema[v].dataType, NumericType):
        return rank_desc_window(df, p, v, out_col)

    # The rows are read several times below: cut the lineage once (reliable
    # checkpoint in the cluster's shared checkpoint folder) so the upstream
    # plan is not recomputed and the small per-season tables can be measured.
    from lapmart.operators.joins import broadcast_if_bounded
    from lapmart.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-df.count() // ROWS_PER_BUCKET)))

    pv = [f"__p{i}" for i in range(len(p))]
    vals = (df.groupBy(*p, v).agg(F.count(F.lit(1)).alias("__n"))
            .select(*[F.col(a).alias(b) for a, b in zip(p, pv)], F.col(v).alias("__v"), "__n"))

    fractions = [i / buckets for i in range(1, buckets)]
    bounds = (vals.where(F.col("__v").isNotNull())
              .groupBy(*pv)
              .agg(F.percentile_approx(F.col("__v").cast("double"), fractions, 10000)
                   .alias("__b"))
              .select(*[F.col(c).alias(c + "b") for c in pv], "__b"))

    # one row per season, which AQE broadcasts by its measured size
    bounds = broadcast_if_bounded(bounds)
    tagged = vals.join(bounds, _null_safe_on(vals, bounds, [(c, c + "b") for c in pv]), "left")
    bucket = F.when(F.col("__v").isNull(), F.lit(buckets)).otherwise(
        F.size(F.filter(F.coalesce(F.col("__b"), F.array().cast("array<double>")),
                        lambda x: x > F.col("__v").cast("double"))))
    tagged = tagged.select(*pv, "__v", "__n", bucket.alias("__k"))

    above = Window.partitionBy(*pv, "__k").orderBy(F.col("__v").desc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    tagged = tagged.withColumn("__above", F.coalesce(F.sum("__n").over(above), F.lit(0)))

    per_bucket = tagged.groupBy(*pv, "__k").agg(F.sum("__n").alias("__t"))
    higher = Window.partitionBy(*pv).orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.withColumn("__off", F.coalesce(F.sum("__t").over(higher), F.lit(0))) \
        .select(*[F.col(c).alias(c + "o") for c in pv], F.col("__k").alias("__ko"), "__off")
    per_bucket = broadcast_if_bounded(per_bucket)        # at most buckets+1 rows per season

    ranked = tagged.join(
        per_bucket,
        _null_safe_on(tagged, per_bucket, [(c, c + "o") for c in pv] + [("__k", "__ko")]),
        "inner",
    ).select(*pv, "__v", (F.lit(1) + F.col("__off") + F.col("__above")).cast("int").alias(out_col))

    # distinct (season, value) pairs: usually few (point totals repeat), then
    # broadcast and the rows are never shuffled for this join, whatever the
    # ties; beyond the bound a shuffle join (AQE splits a hot tie group)
    ranked = broadcast_if_bounded(ranked)
    cond = _null_safe_on(df, ranked, list(zip(p, pv)) + [(v, "__v")])
    return df.join(ranked, cond, "inner").drop(*pv, "__v")


def rank_desc_window(df: DataFrame, partition_cols: Sequence[str], value_col: str,
                     out_col: str = "rank") -> DataFrame:
    """Plain-window form, kept as the executable specification for tests."""
    w = Window.partitionBy(*partition_cols).orderBy(F.col(value_col).desc_nulls_last())
    return df.withColumn(out_col, F.rank().over(w))
