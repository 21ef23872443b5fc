"""Null-key quality checks (FLT-03..05, AGG-05).

``null_key_counts`` is the query form (one aggregation, map-side combined);
the write-time gate that blocks a publish lives in ``sinks.tables.null_gate``
and observes the same predicate during the write itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapmart.functions.columns import any_null


def null_key_counts(df: DataFrame, key_cols: Sequence[str], label: str | None = None) -> DataFrame:
    """One row: total rows and rows with a NULL in any of ``key_cols``."""
    cols = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(any_null(key_cols)).alias("null_key_rows")]
    out = df.agg(*cols)
    if label is not None:
        out = out.select(F.lit(label).alias("entity"), "*")
    return out


def assert_no_null_keys(df: DataFrame, key_cols: Sequence[str], what: str = "table") -> None:
    """Eager form of the gate for ad-hoc use (one job)."""
    r = null_key_counts(df, key_cols).first()
    if r["null_key_rows"]:
        raise ValueError(f"DQ failure: {r['null_key_rows']} rows of {what} have NULL in "
                         f"{list(key_cols)}")
