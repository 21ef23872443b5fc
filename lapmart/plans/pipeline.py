"""Run the layers in the reference's order: bronze (8) → silver (8) → gold (3).

Plain function calls replace the notebook runners; every step is one or a
few Spark jobs.  ``python -m lapmart.plans.pipeline RAW LAKE`` runs it on a
local session.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from lapmart.plans import bronze, gold, silver


def run_pipeline(spark: SparkSession, raw_root: str, lake_root: str,
                 databases: tuple[str, str, str] | None = None) -> dict:
    """Batch run over every snapshot folder; returns the published paths."""
    lake = lake_root.rstrip("/")
    paths = {"bronze": f"{lake}/bronze", "silver": f"{lake}/silver", "gold": f"{lake}/gold"}
    b_db, s_db, g_db = databases or (None, None, None)
    out = {"bronze": bronze.ingest_bronze(spark, raw_root, paths["bronze"])}
    if b_db:
        from lapmart.sinks import tables
        tables.create_database(spark, b_db)
        for e, p in out["bronze"].items():
            tables.register_external(spark, f"`{b_db}`.`{e}`", p, replace=True)
    out["silver"] = silver.build_all_silver(spark, paths["bronze"], paths["silver"], s_db)
    out["gold"] = gold.build_gold(spark, paths["silver"], paths["gold"], g_db)
    return out


if __name__ == "__main__":
    from lapmart.session import local_session

    s = local_session()
    print(run_pipeline(s, sys.argv[1], sys.argv[2], ("bronze", "silver", "gold")))
    s.stop()
