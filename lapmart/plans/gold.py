"""Gold datasets (DS-G1..3): race results, driver and constructor standings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapmart.functions.columns import count_wins, exact_sum
from lapmart.operators.dedup import latest_by
from lapmart.operators.joins import (
    RESULT_ORDER_COLS,
    names_tell_races,
    race_results_star,
)
from lapmart.operators.ranking import rank_desc
from lapmart.schemas import GOLD_PROCESSED_AT, GOLD_RACE_RESULTS_KEYS

RACE_RESULTS_COLUMNS = (
    "race_year", "race_name", "race_date", "circuit_location", "circuit_country",
    "driver_name", "driver_number", "driver_nationality", "team", "grid", "fastest_lap",
    "race_position", "race_time", "points",
)


def race_results_deduped(results: DataFrame, races: DataFrame, circuits: DataFrame,
                         drivers: DataFrame, constructors: DataFrame, **attributes) -> DataFrame:
    """WIN-03 on the star join: one row per (race_year, race_name, driver_name).

    The reference orders this dedup by a per-query constant, i.e. keeps an
    arbitrary row; here the smallest ``result_id`` wins and the dimension
    ids and result columns break any further tie, so the choice is
    reproducible (rows tied on all of them give identical gold rows).
    """
    order = [F.col(c).asc_nulls_first() for c in RESULT_ORDER_COLS]
    dims = (races, circuits, drivers, constructors)
    if names_tell_races(results, races, circuits):
        # wide rows stay where the join by race_id needs them
        return race_results_star(results, *dims, **attributes, reduced=lambda rows: latest_by(
            rows, ("race_id", "driver_name"), order, [], spread=False))
    return latest_by(race_results_star(results, *dims, **attributes), GOLD_RACE_RESULTS_KEYS, order, [])


def race_results(results: DataFrame, races: DataFrame, circuits: DataFrame,
                 drivers: DataFrame, constructors: DataFrame, stamp: bool = True) -> DataFrame:
    """DS-G1: five-table star join, deduplicated, with the gold columns.

    Each dimension is joined once; its columns travel through the one dedup shuffle.
    """
    out = race_results_deduped(
        results, races, circuits, drivers, constructors, race_attributes=True, team=True,
        driver_cols=(("number", "driver_number"), ("nationality", "driver_nationality"))) \
        .select(*RACE_RESULTS_COLUMNS)
    if stamp:
        out = out.withColumn(GOLD_PROCESSED_AT, F.current_timestamp())
    return out


def season_standings(race_results_df: DataFrame, group_cols: tuple[str, ...],
                     stamp: bool = True, season_rows_bound: int | None = None) -> DataFrame:
    """Points and wins per group and season, ranked within the season.

    ``season_rows_bound``: proven bound of standings rows per season (the
    measured size of the dimension that supplies the group key); lets the
    rank use a plain window when a season is provably small.
    """
    # sums of doubles must not depend on the order of rows: ranks go by them
    fractional = race_results_df.schema["points"].dataType.typeName() in ("double", "float")
    points = exact_sum("points") if fractional else F.sum("points")
    agg = race_results_df.groupBy(*group_cols).agg(
        points.alias("total_points"),
        count_wins("race_position").alias("number_of_wins"),
    )
    out = rank_desc(agg, ["race_year"], "total_points", out_col="rank",
                    partition_rows_bound=season_rows_bound)
    out = out.select(*group_cols, "total_points", "number_of_wins", "rank")
    if stamp:
        out = out.withColumn(GOLD_PROCESSED_AT, F.current_timestamp())
    return out


def standings_from_silver(results: DataFrame, races: DataFrame, circuits: DataFrame,
                          drivers: DataFrame, constructors: DataFrame, kind: str,
                          stamp: bool = True) -> DataFrame:
    """Standings straight from the silver entities, without the wide gold row.

    Same rows as computing race results and then standings from them: only
    the columns the aggregate needs are carried through the dedup shuffle.
    """
    if kind == "driver":
        d = race_results_deduped(results, races, circuits, drivers, constructors,
                                 driver_cols=(("nationality", "driver_nationality"),))
        return driver_standings(d, stamp, drivers=drivers)
    d = race_results_deduped(results, races, circuits, drivers, constructors, team=True)
    return constructor_standings(d, stamp, constructors=constructors)


def driver_standings(race_results_df: DataFrame, stamp: bool = True,
                     drivers: DataFrame | None = None) -> DataFrame:
    """Driver standings; pass the drivers dimension to bound a season's size (its row count is read now)."""
    bound = drivers.select("driver_id").count() if drivers is not None else None
    return season_standings(race_results_df, ("race_year", "driver_nationality", "driver_name"),
                            stamp, bound)


def constructor_standings(race_results_df: DataFrame, stamp: bool = True,
                          constructors: DataFrame | None = None) -> DataFrame:
    """Constructor standings; pass the constructors dimension to bound a season."""
    bound = constructors.select("constructor_id").count() if constructors is not None else None
    return season_standings(race_results_df, ("race_year", "team"), stamp, bound)


# --------------------------------------------------------------------------- pipeline

def _publish_path_and_table(spark, df: DataFrame, gold_root: str, name: str,
                            keys, update, table_name: str | None) -> tuple[str, str]:
    """Path copy = this run's result (SNK-04/05); table copy = merge of it
    into the previous table version with the dataset's update list (SNK-12), season by season."""
    from lapmart.sinks import tables
    from lapmart.sinks.merge import merge_into

    root = gold_root.rstrip("/")
    path_version = tables.publish(spark, df, f"{root}/{name}", partition_by=("race_year",))
    table_version = merge_into(spark, f"{root}/_tables/{name}", spark.read.parquet(path_version), keys, update,
                               partition_by=("race_year",), table_name=table_name, stage=False)
    return path_version, table_version


def build_gold(spark, silver_root: str, gold_root: str, database: str | None = None) -> dict:
    """DS-G1..3 in the reference's order; standings read race results' path copy."""
    from lapmart.plans.silver import read_silver
    from lapmart.schemas import (
        GOLD_CONSTRUCTOR_STANDINGS_KEYS,
        GOLD_CONSTRUCTOR_STANDINGS_UPDATE,
        GOLD_DRIVER_STANDINGS_KEYS,
        GOLD_DRIVER_STANDINGS_UPDATE,
        GOLD_RACE_RESULTS_UPDATE,
    )
    from lapmart.sinks import tables

    if database:
        tables.create_database(spark, database)

    def tname(n):
        return f"`{database}`.`{n}`" if database else None

    s = {e: read_silver(spark, silver_root, e)
         for e in ("results", "races", "circuits", "drivers", "constructors")}
    rr = race_results(s["results"], s["races"], s["circuits"], s["drivers"], s["constructors"])
    out = {"race_results": _publish_path_and_table(
        spark, rr, gold_root, "race_results", GOLD_RACE_RESULTS_KEYS,
        GOLD_RACE_RESULTS_UPDATE, tname("race_results"))}
    rr_path = spark.read.parquet(out["race_results"][0])
    ds = driver_standings(rr_path, drivers=s["drivers"])
    out["driver_standings"] = _publish_path_and_table(
        spark, ds, gold_root, "driver_standings", GOLD_DRIVER_STANDINGS_KEYS,
        GOLD_DRIVER_STANDINGS_UPDATE, tname("driver_standings"))
    cs = constructor_standings(rr_path, constructors=s["constructors"])
    out["constructor_standings"] = _publish_path_and_table(
        spark, cs, gold_root, "constructor_standings", GOLD_CONSTRUCTOR_STANDINGS_KEYS,
        GOLD_CONSTRUCTOR_STANDINGS_UPDATE, tname("constructor_standings"))
    return out


def read_gold(spark, gold_root: str, name: str, table: bool = False) -> DataFrame:
    from lapmart.sinks import tables
    root = gold_root.rstrip("/")
    return tables.read_current(spark, f"{root}/_tables/{name}" if table else f"{root}/{name}")
