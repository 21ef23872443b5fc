"""Dashboard analyses named by the reference, as DataFrame queries (RPT-01..03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapmart.functions.columns import count_wins


def season_trend(standings: DataFrame, entity_cols: tuple[str, ...] = ("driver_name",)
                 ) -> DataFrame:
    """RPT-01: season-over-season change of points and rank per driver (or team).

    The window partitions by the driver/team; one partition holds one row
    per season, a bounded count.
    """
    w = Window.partitionBy(*entity_cols).orderBy("race_year")
    return standings.select(
        *entity_cols, "race_year", "total_points", "rank",
        F.lag("total_points").over(w).alias("prev_points"),
        (F.col("total_points") - F.lag("total_points").over(w)).alias("points_change"),
        F.lag("rank").over(w).alias("prev_rank"),
    )


def race_statistics(race_results: DataFrame) -> DataFrame:
    """RPT-02: per race name over all seasons: entries, seasons, points, winners."""
    return race_results.groupBy("race_name").agg(
        F.count(F.lit(1)).alias("entries"),
        F.countDistinct("race_year").alias("seasons"),
        F.min("race_year").alias("first_year"),
        F.max("race_year").alias("last_year"),
        F.sum("points").alias("total_points"),
        F.max("points").alias("max_points"),
        count_wins("race_position").alias("wins_recorded"),
    )


def circuit_distribution(circuits: DataFrame, races: DataFrame) -> DataFrame:
    """RPT-03: circuits and races per country (aggregate first, then join)."""
    per_circuit = races.groupBy("circuit_id").agg(F.count(F.lit(1)).alias("n_races"))
    c = circuits.select("circuit_id", "country", "latitude", "longitude")
    j = c.join(per_circuit, "circuit_id", "left")
    return j.groupBy("country").agg(
        F.count(F.lit(1)).alias("n_circuits"),
        F.coalesce(F.sum("n_races"), F.lit(0)).alias("n_races"),
        F.min("latitude").alias("min_latitude"),
        F.max("latitude").alias("max_latitude"),
        F.min("longitude").alias("min_longitude"),
        F.max("longitude").alias("max_longitude"),
    )
