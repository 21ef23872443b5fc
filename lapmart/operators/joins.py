"""Joins with a checked broadcast and the gold star join (JN-01..05)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bound for a broadcast side and how much Parquet bytes may grow in memory.  The driver holds each side as rows
# and as a hash table, several sides at a time, and well encoded files grow more than that: the bound is a small
# part of a driver of 1 GB.
DEFAULT_MAX_BYTES = 16 * 1024 * 1024
EXPANSION = 5


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, as Spark's planner sees them now (no job, nothing kept)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def broadcast_if_bounded(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when what it is made from is within the bound.

    For projections, filters and look-ups by unique key of the tables read:
    their result is no larger than the inputs, expanded in memory.  The sizes
    come from the file listing of the plan at hand, so a table that has grown
    is seen as it is.  Beyond the bound the frame is returned unhinted and
    Spark chooses: a shuffle join with AQE skew splitting, or a broadcast of a
    side that AQE has measured.
    """
    return F.broadcast(df) if is_bounded(df, max_bytes) else df


def is_bounded(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """Whether ``broadcast_if_bounded`` marks ``df``."""
    return input_bytes(df) * EXPANSION <= max_bytes


def broadcast_or_merge(df: DataFrame) -> DataFrame:
    """``df``, a whole table or some of its columns, for broadcast within the bound; beyond it never broadcast.

    Left to itself, Spark takes a few columns of a table for their share of its compressed files, and broadcasts
    millions of rows whose hash table does not fit the driver.  For sides that an aggregate or filter makes small
    see ``broadcast_if_bounded``, which lets AQE measure them.
    """
    return F.broadcast(df) if is_bounded(df) else df.hint("merge")


# Facts of one race that a task may well hold, how many sets of races are counted to see it, the bytes of the
# facts' files that a task gets, and the most tasks so chosen.
MOST_FACTS_OF_A_RACE = 500_000
RACE_SETS = 1 << 14
FACT_BYTES = 6 * 1024 * 1024
MOST_FACT_TASKS = 20_000


def names_tell_races(results: DataFrame, races: DataFrame, circuits: DataFrame) -> bool:
    """Whether facts may be reduced to one per race and driver's name where they lie by ``race_id``, before the names.

    Asked only where the star join shuffles the facts by ``race_id``.  Groups by year and name of the race are those
    by its id if each year and name come from one row, which the races and circuits at hand show.  It is of use
    unless many of the facts are one race's, which a count by sets of races shows.  All are small aggregations.
    """
    if is_bounded(races):
        return False
    named = races.where(F.col("race_id").isNotNull()).groupBy(F.xxhash64("race_year", "name")).count()
    at = circuits.where(F.col("circuit_id").isNotNull()).groupBy("circuit_id").count()
    sets = results.where(F.col("race_id").isNotNull()).groupBy(F.pmod(F.xxhash64("race_id"), F.lit(RACE_SETS))).count()
    return all(found.where(F.col("count") > most).isEmpty()
               for found, most in ((named, 1), (at, 1), (sets, MOST_FACTS_OF_A_RACE)))


# Tables of fewer bytes than this for each core may well be fewer row groups than cores.
SMALL_PER_CORE = 16 * 1024 * 1024


def spread_if_small(df: DataFrame) -> DataFrame:
    """Deals a small table's rows out to all cores before work on each row (joins, sorts).

    A table of one row group is read by one task, and all that follows up to
    the next shuffle would be done there.  A larger table, by its files'
    sizes, has tasks enough, and is left as it is: no shuffle is added there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if input_bytes(df) < cores * SMALL_PER_CORE else df


def race_circuits(races: DataFrame, circuits: DataFrame) -> DataFrame:
    """JN-01: races joined with their circuit (inner; races without a circuit drop)."""
    race = races.select(
        F.col("race_id"), F.col("race_year"), F.col("name").alias("race_name"),
        F.col("race_timestamp").alias("race_date"), F.col("circuit_id"))
    circ = circuits.select(F.col("circuit_id").alias("c_circuit_id"),
                           F.col("location").alias("circuit_location"),
                           F.col("country").alias("circuit_country"))
    return race.join(broadcast_or_merge(circ), race["circuit_id"] == circ["c_circuit_id"],
                     "inner") \
        .select("race_id", "race_year", "race_name", "race_date",
                "circuit_location", "circuit_country")


# Columns of a fact row that, with the three dimension ids, fully determine a gold
# race-result row; result_id first.  The comparison goes on only where facts repeat a
# result_id, as the driver's do.
RESULT_ORDER_COLS = ("result_id", "race_id", "driver_id", "constructor_id", "grid",
                     "fastest_lap", "race_position", "race_time", "points")


def race_results_star(results: DataFrame, races: DataFrame, circuits: DataFrame,
                      drivers: DataFrame, constructors: DataFrame,
                      driver_cols: tuple[tuple[str, str], ...] = (), team: bool = False,
                      race_attributes: bool = False,
                      reduced: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Star join: fact columns, (race_year, race_name, driver_name) and the attributes asked for.

    Each dimension is joined once.  One that only filters (constructors
    without ``team``, circuits without ``race_attributes``) is a semi join on
    its keys, so the surviving facts are the same in every form.  ``reduced``
    is for rows that lie by ``race_id`` and lack but the race's columns (``names_tell_races``).
    """
    if race_attributes:
        race = race_circuits(races, circuits)
    else:
        circ = circuits.select(F.col("circuit_id").alias("c_circuit_id"))
        race = races.select("race_id", "race_year", F.col("name").alias("race_name"), "circuit_id")
        race = race.join(broadcast_or_merge(circ),
                         race["circuit_id"] == circ["c_circuit_id"], "left_semi").drop("circuit_id")
    drv = drivers.select("driver_id", F.col("name").alias("driver_name"),
                         *[F.col(src).alias(dst) for src, dst in driver_cols])
    con = constructors.select("constructor_id", *([F.col("name").alias("team")] if team else []))
    res = results.select(
        "result_id", "race_id", "driver_id", "constructor_id", "grid", "fastest_lap",
        F.col("position").alias("race_position"), F.col("time").alias("race_time"), "points")
    sides = [(con, "constructor_id", "inner" if team else "left_semi"), (drv, "driver_id", "inner"),
             (race, "race_id", "inner")]

    def joined(rows, side):
        dim, key, how = side
        return rows.join(broadcast_or_merge(dim), key, how)

    small = [is_bounded(dim) for dim, _, _ in sides]
    if all(small):
        res = spread_if_small(res)
    # joins that shuffle the facts come before the others, the one that makes them widest last; they deal them out, too
    order = sorted(range(len(sides)), key=lambda i: small[i])
    if reduced is None:
        return reduce(joined, [sides[i] for i in order], res)
    res = res.where(F.col("race_id").isNotNull())
    res = reduce(joined, [sides[i] for i in order if not small[i] and sides[i][0] is not race], res)
    res = reduce(joined, [sides[i] for i in order if small[i]], _dealt_by_race(res, input_bytes(results)))
    return joined(reduced(res), sides[-1])


def _dealt_by_race(rows: DataFrame, size: int) -> DataFrame:
    """Dealt out by ``race_id``, to tasks that can sort their rows in memory; Spark chooses where sizes are unknown."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, size // FACT_BYTES)
    return rows.repartition(tasks, "race_id") if tasks <= MOST_FACT_TASKS else rows.repartition("race_id")
