"""Declared raw schemas and per-entity layer specs.

Everything below the "fixed values" marker must stay exactly as written:
column names, types and order of the raw files, the raw -> bronze renames,
the silver business keys and null gates, and the gold merge keys / update
lists.  They define which files parse and which rows survive.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

_I, _D, _S = IntegerType(), DoubleType(), StringType()


def _schema(*cols: tuple[str, object]) -> StructType:
    # File readers hand back every column as nullable whatever is declared,
    # so all fields are declared nullable here.
    return StructType([StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class EntitySpec:
    name: str
    path: str                      # below a snapshot folder; may be a glob
    fmt: str                       # "csv" or "json"
    schema: StructType
    select: tuple[tuple[str, str], ...]   # (raw column, bronze column), in output order
    keys: tuple[str, ...]          # silver business key
    gate: tuple[str, ...]          # silver: these must not be NULL
    options: dict = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()


# ---------------------------------------------------------------------------
# fixed values: raw file layout, declared schemas, renames, keys and gates
# ---------------------------------------------------------------------------

CIRCUITS = EntitySpec(
    name="circuits",
    path="circuits.csv",
    fmt="csv",
    options={"header": "true"},
    schema=_schema(("circuitId", _I), ("circuitRef", _S), ("name", _S), ("location", _S),
                   ("country", _S), ("lat", _D), ("lng", _D), ("alt", _I), ("url", _S)),
    select=(("circuitId", "circuit_id"), ("circuitRef", "circuit_ref"), ("name", "name"),
            ("location", "location"), ("country", "country"), ("lat", "latitude"),
            ("lng", "longitude"), ("alt", "altitude")),
    keys=("circuit_id",),
    gate=("circuit_id",),
)

RACES = EntitySpec(
    name="races",
    path="races.csv",
    fmt="csv",
    options={"header": "true"},
    schema=_schema(("raceId", _I), ("year", _I), ("round", _I), ("circuitId", _I),
                   ("name", _S), ("date", _S), ("time", _S)),
    select=(("raceId", "race_id"), ("year", "race_year"), ("round", "round"),
            ("circuitId", "circuit_id"), ("name", "name"), ("race_timestamp", "race_timestamp")),
    keys=("race_id",),
    gate=("race_id", "race_year", "circuit_id"),
    partition_by=("race_year",),
    cluster_by=("race_id",),
)

DRIVERS = EntitySpec(
    name="drivers",
    path="drivers.json",
    fmt="json",
    schema=StructType([
        StructField("driverId", _I), StructField("driverRef", _S),
        StructField("name", _schema(("forename", _S), ("surname", _S))),
        StructField("number", _I), StructField("code", _S), StructField("dob", _S),
        StructField("nationality", _S), StructField("url", _S),
    ]),
    select=(("driverId", "driver_id"), ("driverRef", "driver_ref"), ("number", "number"),
            ("code", "code"), ("name", "name"), ("dob", "dob"), ("nationality", "nationality")),
    keys=("driver_id",),
    gate=("driver_id",),
)

CONSTRUCTORS = EntitySpec(
    name="constructors",
    path="constructors.json",
    fmt="json",
    schema=_schema(("constructorId", _I), ("constructorRef", _S), ("name", _S),
                   ("nationality", _S), ("url", _S)),
    select=(("constructorId", "constructor_id"), ("constructorRef", "constructor_ref"),
            ("name", "name"), ("nationality", "nationality")),
    keys=("constructor_id",),
    gate=("constructor_id",),
)

RESULTS = EntitySpec(
    name="results",
    path="results.json",
    fmt="json",
    schema=_schema(("resultId", _I), ("raceId", _I), ("driverId", _I), ("constructorId", _I),
                   ("number", _I), ("grid", _I), ("position", _I), ("positionText", _S),
                   ("positionOrder", _I), ("points", _D), ("laps", _I), ("time", _S),
                   ("milliseconds", _I), ("fastestLap", _I), ("rank", _I),
                   ("fastestLapTime", _S), ("fastestLapSpeed", _S), ("statusId", _S)),
    select=(("resultId", "result_id"), ("raceId", "race_id"), ("driverId", "driver_id"),
            ("constructorId", "constructor_id"), ("number", "number"), ("grid", "grid"),
            ("position", "position"), ("positionText", "position_text"),
            ("positionOrder", "position_order"), ("points", "points"), ("laps", "laps"),
            ("time", "time"), ("milliseconds", "milliseconds"), ("fastestLap", "fastest_lap"),
            ("rank", "rank"), ("fastestLapTime", "fastest_lap_time"),
            ("fastestLapSpeed", "fastest_lap_speed")),
    keys=("result_id",),
    gate=("result_id",),
)

PITSTOPS = EntitySpec(
    name="pitstops",
    path="pit_stops.json",
    fmt="json",
    schema=_schema(("raceId", _I), ("driverId", _I), ("stop", _I), ("lap", _I),
                   ("time", _S), ("duration", _S), ("milliseconds", _I)),
    select=(("raceId", "race_id"), ("driverId", "driver_id"), ("stop", "stop"), ("lap", "lap"),
            ("time", "time"), ("duration", "duration"), ("milliseconds", "milliseconds")),
    keys=("race_id", "driver_id", "stop"),
    gate=("race_id", "driver_id", "stop"),
)

LAPTIMES = EntitySpec(
    name="laptimes",
    path="lap_times/lap_times_split*.csv",
    fmt="csv",
    options={"header": "false"},
    schema=_schema(("raceId", _I), ("driverId", _I), ("lap", _I), ("position", _I),
                   ("time", _S), ("milliseconds", _I)),
    select=(("raceId", "race_id"), ("driverId", "driver_id"), ("lap", "lap"),
            ("position", "position"), ("time", "time"), ("milliseconds", "milliseconds")),
    keys=("race_id", "driver_id", "lap"),
    gate=("race_id", "driver_id", "lap"),
)

QUALIFYING = EntitySpec(
    name="qualifying",
    path="qualifying/qualifying_split*.json",
    fmt="json",
    options={"multiLine": "true"},
    schema=_schema(("qualifyId", _I), ("raceId", _I), ("driverId", _I), ("constructorId", _I),
                   ("number", _I), ("position", _I), ("q1", _S), ("q2", _S), ("q3", _S)),
    select=(("qualifyId", "qualify_id"), ("raceId", "race_id"), ("driverId", "driver_id"),
            ("constructorId", "constructor_id"), ("number", "number"), ("position", "position"),
            ("q1", "q1"), ("q2", "q2"), ("q3", "q3")),
    keys=("qualify_id",),
    gate=("qualify_id",),
)

ENTITIES: dict[str, EntitySpec] = {
    e.name: e for e in (CIRCUITS, RACES, DRIVERS, CONSTRUCTORS, RESULTS, PITSTOPS,
                        LAPTIMES, QUALIFYING)
}

# Race timestamps are parsed from "<date> <time>" with this pattern.
RACE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Gold merge keys and the columns a matched row takes from the source.
# race_results never updates race_date; driver standings update the
# nationality although it is a grouping key, not a merge key.
GOLD_RACE_RESULTS_KEYS = ("race_year", "race_name", "driver_name")
GOLD_RACE_RESULTS_UPDATE = ("circuit_location", "circuit_country", "driver_number",
                            "driver_nationality", "team", "grid", "fastest_lap",
                            "race_position", "race_time", "points", "gold_processed_at")
GOLD_DRIVER_STANDINGS_KEYS = ("race_year", "driver_name")
GOLD_DRIVER_STANDINGS_UPDATE = ("driver_nationality", "total_points", "number_of_wins",
                                "rank", "gold_processed_at")
GOLD_CONSTRUCTOR_STANDINGS_KEYS = ("race_year", "team")
GOLD_CONSTRUCTOR_STANDINGS_UPDATE = ("total_points", "number_of_wins", "rank",
                                     "gold_processed_at")

# Audit / lineage column names.
FILE_DATE = "file_date"
INGESTION_DATE = "ingestion_date"
PROCESSED_AT = "processed_at"
GOLD_PROCESSED_AT = "gold_processed_at"
