"""Queries over the driver's tables and their DuckDB oracles.

Each query callable takes ``(spark, sf_dir)`` and returns a DataFrame over
whole tables.  ``ORACLE_SQL`` holds, per query, an independent SQL text
over the same tables (DuckDB dialect) producing the same columns.
Integer outputs that differ in width between engines (rank, year) are cast
to BIGINT on both sides; audit timestamps are left out of query output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapmart.plans import gold, roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _bigint(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def _race_results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    s = roles.silver_frames(spark, sf_dir)
    return gold.race_results(s["results"], s["races"], s["circuits"], s["drivers"],
                             s["constructors"], stamp=False), s


# --- shared oracle pieces ---------------------------------------------------

_SQL_RACE_RESULTS = """
WITH res AS (
  SELECT l_orderkey * 10 + l_linenumber AS result_id, l_orderkey AS race_id,
         l_suppkey AS driver_id, l_partkey AS constructor_id, l_linenumber AS grid,
         CAST(l_quantity AS INTEGER) AS fastest_lap, l_linenumber AS race_position,
         l_returnflag || l_linestatus AS race_time, l_quantity AS points
  FROM lineitem),
rc AS (
  SELECT o_orderkey AS race_id, year(o_orderdate) AS race_year,
         'Order#' || CAST(o_orderkey AS VARCHAR) AS race_name, o_orderdate AS race_date,
         c_mktsegment AS circuit_location, n_name AS circuit_country
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey),
drv AS (
  SELECT s_suppkey AS driver_id, s_name AS driver_name, s_nationkey AS driver_number,
         n_name AS driver_nationality
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
con AS (SELECT p_partkey AS constructor_id, p_brand AS team FROM part),
joined AS (
  SELECT rc.race_year, rc.race_name, rc.race_date, rc.circuit_location, rc.circuit_country,
         drv.driver_name, drv.driver_number, drv.driver_nationality, con.team,
         res.grid, res.fastest_lap, res.race_position, res.race_time, res.points,
         res.result_id, res.race_id, res.driver_id, res.constructor_id
  FROM res JOIN drv ON res.driver_id = drv.driver_id
           JOIN con ON res.constructor_id = con.constructor_id
           JOIN rc ON res.race_id = rc.race_id),
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY race_year, race_name, driver_name
      ORDER BY result_id ASC NULLS FIRST, race_id ASC NULLS FIRST,
               driver_id ASC NULLS FIRST, constructor_id ASC NULLS FIRST,
               grid ASC NULLS FIRST, fastest_lap ASC NULLS FIRST,
               race_position ASC NULLS FIRST, race_time ASC NULLS FIRST,
               points ASC NULLS FIRST) AS rn
  FROM joined),
race_results AS (
  SELECT race_year, race_name, race_date, circuit_location, circuit_country, driver_name,
         driver_number, driver_nationality, team, grid, fastest_lap, race_position,
         race_time, points
  FROM ranked WHERE rn = 1)
"""


# --- gold -------------------------------------------------------------------

@query("driver_standings", _SQL_RACE_RESULTS + """
SELECT CAST(race_year AS BIGINT) AS race_year, driver_nationality, driver_name,
       SUM(points) AS total_points,
       COUNT(CASE WHEN race_position = 1 THEN TRUE END) AS number_of_wins,
       CAST(RANK() OVER (PARTITION BY race_year ORDER BY SUM(points) DESC NULLS LAST)
            AS BIGINT) AS rank
FROM race_results
GROUP BY race_year, driver_nationality, driver_name
""")
def driver_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = roles.silver_frames(spark, sf_dir)
    ds = gold.standings_from_silver(s["results"], s["races"], s["circuits"], s["drivers"],
                                    s["constructors"], "driver", stamp=False)
    return _bigint(ds, "race_year", "rank")


@query("constructor_standings", _SQL_RACE_RESULTS + """
SELECT CAST(race_year AS BIGINT) AS race_year, team,
       SUM(points) AS total_points,
       COUNT(CASE WHEN race_position = 1 THEN TRUE END) AS number_of_wins,
       CAST(RANK() OVER (PARTITION BY race_year ORDER BY SUM(points) DESC NULLS LAST)
            AS BIGINT) AS rank
FROM race_results
GROUP BY race_year, team
""")
def constructor_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = roles.silver_frames(spark, sf_dir)
    cs = gold.standings_from_silver(s["results"], s["races"], s["circuits"], s["drivers"],
                                    s["constructors"], "constructor", stamp=False)
    return _bigint(cs, "race_year", "rank")


@query("race_results", _SQL_RACE_RESULTS + """
SELECT CAST(race_year AS BIGINT) AS race_year, race_name, race_date, circuit_location,
       circuit_country, driver_name, driver_number, driver_nationality, team, grid,
       fastest_lap, race_position, race_time, points
FROM race_results
""")
def race_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bigint(_race_results(spark, sf_dir)[0], "race_year")


# --- joins, dedup, quality ---------------------------------------------------

from lapmart.functions.columns import full_name, race_timestamp  # noqa: E402
from lapmart.operators.dedup import latest_by, latest_by_version  # noqa: E402
from lapmart.operators.joins import race_circuits as _race_circuits  # noqa: E402
from lapmart.operators.quality import null_key_counts  # noqa: E402
from lapmart.operators.upsert import upsert_all, upsert_columns  # noqa: E402


@query("race_circuits", """
SELECT o_orderkey AS race_id, CAST(year(o_orderdate) AS BIGINT) AS race_year,
       'Order#' || CAST(o_orderkey AS VARCHAR) AS race_name, o_orderdate AS race_date,
       c_mktsegment AS circuit_location, n_name AS circuit_country
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def race_circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bigint(_race_circuits(roles.races(spark, sf_dir), roles.circuits(spark, sf_dir)),
                   "race_year")


_SQL_RESULTS = """
results AS (
  SELECT l_orderkey * 10 + l_linenumber AS result_id, l_orderkey AS race_id,
         l_suppkey AS driver_id, l_partkey AS constructor_id, l_linenumber AS number,
         l_linenumber AS grid, l_linenumber AS position,
         CAST(l_linenumber AS VARCHAR) AS position_text, l_linenumber AS position_order,
         l_quantity AS points, CAST(l_quantity AS INTEGER) AS laps,
         l_returnflag || l_linestatus AS time, CAST(l_quantity AS INTEGER) AS fastest_lap,
         strftime(l_shipdate, '%Y-%m-%d') AS file_date, l_returnflag
  FROM lineitem)"""

_RESULT_ORDER = """file_date DESC NULLS LAST, race_id ASC NULLS FIRST,
      driver_id ASC NULLS FIRST, constructor_id ASC NULLS FIRST, number ASC NULLS FIRST,
      grid ASC NULLS FIRST, position ASC NULLS FIRST, position_text ASC NULLS FIRST,
      position_order ASC NULLS FIRST, points ASC NULLS FIRST, laps ASC NULLS FIRST,
      time ASC NULLS FIRST, fastest_lap ASC NULLS FIRST"""

_RESULT_COLS = """result_id, race_id, driver_id, constructor_id, number, grid, position,
       position_text, position_order, points, laps, time, fastest_lap, file_date"""


def _latest_sql(src: str, where: str = "TRUE") -> str:
    return f"""(SELECT {_RESULT_COLS} FROM (
      SELECT *, row_number() OVER (PARTITION BY result_id ORDER BY {_RESULT_ORDER}) AS rn
      FROM {src} WHERE {where}) WHERE rn = 1)"""


@query("latest_result_by_snapshot", f"WITH {_SQL_RESULTS}\nSELECT * FROM "
       + _latest_sql("results"))
def latest_result_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-01: newest row per result_id by snapshot folder, full-row tie-break."""
    return latest_by_version(roles.results(spark, sf_dir), ["result_id"])


@query("latest_event_per_user", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1
""")
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-02: newest row per key by load time (``ts`` plays ``ingestion_date``)."""
    ev = roles.table(spark, sf_dir, "events")
    return latest_by(ev, ["user_id"], [F.col("ts").desc_nulls_last(),
                                       F.col("event_id").desc_nulls_last()], [])


@query("dq_null_keys", """
SELECT 'results' AS entity, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE l_returnflag = 'R') AS null_key_rows
FROM lineitem
UNION ALL
SELECT 'races', COUNT(*), COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW' OR o_custkey % 7 = 0) FROM orders
UNION ALL
SELECT 'circuits', COUNT(*), COUNT(*) FILTER (WHERE c_acctbal < 0)
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT 'drivers', COUNT(*), COUNT(*) FILTER (WHERE s_suppkey IS NULL)
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL
SELECT 'constructors', COUNT(*), COUNT(*) FILTER (WHERE p_size > 25) FROM part
""")
def dq_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-03..05 / AGG-05: rows and NULL-key rows per entity (the silver gates).

    The driver's keys hold no NULL, so some are made NULL by a rule on other columns."""
    li, o = roles.table(spark, sf_dir, "lineitem"), roles.table(spark, sf_dir, "orders")
    c, p = roles.table(spark, sf_dir, "customer"), roles.table(spark, sf_dir, "part")
    n = roles.table(spark, sf_dir, "nation")
    frames = {
        "results": (li.select(F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("result_id")), ["result_id"]),
        "races": (o.select(F.col("o_orderkey").alias("race_id"),
                           F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate")).alias("race_year"),
                           F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("circuit_id")),
                  ["race_id", "race_year", "circuit_id"]),
        "circuits": (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                     .select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("circuit_id")), ["circuit_id"]),
        "drivers": (roles.drivers(spark, sf_dir), ["driver_id"]),
        "constructors": (p.select(F.when(F.col("p_size") <= 25, F.col("p_partkey")).alias("constructor_id")),
                         ["constructor_id"])}
    out = None
    for name, (df, cols) in frames.items():
        part = null_key_counts(df, cols, label=name)
        out = part if out is None else out.unionByName(part)
    return out


# --- upserts -------------------------------------------------------------------
# Target = newest rows of the regular deliveries, source = newest rows of the
# corrections (returned items, flag 'R'); together they are the whole table.

def _results_split(spark: SparkSession, sf_dir: str):
    flag = F.col("l_returnflag")               # a plain column: pushed to the scan
    target = latest_by_version(roles.results(spark, sf_dir, flag != "R"), ["result_id"])
    source = latest_by_version(roles.results(spark, sf_dir, flag == "R"), ["result_id"])
    return target, source


_SQL_SPLIT = f"""WITH {_SQL_RESULTS},
tgt AS {_latest_sql("results", "l_returnflag <> 'R'")},
src AS {_latest_sql("results", "l_returnflag = 'R'")}
"""


@query("upsert_single_key", _SQL_SPLIT + """
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.result_id = tgt.result_id)
UNION ALL
SELECT * FROM src
""")
def upsert_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-10: MATCHED → UPDATE SET *, NOT MATCHED → INSERT * on one key."""
    target, source = _results_split(spark, sf_dir)
    return upsert_all(target, source, ["result_id"])


_LAPS = """laps AS (
  SELECT l_orderkey AS race_id, l_suppkey AS driver_id, l_linenumber AS lap,
         l_partkey AS position, l_returnflag || l_linestatus AS time,
         l_extendedprice AS milliseconds, strftime(l_shipdate, '%Y-%m-%d') AS file_date,
         l_linestatus
  FROM lineitem)"""
_LAP_ORDER = """file_date DESC NULLS LAST, position ASC NULLS FIRST, time ASC NULLS FIRST,
      milliseconds ASC NULLS FIRST"""


def _laps_latest(where: str) -> str:
    return f"""(SELECT race_id, driver_id, lap, position, time, milliseconds, file_date FROM (
      SELECT *, row_number() OVER (PARTITION BY race_id, driver_id, lap
                                   ORDER BY {_LAP_ORDER}) AS rn
      FROM laps WHERE {where}) WHERE rn = 1)"""


@query("upsert_composite_key", f"""WITH {_LAPS},
tgt AS {_laps_latest("l_linestatus = 'F'")},
src AS {_laps_latest("l_linestatus = 'O'")}
SELECT * FROM tgt WHERE NOT EXISTS (
  SELECT 1 FROM src WHERE src.race_id = tgt.race_id AND src.driver_id = tgt.driver_id
                      AND src.lap = tgt.lap)
UNION ALL
SELECT * FROM src
""")
def upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-11: the same on a three-column key (race, driver, lap)."""
    li = roles.table(spark, sf_dir, "lineitem")
    laps = li.select(
        F.col("l_orderkey").alias("race_id"), F.col("l_suppkey").alias("driver_id"),
        F.col("l_linenumber").alias("lap"), F.col("l_partkey").alias("position"),
        F.concat("l_returnflag", "l_linestatus").alias("time"),
        F.col("l_extendedprice").alias("milliseconds"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("file_date"), "l_linestatus")
    keys = ["race_id", "driver_id", "lap"]
    # filters on the raw column reach the scan as pushed filters
    t = latest_by_version(laps.where(F.col("l_linestatus") == "F").drop("l_linestatus"), keys)
    s = latest_by_version(laps.where(F.col("l_linestatus") == "O").drop("l_linestatus"), keys)
    return upsert_all(t, s, keys)


_UPDATE_LIST = ("race_id", "driver_id", "constructor_id", "number", "grid", "position",
                "position_text", "position_order", "laps", "time", "fastest_lap", "file_date")


@query("upsert_update_list", _SQL_SPLIT + """
SELECT COALESCE(t.result_id, s.result_id) AS result_id,
""" + ",\n".join(
    f"       CASE WHEN t.result_id IS NULL OR s.result_id IS NOT NULL THEN s.{c} "
    f"ELSE t.{c} END AS {c}" for c in _UPDATE_LIST) + """,
       CASE WHEN t.result_id IS NULL THEN s.points ELSE t.points END AS points
FROM tgt t FULL OUTER JOIN src s ON t.result_id = s.result_id
""")
def upsert_update_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-12: matched rows take only the listed columns (``points`` is left out)."""
    target, source = _results_split(spark, sf_dir)
    return upsert_columns(target, source, ["result_id"], _UPDATE_LIST)


# --- scalar functions -------------------------------------------------------------

@query("conditional_timestamp", """
SELECT o_orderkey AS race_id,
       strftime(o_orderdate, '%Y-%m-%d') AS race_date_text,
       t AS race_time_text,
       try_strptime(strftime(o_orderdate, '%Y-%m-%d') || ' ' || t, '%Y-%m-%d %H:%M:%S')
         AS race_timestamp,
       o_orderstatus || ' ' || CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                                    ELSE o_orderpriority END AS label
FROM (SELECT *, CASE WHEN o_orderpriority = '2-HIGH' THEN '\\N'
                     WHEN o_orderpriority = '3-MEDIUM' THEN ''
                     WHEN o_orderpriority = '5-LOW' THEN '25:00:00'
                     ELSE lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || ':' ||
                          lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':00' END AS t
      FROM orders)
""")
def conditional_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-01/02: ``concat`` (NULL-propagating) and ``try_to_timestamp`` (NULL on mismatch)."""
    o = roles.table(spark, sf_dir, "orders")
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    t = roles.race_time_text(F.col("o_orderpriority"), F.col("o_custkey"), F.col("o_orderkey"))
    return o.select(
        F.col("o_orderkey").alias("race_id"), date.alias("race_date_text"),
        t.alias("race_time_text"),
        race_timestamp(date, t).cast("timestamp_ntz").alias("race_timestamp"),
        full_name(F.col("o_orderstatus"),
                  F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
        .alias("label"),
    )


# --- raw snapshot scans -------------------------------------------------------
# Each query renders a driver table in the raw layout below a fresh folder in
# the shared checkpoint directory, then reads it back through the bronze
# readers (declared schema, one glob scan, folder → file_date).

from lapmart.plans import bronze as _bronze  # noqa: E402
from lapmart.sources.rawfiles import scratch_dir, write_snapshots  # noqa: E402


def _scan(spark: SparkSession, raw: DataFrame, entity: str, rel: str, fmt: str,
          header: bool = False, multiline: bool = False) -> DataFrame:
    root = scratch_dir(spark, f"raw-{entity}") + "/raw"
    write_snapshots(raw, root, rel, fmt, "folder", header=header, multiline=multiline)
    return _bronze.bronze_frame(spark, root, entity).drop("ingestion_date")


_SQL_TIME = """CASE WHEN o_orderpriority = '2-HIGH' THEN '\\N'
                     WHEN o_orderpriority = '3-MEDIUM' THEN ''
                     WHEN o_orderpriority = '5-LOW' THEN '25:00:00'
                     ELSE lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || ':' ||
                          lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':00' END"""


@query("csv_header_scan", f"""
SELECT CAST(o_orderkey AS INTEGER) AS race_id, CAST(year(o_orderdate) AS INTEGER) AS race_year,
       CAST(month(o_orderdate) AS INTEGER) AS round, CAST(o_custkey AS INTEGER) AS circuit_id,
       'Order#' || CAST(o_orderkey AS VARCHAR) AS name,
       try_strptime(strftime(o_orderdate, '%Y-%m-%d') || ' ' || {_SQL_TIME},
                    '%Y-%m-%d %H:%M:%S') AS race_timestamp,
       CAST(year(o_orderdate) AS VARCHAR) || '-12-31' AS file_date
FROM orders
""")
def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01/02/07 + SCL-02: CSV with header, positional schema, time parsing."""
    df = _scan(spark, roles.raw_races(spark, sf_dir), "races", "races.csv", "csv", header=True)
    return df.withColumn("race_timestamp", F.col("race_timestamp").cast("timestamp_ntz"))


@query("csv_glob_scan", """
SELECT CAST(l_orderkey AS INTEGER) AS race_id, CAST(l_suppkey AS INTEGER) AS driver_id,
       l_linenumber AS lap, CAST(l_partkey AS INTEGER) AS position,
       l_returnflag || l_linestatus AS time, CAST(l_quantity AS INTEGER) * 1000 AS milliseconds,
       CAST(year(l_shipdate) AS VARCHAR) || '-12-31' AS file_date
FROM lineitem
""")
def csv_glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03: header-less CSV split files matched by a glob in every folder."""
    return _scan(spark, roles.raw_laptimes(spark, sf_dir), "laptimes",
                 "lap_times/lap_times_split*.csv", "csv")


@query("json_lines_nested_scan", """
SELECT CAST(s_suppkey AS INTEGER) AS driver_id, lower(s_name) AS driver_ref,
       s_nationkey AS number,
       CASE WHEN s_acctbal >= 0 THEN 'C' || CAST(s_nationkey AS VARCHAR) END AS code,
       s_name || ' ' || n_name AS name, '1990-01-01' AS dob, n_name AS nationality,
       r_name AS file_date
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def json_lines_nested_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05 + PRJ-06/07 + SCL-01: JSON Lines with a nested name struct."""
    return _scan(spark, roles.raw_drivers(spark, sf_dir), "drivers", "drivers.json", "json")


@query("json_multiline_scan", """
SELECT CAST(o_orderkey AS INTEGER) AS qualify_id, CAST(o_orderkey AS INTEGER) AS race_id,
       CAST(o_custkey AS INTEGER) AS driver_id, CAST(o_custkey % 100 AS INTEGER) AS constructor_id,
       CAST(month(o_orderdate) AS INTEGER) AS number,
       CAST(day(o_orderdate) AS INTEGER) AS position,
       o_orderstatus AS q1, o_orderpriority AS q2,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS q3,
       CAST(year(o_orderdate) AS VARCHAR) || '-12-31' AS file_date
FROM orders
""")
def json_multiline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06: whole-file JSON arrays spread over several lines, matched by a glob."""
    return _scan(spark, roles.raw_qualifying(spark, sf_dir), "qualifying",
                 "qualifying/qualifying_split*.json", "json", multiline=True)


# --- sinks: round trips through storage ------------------------------------------

import uuid as _uuid  # noqa: E402

from lapmart.sinks import tables as _tables  # noqa: E402

_RESULT_NAMES = ["result_id", "race_id", "driver_id", "constructor_id", "number", "grid",
                 "position", "position_text", "position_order", "points", "laps", "time",
                 "fastest_lap", "file_date"]


@query("append_evolve", f"""WITH {_SQL_RESULTS}
SELECT result_id, race_id, driver_id, constructor_id, number, grid, position, position_text,
       position_order, CASE WHEN l_returnflag <> 'N' THEN points END AS points,
       CAST(laps AS BIGINT) AS laps, time, fastest_lap, file_date
FROM results
""")
def append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-01/02/03: three appends to one path; the second adds a column (``points``), the third has a wider
    type (``laps``), a fourth that doesn't go with the history raises.  The read is by the schema kept beside
    the files: earlier rows have NULL in the new column."""
    path = scratch_dir(spark, "append") + "/results"
    flag = F.col("l_returnflag")
    _tables.append(roles.results(spark, sf_dir, flag == "N").drop("points"), path)
    _tables.append(roles.results(spark, sf_dir, flag == "R"), path)
    _tables.append(roles.results(spark, sf_dir, flag == "A").withColumn("laps", F.col("laps").cast("long")), path)
    try:
        _tables.append(roles.results(spark, sf_dir, flag == "A").withColumn("grid", F.lit("first")), path)
        raise AssertionError("a text was appended to a column of numbers")
    except _tables.SchemaConflict:
        pass
    return _tables.read_appended(spark, path).select(*_RESULT_NAMES)


@query("overwrite_publish", _SQL_SPLIT + """
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.result_id = tgt.result_id)
UNION ALL
SELECT * FROM src
""")
def overwrite_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-13/14 + SNK-10 through storage: publish v1, upsert reading v1 while
    writing v2, read the current version."""
    base = scratch_dir(spark, "publish") + "/results"
    target, source = _results_split(spark, sf_dir)
    assert not _tables.table_exists(spark, base)
    _tables.publish(spark, target, base)
    merged = upsert_all(_tables.read_current(spark, base), source, ["result_id"])
    _tables.publish(spark, merged, base)
    return _tables.read_current(spark, base).select(*_RESULT_NAMES)


@query("ctas_once", """
SELECT p_partkey AS constructor_id, p_name AS constructor_ref, p_brand AS name,
       p_type AS nationality
FROM part
""")
def ctas_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-06/15 + SRC-09/10/11: CREATE TABLE IF NOT EXISTS … AS SELECT from a
    path; a second CTAS from a changed path leaves the table as it was."""
    root = scratch_dir(spark, "ctas")
    db = "lapmart_" + _uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/db'")
    cons = roles.constructors(spark, sf_dir)
    _tables.overwrite(cons, f"{root}/v1")
    _tables.create_table_once_as(spark, f"{db}.constructors", f"{root}/v1")
    _tables.overwrite(cons.withColumn("name", F.upper("name")), f"{root}/v2")
    _tables.create_table_once_as(spark, f"{db}.constructors", f"{root}/v2")
    described = [r["col_name"] for r in _tables.describe(spark, f"{db}.constructors").collect()]
    assert described[:4] == ["constructor_id", "constructor_ref", "name", "nationality"]
    return _whole(spark, db, "constructors")


@query("partitioned_clustered", """
SELECT o_orderkey AS race_id, CAST(month(o_orderdate) AS INTEGER) AS round,
       o_custkey AS circuit_id, 'Order#' || CAST(o_orderkey AS VARCHAR) AS name,
       o_orderdate AS race_timestamp, CAST(year(o_orderdate) AS BIGINT) AS race_year
FROM orders
""")
def partitioned_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-07/08/17: managed table partitioned by season, files range-clustered
    on race_id (the Z-order replacement), read back whole."""
    root = scratch_dir(spark, "part")
    db = "lapmart_" + _uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/db'")
    races = roles.races(spark, sf_dir)
    _tables.save_as_new_table(_tables.clustered(races, ["race_year"], ["race_id"]),
                              f"{db}.races", partition_by=["race_year"])
    return _bigint(_whole(spark, db, "races").select(
        "race_id", "round", "circuit_id", "name", "race_timestamp", "race_year"), "race_year")


# --- incremental ingestion ---------------------------------------------------------

@query("incremental_snapshots", """
SELECT CAST(o_orderkey AS INTEGER) AS race_id, CAST(year(o_orderdate) AS INTEGER) AS race_year,
       CAST(month(o_orderdate) AS INTEGER) AS round, CAST(o_custkey AS INTEGER) AS circuit_id,
       'Order#' || CAST(o_orderkey AS VARCHAR) AS name,
       CAST(year(o_orderdate) AS VARCHAR) || '-12-31' AS file_date
FROM orders
""")
def incremental_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-01: three availableNow runs over growing raw folders.

    Run 1 sees the seasons up to 1997, run 2 the later ones plus a *late*
    re-delivery of the pending orders in an older folder (1900) with other
    names, run 3 nothing new.  Newest-wins keeps every race exactly once
    with its original name.
    """
    from lapmart.streaming.incremental import ingest_incremental

    root = scratch_dir(spark, "incr")
    raw_root, lake = f"{root}/raw", f"{root}/lake"
    raw = roles.raw_races(spark, sf_dir)
    early = F.col("year") <= 1997
    write_snapshots(raw.where(early), raw_root, "races.csv", "csv", "folder", header=True)
    ingest_incremental(spark, raw_root, lake, "races")
    late = (raw
            .join(roles.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
                  .select(F.col("o_orderkey").alias("raceId")), "raceId", "left_semi")
            .withColumn("name", F.concat(F.lit("Late#"), F.col("raceId").cast("string")))
            .withColumn("folder", F.lit("1900-12-31")))
    write_snapshots(raw.where(~early).unionByName(late), raw_root, "races.csv", "csv",
                    "folder", header=True)
    ingest_incremental(spark, raw_root, lake, "races")
    third = ingest_incremental(spark, raw_root, lake, "races")
    assert third["rows"] == 0, third
    return _tables.read_current(spark, f"{lake}/silver/races").select(
        "race_id", "race_year", "round", "circuit_id", "name", "file_date")


# --- reports -------------------------------------------------------------------------

from lapmart.plans import reports as _reports  # noqa: E402

_SQL_DRIVER_STANDINGS = _SQL_RACE_RESULTS.rstrip() + """,
ds AS (
  SELECT race_year, driver_nationality, driver_name, SUM(points) AS total_points,
         RANK() OVER (PARTITION BY race_year ORDER BY SUM(points) DESC NULLS LAST) AS rank
  FROM race_results GROUP BY race_year, driver_nationality, driver_name)
"""


@query("season_trend", _SQL_DRIVER_STANDINGS + """
SELECT driver_name, driver_nationality, CAST(race_year AS BIGINT) AS race_year, total_points,
       CAST(rank AS BIGINT) AS rank,
       lag(total_points) OVER w AS prev_points,
       total_points - lag(total_points) OVER w AS points_change,
       CAST(lag(rank) OVER w AS DOUBLE) AS prev_rank
FROM ds
WINDOW w AS (PARTITION BY driver_name, driver_nationality ORDER BY race_year)
""")
def season_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-01: driver points and rank against the previous season."""
    s = roles.silver_frames(spark, sf_dir)
    ds = gold.standings_from_silver(s["results"], s["races"], s["circuits"], s["drivers"],
                                    s["constructors"], "driver", stamp=False)
    # prev_rank is NULL in a driver's first season: carried as DOUBLE so both
    # engines hand back the same column type
    return _bigint(_reports.season_trend(ds, ("driver_name", "driver_nationality")),
                   "race_year", "rank").withColumn("prev_rank", F.col("prev_rank").cast("double"))


@query("season_trend_team", _SQL_RACE_RESULTS.rstrip() + """,
cs AS (
  SELECT race_year, team, SUM(points) AS total_points,
         RANK() OVER (PARTITION BY race_year ORDER BY SUM(points) DESC NULLS LAST) AS rank
  FROM race_results GROUP BY race_year, team)
SELECT team, CAST(race_year AS BIGINT) AS race_year, total_points,
       CAST(rank AS BIGINT) AS rank,
       lag(total_points) OVER w AS prev_points,
       total_points - lag(total_points) OVER w AS points_change,
       CAST(lag(rank) OVER w AS DOUBLE) AS prev_rank
FROM cs
WINDOW w AS (PARTITION BY team ORDER BY race_year)
""")
def season_trend_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-01: team points and rank against the previous season."""
    s = roles.silver_frames(spark, sf_dir)
    cs = gold.standings_from_silver(s["results"], s["races"], s["circuits"], s["drivers"],
                                    s["constructors"], "constructor", stamp=False)
    # prev_rank as in season_trend
    return _bigint(_reports.season_trend(cs, ("team",)),
                   "race_year", "rank").withColumn("prev_rank", F.col("prev_rank").cast("double"))


@query("race_statistics", _SQL_RACE_RESULTS + """
SELECT race_name, COUNT(*) AS entries, COUNT(DISTINCT race_year) AS seasons,
       CAST(MIN(race_year) AS BIGINT) AS first_year, CAST(MAX(race_year) AS BIGINT) AS last_year,
       SUM(points) AS total_points, MAX(points) AS max_points,
       COUNT(CASE WHEN race_position = 1 THEN TRUE END) AS wins_recorded
FROM race_results GROUP BY race_name
""")
def race_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-02: historical statistics per race name."""
    s = roles.silver_frames(spark, sf_dir)
    narrow = gold.race_results_deduped(s["results"], s["races"], s["circuits"], s["drivers"],
                                       s["constructors"])
    return _bigint(_reports.race_statistics(narrow),
                   "first_year", "last_year")


@query("circuit_distribution", """
SELECT n_name AS country, COUNT(*) AS n_circuits, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_races,
       MIN(c_acctbal) AS min_latitude, MAX(c_acctbal) AS max_latitude,
       CAST(MIN(c_custkey % 360 - 180) AS DOUBLE) AS min_longitude,
       CAST(MAX(c_custkey % 360 - 180) AS DOUBLE) AS max_longitude
FROM customer JOIN nation ON c_nationkey = n_nationkey
     LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) r
       ON r.o_custkey = c_custkey
GROUP BY n_name
""")
def circuit_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-03: circuits and races per country."""
    return _reports.circuit_distribution(roles.circuits(spark, sf_dir), roles.races(spark, sf_dir))


# --- whole layers on the driver data --------------------------------------------------

from lapmart.plans import silver as _silver  # noqa: E402


@query("silver_build_rerun", f"WITH {_SQL_RESULTS}\nSELECT * FROM " + _latest_sql("results"))
def silver_build_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DS-S5 twice over a bronze history that holds every row twice (a rerun
    appends all snapshots again): dedup, gate, create, then upsert into the
    published version.  The result is the newest row per result_id."""
    root = scratch_dir(spark, "silver")
    bronze_path = f"{root}/bronze/results"
    rows = roles.results(spark, sf_dir)
    res = rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                        for f in _bronze.bronze_schema(spark, "results")))
    _tables.append_load(res, bronze_path, "batch-1")
    _tables.append_load(res, bronze_path, "batch-2")
    _silver.build_silver(spark, f"{root}/bronze", f"{root}/silver", "results")
    _silver.build_silver(spark, f"{root}/bronze", f"{root}/silver", "results")
    assert _tables.current_version(spark, f"{root}/silver/results").endswith("_v000002")
    out = _silver.read_silver(spark, f"{root}/silver", "results")
    return out.select(*(F.col(c).cast(rows.schema[c].dataType) for c in _RESULT_NAMES))


@query("gold_build", _SQL_DRIVER_STANDINGS + """
SELECT CAST(race_year AS BIGINT) AS race_year, driver_nationality, driver_name, total_points,
       CAST(rank AS BIGINT) AS rank
FROM ds
""")
def gold_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DS-G1..3 as the pipeline runs them: silver versions published, race
    results written, standings read from that path copy, each dataset
    upserted into its table copy; returns the driver standings table."""
    root = scratch_dir(spark, "gold")
    for name, df in roles.silver_frames(spark, sf_dir).items():
        _tables.publish(spark, df, f"{root}/silver/{name}")
    gold.build_gold(spark, f"{root}/silver", f"{root}/gold")
    ds = gold.read_gold(spark, f"{root}/gold", "driver_standings", table=True)
    return _bigint(ds.select("race_year", "driver_nationality", "driver_name", "total_points",
                             "rank"), "race_year", "rank")


# --- every raw format and silver entity end to end -------------------------------------

_SQL_YEAR = "CAST(year(l_shipdate) AS VARCHAR) || '-12-31'"
# (entity, raw frame, folder-relative file, format, options, SQL of the bronze columns)
_LAYERS = {
    "circuits": (roles.raw_circuits, "circuits.csv", "csv", {"header": True}, """
        SELECT CAST(c_custkey AS INTEGER) AS circuit_id, lower(c_name) AS circuit_ref, c_name AS name,
               c_mktsegment AS location, n_name AS country, c_acctbal AS latitude,
               CAST(c_custkey % 360 - 180 AS DOUBLE) AS longitude, CAST(c_custkey % 900 AS INTEGER) AS altitude,
               c_mktsegment AS file_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "constructors": (roles.raw_constructors, "constructors.json", "json", {}, """
        SELECT CAST(p_partkey AS INTEGER) AS constructor_id, p_name AS constructor_ref, p_brand AS name,
               p_type AS nationality, 'size ' || CAST(p_size AS VARCHAR) AS file_date FROM part"""),
    "drivers": (roles.raw_drivers, "drivers.json", "json", {}, ORACLE_SQL["json_lines_nested_scan"]),
    "races": (roles.raw_races, "races.csv", "csv", {"header": True}, ORACLE_SQL["csv_header_scan"]),
    "results": (roles.raw_results, "results.json", "json", {}, f"""
        SELECT CAST(l_orderkey * 10 + l_linenumber AS INTEGER) AS result_id, CAST(l_orderkey AS INTEGER) AS race_id,
               CAST(l_suppkey AS INTEGER) AS driver_id, CAST(l_partkey AS INTEGER) AS constructor_id,
               l_linenumber AS number, l_linenumber AS grid,
               l_linenumber AS position,
               l_returnflag || l_linestatus AS position_text, l_linenumber AS position_order,
               CAST(l_quantity AS DOUBLE) AS points, CAST(month(l_shipdate) AS INTEGER) AS laps,
               l_returnflag || l_linestatus AS time, CAST(l_quantity AS INTEGER) * 1000 AS milliseconds,
               CAST(day(l_shipdate) AS INTEGER) AS fastest_lap, CAST(quarter(l_shipdate) AS INTEGER) AS rank,
               l_returnflag AS fastest_lap_time, l_linestatus AS fastest_lap_speed, {_SQL_YEAR} AS file_date
        FROM lineitem"""),
    "pitstops": (roles.raw_pitstops, "pit_stops.json", "json", {}, f"""
        SELECT CAST(l_orderkey AS INTEGER) AS race_id, CAST(l_suppkey AS INTEGER) AS driver_id,
               l_linenumber AS stop, CAST(month(l_shipdate) AS INTEGER) AS lap, l_returnflag AS time,
               l_linestatus AS duration, CAST(l_quantity AS INTEGER) * 1000 AS milliseconds, {_SQL_YEAR} AS file_date
        FROM lineitem"""),
    "laptimes": (roles.raw_laptimes, "lap_times/lap_times_split*.csv", "csv", {}, ORACLE_SQL["csv_glob_scan"]),
    "qualifying": (roles.raw_qualifying, "qualifying/qualifying_split*.json", "json", {"multiline": True},
                   ORACLE_SQL["json_multiline_scan"]),
}


def _latest_of(sql: str, entity: str) -> str:
    """Newest row per business key of an entity's bronze rows, ties by content as in ``latest_by``."""
    from lapmart.schemas import ENTITIES

    spec = ENTITIES[entity]
    rest = ", ".join(f"{c} ASC NULLS FIRST" for _, c in spec.select if c not in spec.keys)
    return f"""SELECT * EXCLUDE (rn), true AS loaded, true AS processed FROM (
        SELECT *, row_number() OVER (PARTITION BY {", ".join(spec.keys)}
                                     ORDER BY file_date DESC NULLS LAST, {rest}) AS rn
        FROM ({sql})) WHERE rn = 1"""


def _silver_of(entity: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, rel, fmt, options, _ = _LAYERS[entity]
        root = scratch_dir(spark, f"layer-{entity}")
        write_snapshots(raw(spark, sf_dir), f"{root}/raw", rel, fmt, "folder", **options)
        _bronze.ingest_bronze(spark, f"{root}/raw", f"{root}/bronze", entities=[entity])
        _silver.build_silver(spark, f"{root}/bronze", f"{root}/silver", entity)
        out = _silver.read_silver(spark, f"{root}/silver", entity)
        out = out.select(*(c for c in out.columns if c not in ("ingestion_date", "processed_at")),
                         F.col("ingestion_date").isNotNull().alias("loaded"),
                         F.col("processed_at").isNotNull().alias("processed"))
        if entity == "races":
            out = out.withColumn("race_timestamp", F.col("race_timestamp").cast("timestamp_ntz"))
        return out
    run.__doc__ = f"DS-B/DS-S {entity}: raw snapshots, bronze, silver; audit columns (PRJ-05, SCL-03) as flags."
    return run


for _entity, _layer in _LAYERS.items():
    query(f"silver_{_entity}", _latest_of(_layer[4], _entity))(_silver_of(_entity))


@query("json_lines_flat_scan", _LAYERS["results"][4])
def json_lines_flat_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-04: flat JSON Lines in the fact table's own format."""
    return _scan(spark, roles.raw_results(spark, sf_dir), "results", "results.json", "json")


@query("incremental_old_mtime", ORACLE_SQL["incremental_snapshots"])
def incremental_old_mtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-01: folders delivered later whose files carry times ten days older (as a preserving copy
    leaves them) are ingested like any other."""
    from lapmart.sinks import fs
    from lapmart.streaming.incremental import ingest_incremental

    root = scratch_dir(spark, "oldtime")
    raw_root, lake = f"{root}/raw", f"{root}/lake"
    raw = roles.raw_races(spark, sf_dir)
    first = F.col("year") % 2 == 0
    write_snapshots(raw.where(first), raw_root, "races.csv", "csv", "folder", header=True)
    ingest_incremental(spark, raw_root, lake, "races")
    write_snapshots(raw.where(~first | first.isNull()), raw_root, "races.csv", "csv", "folder", header=True)
    seen = set(fs.list_dirs(spark, raw_root))
    for folder in seen:
        if int(folder[:4]) % 2:
            fs.set_time(spark, f"{raw_root}/{folder}/races.csv", days_ago=10)
    ingest_incremental(spark, raw_root, lake, "races")
    return _tables.read_current(spark, f"{lake}/silver/races").select(
        "race_id", "race_year", "round", "circuit_id", "name", "file_date")


@query("upsert_missing_column", _SQL_SPLIT + """
SELECT COALESCE(t.result_id, s.result_id) AS result_id, COALESCE(s.race_id, t.race_id) AS race_id,
       t.points AS points
FROM tgt t FULL OUTER JOIN src s ON t.result_id = s.result_id
""")
def upsert_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-10: a column that the source lacks keeps its value in matched rows, NULL in inserted ones."""
    target, source = _results_split(spark, sf_dir)
    return upsert_all(target.select("result_id", "race_id", "points"), source.select("result_id", "race_id"),
                      ["result_id"])


@query("replace_table", """
SELECT p_partkey AS constructor_id, upper(p_brand) AS name FROM part
""")
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-09: a managed table created, then replaced by one of other columns."""
    root = scratch_dir(spark, "replace")
    db = "lapmart_" + _uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/db'")
    cons = roles.constructors(spark, sf_dir)
    _tables.replace_table(cons, f"{db}.constructors")
    _tables.replace_table(cons.select("constructor_id", F.upper("name").alias("name")), f"{db}.constructors")
    return _whole(spark, db, "constructors")


@query("view_merge_source", _SQL_SPLIT + """
SELECT * FROM tgt WHERE NOT EXISTS (
  SELECT 1 FROM src WHERE src.result_id = tgt.result_id AND src.grid >= 3)
UNION ALL
SELECT * FROM src WHERE grid >= 3
""")
def view_merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-16 + FLT-02: the merge's source is a registered view, filtered by a predicate in a string."""
    target, source = _results_split(spark, sf_dir)
    name = "lapmart_" + _uuid.uuid4().hex[:10]
    _tables.register_view(source, name)
    return upsert_all(target, spark.table(name).filter("grid >= 3"), ["result_id"])


@query("rank_bucketed", ORACLE_SQL["driver_standings"])
def rank_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-04 without a bound for the season's size: the distributed rank."""
    s = roles.silver_frames(spark, sf_dir)
    dedup = gold.race_results_deduped(s["results"], s["races"], s["circuits"], s["drivers"], s["constructors"],
                                      driver_cols=(("nationality", "driver_nationality"),))
    return _bigint(gold.driver_standings(dedup, stamp=False), "race_year", "rank")


def _second_run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Gold twice: the second run's facts have the later season's points doubled and two thirds of the races."""
    root = scratch_dir(spark, "gold2")
    frames = roles.silver_frames(spark, sf_dir)
    for n, df in frames.items():
        _tables.publish(spark, df, f"{root}/silver/{n}")
    gold.build_gold(spark, f"{root}/silver", f"{root}/gold")
    changed = frames["results"].where("race_id % 3 <> 0").withColumn("points", F.col("points") * 2)
    _tables.publish(spark, changed, f"{root}/silver/results")
    gold.build_gold(spark, f"{root}/silver", f"{root}/gold")
    return gold.read_gold(spark, f"{root}/gold", name, table=True)


@query("gold_build_rerun", _SQL_RACE_RESULTS + """
SELECT CAST(race_year AS BIGINT) AS race_year, race_name, race_date, driver_name, team,
       points * CASE WHEN CAST(substr(race_name, 7) AS BIGINT) % 3 <> 0 THEN 2 ELSE 1 END AS points,
       true AS stamped
FROM race_results
""")
def gold_build_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DS-G1 + SNK-12 across two runs: rows of the second run update, the others stay."""
    rr = _second_run(spark, sf_dir, "race_results")
    return _bigint(rr.select("race_year", "race_name", "race_date", "driver_name", "team", "points",
                             F.col("gold_processed_at").isNotNull().alias("stamped")), "race_year")


@query("gold_constructor_rerun", _SQL_RACE_RESULTS.rstrip() + """,
one AS (
  SELECT race_year, team, SUM(points) AS total_points,
         COUNT(CASE WHEN race_position = 1 THEN TRUE END) AS number_of_wins,
         RANK() OVER (PARTITION BY race_year ORDER BY SUM(points) DESC NULLS LAST) AS rank
  FROM race_results GROUP BY race_year, team),
two AS (
  SELECT race_year, team, SUM(points * 2) AS total_points,
         COUNT(CASE WHEN race_position = 1 THEN TRUE END) AS number_of_wins,
         RANK() OVER (PARTITION BY race_year ORDER BY SUM(points * 2) DESC NULLS LAST) AS rank
  FROM race_results WHERE CAST(substr(race_name, 7) AS BIGINT) % 3 <> 0 GROUP BY race_year, team)
SELECT CAST(one.race_year AS BIGINT) AS race_year, one.team,
       COALESCE(two.total_points, one.total_points) AS total_points,
       COALESCE(two.number_of_wins, one.number_of_wins) AS number_of_wins,
       CAST(COALESCE(two.rank, one.rank) AS BIGINT) AS rank
FROM one LEFT JOIN two ON one.race_year = two.race_year AND one.team = two.team
""")
def gold_constructor_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DS-G3 + SNK-12 across two runs: the persisted constructor standings take the second run's points, wins and
    ranks; teams that the second run lacks stay."""
    cs = _second_run(spark, sf_dir, "constructor_standings")
    return _bigint(cs.select("race_year", "team", "total_points", "number_of_wins", "rank"), "race_year", "rank")


# --- merges that write what they touch ----------------------------------------------------

from lapmart.sinks.merge import merge_into as _merge_into  # noqa: E402


@query("merge_partition_move", """
WITH r AS (
  SELECT o_orderkey AS race_id, CAST(year(o_orderdate) AS BIGINT) AS race_year, CAST(month(o_orderdate) AS INTEGER) AS round,
         o_custkey AS circuit_id, 'Order#' || CAST(o_orderkey AS VARCHAR) AS name, o_orderstatus
  FROM orders),
last AS (SELECT max(race_year) AS y FROM r)
SELECT race_id, CASE WHEN race_year = y AND o_orderstatus = 'O' THEN race_year + 1 ELSE race_year END AS race_year, round,
       circuit_id, CASE WHEN race_year = y AND o_orderstatus = 'O' THEN 'Moved ' || name ELSE name END AS name
FROM r, last
""")
def merge_partition_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-14 + SNK-10: races by season; the open races of the last season move to the next one.  Only these two
    seasons' partitions are written, the others are read from the first version."""
    base = scratch_dir(spark, "move") + "/races"
    races = roles.races(spark, sf_dir).select("race_id", "race_year", "round", "circuit_id", "name")
    first = _merge_into(spark, base, races, ["race_id"], partition_by=["race_year"], cluster_by=["race_id"])
    year = _tables.read_current(spark, base).agg(F.max("race_year")).first()[0]
    open_ = roles.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O").select(F.col("o_orderkey").alias("race_id"))
    moved = (races.where(F.col("race_year") == year).join(open_, "race_id", "left_semi")
             .withColumns({"race_year": F.col("race_year") + 1, "name": F.concat(F.lit("Moved "), "name")}))
    second = _merge_into(spark, base, moved, ["race_id"], partition_by=["race_year"], cluster_by=["race_id"])
    seasons = {f.rsplit("/", 2)[1] for f in spark.read.parquet(second).inputFiles()}
    assert seasons <= {f"race_year={year}", f"race_year={year + 1}"}, seasons
    assert first in _tables.live_units(spark, base)
    return _bigint(_tables.read_current(spark, base).select("race_id", "race_year", "round", "circuit_id", "name"),
                   "race_year")


@query("merge_touched_files", f"""WITH {_SQL_RESULTS},
tgt AS {_latest_sql("results")},
late AS (SELECT max(result_id) - max(result_id) // 10 AS k FROM results),
src AS {_latest_sql("results", "l_returnflag = 'R' AND result_id > (SELECT k FROM late)")}
SELECT t.result_id, t.race_id, t.driver_id, t.constructor_id, t.number, t.grid, t.position,
       t.position_text, t.position_order, CASE WHEN s.result_id IS NULL THEN t.points ELSE s.points * 2 END AS points,
       t.laps, t.time, t.fastest_lap, t.file_date
FROM tgt t LEFT JOIN src s ON t.result_id = s.result_id
""")
def merge_touched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-12 on files: results clustered by key; the corrections of the last tenth of the keys update the points.
    Files that hold none of their keys are neither read for the merge nor written again."""
    base = scratch_dir(spark, "files") + "/results"
    rows = latest_by_version(roles.results(spark, sf_dir), ["result_id"])
    _tables.publish(spark, rows.repartitionByRange(16, "result_id"), base)
    top = _tables.read_current(spark, base).agg(F.max("result_id")).first()[0]
    fixed = latest_by_version(roles.results(spark, sf_dir, F.col("l_returnflag") == "R"), ["result_id"])
    fixed = fixed.where(F.col("result_id") > top - top // 10).withColumn("points", F.col("points") * 2)
    _merge_into(spark, base, fixed, ["result_id"], update=["points"])
    live = _tables.live_units(spark, base)
    kept = sum(len(names) for d, names in live.items() if d.endswith("_v000001"))
    assert 8 <= kept < 16, live
    return _tables.read_current(spark, base).select(*_RESULT_NAMES)


@query("incremental_merge_on_read", ORACLE_SQL["incremental_snapshots"])
def incremental_merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-01: snapshots drained in batches of one file, each appended as a load; silver is read with the loads that
    no compaction has merged yet, an old snapshot that arrives late among them."""
    from lapmart.streaming import incremental

    root = scratch_dir(spark, "onread")
    raw_root, lake = f"{root}/raw", f"{root}/lake"
    raw = roles.raw_races(spark, sf_dir)
    early = F.col("year") <= 1994
    write_snapshots(raw.where(early), raw_root, "races.csv", "csv", "folder", header=True)
    incremental.ingest_incremental(spark, raw_root, lake, "races")
    old = raw.where("circuitId % 2 = 0").withColumns({
        "name": F.concat(F.lit("Late#"), F.col("raceId").cast("string")), "folder": F.lit("1900-12-31")})
    write_snapshots(raw.where(~early).unionByName(old), raw_root, "races.csv", "csv", "folder", header=True)
    done = incremental.ingest_incremental(spark, raw_root, lake, "races", max_files_per_trigger=1, compacted=False)
    bronze, silver = f"{lake}/bronze/races", f"{lake}/silver/races"
    assert done["batches"] > 1 and len(incremental.pending_loads(spark, silver)) == done["batches"]
    return incremental.read_newest(spark, bronze, silver, "races").select(
        "race_id", "race_year", "round", "circuit_id", "name", "file_date")


@query("corrupt_records", """
SELECT CAST(year(l_shipdate) AS VARCHAR) || '-12-31' AS file_date, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE l_linenumber IN (2, 3, 5)) AS n_corrupt,
       COUNT(*) FILTER (WHERE l_linenumber = 5) AS null_ids,
       COUNT(*) FILTER (WHERE l_linenumber IN (3, 5)) AS null_positions,
       COUNT(*) FILTER (WHERE l_linenumber IN (2, 5)) AS null_laps,
       CAST(SUM(CASE WHEN l_linenumber <> 5 THEN l_linenumber END) AS BIGINT) AS sum_grid
FROM lineitem GROUP BY 1
""")
def corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-07: results as JSON Lines of which some have a quoted position, 7.5 laps, or end in the middle.  Values
    that don't fit are NULL, the others of the row stay, and the records are counted by file; a load with more of
    them than allowed is taken back."""
    from lapmart.sinks import fs
    from lapmart.sources.snapshots import corrupt_counts

    root = scratch_dir(spark, "corrupt")
    raw = roles.raw_results(spark, sf_dir)
    line = F.to_json(F.struct(*(c for c in raw.columns if c != "folder")))
    n = F.col("number")
    line = _broken(line, n)
    write_snapshots(raw.select(line.alias("value"), "folder"), f"{root}/raw", "results.json", "text", "folder")
    try:
        _bronze.ingest_bronze(spark, f"{root}/raw", f"{root}/bronze", entities=["results"], max_corrupt=0)
        raise AssertionError("the gate let broken records pass")
    except _tables.QualityGateError:
        assert fs.list_names(spark, f"{root}/bronze/results") == []
    _bronze.ingest_bronze(spark, f"{root}/raw", f"{root}/bronze", entities=["results"])
    read = _bronze.read_bronze(spark, f"{root}/bronze", "results").groupBy("file_date").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("result_id").isNull()).alias("null_ids"),
        F.count_if(F.col("position").isNull()).alias("null_positions"),
        F.count_if(F.col("laps").isNull()).alias("null_laps"), F.sum("grid").alias("sum_grid"))
    bad = corrupt_counts(spark, f"{root}/raw", "results").groupBy("file_date").agg(F.sum("n_corrupt").alias("n_corrupt"))
    return read.join(bad, "file_date")


def _broken(line, n):
    return (F.when(n == 2, F.regexp_replace(line, r'"laps":\d+', '"laps":7.5'))
            .when(n == 3, F.regexp_replace(line, r'"position":(\d+)', r'"position":"$1"'))
            .when(n == 5, F.substring(line, 1, 30)).otherwise(line))


def _whole(spark: SparkSession, db: str, name: str) -> DataFrame:
    """The table's rows from its files; the database that the query made goes."""
    files = written_files(spark, f"{db}.{name}")
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return files


def written_files(spark: SparkSession, table_name: str) -> DataFrame:
    copy = scratch_dir(spark, "copy") + "/rows"
    df = spark.table(table_name)
    df.write.parquet(copy)
    return spark.read.schema(df.schema).parquet(copy)
