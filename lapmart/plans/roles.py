"""Silver-shaped views of the driver's TPC-H-like tables.

The benchmark and correctness data are not motor-racing files, so each
domain entity is played by one driver table (the "role map"):

=============  ===============================  ===========================================
entity         table                            columns
=============  ===============================  ===========================================
results        lineitem                         result_id = l_orderkey*10 + l_linenumber,
                                                race_id = l_orderkey, driver_id = l_suppkey,
                                                constructor_id = l_partkey,
                                                grid = position = l_linenumber,
                                                points = l_quantity, fastest_lap =
                                                int(l_quantity), time = returnflag||linestatus,
                                                file_date = l_shipdate (day)
races          orders                           race_id = o_orderkey,
                                                race_year = year(o_orderdate),
                                                round = month(o_orderdate),
                                                circuit_id = o_custkey,
                                                name = 'Order#' || o_orderkey,
                                                race_timestamp = o_orderdate
circuits       customer + nation                circuit_id = c_custkey, name = c_name,
                                                location = c_mktsegment, country = n_name,
                                                latitude = c_acctbal
drivers        supplier + nation                driver_id = s_suppkey, name = s_name,
                                                number = s_nationkey, nationality = n_name
constructors   part                             constructor_id = p_partkey, name = p_brand,
                                                nationality = p_type
=============  ===============================  ===========================================

Every function reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapmart.operators.joins import broadcast_if_bounded


# Declared schemas of the driver tables (reading with a declared schema skips
# the footer-inference job Spark otherwise runs for every read).
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def results(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    """``where``: optional predicate on lineitem columns (pushed to the scan)."""
    li = table(spark, sf_dir, "lineitem")
    if where is not None:
        li = li.where(where)
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("result_id"),
        F.col("l_orderkey").alias("race_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.col("l_partkey").alias("constructor_id"),
        F.col("l_linenumber").alias("number"),
        F.col("l_linenumber").alias("grid"),
        F.col("l_linenumber").alias("position"),
        F.col("l_linenumber").cast("string").alias("position_text"),
        F.col("l_linenumber").alias("position_order"),
        F.col("l_quantity").alias("points"),
        F.col("l_quantity").cast("int").alias("laps"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("time"),
        F.col("l_quantity").cast("int").alias("fastest_lap"),
        F.date_format(F.col("l_shipdate"), "yyyy-MM-dd").alias("file_date"),
    )


def races(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("race_id"),
        F.year("o_orderdate").alias("race_year"),
        F.month("o_orderdate").alias("round"),
        F.col("o_custkey").alias("circuit_id"),
        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderdate").alias("race_timestamp"),
    )


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = broadcast_if_bounded(_nation(spark, sf_dir))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner").select(
        F.col("c_custkey").alias("circuit_id"),
        F.col("c_name").alias("circuit_ref"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("location"),
        F.col("n_name").alias("country"),
        F.col("c_acctbal").alias("latitude"),
        (F.col("c_custkey") % 360 - 180).cast("double").alias("longitude"),
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = broadcast_if_bounded(_nation(spark, sf_dir))
    return s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner").select(
        F.col("s_suppkey").alias("driver_id"),
        F.col("s_name").alias("driver_ref"),
        F.col("s_nationkey").alias("number"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("nationality"),
    )


def constructors(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("constructor_id"),
        F.col("p_name").alias("constructor_ref"),
        F.col("p_brand").alias("name"),
        F.col("p_type").alias("nationality"),
    )


def silver_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "results": results(spark, sf_dir),
        "races": races(spark, sf_dir),
        "circuits": circuits(spark, sf_dir),
        "drivers": drivers(spark, sf_dir),
        "constructors": constructors(spark, sf_dir),
    }


# --------------------------------------------------------------------------- raw-shaped
# Driver tables rendered in the raw snapshot layout (camelCase columns as in
# the raw files, plus the snapshot folder).  Used by the scan and incremental
# queries: write them as raw folders, read them back with the declared schema.

def race_time_text(priority, custkey, orderkey):
    """A race start time as raw text; some priorities give unparseable text."""
    hh = F.lpad((custkey % 24).cast("string"), 2, "0")
    mm = F.lpad((orderkey % 60).cast("string"), 2, "0")
    return (F.when(priority == "2-HIGH", F.lit("\\N"))
            .when(priority == "3-MEDIUM", F.lit(""))
            .when(priority == "5-LOW", F.lit("25:00:00"))
            .otherwise(F.concat(hh, F.lit(":"), mm, F.lit(":00"))))


def raw_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("raceId"), F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("round"), F.col("o_custkey").alias("circuitId"),
        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        race_time_text(F.col("o_orderpriority"), F.col("o_custkey"), F.col("o_orderkey"))
        .alias("time"),
        F.col("o_orderpriority").alias("url"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-12-31")).alias("folder"),
    )


def raw_laptimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("raceId"), F.col("l_suppkey").alias("driverId"),
        F.col("l_linenumber").alias("lap"), F.col("l_partkey").alias("position"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("time"),
        (F.col("l_quantity").cast("int") * 1000).alias("milliseconds"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit("-12-31")).alias("folder"),
    )


def raw_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = broadcast_if_bounded(table(spark, sf_dir, "nation").select("n_nationkey", "n_name",
                                                                   "n_regionkey"))
    r = broadcast_if_bounded(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    j = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") ==
                                                              r["r_regionkey"])
    return j.select(
        F.col("s_suppkey").alias("driverId"), F.lower("s_name").alias("driverRef"),
        F.struct(F.col("s_name").alias("forename"), F.col("n_name").alias("surname"))
        .alias("name"),
        F.col("s_nationkey").alias("number"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("C"), F.col("s_nationkey").cast("string")))
        .alias("code"),
        F.lit("1990-01-01").alias("dob"), F.col("n_name").alias("nationality"),
        F.lit("u").alias("url"), F.col("r_name").alias("folder"),
    )


def raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    text = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("resultId"),
        F.col("l_orderkey").alias("raceId"), F.col("l_suppkey").alias("driverId"),
        F.col("l_partkey").alias("constructorId"), F.col("l_linenumber").alias("number"),
        F.col("l_linenumber").alias("grid"),
        F.col("l_linenumber").alias("position"),
        text.alias("positionText"), F.col("l_linenumber").alias("positionOrder"),
        F.col("l_quantity").cast("double").alias("points"),
        F.month("l_shipdate").alias("laps"), text.alias("time"),
        (F.col("l_quantity").cast("int") * 1000).alias("milliseconds"),
        F.dayofmonth("l_shipdate").alias("fastestLap"), F.quarter("l_shipdate").alias("rank"),
        F.col("l_returnflag").alias("fastestLapTime"), F.col("l_linestatus").alias("fastestLapSpeed"),
        F.lit("1").alias("statusId"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit("-12-31")).alias("folder"),
    )


def raw_circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), _nation(spark, sf_dir)
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        F.col("c_custkey").alias("circuitId"), F.lower("c_name").alias("circuitRef"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("location"),
        F.col("n_name").alias("country"), F.col("c_acctbal").cast("double").alias("lat"),
        (F.col("c_custkey") % 360 - 180).cast("double").alias("lng"),
        (F.col("c_custkey") % 900).alias("alt"), F.lit("u").alias("url"),
        F.col("c_mktsegment").alias("folder"))


def raw_constructors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("constructorId"), F.col("p_name").alias("constructorRef"),
        F.col("p_brand").alias("name"), F.col("p_type").alias("nationality"),
        F.lit("u").alias("url"), F.concat(F.lit("size "), F.col("p_size")).alias("folder"))


def raw_pitstops(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("raceId"), F.col("l_suppkey").alias("driverId"),
        F.col("l_linenumber").alias("stop"), F.month("l_shipdate").alias("lap"),
        F.col("l_returnflag").alias("time"), F.col("l_linestatus").alias("duration"),
        (F.col("l_quantity").cast("int") * 1000).alias("milliseconds"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit("-12-31")).alias("folder"))


def raw_qualifying(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("qualifyId"), F.col("o_orderkey").alias("raceId"),
        F.col("o_custkey").alias("driverId"), (F.col("o_custkey") % 100).alias("constructorId"),
        F.month("o_orderdate").alias("number"), F.dayofmonth("o_orderdate").alias("position"),
        F.col("o_orderstatus").alias("q1"), F.col("o_orderpriority").alias("q2"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("q3"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-12-31")).alias("folder"),
    )
