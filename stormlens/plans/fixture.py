"""The driver's tables seen as a rain-gauge network (FIXTURES.md §4).

``orders`` becomes raw readings; the stations whose id starts with the region
prefix form the study network. Spark-side stages are functions of
(spark, sf_dir); the same stages exist as SQL text (``SQL_PREFIX``) so the DuckDB
oracle computes every registered query independently from the same tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormlens.operators.calendar import densify
from stormlens.functions.calendar import parse_obs_date
from stormlens.operators.clean import clean_sentinels, filter_prefix, to_station_days
from stormlens.sources.readings import load_fixture_readings

PREFIX = "1371"
STATIONS = ("137110a", "137120a", "137130a", "137140a", "137150a")
TARGETS = STATIONS[:3]
NON_TARGETS = STATIONS[3:]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_fixture_readings(spark, sf_dir)


def region_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_prefix(readings(spark, sf_dir), "station_id", PREFIX)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station, obs_date, rain_mm) of the region, sentinels recoded."""
    return to_station_days(region_readings(spark, sf_dir))


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region readings with id, name and text timestamp kept, sentinels recoded."""
    r = clean_sentinels(region_readings(spark, sf_dir))
    return r.select("station_id", "name", "data_timestamp",
                    parse_obs_date("data_timestamp").alias("obs_date"), "rain_mm", "trace")


def named_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``named`` for every station of the network."""
    r = clean_sentinels(readings(spark, sf_dir))
    return r.select("station_id", "name", "data_timestamp",
                    parse_obs_date("data_timestamp").alias("obs_date"), "rain_mm", "trace")


def bounds(spark: SparkSession, sf_dir: str, everything: bool = False) -> tuple[dt.date, dt.date]:
    """First and last reading date of the region (or of all stations), from the data."""
    rows = to_station_days(readings(spark, sf_dir)) if everything else cleaned(spark, sf_dir)
    r = rows.agg(F.min("obs_date"), F.max("obs_date")).first()
    return r[0], r[1]


def grid_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dt.date, dt.date]:
    """The region's cleaned readings and the calendar's bounds."""
    return (cleaned(spark, sf_dir), *bounds(spark, sf_dir))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense (station, obs_date) calendar with daily means (NULL = no reading)."""
    return densify(*grid_input(spark, sf_dir))


# ---------------------------------------------------------------------------
# SQL text of the same stages (DuckDB dialect; tables are pre-registered views).
# ---------------------------------------------------------------------------

READINGS_SQL = """
readings AS (
  SELECT o_orderkey AS rid,
         (CASE WHEN o_orderstatus = 'P' THEN '1301' ELSE '1371' END)
            || substr(o_orderpriority, 1, 1) || '0a' AS station_id,
         substr(o_orderpriority, 3) AS name,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00.0 +0:00' AS data_timestamp,
         CASE WHEN o_orderkey % 101 = 0 THEN 9999e0
              WHEN o_orderkey % 37  = 0 THEN 8888e0
              WHEN o_orderkey % 53  = 0 THEN NULL
              WHEN o_orderkey % 2   = 0 THEN 0e0
              ELSE floor((o_totalprice/5e5)*(o_totalprice/5e5)*(o_totalprice/5e5)
                        *(o_totalprice/5e5)*25e2)/1e1 END AS rain_mm,
         CASE WHEN o_orderkey % 37 = 0 AND o_orderkey % 5 = 0 THEN 'Y' ELSE 'N' END AS trace
  FROM orders)"""

CLEANED_SQL = """
region AS (SELECT * FROM readings WHERE station_id LIKE '1371%'),
cleaned AS (
  SELECT station_id AS station, CAST(substr(data_timestamp, 1, 10) AS DATE) AS obs_date,
         CASE WHEN rain_mm = 9999e0 THEN NULL WHEN rain_mm = 8888e0 THEN 0e0
              ELSE rain_mm END AS rain_mm
  FROM region),
named AS (
  SELECT station_id, name, data_timestamp, CAST(substr(data_timestamp, 1, 10) AS DATE) AS obs_date,
         CASE WHEN rain_mm = 9999e0 THEN NULL WHEN rain_mm = 8888e0 THEN 0e0
              ELSE rain_mm END AS rain_mm, trace
  FROM region),
named_all AS (
  SELECT station_id, name, data_timestamp, CAST(substr(data_timestamp, 1, 10) AS DATE) AS obs_date,
         CASE WHEN rain_mm = 9999e0 THEN NULL WHEN rain_mm = 8888e0 THEN 0e0
              ELSE rain_mm END AS rain_mm, trace
  FROM readings)"""

GRID_SQL = """
daily AS (SELECT station, obs_date, avg(rain_mm) AS rain_mm FROM cleaned GROUP BY station, obs_date),
days AS (SELECT CAST(unnest(generate_series((SELECT min(obs_date) FROM cleaned), (SELECT max(obs_date) FROM cleaned),
                                            INTERVAL 1 DAY)) AS DATE) AS obs_date),
grid AS (
  SELECT s.station, d.obs_date, daily.rain_mm
  FROM (SELECT DISTINCT station FROM cleaned) s CROSS JOIN days d
  LEFT JOIN daily ON daily.station = s.station AND daily.obs_date = d.obs_date)"""

SQL_PREFIX = "WITH " + ",".join([READINGS_SQL, CLEANED_SQL, GRID_SQL])


def sql(*ctes: str, body: str) -> str:
    """Full oracle statement: shared prefix, extra CTEs, final SELECT."""
    extra = "".join("," + c for c in ctes)
    return f"{SQL_PREFIX}{extra}\n{body}"


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"
