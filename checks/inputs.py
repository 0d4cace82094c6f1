"""Sensor tables derived from the driver's tables.

The same text defines each table for Spark and for DuckDB. The random values of ``events`` would
never freeze, drift or repeat, so they are shaped per parameter.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stillwater import use_utc

SITE = "CASE user_id % {NS} WHEN 0 THEN 'bellvue' WHEN 1 THEN 'salyer' ELSE 'udall' END"
PARAMETER = ("CASE event_type WHEN 'signup' THEN 'Temperature' WHEN 'purchase' THEN 'DO' WHEN 'error' THEN 'Turbidity' "
             "WHEN 'view' THEN 'Depth' ELSE 'Specific Conductivity' END")

SENSOR_RAW = f"""
SELECT {SITE} AS site,
  CAST(user_id AS STRING) AS id,
  CASE WHEN event_id % 211 = 0 THEN 'VuLink 9' ELSE 'sonde' END AS name,
  ts AS timestamp,
  {PARAMETER} AS parameter,
  CASE event_type
    WHEN 'signup'   THEN CASE WHEN day(ts) IN (5, 6) THEN value / 100 - 1.5 ELSE 5 + value / 20 END
    WHEN 'purchase' THEN CASE WHEN day(ts) BETWEEN 10 AND 14 THEN value / 30 ELSE 6 + value / 50 END
    WHEN 'error'    THEN 20 * (({{US}} / 86400000000.0E0) % 6) / 6 + value * 0.02E0
    WHEN 'view'     THEN CASE WHEN day(ts) = 20 THEN value / 100 - 2 ELSE 1 + value / 100 END
    ELSE round(value / 25) * 25 END AS value,
  'u' AS units
FROM events"""

# a site visit shows as an extreme reading
SENSOR_NOTES = f"""
SELECT {SITE} AS site, 'crew' AS crew, ts AS start_dt,
  CASE WHEN event_id % 3 = 0 THEN 'Sensor Calibration or Check' WHEN event_id % 3 = 1 THEN 'Sensor Swap' ELSE '???' END AS visit_type,
  CASE event_id % 4 WHEN 0 THEN 'Deployed' WHEN 1 THEN 'Pulled' WHEN 2 THEN 'Swapped' END AS sensor_change,
  (event_id % 2 = 0) AS sonde_moved,
  CASE WHEN event_id % 5 = 0 THEN 'wiper stuck' END AS sensor_malfunction,
  concat('visit ', CAST(event_id AS STRING)) AS visit_comments
FROM events WHERE value >= 280"""

MALFUNCTIONS = f"""
SELECT {SITE} AS site, ts AS start_dt,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE ts + INTERVAL 12 HOURS END AS end_dt,
  CASE event_type WHEN 'signup' THEN 'Temperature' WHEN 'purchase' THEN 'DO' WHEN 'error' THEN 'Turbidity' WHEN 'view' THEN 'Depth' END AS parameter,
  CASE event_id % 5 WHEN 0 THEN 'Buried in sediment' WHEN 1 THEN 'biofilm on wiper' WHEN 2 THEN 'improper level calibration'
       WHEN 3 THEN 'sonde not submerged' ELSE 'cable fault' END AS notes
FROM events WHERE value >= 240 AND value < 280"""

# the survey export: every event is a row, times in the crews' formats, free-text "other" answers
SURVEY = f"""
SELECT CASE WHEN event_id % 7 = 0 THEN 'Other (please specify)' ELSE {SITE} END AS site,
  CASE WHEN event_id % 7 = 0 THEN 'River Bluffs' END AS site_other,
  event_type AS crew,
  {{TEXT}} AS start_dt,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE {{TEXT}} END AS malfunction_end_dt,
  CASE event_id % 5 WHEN 0 THEN '???' WHEN 1 THEN 'Sensor Swap' WHEN 2 THEN 'Sensor malfunction'
       WHEN 3 THEN 'Other (please specify)' ELSE 'Grab sample' END AS visit_type,
  CASE WHEN event_id % 5 = 3 THEN 'Sensor install' END AS visit_type_other,
  CASE event_type WHEN 'view' THEN 'Chlorophyll a, RDO' WHEN 'click' THEN 'Conductivity' WHEN 'error' THEN 'Turbidity, Modem'
       WHEN 'signup' THEN 'Other (please specify)' END AS which_sensor_malfunction,
  CASE WHEN event_type = 'signup' THEN 'ORP' END AS other_which_sensor_malfunction,
  CASE event_id % 4 WHEN 0 THEN 'Deployed' WHEN 1 THEN 'Pulled' WHEN 2 THEN 'Swapped' END AS sensor_change,
  CASE WHEN event_id % 6 <> 0 THEN CAST(event_id AS STRING) END AS sn_removed,
  CASE WHEN event_id % 8 <> 0 THEN CAST(event_id + 1 AS STRING) END AS sn_deployed,
  (event_id % 2 = 0) AS sensors_cleaned,
  'no' AS photos_downloaded, CAST(NULL AS STRING) AS photos_downloaded_other,
  value AS do_pre_clean, value + 1 AS do_post_clean,
  concat('note ', CAST(event_id AS STRING)) AS visit_comments
FROM events"""

SPARK_FORMATS = ("yyyy-MM-dd", "yyyyMMdd HH:mm:ss", "MM/dd/yy HH:mm", "MM-dd-yyyy HH:mm", "MMM d, yy HH:mm")
DUCK_FORMATS = ("%Y-%m-%d", "%Y%m%d %H:%M:%S", "%m/%d/%y %H:%M", "%m-%d-%Y %H:%M", "%b %-d, %y %H:%M")


def _by_format(render, formats) -> str:
    cases = " ".join(f"WHEN {i} THEN {render(f)}" for i, f in enumerate(formats))
    return f"CASE event_id % {len(formats)} {cases} END"


def view_text(text: str, engine: str, sites: int = 3) -> str:
    spark = engine == "spark"
    us = "unix_micros(CAST(ts AS TIMESTAMP))" if spark else "epoch_us(ts)"
    stamp = (_by_format(lambda f: f"date_format(ts, '{f}')", SPARK_FORMATS) if spark
             else _by_format(lambda f: f"strftime(ts, '{f}')", DUCK_FORMATS))
    return text.replace("{NS}", str(sites)).replace("{US}", us).replace("{TEXT}", stamp)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, text: str, sites: int = 3) -> DataFrame:
    sql = view_text(text, "spark", sites).replace("FROM events", "FROM {events}")
    return spark.sql(sql, events=table(spark, sf_dir, "events"))


SPEC = {"Temperature": (-5.0, 12.0), "DO": (0.0, 9.0), "Turbidity": (0.0, 19.0), "Depth": (-1.5, 3.0)}

# (site, parameter) -> (t_mean01, t_mean99, t_slope_behind_01, t_slope_behind_99) for the one season there is
THRESHOLD_ROWS = tuple(
    ("winter_baseflow", site, parameter, *limits)
    for site in ("bellvue", "salyer", "udall")
    for parameter, limits in (
        ("Temperature", (4.5, 13.0, -0.08, 0.08)),
        ("DO", (4.0, 9.5, -0.03, 0.03)),
        ("Turbidity", (0.5, 21.0, -0.06, 0.06)),
        ("Depth", (0.5, 3.0, -0.02, 0.02)),
        ("Specific Conductivity", (0.0, 175.0, -2.0, 2.0)),
    )
)
THRESHOLD_NAMES = ("season", "site", "parameter", "t_mean01", "t_mean99", "t_slope_behind_01", "t_slope_behind_99")

NETWORK = "bellvue, salyer, udall"
HALF_MONTHS = "CASE WHEN day({t}) <= 15 THEN 'first' ELSE 'second' END"


def thresholds(spark: SparkSession) -> DataFrame:
    values = ", ".join(str(r) for r in THRESHOLD_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(THRESHOLD_NAMES)})").selectExpr(
        *THRESHOLD_NAMES[:3], *[f"CAST({c} AS DOUBLE) AS {c}" for c in THRESHOLD_NAMES[3:]])
