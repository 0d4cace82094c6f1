"""One query per operator, each with the SQL that must give the same rows."""
from __future__ import annotations

import os
import tempfile
from collections.abc import Callable
from datetime import datetime

import stillwater as sw
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import inputs
from .inputs import SPEC, derived, table
from .sql import build, rows, tidy
from .values import DEFAULT_SITES, SITE_RENAMES

HOUR = sw.Layout("1 hour", gap_free=True)
GAPPED = sw.Layout("1 hour", gap_free=False)
SQL_DT = "strftime(dt_round, '%Y-%m-%d %H:%M:%S') AS dt"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, **options):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = build(sql, **options)
        return f
    return register


def r6(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def raw(spark, d, sites=3) -> DataFrame:
    return derived(spark, d, inputs.SENSOR_RAW, sites)


def padded(spark, d, sites=3) -> DataFrame:
    return sw.prepare_series(raw(spark, d, sites), "1 hour")


def notes(spark, d) -> DataFrame:
    return sw.sensor_notes(sw.clean_notes(derived(spark, d, inputs.SENSOR_NOTES), "1 hour"))


def with_stats(spark, d, sites=3) -> DataFrame:
    return sw.summary_statistics(padded(spark, d, sites), HOUR)


def time_range(spark, d) -> DataFrame:
    """First and last stamp of all readings, without the padded plan."""
    return sw.series_bounds(raw(spark, d), "1 hour").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))


def noted(spark, d) -> DataFrame:
    return sw.attach_field_notes(padded(spark, d), notes(spark, d), HOUR, time_range(spark, d))


def edges(spark) -> DataFrame:
    rows = [{"network_name": "clp", "network": inputs.NETWORK, "network_order": 0},
            {"network_name": "solo", "network": "bellvue", "network_order": 1}]
    return sw.network_edges(sw.normal_networks(sw.literal_table(spark, rows, sw.schema.NETWORKS)))


def dt() -> Column:
    return F.date_format("dt_round", "yyyy-MM-dd HH:mm:ss").alias("dt")


def keys() -> tuple:
    return dt(), "site", "parameter"


SQL_KEYS = f"{SQL_DT}, site, parameter"


# --- preparation -----------------------------------------------------------

@query(f"SELECT {SQL_KEYS}, units, round(mean, 6) AS mean, round(spread, 6) AS spread, n_obs FROM summary")
def interval_summary(spark, d):
    return sw.interval_summary(raw(spark, d), "1 hour").select(*keys(), "units", r6("mean"), r6("spread"), "n_obs")


@query(f"SELECT {SQL_KEYS}, units, round(mean, 6) AS mean, CAST(n_obs AS DOUBLE) AS n_obs FROM padded")
def pad_grid(spark, d):
    return padded(spark, d).select(*keys(), "units", r6("mean"), F.col("n_obs").cast("double").alias("n_obs"))


OLD_NAMES = ("CASE CAST(c_custkey AS BIGINT) % 11 WHEN 0 THEN 'Tamasag' WHEN 1 THEN 'Legacy' WHEN 2 THEN 'LINCOLN' "
             "WHEN 3 THEN 'Timberline' WHEN 4 THEN 'Prospect' WHEN 5 THEN 'boxelder' WHEN 6 THEN 'Archery' "
             "WHEN 7 THEN 'River Bluffs' WHEN 8 THEN 'MountainCampus' WHEN 9 THEN 'Legacy Lincoln' ELSE c_name END")
_renamed = "".join(f"WHEN contains(s, '{o}') THEN replace(s, '{o}', '{n}') " for o, n in SITE_RENAMES)


@query(f"SELECT c_custkey, CASE {_renamed} ELSE s END AS site FROM "
       f"(SELECT c_custkey, lower(concat({OLD_NAMES}, ' sonde')) AS s FROM customer)")
def site_names(spark, d):
    df = table(spark, d, "customer").selectExpr("c_custkey", f"concat({OLD_NAMES}, ' sonde') AS site")
    return sw.standardize_site_names(df)


@query("""SELECT event_id, 20 * value AS raw,
    CASE WHEN event_type = 'error' AND 20 * value >= 1000 THEN 1000 ELSE 20 * value END AS mean FROM events""")
def turbidity_cap(spark, d):
    df = table(spark, d, "events").selectExpr(
        "event_id", "CASE WHEN event_type = 'error' THEN 'Turbidity' ELSE 'DO' END AS parameter", "20 * value AS mean")
    return sw.standardize_turbidity(df).select("event_id", "raw", "mean")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS mean FROM orders")
def approval_mask(spark, d):
    df = table(spark, d, "orders").selectExpr(
        "o_orderkey", "o_totalprice AS mean", "CASE WHEN o_orderstatus = 'F' THEN 'OMIT' ELSE 'OK' END AS approval_status")
    return sw.mask_omitted(df).select("o_orderkey", "mean")


@query("SELECT c_custkey, CAST(NULL AS DOUBLE) AS raw, c_acctbal FROM customer")
def ensure_column(spark, d):
    df = sw.ensure_column(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "raw", dtype="double")
    return sw.ensure_column(df, "c_acctbal", default=0, dtype="double")


# --- statistics ------------------------------------------------------------

STATS = ("front1", "back1", "rollmed", "rollavg", "rollsd", "slope_ahead", "slope_behind", "rollslope")
_stats_sql = ", ".join(f"round({c}, 9) AS {c}" for c in STATS)


@query(f"SELECT {SQL_KEYS}, {_stats_sql}, month, year, y_m, season FROM stats")
def summary_stats(spark, d):
    return with_stats(spark, d).select(*keys(), *[F.round(c, 9).alias(c) for c in STATS], "month", "year", "y_m", "season")


@query(f"SELECT {SQL_KEYS}, {_stats_sql} FROM stats", source="summary")
def summary_stats_gapped(spark, d):
    """Unpadded series: frames are counted in rows, across the gaps."""
    df = sw.interval_summary(raw(spark, d), "1 hour")
    return sw.summary_statistics(df, sw.Layout("1 hour", gap_free=False, slots=64)).select(*keys(), *[F.round(c, 9).alias(c) for c in STATS])


@query("""SELECT o_orderkey, month(o_orderdate) AS month, concat(year(o_orderdate), ' - ', month(o_orderdate)) AS y_m,
    CASE WHEN month(o_orderdate) IN (12, 1, 2, 3, 4) THEN 'winter_baseflow' WHEN month(o_orderdate) IN (5, 6) THEN 'snowmelt'
         WHEN month(o_orderdate) IN (7, 8, 9) THEN 'monsoon' ELSE 'fall_baseflow' END AS season FROM orders""")
def season_class(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("dt_round"))
    return sw.operators.statistics.with_calendar(df).select("o_orderkey", "month", "y_m", "season")


# --- series flags ----------------------------------------------------------

@query(f"SELECT {SQL_KEYS}, CASE WHEN mean IS NULL THEN 'missing data' END AS flag FROM padded")
def flag_missing(spark, d):
    return sw.missing_flag(padded(spark, d)).select(*keys(), "flag")


@query(f"SELECT {SQL_KEYS}, CASE WHEN mean = front1 OR mean = back1 THEN 'repeated value' END AS flag FROM stats")
def flag_repeat(spark, d):
    return sw.repeat_flag(with_stats(spark, d)).select(*keys(), "flag")


@query(f"""SELECT {SQL_KEYS}, CASE WHEN mean < spec_min OR mean > spec_max THEN 'outside of sensor specification range' END AS flag
    FROM padded LEFT JOIN spec USING (parameter)""")
def flag_spec(spark, d):
    rows = [{"parameter": p, "spec_min": lo, "spec_max": hi} for p, (lo, hi) in SPEC.items()]
    spec = sw.literal_table(spark, rows, sw.schema.SENSOR_SPEC)
    return sw.spec_flag(padded(spark, d), spec).select(*keys(), "flag")


@query(f"""SELECT {SQL_KEYS}, nullif(concat_ws(';', CASE WHEN sonde_employed = 1 THEN 'sonde not employed' END,
    CASE WHEN visit THEN 'site visit' END, CASE WHEN sv THEN 'sv window' END), '') AS flag FROM rules2""")
def flag_field(spark, d):
    return sw.field_flags(noted(spark, d), HOUR).select(*keys(), "flag")


@query(f"""SELECT {SQL_KEYS}, nullif(concat_ws(';', CASE WHEN interfered THEN 'DO interference' END,
    CASE WHEN buried THEN 'Possible burial' END), '') AS flag FROM rules2""")
def flag_do_noise(spark, d):
    return sw.do_noise_flags(with_stats(spark, d), HOUR).select(*keys(), "flag")


@query(f"SELECT {SQL_KEYS}, CASE WHEN sonde_moved THEN 'sonde moved' END AS depth_change FROM noted")
def depth_shift(spark, d):
    return sw.depth_shift(noted(spark, d)).select(*keys(), "depth_change")


@query(f"""SELECT {SQL_KEYS}, s.kind AS depth_change FROM padded LEFT JOIN
    (SELECT DISTINCT site, dt_round, 'sonde moved' AS kind FROM snotes WHERE sonde_moved) s USING (site, dt_round)""")
def depth_shift_table(spark, d):
    shifts = notes(spark, d).select("site", "dt_round", F.when(F.col("sonde_moved"), "sonde moved").alias("type"))
    return sw.depth_shift(padded(spark, d), shifts).select(*keys(), "depth_change")


_season = inputs.HALF_MONTHS.format(t="dt_round")


@query(f"""SELECT site, parameter, season, round(t_mean01, 6) AS t_mean01, round(t_mean99, 6) AS t_mean99,
    round(t_slope_behind_01, 6) AS t_slope_behind_01, round(t_slope_behind_99, 6) AS t_slope_behind_99,
    round(t_sd_0199, 6) AS t_sd_0199 FROM (
      SELECT site, parameter, season, t_mean01, t_mean99, any_value(t_slope_behind_01) AS t_slope_behind_01,
        any_value(t_slope_behind_99) AS t_slope_behind_99, stddev_samp(mean) AS t_sd_0199
      FROM (SELECT * EXCLUDE (season), {_season} AS season FROM stats) JOIN (
        SELECT site, parameter, season, quantile_cont(mean, 0.01) AS t_mean01, quantile_cont(mean, 0.99) AS t_mean99,
          quantile_cont(slope_behind, 0.01) FILTER (WHERE slope_behind < 0) AS t_slope_behind_01,
          quantile_cont(slope_behind, 0.99) FILTER (WHERE slope_behind > 0) AS t_slope_behind_99
        FROM (SELECT * EXCLUDE (season), {_season} AS season FROM stats) GROUP BY ALL) q USING (site, parameter, season)
      WHERE mean > t_mean01 AND mean < t_mean99 GROUP BY ALL)""")
def threshold_table(spark, d):
    df = with_stats(spark, d).withColumn("season", F.expr(_season))
    out = sw.threshold_table(df)
    return out.select("site", "parameter", "season", *[r6(c) for c in out.columns[3:]])


@query(f"""SELECT {SQL_KEYS}, nullif(concat_ws(';', CASE WHEN off_season THEN 'outside of seasonal range' END,
    CASE WHEN steep THEN 'slope violation' END), '') AS flag FROM rules1""")
def flag_seasonal(spark, d):
    return sw.seasonal_flag(with_stats(spark, d), inputs.thresholds(spark)).select(*keys(), "flag")


@query(f"""SELECT {SQL_KEYS}, CASE WHEN drifting THEN 'drift' END AS flag
    FROM padded LEFT JOIN drift_alone USING (site, parameter, dt_round)""", sites=1)
def flag_drift(spark, d):
    return sw.drift_flag(padded(spark, d, sites=1), HOUR).select(*keys(), "flag")


@query(f"""SELECT {SQL_KEYS}, CASE WHEN drifting THEN 'drift' END AS flag
    FROM rules2 LEFT JOIN drift USING (site, parameter, dt_round)""")
def flag_drift_between_visits(spark, d):
    df = sw.drift_flag(sw.field_flags(noted(spark, d), HOUR), HOUR)
    return df.select(*keys(), F.when(F.col("flag").contains("drift"), "drift").alias("flag"))


# --- site flags ------------------------------------------------------------

@query(f"SELECT {SQL_KEYS}, CASE WHEN bool_or(parameter = 'Temperature' AND mean <= 0) OVER (PARTITION BY site, dt_round) "
       "THEN 'frozen' END AS flag FROM padded")
def flag_frozen(spark, d):
    return sw.frozen_flag(padded(spark, d)).select(*keys(), "flag")


def _unsubmerged(name: str, method: str, condition: str):
    def run(spark, d):
        return sw.unsubmerged_flag(padded(spark, d), method).select(*keys(), "flag")
    run.__name__ = name
    query(f"SELECT {SQL_KEYS}, CASE WHEN bool_or({condition}) OVER (PARTITION BY site, dt_round) "
          "THEN 'sonde unsubmerged' END AS flag FROM padded")(run)


_unsubmerged("flag_unsubmerged", "depth", "parameter = 'Depth' AND mean <= 0")
_unsubmerged("flag_unsubmerged_sc", "sc", "parameter = 'Specific Conductivity' AND mean <= 10")
_unsubmerged("flag_unsubmerged_depth_sc", "depth_sc",
             "(parameter = 'Depth' AND mean <= 0) OR (parameter = 'Specific Conductivity' AND mean <= 10)")


@query(f"""SELECT {SQL_KEYS}, CASE WHEN off_season AND steep AND NOT dropped THEN 'outside of seasonal range;slope violation'
    WHEN off_season AND steep THEN 'outside of seasonal range;' WHEN off_season THEN 'outside of seasonal range'
    WHEN steep AND NOT dropped THEN 'slope violation' END AS flag
    FROM (SELECT *, parameter IN ('Temperature', 'Depth') OR bool_or(explains) OVER (PARTITION BY site, dt_round) AS dropped FROM rules2)""")
def slope_reconcile(spark, d):
    df = sw.seasonal_flag(with_stats(spark, d), inputs.thresholds(spark))
    return sw.reconcile_slope(df, HOUR).select(*keys(), "flag")


@query(f"""SELECT {SQL_KEYS}, CASE WHEN parameter = 'DO' THEN nullif(concat_ws(';', CASE WHEN interfered THEN 'DO interference' END,
    CASE WHEN buried THEN 'Possible burial' END), '') WHEN bool_or(buried) OVER (PARTITION BY site, dt_round)
    THEN 'Possible burial' END AS flag FROM rules2""")
def burial_spread(spark, d):
    return sw.spread_burial(sw.do_noise_flags(with_stats(spark, d), HOUR)).select(*keys(), "flag")


@query(f"SELECT {SQL_KEYS}, mal_flag FROM padded LEFT JOIN mal_flags USING (site, parameter, dt_round)")
def flag_malfunction(spark, d):
    records = derived(spark, d, inputs.MALFUNCTIONS)
    return sw.malfunction_flag(padded(spark, d), records, HOUR).select(*keys(), "mal_flag")


# --- network and finish ----------------------------------------------------

@query("""SELECT site, lag(site) OVER w AS up, lead(site) OVER w AS down
    FROM (SELECT *, replace(lower(n_name), '_', '') AS site FROM nation) WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_nationkey)""")
def network_edges(spark, d):
    nations = table(spark, d, "nation").groupBy("n_regionkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))),
                                 lambda s: s["n_name"]), ", ").alias("network"))
    regions = table(spark, d, "region").join(nations, F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.lower("r_name").alias("network_name"), "network", F.col("r_regionkey").alias("network_order"))
    return sw.network_edges(sw.normal_networks(regions)).select("site", "up", "down")


def site_flagged(spark, d) -> DataFrame:
    flags = sw.plans.pipeline.flag_site_evidence
    return flags(padded(spark, d), time_range(spark, d), HOUR, notes=notes(spark, d), malfunctions=derived(spark, d, inputs.MALFUNCTIONS),
                 thresholds=inputs.thresholds(spark), spec=SPEC)


@query(f"""SELECT {SQL_KEYS}, flag, mal_flag FROM site_flags LEFT JOIN mal_flags USING (site, parameter, dt_round)""")
def site_evidence(spark, d):
    return site_flagged(spark, d).select(*keys(), "flag", "mal_flag")


@query(f"SELECT {SQL_KEYS}, net_flag AS auto_flag FROM networked")
def network_check(spark, d):
    return sw.network_check(site_flagged(spark, d), edges(spark), HOUR).select(*keys(), "auto_flag")


MESSY = ("concat_ws(';', CASE o_orderkey % 9 WHEN 0 THEN 'drift' WHEN 1 THEN 'site visit' WHEN 2 THEN 'sv window' WHEN 3 THEN 'frozen' "
         "WHEN 4 THEN 'slope violation' WHEN 5 THEN '' END, CASE o_custkey % 5 WHEN 0 THEN ' Possible burial' WHEN 1 THEN 'drift ' "
         "WHEN 2 THEN '' WHEN 3 THEN 'outside of seasonal range' END, CASE o_orderstatus WHEN 'F' THEN 'DO interference' END)")


@query(f"SELECT o_orderkey, {tidy('f')} AS auto_flag FROM (SELECT o_orderkey, {MESSY} AS f FROM orders)")
def tidy_flags(spark, d):
    return sw.tidy_flags(table(spark, d, "orders").selectExpr("o_orderkey", f"{MESSY} AS auto_flag"))


@query(f"SELECT {SQL_KEYS}, sus_flag AS auto_flag FROM suspected")
def flag_suspect(spark, d):
    df = sw.tidy_flags(sw.network_check(site_flagged(spark, d), edges(spark), HOUR))
    return sw.suspect_flag(df, HOUR).select(*keys(), "auto_flag")


@query(f"SELECT {SQL_KEYS}, auto_flag FROM lonely")
def lone_suspect(spark, d):
    df = sw.tidy_flags(sw.network_check(site_flagged(spark, d), edges(spark), HOUR))
    return sw.drop_lone_suspect(sw.suspect_flag(df, HOUR), HOUR).select(*keys(), "auto_flag")


def pipeline(spark, d, interval="1 hour") -> DataFrame:
    return sw.run_pipeline(
        raw(spark, d), notes=sw.sensor_notes(sw.clean_notes(derived(spark, d, inputs.SENSOR_NOTES), interval)),
        malfunctions=derived(spark, d, inputs.MALFUNCTIONS), thresholds=inputs.thresholds(spark), spec=SPEC,
        edges=edges(spark), interval=interval)


@query(f"""SELECT {SQL_DT}, {SQL_DT.replace(' AS dt', ' AS dt_join')}, site, parameter, round(mean, 6) AS mean, units,
    CAST(n_obs AS DOUBLE) AS n_obs, round(spread, 6) AS spread, auto_flag, mal_flag,
    CASE WHEN sonde_moved THEN 'yes' WHEN NOT sonde_moved THEN 'no' END AS sonde_moved, sonde_employed, season,
    strftime(last_site_visit, '%Y-%m-%d %H:%M:%S') AS last_site_visit
    FROM lonely LEFT JOIN mal_flags USING (site, parameter, dt_round)""")
def final_flags(spark, d):
    """The whole run, from raw readings to published flags."""
    df = sw.final_projection(pipeline(spark, d))
    return df.select(
        dt(), "dt_join", "site", "parameter", r6("mean"), "units", F.col("n_obs").cast("double").alias("n_obs"), r6("spread"),
        "auto_flag", "mal_flag",
        F.when(F.col("sonde_moved"), "yes").when(~F.col("sonde_moved"), "no").alias("sonde_moved"), "sonde_employed",
        "season", F.date_format("last_site_visit", "yyyy-MM-dd HH:mm:ss").alias("last_site_visit"))


@query(f"""SELECT {SQL_KEYS}, round(mean_filled, 6) AS mean_filled, round(s3, 6) AS smoothed_mean,
    CASE site WHEN 'bellvue' THEN 'Bellvue' WHEN 'salyer' THEN 'Salyer' ELSE 'Udall' END AS site_dashboard,
    round(CASE parameter WHEN 'Turbidity' THEN s3 WHEN 'Temperature' THEN mean * 9 / 5 + 32 ELSE mean END, 6) AS mean_dashboard
    FROM pass3""")
def dashboard(spark, d):
    df = sw.low_pass(sw.interpolate_gaps(padded(spark, d), HOUR), HOUR, "mean_filled")
    return sw.dashboard_columns(df).select(*keys(), r6("mean_filled"), r6("smoothed_mean"), "site_dashboard", r6("mean_dashboard"))


# --- signal ----------------------------------------------------------------

@query(f"SELECT {SQL_KEYS}, round(mean_filled, 6) AS mean_filled FROM filled")
def interp_linear(spark, d):
    return sw.interpolate_gaps(padded(spark, d), HOUR).select(*keys(), r6("mean_filled"))


@query()
def interp_spline(spark, d):
    return sw.interpolate_gaps(padded(spark, d), HOUR, method="spline").select(*keys(), r6("mean_filled"))


# The curve of a whole series at once: elimination and back substitution of its tridiagonal system, row by row. The outer
# equations take the third derivative from the cubics through the first and the last four values.
_by = "PARTITION BY site ORDER BY x"
_spline_body = f"""known AS (SELECT site, epoch(dt_round) AS x, mean AS y, row_number() OVER (PARTITION BY site ORDER BY dt_round) AS i
    FROM padded WHERE parameter = 'Turbidity' AND mean IS NOT NULL),
  knots AS (SELECT *, lead(x) OVER w - x AS h, (lead(y) OVER w - y) / (lead(x) OVER w - x) AS m, x - lag(x) OVER w AS h0, (y - lag(y) OVER w) / (x - lag(x) OVER w) AS m0,
    count(*) OVER (PARTITION BY site) AS n FROM known WINDOW w AS ({_by})),
  sys AS (SELECT site, i, n, x, y, h, m, h0,
    CASE WHEN i = 1 THEN -h WHEN i = n THEN -h0 ELSE 2 * (h + h0) END AS b,
    CASE WHEN i = 1 THEN ((lead(m, 2) OVER w - lead(m, 1) OVER w) / (lead(x, 3) OVER w - lead(x, 1) OVER w) - (lead(m, 1) OVER w - m) / (lead(x, 2) OVER w - x))
        * h * h / (lead(x, 3) OVER w - x)
      WHEN i = n THEN -((m0 - lag(m0, 1) OVER w) / (x - lag(x, 2) OVER w) - (lag(m0, 1) OVER w - lag(m0, 2) OVER w) / (lag(x, 1) OVER w - lag(x, 3) OVER w))
        * h0 * h0 / (x - lag(x, 3) OVER w)
      ELSE m - m0 END AS r FROM knots WINDOW w AS ({_by})),
  down AS (SELECT site, i, b, r FROM sys WHERE i = 1
    UNION ALL SELECT s.site, s.i, s.b - s.h0 * s.h0 / f.b, s.r - s.h0 / f.b * f.r FROM down f JOIN sys s ON s.site = f.site AND s.i = f.i + 1),
  up AS (SELECT f.site, f.i, f.r / f.b AS c FROM down f JOIN sys s ON s.site = f.site AND s.i = f.i WHERE s.i = s.n
    UNION ALL SELECT f.site, f.i, (f.r - s.h * u.c) / f.b FROM up u JOIN down f ON f.site = u.site AND f.i = u.i - 1 JOIN sys s ON s.site = f.site AND s.i = f.i),
  cubic AS (SELECT s.site, s.i, s.x, s.y, s.m - s.h * (z.c + 2 * a.c) AS b, 3 * a.c AS c, (z.c - a.c) / s.h AS e
    FROM sys s JOIN up a ON a.site = s.site AND a.i = s.i JOIN up z ON z.site = s.site AND z.i = s.i + 1),
  gaps AS (SELECT *, count(*) FILTER (WHERE mean IS NULL) OVER (PARTITION BY site, parameter, g) AS run FROM (
    SELECT *, epoch(dt_round) AS t, count(mean) OVER (PARTITION BY site, parameter ORDER BY dt_round) AS g FROM padded)),
  splined AS (SELECT p.site, p.parameter, p.dt_round, CASE WHEN p.parameter <> 'Turbidity' THEN NULL WHEN p.mean IS NOT NULL THEN p.mean
      WHEN p.run <= 4 THEN c.y + (t - c.x) * (c.b + (t - c.x) * (c.c + (t - c.x) * c.e)) END AS mean_filled
    FROM gaps p LEFT JOIN (SELECT site, max(i) AS top FROM cubic GROUP BY site) l ON l.site = p.site
    LEFT JOIN cubic c ON c.site = p.site AND c.i = greatest(least(p.g, l.top), 1))"""
_padded = build("SELECT * FROM padded")
ORACLE["interp_spline"] = (f"{_padded[:_padded.rindex('SELECT * FROM padded')].rstrip()},\n  {_spline_body}\n"
                           f"SELECT {SQL_KEYS}, round(mean_filled, 6) AS mean_filled FROM splined").replace("WITH", "WITH RECURSIVE", 1)


# --- rules that rarely fire, on readings that make them -----------------------

_LONE = "CASE WHEN unix_or_epoch % 7 = 0 THEN 'suspect data' WHEN unix_or_epoch % 11 < 3 THEN 'drift' END"


@query(f"""SELECT {SQL_KEYS}, CASE WHEN f = 'suspect data' AND lag(f) OVER w IS NULL AND lead(f) OVER w IS NULL THEN NULL ELSE f END AS auto_flag
    FROM (SELECT *, {_LONE.replace('unix_or_epoch', "(epoch_us(dt_round) // 3600000000)")} AS f FROM padded)
    WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)""")
def lone_suspect_dropped(spark, d):
    """Every seventh hour is suspect, three of eleven drift: most suspects stand alone and go."""
    flagged = padded(spark, d).withColumn("auto_flag", F.expr(_LONE.replace("unix_or_epoch", "(unix_seconds(dt_round) div 3600)")))
    return sw.drop_lone_suspect(flagged, HOUR).select(*keys(), "auto_flag")


@query(f"SELECT {SQL_KEYS}, round(s3, 6) AS smoothed_mean FROM pass3")
def low_pass(spark, d):
    filled = sw.interpolate_gaps(padded(spark, d), HOUR)
    return sw.low_pass(filled, HOUR, "mean_filled").select(*keys(), r6("smoothed_mean"))


@query("""SELECT site, parameter, min(step) AS min_step, max(step) AS max_step,
    coalesce(min(step) <> max(step), false) AS irregular FROM (
      SELECT site, parameter, CAST(epoch(dt_round) - epoch(lag(dt_round) OVER (PARTITION BY site, parameter ORDER BY dt_round)) AS BIGINT) AS step
      FROM summary) GROUP BY ALL""")
def spacing_report(spark, d):
    return sw.spacing_report(sw.interval_summary(raw(spark, d), "1 hour"), GAPPED)


# --- notes -----------------------------------------------------------------

_half = "make_timestamp(((epoch_us({t}) + 450000000) // 900000000) * 900000000)"
# what each written form keeps of the time
_kept = """CASE event_id % 5 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('second', ts) ELSE date_trunc('minute', ts) END"""
_site = inputs.SITE.replace("{NS}", "3")
_survey = f"""SELECT *, {_kept} AS t, CASE WHEN event_id % 7 = 0 THEN 'riverbluffs' ELSE {_site} END AS site,
    CASE WHEN event_id % 4 <> 0 THEN {_kept} END AS t_end,
    CASE event_id % 5 WHEN 0 THEN 'Sensor Calibration or Check' WHEN 1 THEN 'Sensor Swap' WHEN 2 THEN 'Sensor malfunction'
        WHEN 3 THEN 'Sensor install' ELSE 'Grab sample' END AS visit_type,
    CASE WHEN event_id % 6 <> 0 THEN CAST(event_id AS VARCHAR) END AS pulled,
    CASE WHEN event_id % 8 <> 0 THEN CAST(event_id + 1 AS VARCHAR) END AS deployed FROM events"""


def survey(spark, d) -> DataFrame:
    return sw.clean_notes(derived(spark, d, inputs.SURVEY), "15 minutes")


def text_time(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def sql_time(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {name}"


@query(f"""SELECT {sql_time('t', 'start_dt')}, {sql_time('t_end', 'malfunction_end_dt')}, {sql_time(_half.format(t='t'), 'dt_round')},
    site, visit_type, pulled AS sensor_pulled, deployed AS sensor_deployed,
    CASE event_type WHEN 'view' THEN 'Chlorophyll a, RDO' WHEN 'click' THEN 'Conductivity' WHEN 'error' THEN 'Turbidity, Modem'
        WHEN 'signup' THEN 'ORP' END AS which_sensor_malfunction, concat('note ', event_id) AS visit_comments FROM ({_survey})""")
def notes_clean(spark, d):
    return survey(spark, d).select(
        text_time("start_dt"), text_time("malfunction_end_dt"), text_time("dt_round"), "site", "visit_type", "sensor_pulled",
        "sensor_deployed", "which_sensor_malfunction", "visit_comments")


@query(f"""SELECT site, {sql_time(_half.format(t='t'), 'dt_join')},
    CASE event_id % 4 WHEN 1 THEN '1' WHEN 0 THEN '0' END AS sonde_employed,
    CASE event_id % 4 WHEN 1 THEN 'SN Removed: ' || pulled WHEN 0 THEN deployed
      WHEN 2 THEN concat('SN Removed: ', coalesce(pulled, 'NA'), ' SN Deployed: ', coalesce(deployed, 'NA')) END AS sensor_swapped_notes,
    visit_type, year({_half.format(t='t')}) AS field_season, concat('note ', event_id) AS visit_comments
    FROM ({_survey}) WHERE event_id % 5 IN (0, 1, 3)""")
def notes_sensor(spark, d):
    return sw.sensor_notes(survey(spark, d)).select(
        "site", "dt_join", F.col("sonde_employed").cast("string").alias("sonde_employed"), "sensor_swapped_notes", "visit_type",
        "field_season", "visit_comments")


@query(f"""SELECT site, {sql_time('t', 'start_dt')}, {sql_time('t_end', 'end_dt')}, p AS parameter, concat('note ', event_id) AS notes
    FROM (SELECT *, unnest(CASE event_type WHEN 'view' THEN ['Chl-a Fluorescence', 'DO'] WHEN 'click' THEN ['Specific Conductivity']
      WHEN 'error' THEN ['Turbidity'] WHEN 'signup' THEN ['ORP'] ELSE [NULL] END) AS p FROM ({_survey})) WHERE event_id % 5 = 2""")
def notes_malfunction(spark, d):
    return sw.malfunction_notes(survey(spark, d)).select("site", text_time("start_dt"), text_time("end_dt"), "parameter", "notes")


@query(f"""SELECT site, {sql_time('t', 'start_dt')}, strftime(t, '%Y-%m-%d') AS date, (event_id % 2 = 0) AS sensors_cleaned,
    value + 1 AS do_post_clean, value AS do_pre_clean FROM ({_survey})""")
def notes_cleaning(spark, d):
    return sw.cleaning_notes(survey(spark, d)).select(
        "site", text_time("start_dt"), F.col("date").cast("string").alias("date"), "sensors_cleaned", "do_post_clean", "do_pre_clean")


@query(f"""SELECT {SQL_KEYS}, sonde_employed, {sql_time('last_site_visit', 'last_site_visit')}, sensor_malfunction, visit_comments,
    CASE WHEN sonde_moved THEN 'yes' WHEN NOT sonde_moved THEN 'no' END AS sonde_moved FROM noted""")
def field_notes_asof(spark, d):
    return noted(spark, d).select(
        *keys(), "sonde_employed", text_time("last_site_visit"), "sensor_malfunction", "visit_comments",
        F.when(F.col("sonde_moved"), "yes").when(~F.col("sonde_moved"), "no").alias("sonde_moved"))


# --- merging ---------------------------------------------------------------

_HIST = "dt_round < TIMESTAMP '2024-01-20 00:00:00' AND NOT (site = 'udall' AND parameter = 'Depth')"
_NEW = "dt_round >= TIMESTAMP '2024-01-18 00:00:00' AND NOT (site = 'salyer' AND parameter = 'DO')"
_OLD_FLAG = "CASE WHEN mean IS NULL THEN 'missing data' WHEN mean > 10 THEN 'drift' END"


def history(spark, d) -> DataFrame:
    return padded(spark, d).where(_HIST).withColumn("auto_flag", F.expr(_OLD_FLAG)).withColumn(
        "sonde_moved", F.lit(False)).drop("flag")


def incoming(spark, d) -> DataFrame:
    return padded(spark, d).where(_NEW)


_hist_sql = f"hist AS (SELECT *, {_OLD_FLAG} AS auto_flag, max(dt_round) OVER (PARTITION BY site, parameter) - INTERVAL 3 DAYS AS cut FROM padded WHERE {_HIST})"
_new_sql = f"inc AS (SELECT * FROM padded WHERE {_NEW})"


def _merge_oracle(body: str) -> str:
    base = build("SELECT * FROM padded")
    base = base[: base.rindex("\nSELECT * FROM padded")]
    return f"{base},\n{_hist_sql},\n{_new_sql}\n{body}"


@query()
def merge_preflag(spark, d):
    out = sw.merge_preflag(incoming(spark, d), history(spark, d), "3 days")
    return out.select(*keys(), r6("mean"), "flag", "historical")


ORACLE["merge_preflag"] = _merge_oracle(f"""SELECT {SQL_KEYS}, round(mean, 6) AS mean, auto_flag AS flag, true AS historical
    FROM hist WHERE dt_round >= cut AND (site, parameter) IN (SELECT DISTINCT (site, parameter) FROM inc)
    UNION ALL SELECT {SQL_KEYS}, round(mean, 6), NULL, false FROM inc i
    WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.site = i.site AND h.parameter = i.parameter AND h.dt_round = i.dt_round AND h.dt_round >= h.cut)""")


def reflagged(spark, d) -> DataFrame:
    """What a new run makes of the merged rows: values above 9 drift now."""
    merged = sw.merge_preflag(incoming(spark, d), history(spark, d), "3 days")
    return merged.withColumn("auto_flag", F.when(F.col("mean") > 9, "drift").otherwise(F.col("flag"))).drop("flag")


_merged_cte = f"""merged AS (SELECT site, parameter, dt_round, mean, auto_flag AS flag, true AS historical FROM hist
      WHERE dt_round >= cut AND (site, parameter) IN (SELECT DISTINCT (site, parameter) FROM inc)
    UNION ALL SELECT site, parameter, dt_round, mean, NULL, false FROM inc i
      WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.site = i.site AND h.parameter = i.parameter AND h.dt_round = i.dt_round AND h.dt_round >= h.cut)),
    reflagged AS (SELECT * EXCLUDE (flag), CASE WHEN mean > 9 THEN 'drift' ELSE flag END AS auto_flag FROM merged)"""


@query()
def merge_archive(spark, d):
    old = history(spark, d).withColumn("historical", F.lit(True))
    return sw.merge_archive(reflagged(spark, d), old, "3 days").select(*keys(), r6("mean"), "auto_flag", "historical")


ORACLE["merge_archive"] = _merge_oracle(f"""SELECT {SQL_KEYS}, round(mean, 6) AS mean, auto_flag, true AS historical FROM hist
    WHERE dt_round < cut OR (site, parameter) NOT IN (SELECT DISTINCT (site, parameter) FROM reflagged)
    UNION ALL SELECT {SQL_KEYS}, round(mean, 6), auto_flag, true FROM reflagged""").replace(
        f"{_new_sql}\n", f"{_new_sql},\n{_merged_cte}\n")


@query()
def overlap_changes(spark, d):
    return sw.overlap_changes(reflagged(spark, d), history(spark, d), "3 days")


ORACLE["overlap_changes"] = _merge_oracle("""SELECT h.site, h.parameter, count(*) AS changed_rows
    FROM hist h JOIN reflagged r USING (site, parameter, dt_round)
    WHERE h.dt_round >= h.cut AND (h.auto_flag IS DISTINCT FROM r.auto_flag OR h.mean IS DISTINCT FROM r.mean) GROUP BY ALL
    """).replace(f"{_new_sql}\n", f"{_new_sql},\n{_merged_cte}\n")


def committed(spark, d, rows: DataFrame) -> tuple[str, sw.Commit]:
    """An archive of these rows alone, and its commit."""
    root = work_dir(spark, "archive")
    return root, sw.write_back(spark, root, rows.withColumn("historical", F.lit(True)), "3 days")


@query()
def archive_write_back(spark, d):
    """``merge_archive``'s rows, read back from an archive in which only the touched months were written."""
    root, first = committed(spark, d, history(spark, d))
    touched = incoming(spark, d).select("site", "parameter").distinct()
    merged = sw.merge_preflag(incoming(spark, d), sw.trailing_rows(spark, root, touched, "3 days", first), "3 days", cut=True)
    again = merged.withColumn("auto_flag", F.when(F.col("mean") > 9, "drift").otherwise(F.col("flag"))).drop("flag")
    commit = sw.write_back(spark, root, again, "3 days", base=first)
    return sw.read_archive(spark, root, commit=commit).select(*keys(), r6("mean"), "auto_flag", "historical")


ORACLE["archive_write_back"] = ORACLE["merge_archive"]


@query()
def preflag_by_index(spark, d):
    """``merge_preflag`` with the overlap found by the archive's index instead of a pass over the history."""
    root, commit = committed(spark, d, history(spark, d))
    past = sw.trailing_rows(spark, root, incoming(spark, d).select("site", "parameter").distinct(), "3 days", commit)
    return sw.merge_preflag(incoming(spark, d), past, "3 days", cut=True).select(*keys(), r6("mean"), "flag", "historical")


ORACLE["preflag_by_index"] = ORACLE["merge_preflag"]


@query("""SELECT site, parameter, CAST(year(dt_round) AS INT) AS year, CAST(month(dt_round) AS INT) AS month, count(*) AS rows,
    strftime(min(dt_round), '%Y-%m-%d %H:%M:%S') AS oldest, strftime(max(dt_round), '%Y-%m-%d %H:%M:%S') AS newest FROM padded GROUP BY ALL""")
def archive_index(spark, d):
    root, commit = committed(spark, d, padded(spark, d).withColumn("auto_flag", F.lit(None).cast("string")))
    return sw.series_index(spark, root, commit).select("site", "parameter", "year", "month", "rows", text_time("oldest"), text_time("newest"))


@query("""SELECT site, parameter, units, strftime(dt_round, '%Y-%m-%d %H:%M:%S') AS dt, round(mean, 6) AS mean, n_obs FROM summary""")
def incremental_archive(spark, d):
    """Two runs of raw readings that overlap by three days, as two commits: every stamp of the summary is there once, with its values."""
    root, every = work_dir(spark, "archive"), raw(spark, d)
    cut = "TIMESTAMP '2024-01-19 23:30:00'"  # between two stamps: of a stamp that both runs have, the archived row stays
    for batch, part in enumerate((every.where(f"timestamp < {cut}"), every.where(f"timestamp >= {cut}"))):
        sw.incremental_run(spark, root, part, "3 days", source="check", batch=batch, interval="1 hour")
    return sw.read_archive(spark, root).where("n_obs IS NOT NULL").select("site", "parameter", "units", dt(), r6("mean"), "n_obs")


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dt FROM orders
    WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 45 DAYS""")
def recent_45d(spark, d):
    df = table(spark, d, "orders").withColumn("dt_round", F.col("o_orderdate").cast("timestamp"))
    return sw.recent(df).select("o_orderkey", dt())


# --- bookkeeping -----------------------------------------------------------

NOW = "2024-01-31 06:00:00"
_tracker_sql = f"""(SELECT site, parameter, concat(site, '-', parameter) AS site_parameter,
    CAST(sum(CASE WHEN value > 60 THEN 1 ELSE 0 END) % 60 AS INT) AS failure_count,
    max(CASE WHEN day(timestamp) <= 25 THEN timestamp END) AS last_success,
    count(*) % 7 = 0 AS auto_disabled, count(*) % 3 = 0 AS try_again FROM {{raw}} GROUP BY site, parameter)"""
_received = "timestamp >= TIMESTAMP '2024-01-30 00:00:00' AND value > 5"
_tracker_out = ("site, parameter, site_parameter, failure_count, strftime(last_success, '%Y-%m-%d %H:%M:%S') AS last_success, "
                "auto_disabled, try_again")


def tracker(spark, d) -> DataFrame:
    t = spark.sql("SELECT * FROM " + _tracker_sql.format(raw="{raw}"), raw=raw(spark, d))
    return t.withColumn("last_success", F.col("last_success").cast("timestamp"))


@query(f"""SELECT site, parameter, site_parameter, failure_count, strftime(last_success, '%Y-%m-%d %H:%M:%S') AS last_success,
    failure_count >= 30 AS auto_disabled, CASE WHEN epoch(TIMESTAMP '{NOW}') - epoch(last_success) >= 5 * 86400 THEN true ELSE try_again END AS try_again
    FROM (SELECT t.* REPLACE (CASE WHEN r.n > 0 THEN 0 ELSE failure_count + 1 END AS failure_count,
        CASE WHEN r.n > 0 THEN TIMESTAMP '{NOW}' ELSE last_success END AS last_success)
      FROM {_tracker_sql.format(raw='sensor_raw')} t LEFT JOIN (SELECT site, parameter, count(*) AS n FROM sensor_raw WHERE {_received} GROUP BY ALL) r
      USING (site, parameter))""")
def tracker_update(spark, d):
    out = sw.tracker_update(tracker(spark, d), raw(spark, d).where(_received), NOW, disable_after=30, retry_days=5)
    return out.select("site", "parameter", "site_parameter", "failure_count", text_time("last_success"), "auto_disabled", "try_again")


_rare = "value > 250 AND timestamp >= TIMESTAMP '2024-01-30 12:00:00'"


@query(f"""SELECT site, parameter, failure_count, failure_count >= 30 AS auto_disabled FROM (
    SELECT t.* REPLACE (CASE WHEN r.n > 0 THEN 0 ELSE failure_count + 1 END AS failure_count)
    FROM {_tracker_sql.format(raw='sensor_raw')} t LEFT JOIN (SELECT site, parameter, count(*) AS n FROM sensor_raw WHERE {_rare} GROUP BY ALL) r
    USING (site, parameter))""")
def tracker_disables(spark, d):
    """Hardly any series gets readings: the others count up, and those at the limit are switched off."""
    out = sw.tracker_update(tracker(spark, d), raw(spark, d).where(_rare), NOW, disable_after=30)
    return out.select("site", "parameter", "failure_count", "auto_disabled")


_sites = ", ".join(f"('{s}')" for s in DEFAULT_SITES)


@query(f"""SELECT v.site, {sql_time('start_dt', 'start_dt')}, '{NOW}' AS end_dt FROM (VALUES {_sites}) v(site), (
    SELECT CASE WHEN NOT coalesce(bool_and(a = b), true) AND min(a) <= min(b) THEN min(b) ELSE min(a) END AS start_dt FROM (
      SELECT p.site, max(CASE WHEN parameter = 'Temperature' THEN latest END) AS a,
        max(CASE WHEN NOT auto_disabled AND NOT try_again THEN latest END) AS b
      FROM (SELECT site, parameter, max(dt_round) AS latest FROM padded GROUP BY ALL) p
      LEFT JOIN {_tracker_sql.format(raw='sensor_raw')} t USING (site, parameter) GROUP BY p.site))""")
def session_dates(spark, d):
    out = sw.session_dates(spark, padded(spark, d), tracker(spark, d), NOW)
    return out.select("site", text_time("start_dt"), text_time("end_dt"))


@query("""SELECT user_id, epoch_us(ts) // 1000000 AS timestamp, value,
    CASE event_type WHEN 'signup' THEN '1' WHEN 'purchase' THEN '2' WHEN 'error' THEN '3' WHEN 'view' THEN '4' ELSE '5' END AS "parameterId",
    'u1' AS "unitId", user_id % 2 = 0 AS "customParameter" FROM events""")
def page_flatten(spark, d):
    return sw.flatten_pages(pages(spark, d)).select("user_id", "timestamp", "value", "parameterId", "unitId", "customParameter")


PARAMETER_ID = ("CASE event_type WHEN 'signup' THEN '1' WHEN 'purchase' THEN '2' WHEN 'error' THEN '3' WHEN 'view' THEN '4' ELSE '5' END")


def pages(spark, d) -> DataFrame:
    """One page per user and day, nested as the service sends it."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    readings = e.groupBy("user_id", "day", F.expr(PARAMETER_ID).alias("parameterId")).agg(F.collect_list(F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"), "value")).alias("readings"))
    return readings.groupBy("user_id", "day").agg(F.collect_list(F.struct(
        "parameterId", F.lit("u1").alias("unitId"), (F.col("user_id") % 2 == 0).alias("customParameter"), "readings",
    )).alias("parameters")).drop("day")


@query("""SELECT user_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS timestamp, value, event_type AS parameter, 'mg/L' AS units
    FROM events WHERE event_type <> 'click'""")
def reading_names(spark, d):
    known = table(spark, d, "events").where("event_type <> 'click'").select(F.expr(PARAMETER_ID).alias("k"), F.col("event_type").alias("v"))
    names = known.distinct().agg(
        F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("parameters")).withColumn(
        "units", F.create_map(F.lit("u1"), F.lit("mg/L")))
    return sw.reading_names(sw.flatten_pages(pages(spark, d)), names).select(
        "user_id", text_time("timestamp"), "value", "parameter", "units")


@query("""SELECT lower(s.n_name) AS site, CAST(c_custkey AS VARCHAR) AS id, lower(concat(n.n_name, ' sonde ', c_custkey)) AS name
    FROM customer JOIN nation n ON c_nationkey = n.n_nationkey
    JOIN nation s ON contains(lower(concat(n.n_name, ' sonde ', c_custkey)), lower(s.n_name))""")
def location_match(spark, d):
    nation = table(spark, d, "nation")
    locations = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("id"), F.concat_ws(" sonde ", "n_name", "c_custkey").alias("name"),
        F.lit("none").alias("gps"))
    return sw.match_locations(nation.select(F.col("n_name").alias("site")), locations).select("site", "id", "name")


@query("""SELECT event_id, strftime(ts, 'pull-%Y%m%d') AS source_file FROM events
    WHERE strftime(ts, 'pull-%Y%m%d') NOT IN (SELECT strftime(ts, 'pull-%Y%m%d') FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00')""")
def archive_new_files(spark, d):
    e = table(spark, d, "events").select("event_id", "ts", F.concat(F.lit("pull-"), F.date_format("ts", "yyyyMMdd")).alias("source_file"))
    archived = e.where("ts < TIMESTAMP '2024-01-15 12:00:00'")
    return sw.new_to_archive(e, archived).select("event_id", "source_file")


_kind = "CASE o_orderstatus WHEN 'F' THEN 'main' WHEN 'O' THEN 'archive' ELSE 'tracker' END"


@query(f"""SELECT dataset, kind, snapshot, keep FROM (SELECT *, row_number() OVER (PARTITION BY dataset, kind ORDER BY ts DESC, snapshot DESC)
    <= CASE kind WHEN 'main' THEN 1 WHEN 'archive' THEN 3 ELSE 10 END AS keep
    FROM (SELECT o_orderpriority AS dataset, {_kind} AS kind, o_orderkey AS snapshot, o_orderdate AS ts FROM orders))""")
def retention(spark, d):
    snapshots = table(spark, d, "orders").selectExpr("o_orderpriority AS dataset", f"{_kind} AS kind", "o_orderkey AS snapshot",
                                                     "o_orderdate AS ts")
    return sw.retention(snapshots).select("dataset", "kind", "snapshot", "keep")


@query("SELECT site, parameter, count(*) AS data_count FROM sensor_raw GROUP BY ALL")
def reading_counts(spark, d):
    return sw.reading_counts(raw(spark, d))


@query("""SELECT o_orderkey, strftime(date_trunc('second', o_orderdate), '%Y-%m-%d %H:%M:%S') AS stamp FROM orders""")
def snapshot_names(spark, d):
    names = table(spark, d, "orders").select("o_orderkey", F.concat(
        F.lit("SondeFlags"), F.date_format("o_orderdate", "yyyyMMdd-'T'HHmmss'Z'"), F.lit(".parquet")).alias("file"))
    stamp = sw.snapshot_stamp(F.col("file"))
    return names.select("o_orderkey", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("stamp"))


# --- streaming -------------------------------------------------------------

def work_dir(spark: SparkSession, name: str) -> str:
    """A new path for stream state and results in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="checks-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{os.urandom(6).hex()}"


@query(f"SELECT {SQL_KEYS}, units, round(mean, 6) AS mean, round(spread, 6) AS spread, n_obs FROM summary")
def stream_interval_summary(spark, d):
    """The same summary from a stream; the windows still open at its end come from the readings themselves."""
    schema = table(spark, d, "events").schema
    stream = sw.read_raw_stream(spark, d, schema=schema, glob="events.parquet")
    sql = inputs.view_text(inputs.SENSOR_RAW, "spark", 3).replace("FROM events", "FROM {events}")
    summary = sw.stream_interval_summary(spark.sql(sql, events=stream), "1 hour", "1 hour")
    out = work_dir(spark, "interval-summary")
    run = (summary.writeStream.format("parquet").option("checkpointLocation", f"{out}/state")
           .outputMode("append").trigger(availableNow=True).start(f"{out}/rows"))
    run.awaitTermination()
    closed = spark.read.schema(summary.schema).parquet(f"{out}/rows")
    return closed.unionByName(sw.open_windows(raw(spark, d), run, "1 hour").select(*closed.columns)).select(
        *keys(), "units", r6("mean"), r6("spread"), "n_obs")


@query(f"SELECT {SQL_KEYS}, units, round(mean, 6) AS mean, round(spread, 6) AS spread, n_obs FROM summary")
def stream_late_summary(spark, d):
    """The summary of readings that arrive out of order in four files: closed stamps, summed anew for late rows, and open ones."""
    out = work_dir(spark, "late-summary")
    source = f"{out}/in"
    for turn in range(4):
        derived(spark, d, inputs.SENSOR_RAW + f" WHERE event_id % 4 = {turn}").coalesce(1).write.mode("append").parquet(source)
        sw.stream_summary(sw.read_raw_stream(spark, source), f"{out}/state", f"{out}/checkpoint", "1 hour", "6 hours").trigger(
            availableNow=True).start().awaitTermination()
    closed = sw.closed_summary(spark, f"{out}/state")
    rest = sw.open_summary(spark, f"{out}/state", "1 hour").select(*closed.columns)
    return closed.unionByName(rest).select(*keys(), "units", r6("mean"), r6("spread"), "n_obs")


@query("""SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, value, strftime(ts, 'pull-%Y%m%d') AS pull FROM events""")
def archive_by_content(spark, d):
    """A day's pull is a file; the archive gets half of the pulls, then all of them, then nothing new, and holds every reading once."""
    out = work_dir(spark, "pulls")
    e = table(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("timestamp"), "value",
                                         F.concat(F.lit("pull-"), F.date_format("ts", "yyyyMMdd")).alias("pull"))
    for part in (e.where("timestamp < TIMESTAMP '2024-01-15 12:00:00'"), e.where("timestamp >= TIMESTAMP '2024-01-15 12:00:00'"), None):
        if part is not None:
            part.repartition("pull").write.partitionBy("pull").mode("append").parquet(f"{out}/in")
        report = sw.archive_append(spark, f"{out}/in", f"{out}/archive")
    arrived = spark.read.parquet(f"{out}/archive")
    return arrived.join(report.where("complete").select("file_id"), "file_id", "left_semi").select("id", text_time("timestamp").alias("stamp"), "value", "pull")


# --- sources and sinks: written below the shared folder, read back -----------

def stored_file(spark: SparkSession, name: str, text: str) -> str:
    """A small configuration file in the shared folder, by Spark's file system."""
    path = f"{work_dir(spark, 'config')}/{name}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    return path


@query(f"""SELECT site, id, name, {sql_time('timestamp', 'stamp')}, parameter, value, units, count(*) AS n FROM sensor_raw GROUP BY ALL""")
def raw_pulls(spark, d):
    """Two pulls, one of them sent twice: a pull that is written again replaces itself."""
    out = work_dir(spark, "raw")
    r = raw(spark, d)
    for part, hour in (("day(timestamp) <= 10", 1), ("day(timestamp) > 10", 2), ("day(timestamp) <= 10", 1)):
        sw.write_raw(r.where(part), out, datetime(2024, 2, 1, hour))
    return sw.read_raw(spark, out).groupBy("site", "id", "name", text_time("timestamp").alias("stamp"), "parameter", "value", "units").agg(F.count("*").alias("n"))


@query()
def notes_file(spark, d):
    out = work_dir(spark, "survey")
    derived(spark, d, inputs.SURVEY).write.option("header", True).option("escape", '"').csv(out)
    return sw.clean_notes(sw.read_field_notes(spark, out), "15 minutes").select(
        text_time("start_dt"), text_time("malfunction_end_dt"), text_time("dt_round"), "site", "visit_type", "sensor_pulled",
        "sensor_deployed", "which_sensor_malfunction", "visit_comments")


ORACLE["notes_file"] = ORACLE["notes_clean"]


@query("""SELECT 'winter_baseflow' AS season, CASE lower(n_name) WHEN 'nation_3' THEN 'salyer' ELSE lower(n_name) END AS site, event_type AS parameter,
    min(value) AS t_mean01, max(value) AS t_mean99 FROM events JOIN nation ON n_nationkey = user_id % 25 GROUP BY ALL""")
def thresholds_file(spark, d):
    """A threshold file with other columns' order and an old site name."""
    out = work_dir(spark, "thresholds")
    named = table(spark, d, "events").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("user_id") % 25)
    limits = named.groupBy(F.when(F.col("n_name") == "NATION_3", "Legacy").otherwise(F.col("n_name")).alias("site"), F.col("event_type").alias("parameter")).agg(
        F.max("value").alias("t_mean99"), F.min("value").alias("t_mean01"))
    limits.withColumns({"season": F.lit("winter_baseflow"), **{c: F.lit("NA") for c in ("t_slope_behind_01", "t_slope_behind_99", "t_sd_0199")}}).write.option(
        "header", True).csv(out)
    return sw.read_thresholds(spark, out).select("season", "site", "parameter", "t_mean01", "t_mean99")


@query("""SELECT lower(r_name) AS network_name, replace(lower(n_name), '_', '') AS site, CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS INT) AS place
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
def networks_file(spark, d):
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = nations.groupBy("r_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]), ", ").alias("network"))
    out = f"{work_dir(spark, 'networks')}/site.order.csv"
    rows.withColumnRenamed("r_name", "network_name").coalesce(1).write.option("header", True).csv(out)
    return sw.load_networks(spark, out).select("network_name", F.posexplode("network").alias("place", "site")).withColumn("place", (F.col("place") + 1).cast("int"))


@query("SELECT event_type AS parameter, min(value) AS spec_min, max(value) AS spec_max FROM events GROUP BY event_type")
def sensor_spec_file(spark, d):
    limits = table(spark, d, "events").groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    text = "".join(f"{r.event_type}:\n  min: {r.lo!r}\n  max: {r.hi!r}\n" for r in limits)
    return sw.read_sensor_spec(spark, stored_file(spark, "spec.yml", text)).select("parameter", "spec_min", "spec_max")


@query(f"SELECT {SQL_KEYS}, round(mean, 6) AS mean FROM padded WHERE day(dt_round) <= 20")
def latest_snapshot(spark, d):
    """Three snapshots, the newest by name not written last."""
    out, rows = work_dir(spark, "snapshots"), padded(spark, d)
    for day, hour in ((10, 3), (20, 9), (30, 6)):
        sw.write_snapshot(rows.where(f"day(dt_round) <= {day}"), out, "SondeFlags", datetime(2024, 2, 1, hour))
    return sw.read_latest(spark, out, "SondeFlags").select(*keys(), r6("mean"))


@query(f"SELECT {SQL_KEYS}, round(mean, 6) AS mean FROM padded")
def series_csv(spark, d):
    out = work_dir(spark, "csv")
    sw.write_series_csv(padded(spark, d).select("site", "parameter", "dt_round", "mean"), out)
    back = spark.read.schema("dt_round string, mean double, site string, parameter string").csv(out, header=True)
    return back.select("site", "parameter", F.col("dt_round").alias("dt"), r6("mean"))


@query(f"""SELECT site, {sql_time('t', 'start_dt')}, concat('note ', event_id) AS visit_comments,
    row_number() OVER (ORDER BY t DESC, concat('note ', event_id)) - 1 AS position FROM ({_survey})""")
def notes_newest(spark, d):
    """Notes newest first, from an ordered table: the place of a note follows from its file and the recorded order."""
    out, order = work_dir(spark, "notes"), [F.desc("start_dt"), F.asc("visit_comments")]
    sw.write_ordered(survey(spark, d).select("site", "start_dt", "visit_comments"), out, order)
    return sw.with_position(spark, out, order).select("site", text_time("start_dt"), "visit_comments", "position")
