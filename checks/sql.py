"""Oracle SQL for DuckDB: each step as a named query, put together by what a query mentions."""
from __future__ import annotations

import re

from . import inputs
from .values import MALFUNCTION_KINDS, NETWORK_IGNORED, SUSPECT_EXCLUDED, TIDY_RULES

K = "PARTITION BY site, parameter ORDER BY dt_round"


def rows(first: int, last: int) -> str:
    def end(n):
        return "CURRENT ROW" if n == 0 else f"{abs(n)} {'PRECEDING' if n < 0 else 'FOLLOWING'}"
    return f"({K} ROWS BETWEEN {end(first)} AND {end(last)})"


def holds_any(flag: str, labels) -> str:
    return "coalesce(" + " OR ".join(f"contains({flag}, '{x}')" for x in labels) + ", false)"


def fold(*parts: str) -> str:
    return f"nullif(concat_ws(';', {', '.join(parts)}), '')"


def label(condition: str, text: str) -> str:
    return f"CASE WHEN {condition} THEN '{text}' END"


def tidy(flag: str) -> str:
    cases = " ".join(f"WHEN contains({flag}, '{t}') THEN '{x}'" for t, x in TIDY_RULES)
    whole = f"CASE WHEN {flag} IS NULL THEN NULL {cases} ELSE {flag} END"
    tokens = (f"list_filter(list_transform(string_split(replace({whole}, chr(10), ' '), ';'), lambda x: trim(x)), "
              f"lambda x: x <> '')")
    keyed = f"list_sort(list_transform({tokens}, lambda x: {{'k': lower(x), 'v': x}}))"
    return f"nullif(array_to_string(list_transform({keyed}, lambda s: s.v), ';'), '')"


def fit(w: str) -> str:
    return (f"CASE WHEN count(*) OVER {w} < 10 OR count(mean) OVER {w} < ceil(0.9E0 * count(*) OVER {w}) "
            f"OR regr_slope(mean, rn) OVER {w} <= 0 THEN 0 ELSE regr_r2(mean, rn) OVER {w} END")


def malfunction_columns() -> str:
    known = {k: f"regexp_matches(lower(coalesce(m.notes, '')), '{p}')" for k, p, _ in MALFUNCTION_KINDS}
    known["general"] = "NOT (" + " OR ".join(known.values()) + ")"
    return ", ".join(f"coalesce(bool_or({c}), false) AS m_{k}" for k, c in known.items())


def steps(sites: int = 3, interval: int = 3600, source: str = "padded") -> dict[str, str]:
    step, half, minutes = interval * 1_000_000, interval * 500_000, interval / 60
    d = "PARTITION BY site, parameter, vg ORDER BY dt_round RANGE BETWEEN INTERVAL {} MINUTE PRECEDING AND {}"
    rounded = f"make_timestamp(((epoch_us({{t}}) + {half}) // {step}) * {step})"
    labels = [x for _, _, x in MALFUNCTION_KINDS]
    thresholds = ", ".join(str(r) for r in inputs.THRESHOLD_ROWS)
    spec = ", ".join(f"('{p}', {lo}, {hi})" for p, (lo, hi) in inputs.SPEC.items())
    out = {
        "sensor_raw": inputs.view_text(inputs.SENSOR_RAW, "duck", sites),
        "clean": f"""SELECT lower(site) AS site, parameter, units, timestamp, value, {rounded.format(t='timestamp')} AS dt_round
            FROM sensor_raw WHERE NOT regexp_matches(lower(name), 'vulink|virridy')
            AND NOT regexp_matches(lower(parameter), 'fdom fluorescence')""",
        "summary": """SELECT dt_round, site, parameter, units, avg(value) AS mean, max(value) - min(value) AS spread,
            count(*) AS n_obs FROM (SELECT DISTINCT * FROM clean) GROUP BY ALL""",
        "grid": f"""SELECT site, parameter, unnest(generate_series(min(dt_round), max(dt_round), INTERVAL {interval} SECOND)) AS dt_round
            FROM summary GROUP BY site, parameter""",
        "padded": """SELECT site, parameter, dt_round, units, mean, spread, n_obs
            FROM grid LEFT JOIN summary USING (site, parameter, dt_round)""",
        "notes_view": inputs.view_text(inputs.SENSOR_NOTES, "duck", sites),
        "snotes": f"""SELECT site, date_trunc('second', start_dt) AS start_dt, {rounded.format(t="date_trunc('second', start_dt)")} AS dt_round,
            CASE sensor_change WHEN 'Pulled' THEN 1 WHEN 'Deployed' THEN 0 END AS sonde_employed, sonde_moved,
            sensor_malfunction, visit_comments FROM notes_view""",
        "nmerged": """SELECT site, dt_round,
            arg_max(sonde_employed, start_dt) FILTER (WHERE sonde_employed IS NOT NULL) AS sonde_employed,
            arg_max(sensor_malfunction, start_dt) FILTER (WHERE sensor_malfunction IS NOT NULL) AS sensor_malfunction,
            bool_or(sonde_moved) AS sonde_moved, arg_max(visit_comments, start_dt) AS visit_comments
            FROM snotes GROUP BY site, dt_round""",
        "nstate": """SELECT site, dt_round AS noted_at, sonde_moved, visit_comments,
            last_value(sonde_employed IGNORE NULLS) OVER w AS sonde_employed,
            last_value(sensor_malfunction IGNORE NULLS) OVER w AS sensor_malfunction
            FROM nmerged WINDOW w AS (PARTITION BY site ORDER BY dt_round ROWS UNBOUNDED PRECEDING)""",
        "noted": f"""SELECT p.*, n.noted_at AS last_site_visit,
            CASE WHEN n.noted_at IS NULL THEN 1 ELSE coalesce(n.sonde_employed, 0) END AS sonde_employed,
            n.sensor_malfunction, CASE WHEN n.noted_at = p.dt_round THEN n.sonde_moved END AS sonde_moved,
            CASE WHEN n.noted_at = p.dt_round THEN n.visit_comments END AS visit_comments
            FROM {source} p ASOF LEFT JOIN nstate n ON p.site = n.site AND p.dt_round >= n.noted_at""",
        "near": f"""SELECT *, lead(mean) OVER ({K}) AS front1, lag(mean) OVER ({K}) AS back1,
            CASE WHEN count(mean) OVER r = 7 THEN quantile_cont(mean, 0.5) OVER r END AS rollmed,
            CASE WHEN count(mean) OVER r = 7 THEN avg(mean) OVER r END AS rollavg,
            CASE WHEN count(mean) OVER r = 7 THEN stddev_samp(mean) OVER r END AS rollsd
            FROM noted WINDOW r AS {rows(-6, 0)}""",
        "stats": f"""SELECT *, CASE WHEN count(slope_behind) OVER r = 7 THEN avg(slope_behind) OVER r END AS rollslope,
            month(dt_round) AS month, year(dt_round) AS year, concat(year(dt_round), ' - ', month(dt_round)) AS y_m,
            CASE WHEN month(dt_round) IN (12, 1, 2, 3, 4) THEN 'winter_baseflow' WHEN month(dt_round) IN (5, 6) THEN 'snowmelt'
                 WHEN month(dt_round) IN (7, 8, 9) THEN 'monsoon' ELSE 'fall_baseflow' END AS season
            FROM (SELECT *, (front1 - mean) / {minutes} AS slope_ahead, (mean - back1) / {minutes} AS slope_behind FROM near)
            WINDOW r AS {rows(-6, 0)}""",
        "limits": f"SELECT * FROM (VALUES {thresholds}) t({', '.join(inputs.THRESHOLD_NAMES)})",
        "spec": f"SELECT * FROM (VALUES {spec}) t(parameter, spec_min, spec_max)",
        "rules1": f"""SELECT s.*, coalesce(last_site_visit = dt_round, false) AS visit,
            coalesce(parameter = 'DO' AND ((back1 - mean >= 0.5 AND front1 - mean >= 0.5) OR mean <= 5), false) AS interfered,
            coalesce(mean = front1 OR mean = back1, false) AS repeated,
            coalesce(mean < spec_min OR mean > spec_max, false) AS off_spec,
            coalesce(mean < t_mean01 OR mean > t_mean99, false) AS off_season,
            coalesce(slope_ahead >= t_slope_behind_99, false) OR coalesce(slope_behind >= t_slope_behind_99, false)
            OR coalesce(slope_ahead <= t_slope_behind_01, false) OR coalesce(slope_behind <= t_slope_behind_01, false) AS steep
            FROM stats s LEFT JOIN limits USING (site, parameter, season) LEFT JOIN spec USING (parameter)""",
        "rules2": f"""SELECT *,
            coalesce(bool_or(visit) OVER {rows(-4, -1)}, false) OR coalesce(lead(visit) OVER ({K}), false) AS sv,
            parameter = 'DO' AND ((count(*) OVER r = 96 AND sum(interfered::INT) OVER r >= 24)
                               OR (count(*) OVER c = 96 AND sum(interfered::INT) OVER c >= 24)) AS buried,
            parameter IN ('Temperature', 'Depth') AND (steep OR coalesce(lag(steep) OVER ({K}), false)
                               OR coalesce(lead(steep) OVER ({K}), false)) AS explains
            FROM rules1 WINDOW r AS {rows(-95, 0)}, c AS {rows(-47, 48)}""",
        "grouped": f"SELECT *, sum((visit OR sv)::INT) OVER ({K} ROWS UNBOUNDED PRECEDING) AS vg FROM rules2",
        # without notes there are no visit groups
        "ungrouped": "SELECT *, 0 AS vg FROM stats",
    }
    for name, base in (("drift", "grouped"), ("drift_alone", "ungrouped")):
        out[f"{name}_rows"] = f"""SELECT *, row_number() OVER (PARTITION BY site, parameter, vg ORDER BY dt_round) AS rn
            FROM {base} WHERE parameter IN ('Turbidity', 'Chl-a Fluorescence')"""
        out[f"{name}_fits"] = f"""SELECT *, greatest({fit('w1')}, {fit('w2')}, {fit('w3')}, {fit('w4')}) AS tightest
            FROM {name}_rows WINDOW w1 AS ({d.format(1440, 'CURRENT ROW')}), w2 AS ({d.format(720, 'INTERVAL 720 MINUTE FOLLOWING')}),
            w3 AS ({d.format(4320, 'CURRENT ROW')}), w4 AS ({d.format(2160, 'INTERVAL 2160 MINUTE FOLLOWING')})"""
        out[name] = f"""SELECT site, parameter, dt_round, avg(tightest) OVER ({d.format(1440, 'CURRENT ROW')}) >= 0.5 AS drifting
            FROM {name}_fits"""
    series_fold = fold(
        label("sonde_employed = 1", "sonde not employed"), label("visit", "site visit"), label("sv", "sv window"),
        label("mean IS NULL", "missing data"), label("interfered", "DO interference"), label("buried", "Possible burial"),
        label("repeated", "repeated value"), label("drifting", "drift"),
        label("off_spec", "outside of sensor specification range"),
        label("off_season", "outside of seasonal range"), label("steep", "slope violation"))
    out.update({
        "series_flags": f"""SELECT r.*, {series_fold} AS flag FROM rules2 r LEFT JOIN drift USING (site, parameter, dt_round)""",
        "site_context": """SELECT *,
            bool_or(parameter = 'Temperature' AND coalesce(mean <= 0, false)) OVER s AS freezing,
            bool_or(parameter = 'Depth' AND coalesce(mean <= 0, false)) OVER s AS dry,
            bool_or(parameter = 'Specific Conductivity' AND coalesce(mean <= 10, false)) OVER s AS no_sc,
            bool_or(buried) OVER s AS do_buried, bool_or(explains) OVER s AS explained
            FROM series_flags WINDOW s AS (PARTITION BY site, dt_round)""",
        "frozen_flags": f"SELECT * REPLACE ({fold('flag', label('freezing', 'frozen'))} AS flag) FROM site_context",
        "reconciled": """SELECT * REPLACE (CASE WHEN steep AND (parameter IN ('Temperature', 'Depth') OR explained)
            THEN nullif(replace(flag, 'slope violation', ''), '') ELSE flag END AS flag) FROM frozen_flags""",
        "records": inputs.view_text(inputs.MALFUNCTIONS, "duck", sites),
        "reported": f"""SELECT p.site, p.parameter, p.dt_round, {malfunction_columns()} FROM padded p JOIN records m
            ON p.site = m.site AND p.dt_round >= m.start_dt AND p.dt_round <= coalesce(m.end_dt, TIMESTAMP '9999-12-31 23:59:59')
            AND (m.parameter IS NULL OR m.parameter = p.parameter OR (p.parameter = 'ORP' AND m.parameter = 'pH')
                 OR regexp_matches(lower(m.notes), '{MALFUNCTION_KINDS[0][1]}') OR contains(lower(m.notes), 'not submerged'))
            GROUP BY ALL""",
        "mal_flags": "SELECT site, parameter, dt_round, nullif(concat_ws(';' || chr(10), "
            + ", ".join(label(f"m_{k}", x) for (k, _, _), x in zip(MALFUNCTION_KINDS, labels))
            + ", " + label("m_general", "reported sensor malfunction") + "), '') AS mal_flag FROM reported",
        "site_flags": f"""SELECT * EXCLUDE (flag), {fold('flag', label("do_buried AND parameter <> 'DO'", "Possible burial"),
                                                         label('dry', 'sonde unsubmerged'))} AS flag FROM reconciled""",
        "edges": """SELECT * FROM (VALUES ('bellvue', NULL, 'salyer'), ('salyer', 'bellvue', 'udall'), ('udall', 'salyer', NULL))
            e(site, up, down)""",
        "telling": f"""SELECT DISTINCT site, parameter, dt_round FROM site_flags
            WHERE flag IS NOT NULL AND NOT {holds_any('flag', NETWORK_IGNORED)}""",
        "heard": """SELECT f.*, u.site IS NOT NULL OR d.site IS NOT NULL AS heard FROM site_flags f JOIN edges e ON f.site = e.site
            LEFT JOIN telling u ON u.site = e.up AND u.parameter = f.parameter AND u.dt_round = f.dt_round
            LEFT JOIN telling d ON d.site = e.down AND d.parameter = f.parameter AND d.dt_round = f.dt_round""",
        "networked": f"""SELECT *, CASE WHEN flag IS NOT NULL AND NOT {holds_any('flag', NETWORK_IGNORED)}
            AND count(*) OVER w = 17 AND bool_or(heard) OVER w THEN NULL ELSE flag END AS net_flag
            FROM heard WINDOW w AS {rows(-8, 8)}""",
        "tidied": f"SELECT *, {tidy('net_flag')} AS tidy_flag FROM networked",
        "suspect_bits": f"""SELECT *, coalesce(tidy_flag IS NOT NULL AND tidy_flag <> 'suspect data'
            AND NOT {holds_any('tidy_flag', SUSPECT_EXCLUDED)}, false)::INT AS bad, (mean IS NULL)::INT AS gone FROM tidied""",
        "suspected": f"""SELECT *, CASE WHEN tidy_flag IS NULL AND (
            (count(*) OVER r = 8 AND avg(bad) OVER r >= 0.5) OR (count(*) OVER c = 8 AND avg(bad) OVER c >= 0.5)
            OR (mean IS NOT NULL AND count(*) OVER r = 8 AND avg(gone) OVER r >= 0.875E0
                AND count(*) OVER c = 8 AND avg(gone) OVER c >= 0.875E0))
            THEN 'suspect data' ELSE tidy_flag END AS sus_flag
            FROM suspect_bits WINDOW r AS {rows(-7, 0)}, c AS {rows(-3, 4)}""",
        "lonely": f"""SELECT *, CASE WHEN sus_flag = 'suspect data' AND lag(sus_flag) OVER ({K}) IS NULL
            AND lead(sus_flag) OVER ({K}) IS NULL THEN NULL ELSE sus_flag END AS auto_flag FROM suspected""",
        "gaps": f"""SELECT *, count(mean) OVER ({K} ROWS UNBOUNDED PRECEDING) AS g FROM padded""",
        "runs": f"""SELECT *, count(*) FILTER (WHERE mean IS NULL) OVER (PARTITION BY site, parameter, g) AS run,
            last_value(CASE WHEN mean IS NOT NULL THEN {{'t': epoch(dt_round), 'v': mean}} END IGNORE NULLS) OVER ({K} ROWS UNBOUNDED PRECEDING) AS l,
            first_value(CASE WHEN mean IS NOT NULL THEN {{'t': epoch(dt_round), 'v': mean}} END IGNORE NULLS)
                OVER ({K} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM gaps""",
        "filled": """SELECT site, parameter, dt_round, mean, units, CASE WHEN parameter <> 'Turbidity' THEN NULL WHEN mean IS NOT NULL THEN mean
            WHEN run <= 4 AND l IS NOT NULL AND n IS NOT NULL
            THEN l.v + (n.v - l.v) * (epoch(dt_round) - l.t) / (n.t - l.t) END AS mean_filled FROM runs""",
    })
    taps = "(lag({0}, 2) OVER k + 4 * lag({0}) OVER k + 6 * {0} + 4 * lead({0}) OVER k + lead({0}, 2) OVER k) / 16"
    for name, base, c in (("pass1", "filled", "mean_filled"), ("pass2", "pass1", "s1"), ("pass3", "pass2", "s2")):
        out[name] = f"SELECT *, {taps.format(c)} AS s{name[-1]} FROM {base} WINDOW k AS ({K})"
    return out


def build(final: str, **options) -> str:
    """``final`` with the steps it needs, in order."""
    available = steps(**options)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\b[a-z_0-9]+\b", text)) & available.keys():
            if word not in needed and re.search(rf"\b(FROM|JOIN)\s+{word}\b", text):
                needed.add(word)
                visit(available[word])

    visit(final)
    with_ = ",\n".join(f"{n} AS ({t})" for n, t in available.items() if n in needed)
    return f"WITH {with_}\n{final}" if with_ else final
