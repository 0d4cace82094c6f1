"""The whole quality-control run as two chunked stages.

Stage one covers a site's own evidence: padding, field notes, statistics, series flags, site flags
and reported malfunctions share a single exchange on (site, chunk). Stage two covers the network and
what follows from it, again with one exchange. Both give what the single operators give one by one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import contains, ensure_column, fold, fold_flags, tidied
from ..functions.timegrid import join_stamp
from ..operators import finish, series_rules as series, site_rules as site, statistics
from ..operators.malfunction import malfunction_rules, malfunction_states
from ..operators.merge import merge_preflag
from ..operators.network import auto_flag, spread_with_reports
from ..operators.notes import AT_VISIT, CARRIED, note_columns, note_states
from ..operators.prepare import fill_markers, grid_markers, interval_summary, pad_grid, series_bounds
from ..operators.signal import filled_column, row_column, smoothed_column
from ..schema import BURIAL, DRIFT, FROZEN, MISSING, OUT_OF_SEASON, OUT_OF_SPEC, REPEATED, SEASONS, SLOPE, UNSUBMERGED
from .asof import States, attach_states, resolve_states, with_events
from .layout import CHUNK, CLOCK, POSITION, Frames, Layout, gather, number_rows, spread

# fixed values: the published column names
CURATED_COLUMNS = (
    "dt_round", "dt_join", "site", "parameter", "mean", "units", "n_obs", "spread", "auto_flag", "mal_flag",
    "sonde_moved", "historical", "mean_filled", "smoothed_mean", "site_dashboard", "mean_dashboard",
)
SUSPECT_WIDTH, NETWORK_WIDTH = 8, 17
TURBID = ("Turbidity",)


def _states(notes: DataFrame | None, malfunctions: DataFrame | None, layout: Layout) -> States:
    spans, columns = note_states(notes, layout) if notes is not None else ([], {})
    if malfunctions is not None:
        more, others = malfunction_states(malfunctions, layout)
        spans, columns = spans + more, columns | others
    return spans, columns


def _unfold_notes(df: DataFrame, noted: bool) -> DataFrame:
    if noted:
        return note_columns(df)
    for name, dtype in {**CARRIED, **AT_VISIT}.items():
        df = ensure_column(df, name, dtype=dtype)
    return df


def flag_site_evidence(rows: DataFrame, bounds: DataFrame, layout: Layout, *, notes: DataFrame | None = None,
                       malfunctions: DataFrame | None = None, thresholds: DataFrame | None = None,
                       spec: DataFrame | dict | None = None, submerged_method: str = "depth",
                       seasons=SEASONS) -> DataFrame:
    """Stage one. ``rows`` may hold grid markers (``_marker``) when the layout is gap free."""
    back, ahead = series.drift_room(layout)
    # room for the longest frame, and for what that frame's rows look at themselves
    before, after = max(back, 96) + 8, max(ahead, 48) + 8
    states = _states(notes, malfunctions, layout)
    rows = rows.drop(*CARRIED, *AT_VISIT) if notes is not None else rows
    rows = ensure_column(ensure_column(rows, "flag"), "mal_flag")

    if layout.gap_free:
        rows = spread(rows, layout, before, after)
        rows = resolve_states(with_events(rows, states, bounds, layout, before, after), states)
        rows = fill_markers(rows, "site", "parameter", CHUNK, CLOCK) if "_marker" in rows.columns else rows
    else:
        rows = attach_states(rows, states, layout, bounds) if states[0] else rows
        rows = spread(rows if POSITION in rows.columns else number_rows(rows, layout), layout, before, after)
    rows = _unfold_notes(rows, notes is not None)

    # windows of the same order are asked for together: every round of them copies the chunk once
    frames = Frames()
    rows = rows.withColumns(statistics.neighbour_columns(rows, frames))
    rows = rows.withColumns({**statistics.slope_columns(rows, layout.step / 60), **statistics.calendar_columns(seasons)})
    rules = [*series.field_rules(), (MISSING, series.missing()), *series.do_rules(), (REPEATED, series.repeated()),
             (DRIFT, F.col("_drift"))]
    if spec is not None:
        rows = series.with_spec(rows, spec, find_heavy=False)
        rules.append((OUT_OF_SPEC, series.out_of_spec()))
    steep = contains(F.col("flag"), SLOPE)
    if thresholds is not None:
        rows = series.with_thresholds(rows, thresholds, find_heavy=False)
        rules += [(OUT_OF_SEASON, series.out_of_season()), (SLOPE, series.steep())]
        steep = steep | series.true(series.steep())
    rows = rows.withColumns({**series.visit_column(), **series.interference_columns(), "_steep": steep})
    rows = rows.withColumns({
        **statistics.rolling_slope(rows, frames), **series.around_visit(frames), **series.burial_column(frames),
        "_explains": site.explains_slope(F.col("_steep"), frames),
    })
    visit = series.true(F.col("flag").rlike(series.VISIT_PATTERN)) | (F.col("_visit") == 1) | F.col("_sv")
    rows = fold_flags(series.drift_column(rows, visit), rules)

    if not layout.gap_free:
        rows = gather(rows)
    stamp = ("site", CHUNK, CLOCK) if layout.gap_free else site.STAMP
    buried = site.of("DO") & contains(F.col("flag"), BURIAL)
    rows = rows.withColumns({
        "_frozen": site.any_at(site.freezing(), stamp),
        "_dry": site.any_at(site.out_of_water(submerged_method), stamp),
        "_do_buried": site.any_at(buried, stamp) & ~site.of("DO"),
        "_explained": site.any_at(F.col("_explains"), stamp),
    })
    frozen = fold(F.col("flag"), [(FROZEN, F.col("_frozen"))])
    kept = site.without_slope(frozen, F.col("_explained"))
    rows = rows.withColumn("flag", fold(kept, [(BURIAL, F.col("_do_buried")), (UNSUBMERGED, F.col("_dry"))]))
    if malfunctions is not None:
        mal = fold(F.col("mal_flag").cast("string"), malfunction_rules(), ";\n")
        rows = rows.withColumn("mal_flag", mal)
    rows = rows.drop("_visit", "_sv", "_interfered", "_hit", "_buried", "_steep", "_drift", "_explains", "_explained", "_frozen", "_dry",
                     "_do_buried", "_note_state", "_sonde_state", "_sensor_state", "spec_min", "spec_max",
                     *series.THRESHOLD_COLUMNS)
    return gather(rows) if layout.gap_free else rows


def flag_network(df: DataFrame, layout: Layout, *, edges: DataFrame | None = None,
                 exempt_parameters: tuple[str, ...] = (), max_gap: int = 4, passes: int = 3) -> DataFrame:
    """Stage two: neighbours, tidy flags, suspect data, filled and smoothed Turbidity."""
    before = max(NETWORK_WIDTH // 2 + SUSPECT_WIDTH, max_gap + 1 + 2 * passes)
    after = max(NETWORK_WIDTH // 2 + SUSPECT_WIDTH // 2 + 1, max_gap + 1 + 2 * passes)
    frames = Frames()
    df = df.drop("auto_flag", "mean_filled", "smoothed_mean")
    if edges is None:
        rows = spread(df, layout, before, after).withColumns({"auto_flag": F.col("flag"), **row_column(frames)})
    else:
        rows = spread_with_reports(df, edges, layout, before, after)
        rows = rows.withColumns({"auto_flag": auto_flag(frames, NETWORK_WIDTH, exempt_parameters), **row_column(frames)})
        rows = rows.drop("_heard")
    rows = rows.withColumns({"auto_flag": tidied(F.col("auto_flag"))})
    rows = rows.withColumns(finish.suspect_inputs())
    rows = rows.withColumns({
        "auto_flag": finish.suspected(frames, SUSPECT_WIDTH),
        "mean_filled": filled_column(frames, "mean", max_gap, TURBID),
    })
    rows = rows.withColumns({
        "auto_flag": finish.without_lone_suspect(frames),
        "smoothed_mean": F.when(F.col("parameter").isin(*TURBID), smoothed_column(frames, "mean_filled", passes)),
    })
    return gather(rows).drop("_bad", "_gone", "_row")


def run_pipeline(raw: DataFrame, *, notes: DataFrame | None = None, malfunctions: DataFrame | None = None,
                 thresholds: DataFrame | None = None, spec: DataFrame | dict | None = None,
                 edges: DataFrame | None = None, history: DataFrame | None = None,
                 period: int | str | None = None, interval: int | str = "15 minutes",
                 submerged_method: str = "depth", exempt_parameters: tuple[str, ...] = (), max_gap: int = 4,
                 passes: int = 3, seasons=SEASONS, slots: int = 4096) -> DataFrame:
    """Raw readings in, flagged series out.

    With ``history`` its trailing ``period`` is flagged again together with the new rows; between the
    two there may be gaps, so rows are then numbered instead of taken by the clock.
    """
    series_rows, bounds = interval_summary(raw, interval), series_bounds(raw, interval)
    how = dict(notes=notes, malfunctions=malfunctions, thresholds=thresholds, spec=spec, edges=edges, submerged_method=submerged_method,
               exempt_parameters=exempt_parameters, max_gap=max_gap, passes=passes, seasons=seasons)
    if history is not None:
        return flag_merged(merge_preflag(pad_grid(series_rows, interval, bounds), history, period), interval=interval, slots=slots, **how)
    rows = series_rows.unionByName(grid_markers(bounds, interval), allowMissingColumns=True)
    bounds = bounds.agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    return _flagged(rows, bounds, Layout(interval, gap_free=True, slots=slots), **how)


def flag_merged(rows: DataFrame, *, interval: int | str = "15 minutes", slots: int = 4096, **how) -> DataFrame:
    """Flag what ``merge_preflag`` gives; ``how`` is ``run_pipeline``'s. There may be gaps, so rows are numbered."""
    return _flagged(rows.drop("auto_flag"), None, Layout(interval, gap_free=False, slots=slots), **how)


def _flagged(rows: DataFrame, bounds: DataFrame | None, layout: Layout, *, edges: DataFrame | None = None,
             exempt_parameters: tuple[str, ...] = (), max_gap: int = 4, passes: int = 3, **evidence) -> DataFrame:
    flagged = flag_site_evidence(rows, bounds, layout, **evidence)
    out = flag_network(flagged, layout, edges=edges, exempt_parameters=exempt_parameters, max_gap=max_gap, passes=passes)
    return out.drop(POSITION)


def curated(df: DataFrame) -> DataFrame:
    """The archive's columns, with the ones the dashboards read."""
    df = finish.dashboard_columns(df).withColumn("dt_join", join_stamp(F.col("dt_round")))
    df = ensure_column(df, "historical", default=False, dtype="boolean")
    return df.select(*CURATED_COLUMNS)
