"""Flags that look at one series only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import add_flag, contains, ensure_column, fold_flags, has_token
from ..plans.joins import join_lookup
from ..plans.layout import Frames, Layout, over_series
from ..schema import (
    BURIAL, DO_INTERFERENCE, DRIFT, DRIFT_PARAMETERS, MISSING, NOT_EMPLOYED, OUT_OF_SEASON, OUT_OF_SPEC,
    REPEATED, SITE_VISIT, SLOPE, SV_WINDOW,
)

DAY, HALF_DAY = 1440 * 60, 720 * 60
THREE_DAYS, HALF_THREE_DAYS = 4320 * 60, 2160 * 60


def true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


# --- row rules -------------------------------------------------------------

def missing() -> Column:
    return F.col("mean").isNull()


def repeated() -> Column:
    return (F.col("mean") == F.col("front1")) | (F.col("mean") == F.col("back1"))


def missing_flag(df: DataFrame) -> DataFrame:
    return add_flag(df, missing(), MISSING)


def repeat_flag(df: DataFrame) -> DataFrame:
    """Needs ``front1``/``back1`` (see ``summary_statistics``)."""
    return add_flag(df, repeated(), REPEATED)


def with_spec(df: DataFrame, spec: DataFrame | dict, find_heavy: bool = True) -> DataFrame:
    """Add ``spec_min``/``spec_max``; a mapping parameter -> (min, max) becomes literals, not a join.

    ``find_heavy=False`` is for a ``df`` that is dear to read twice and is shuffled afterwards anyway: adaptive
    execution then splits the parts of heavy keys.
    """
    if not isinstance(spec, dict):
        table = spec.select("parameter", "spec_min", "spec_max")
        return join_lookup(df, table, ("parameter",), F.col("dt_round")) if find_heavy else df.join(table, "parameter", "left")
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for parameter, (lo, hi) in spec.items():
        hit = F.col("parameter") == parameter
        low, high = F.when(hit, float(lo)).otherwise(low), F.when(hit, float(hi)).otherwise(high)
    return df.withColumns({"spec_min": low, "spec_max": high})


def out_of_spec() -> Column:
    return (F.col("mean") < F.col("spec_min")) | (F.col("mean") > F.col("spec_max"))


def spec_flag(df: DataFrame, spec: DataFrame | dict) -> DataFrame:
    """Outside of what the sensor can measure; parameters without a specification stay as they are."""
    return add_flag(with_spec(df, spec), out_of_spec(), OUT_OF_SPEC).drop("spec_min", "spec_max")


THRESHOLD_COLUMNS = ("t_mean01", "t_mean99", "t_slope_behind_01", "t_slope_behind_99")


def with_thresholds(df: DataFrame, thresholds: DataFrame, find_heavy: bool = True) -> DataFrame:
    """Add a series' thresholds of the row's season; ``find_heavy`` as in ``with_spec``."""
    table = thresholds.select("site", "parameter", "season", *THRESHOLD_COLUMNS)
    keys = ("site", "parameter", "season")
    return join_lookup(df, table, keys, F.col("dt_round")) if find_heavy else df.join(table, list(keys), "left")


def out_of_season() -> Column:
    return (F.col("mean") < F.col("t_mean01")) | (F.col("mean") > F.col("t_mean99"))


def steep() -> Column:
    up, down = F.col("t_slope_behind_99"), F.col("t_slope_behind_01")
    ahead, behind = F.col("slope_ahead"), F.col("slope_behind")
    return (ahead >= up) | (behind >= up) | (ahead <= down) | (behind <= down)


def seasonal_flag(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Seasonal range and slope flags; needs ``season`` and the slopes of ``summary_statistics``."""
    df = with_thresholds(df, thresholds)
    return fold_flags(df, [(OUT_OF_SEASON, out_of_season()), (SLOPE, steep())]).drop(*THRESHOLD_COLUMNS)


def depth_shift(df: DataFrame, shifts: DataFrame | None = None) -> DataFrame:
    """Mark moved sondes in ``depth_change``, from the notes or from a table (site, dt_round, type)."""
    if shifts is None:
        return df.withColumn("depth_change", F.when(F.col("sonde_moved"), F.lit("sonde moved")))
    moved = (
        shifts.where(F.col("type") == "sonde moved")
        .select("site", F.col("dt_round").cast("timestamp").alias("dt_round"))
        .dropDuplicates().withColumn("depth_change", F.lit("sonde moved"))
    )
    return df.join(moved, ["site", "dt_round"], "left")


# --- field visits ----------------------------------------------------------

def visited() -> Column:
    return (F.col("last_site_visit") == F.col("dt_round")) | has_token(F.col("flag"), SITE_VISIT)


def visit_column() -> dict[str, Column]:
    return {"_visit": true(visited()).cast("int")}


def around_visit(frames: Frames, after: int = 4, before: int = 1) -> dict[str, Column]:
    near = (frames.total("_visit", -after, -1) if after else F.lit(0)) + (
        frames.total("_visit", 1, before) if before else F.lit(0))
    return {"_sv": near > 0}


def field_rules() -> list[tuple[str, Column]]:
    return [
        (NOT_EMPLOYED, F.col("sonde_employed") == 1),
        (SITE_VISIT, F.col("last_site_visit") == F.col("dt_round")),
        (SV_WINDOW, F.col("_sv")),
    ]


def field_flags(df: DataFrame, layout: Layout = Layout(), after: int = 4, before: int = 1) -> DataFrame:
    """Sonde out of the water, technicians on site, and the rows around a visit."""
    df = ensure_column(df, "flag")

    def build(rows: DataFrame, frames: Frames) -> DataFrame:
        rows = rows.withColumns(visit_column())
        rows = rows.withColumns(around_visit(frames, after, before))
        return fold_flags(rows, field_rules()).drop("_visit", "_sv")

    return over_series(df, layout, after, before, build)


# --- dissolved oxygen ------------------------------------------------------

def interference_columns(drop: float = 0.5, low: float = 5.0) -> dict[str, Column]:
    mean, is_do = F.col("mean"), F.col("parameter") == "DO"
    dip = (F.col("back1") - mean >= drop) & (F.col("front1") - mean >= drop)
    seen = true(is_do & (dip | (mean <= low)))
    return {"_interfered": seen, "_hit": (seen | (is_do & contains(F.col("flag"), DO_INTERFERENCE))).cast("int")}


def burial_column(frames: Frames, min_hits: int = 24, width: int = 96) -> dict[str, Column]:
    """Many interfered rows in a full trailing or centred window."""
    def full_of_hits(first: int, last: int) -> Column:
        return (frames.count(first, last) == width) & (frames.total("_hit", first, last) >= min_hits)

    trailing = full_of_hits(-(width - 1), 0)
    centred = full_of_hits(-((width + 1) // 2 - 1), width // 2)
    return {"_buried": (F.col("parameter") == "DO") & (trailing | centred)}


def do_rules() -> list[tuple[str, Column]]:
    return [(DO_INTERFERENCE, F.col("_interfered")), (BURIAL, F.col("_buried"))]


def do_noise_flags(df: DataFrame, layout: Layout = Layout(), drop: float = 0.5, low: float = 5.0,
                   min_hits: int = 24, width: int = 96) -> DataFrame:
    """Dips and very low dissolved oxygen; their persistence means a buried sonde. Needs front1/back1."""
    df = ensure_column(df, "flag")

    def build(rows: DataFrame, frames: Frames) -> DataFrame:
        rows = rows.withColumns(interference_columns(drop, low))
        rows = rows.withColumns(burial_column(frames, min_hits, width))
        return fold_flags(rows, do_rules()).drop("_interfered", "_hit", "_buried")

    return over_series(df, layout, width, width // 2, build)


# --- drift -----------------------------------------------------------------

# (seconds back, seconds ahead) of the regression windows
DRIFT_WINDOWS = ((DAY, 0), (HALF_DAY, HALF_DAY), (THREE_DAYS, 0), (HALF_THREE_DAYS, HALF_THREE_DAYS))
DRIFT_MIN_ROWS = 10
VISIT_PATTERN = r"(?i)(site\s*visit|\bsv\b)"


def drift_room(layout: Layout) -> tuple[int, int]:
    """Rows before and after that a drift verdict can depend on."""
    return layout.rows_in(THREE_DAYS) + layout.rows_in(DAY), layout.rows_in(HALF_THREE_DAYS)


def drift_column(df: DataFrame, new_group: Column, limit: float = 0.5,
                 parameters: tuple[str, ...] = DRIFT_PARAMETERS) -> DataFrame:
    """Add ``_drift``: steadily rising values since the last visit.

    Each window's regression is the running sums at the window's end minus those before its start,
    so a row costs the same whatever the window length. Values are taken relative to the chunk's
    mean, and products are summed in an exact coarse part and a small rest, so a difference of two
    large sums keeps its digits.
    """
    chunk, frames = Frames(), Frames("_visits")
    drifting = F.col("parameter").isin(*parameters)
    df = df.withColumns({
        "_visits": F.sum(new_group.cast("int")).over(chunk.upto(0)),
        "_y": F.when(drifting, F.col("mean") - F.avg("mean").over(chunk.whole)),
    })
    df = df.withColumn("_x", F.row_number().over(frames.ordered).cast("double"))
    known = F.col("_y").isNotNull()
    x, y = F.when(known, F.col("_x")), F.col("_y")
    parts = {"n": F.when(drifting, 1.0), "m": F.when(known, 1.0), "x": x, "xx": x * x}
    for name, product in {"y": y, "xy": x * y, "yy": y * y}.items():
        coarse = F.floor(product * 4096.0).cast("double") / 4096.0
        parts |= {name: coarse, f"{name}_rest": product - coarse}
    sums = F.struct(*[F.coalesce(F.sum(part).over(frames.upto(0)), F.lit(0.0)).alias(k) for k, part in parts.items()])
    df = df.withColumn("_sums", F.when(drifting, sums))
    edges = {ahead for _, ahead in DRIFT_WINDOWS if ahead} | {-back - 1 for back, _ in DRIFT_WINDOWS}
    df = df.withColumns({_edge(e): F.last("_sums").over(frames.upto(e)) for e in edges})
    df = df.withColumns({f"_w{i}_{k}": v for i, (back, ahead) in enumerate(DRIFT_WINDOWS)
                         for k, v in _window_sums(back, ahead).items()})
    df = df.withColumns({f"_w{i}_{k}": v for i in range(len(DRIFT_WINDOWS)) for k, v in _moments(i).items()})
    df = df.withColumn("_fit", F.when(drifting, F.greatest(*[_steadiness(i) for i in range(len(DRIFT_WINDOWS))])))
    day_sum, day_rows = (
        F.coalesce(f("_fit").over(frames.upto(0)), F.lit(0)) - F.coalesce(f("_fit").over(frames.upto(-DAY - 1)), F.lit(0))
        for f in (F.sum, F.count)
    )
    df = df.withColumn("_drift", drifting & (day_sum >= limit * day_rows))
    return df.drop("_visits", "_x", "_y", "_fit", "_sums", *map(_edge, edges), *[c for c in df.columns if c.startswith(tuple(f"_w{i}_" for i in range(len(DRIFT_WINDOWS))))])


def _edge(edge: int) -> str:
    """Column of the running sums up to ``edge`` seconds from the row."""
    return "_sums" if edge == 0 else f"_sums_{'back' if edge < 0 else 'ahead'}_{abs(edge)}"


def _window_sums(back: int, ahead: int) -> dict[str, Column]:
    """Sums over one window; the products' rests are added last."""
    upto, before = F.col(_edge(ahead)), F.col(_edge(-back - 1))

    def total(part: str) -> Column:
        return upto[part] - F.coalesce(before[part], F.lit(0.0))

    return {**{k: total(k) for k in ("n", "m", "x", "xx")}, **{k: total(k) + total(f"{k}_rest") for k in ("y", "xy", "yy")}}


def _moments(i: int) -> dict[str, Column]:
    m, x, y = (F.col(f"_w{i}_{k}") for k in ("m", "x", "y"))
    return {"vx": F.col(f"_w{i}_xx") - F.try_divide(x * x, m), "vy": F.col(f"_w{i}_yy") - F.try_divide(y * y, m),
            "cov": F.col(f"_w{i}_xy") - F.try_divide(x * y, m)}


def _steadiness(i: int) -> Column:
    """R squared of a rising line over one window, else 0."""
    n, m, yy, vx, vy, cov = (F.col(f"_w{i}_{k}") for k in ("n", "m", "yy", "vx", "vy", "cov"))
    usable = (n >= DRIFT_MIN_ROWS) & (m >= F.ceil(n * 0.9))
    level = vy <= yy * 1e-12
    return F.when(usable & ~level & (cov > 0.0), F.try_divide(cov * cov, vx * vy)).otherwise(0.0)


def drift_flag(df: DataFrame, layout: Layout = Layout(), parameters: tuple[str, ...] = DRIFT_PARAMETERS,
               limit: float = 0.5) -> DataFrame:
    """Flag steady rises of the given parameters; windows never cross a site visit."""
    df = ensure_column(df, "flag")
    before, after = drift_room(layout)

    def build(rows: DataFrame, _: Frames) -> DataFrame:
        visit = true(F.col("flag").rlike(VISIT_PATTERN))
        rows = drift_column(rows, visit, limit, parameters)
        return fold_flags(rows, [(DRIFT, F.col("_drift"))]).drop("_drift")

    return over_series(df, layout, before, after, build)
