"""Gap filling, smoothing and spacing checks."""
from __future__ import annotations

import warnings
from math import comb

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.flags import ensure_column
from ..functions.timegrid import floor_to
from ..plans.layout import CHUNK, CLOCK, Frames, Layout, clock, gather, over_series, spread
from ..plans.scan import running
from ..schema import SERIES

METHODS = ("linear", "spline")
KNOT_HALO = 64
KNOTS = 4096
ROUNDS = 6  # of elimination; they reach 2^ROUNDS - 1 knots, less than KNOT_HALO


# --- spacing ---------------------------------------------------------------

def spacing_report(df: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Smallest and largest step per series; ``irregular`` when they differ."""
    steps = over_series(df.select(*SERIES, "dt_round").dropDuplicates(), layout, 1, 0,
                        lambda rows, frames: rows.withColumn("_step", F.col(CLOCK) - frames.lag(CLOCK)))
    return (
        steps.groupBy(*SERIES)
        .agg(F.min("_step").alias("min_step"), F.max("_step").alias("max_step"))
        .withColumn("irregular", F.coalesce(F.col("min_step") != F.col("max_step"), F.lit(False)))
    )


# --- gaps ------------------------------------------------------------------

def row_column(frames: Frames) -> dict[str, Column]:
    return {"_row": F.row_number().over(frames.ordered)}


def filled_column(frames: Frames, value: str, max_gap: int, parameters: tuple[str, ...]) -> Column:
    """Straight line over runs of at most ``max_gap`` NULLs that have a value on both sides (needs ``_row``)."""
    v = F.col(value)
    known = F.when(v.isNotNull(), F.struct(F.col("_row").alias("row"), F.col(CLOCK).alias("t"), v.alias("v")))
    left = F.last(known, ignorenulls=True).over(frames.rows(-max_gap, -1))
    right = F.first(known, ignorenulls=True).over(frames.rows(1, max_gap))
    share = (F.col(CLOCK) - left["t"]) / (right["t"] - left["t"])
    short = right["row"] - left["row"] - 1 <= max_gap
    filled = F.coalesce(v, F.when(short, left["v"] + (right["v"] - left["v"]) * share))
    return F.when(F.col("parameter").isin(*parameters), filled)


def interpolate_gaps(df: DataFrame, layout: Layout = Layout(), max_gap: int = 4, method: str = "linear",
                     value_col: str = "mean", new_value_col: str = "mean_filled",
                     parameters: tuple[str, ...] = ("Turbidity",), check_spacing: bool = False) -> DataFrame:
    """Fill short gaps of the given parameters; other series get a NULL column.

    ``check_spacing`` runs ``spacing_report`` first and warns about irregular series.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if not isinstance(df.schema["dt_round"].dataType, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError("dt_round must be a timestamp")
    if check_spacing and not spacing_report(df, layout).where("irregular").isEmpty():
        warnings.warn("series are not equally spaced; pad them with pad_grid first", stacklevel=2)
    if method == "spline":
        return fill_spline(df, layout, max_gap, value_col, new_value_col, parameters)

    def build(rows: DataFrame, frames: Frames) -> DataFrame:
        rows = rows.withColumns(row_column(frames))
        return rows.withColumn(new_value_col, filled_column(frames, value_col, max_gap, parameters)).drop("_row")

    return over_series(df, layout, max_gap + 1, max_gap + 1, build)


def fill_spline(df: DataFrame, layout: Layout, max_gap: int, value: str, new: str,
                parameters: tuple[str, ...]) -> DataFrame:
    """Cubic spline through all known values of a series.

    A knot's influence on the curve at least halves with every further knot, so a chunk of knots with
    ``KNOT_HALO`` more on each side gives the whole series' curve to double precision. Chunks are cut
    by knot number, so long silent stretches do not thin them out. Knots and gaps of a chunk share one
    exchange; the knots' equations are solved by windows (``curvatures``).
    """
    series = df.where(F.col("parameter").isin(*parameters)).select(*SERIES, "dt_round", F.col(value).alias("_v"))
    marked = gather(_short_runs(spread(series, layout, max_gap + 1, max_gap + 1), max_gap))
    marked = marked.withColumn("_t", clock()).withColumn("_bucket", floor_to(F.col("_t"), layout.slots * layout.step))
    numbered = running(marked, SERIES, "_t", "_bucket",
                       sums={"_knot": F.when(F.col("_v").isNotNull(), 1).otherwise(0)})
    wanted = numbered.where(F.col("_v").isNotNull() | F.col("_short")).select(*SERIES, "dt_round", "_t", "_v", "_knot")
    home = floor_to(F.col("_knot"), KNOTS)
    offset = F.pmod(F.col("_knot"), F.lit(KNOTS))
    is_knot = F.col("_v").isNotNull()
    homes = F.array_compact(F.array(
        F.struct(home.alias("c"), (~is_knot).alias("fill")),
        F.when(is_knot & (offset >= KNOTS - KNOT_HALO), F.struct((home + 1).alias("c"), F.lit(False).alias("fill"))),
        F.when(is_knot & (offset <= KNOT_HALO), F.struct((home - 1).alias("c"), F.lit(False).alias("fill"))),
    ))
    chunks = wanted.withColumn("_h", F.explode(homes)).select(
        *SERIES, "dt_round", "_t", "_v", F.col("_h.c").alias(CHUNK), F.col("_h.fill").alias("_fill"))
    curved = curvatures(chunks.repartition(*SERIES, CHUNK), (*SERIES, CHUNK, "_fill"))
    piece = F.struct(F.col("_t").alias("t"), F.col("_v").alias("v"), "first", "z", "third")
    inner = F.col("_width").isNotNull()
    alone = ~inner & F.col("_width_before").isNull()  # a series of one value is level
    curved = curved.withColumns({
        "first": F.when(alone, 0.0).otherwise(F.col("_slope") - F.col("_width") * (F.col("_z_next") + 2 * F.col("_z"))),
        "third": F.when(alone, 0.0).otherwise((F.col("_z_next") - F.col("_z")) / F.col("_width")),
        "z": F.col("_z"),
    }).withColumn("_piece", F.when(~F.col("_fill") & (inner | alone), piece))
    # a gap belongs to the piece on its left; before the first knot and behind the last one the end pieces go on
    in_chunk = Window.partitionBy(*SERIES, CHUNK).orderBy("_t")
    whole = in_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p = F.coalesce(F.last("_piece", ignorenulls=True).over(in_chunk.rowsBetween(Window.unboundedPreceding, 0)),
                   F.first("_piece", ignorenulls=True).over(whole))
    step = F.col("_t") - F.col("_p.t")
    curve = F.col("_p.v") + step * (F.col("_p.first") + step * (3 * F.col("_p.z") + step * F.col("_p.third")))
    filled = curved.withColumn("_p", p).where("_fill").select(*SERIES, "dt_round", curve.alias("_filled"))
    return (
        df.join(filled, [*SERIES, "dt_round"], "left")
        .withColumn(new, F.when(F.col("parameter").isin(*parameters), F.coalesce(F.col(value), F.col("_filled"))))
        .drop("_filled")
    )


def curvatures(knots: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """A sixth of the curve's second derivative (``_z``) at every knot ``(_t, _v)`` of a group, with the next knot's and
    the width and slope of the piece that follows.

    Each inner knot has one equation with its two neighbours. A round of elimination replaces the neighbours at distance
    ``d`` by those at ``2 d`` and squares the weight they still have, which is a half at most: after ``ROUNDS`` rounds it is
    below 2^-64 and every equation names its own knot alone. The outer knots follow from the third derivative of
    the cubic through the outer four values, which is put into the equations next to them. With two knots the curve is a
    line, with three a parabola.
    """
    order = Window.partitionBy(*keys).orderBy("_t")

    def back(name: str, n: int = 1, default=None) -> Column:
        return F.lag(name, n, default).over(order)

    def ahead(name: str, n: int = 1, default=None) -> Column:
        return F.lead(name, n, default).over(order)

    width = ahead("_t") - F.col("_t")
    rows = knots.withColumns({"_width": width.cast("double"), "_slope": (ahead("_v") - F.col("_v")) / width})
    rows = rows.withColumns({"_width_before": back("_width"), "_slope_before": back("_slope"), "_width_next": ahead("_width")})
    h, h0 = F.col("_width"), F.col("_width_before")
    rows = rows.withColumns({"_second": (F.col("_slope") - F.col("_slope_before")) / (h + h0), "_width_second": back("_width_before")})
    # third derivatives of the cubics through the four knots from one before, and up to one behind
    low = (ahead("_second") - F.col("_second")) / (h0 + h + F.col("_width_next"))
    high = (F.col("_second") - back("_second")) / (F.col("_width_second") + h0 + h)
    rows = rows.withColumns({"_low": F.coalesce(low, F.lit(0.0)), "_high": F.coalesce(high, F.lit(0.0))})
    inner = h.isNotNull() & h0.isNotNull()
    is_first, is_last = F.col("_width_second").isNull(), F.col("_width_next").isNull()
    own = 2 * (h0 + h) + F.when(is_first, h0).otherwise(0.0) + F.when(is_last, h).otherwise(0.0)
    right = (F.col("_slope") - F.col("_slope_before") + F.when(is_first, h0 * h0 * F.col("_low")).otherwise(0.0)
             - F.when(is_last, h * h * F.col("_high")).otherwise(0.0))

    def of_inner(c: Column) -> Column:
        return F.coalesce(F.when(inner, c), F.lit(0.0))

    rows = rows.withColumns({"_a": of_inner(F.when(~is_first, h0) / own), "_c": of_inner(F.when(~is_last, h) / own),
                             "_z": of_inner(right / own)})
    a, c, z = F.col("_a"), F.col("_c"), F.col("_z")
    for d in (2 ** k for k in range(ROUNDS)):
        rest = 1 - a * back("_c", d, 0.0) - c * ahead("_a", d, 0.0)
        rows = rows.withColumns({
            "_a": -a * back("_a", d, 0.0) / rest, "_c": -c * ahead("_c", d, 0.0) / rest,
            "_z": (z - a * back("_z", d, 0.0) - c * ahead("_z", d, 0.0)) / rest,
        })
    outer = F.when(h0.isNull(), ahead("_z") - h * ahead("_low")).when(h.isNull(), back("_z") + h0 * back("_high")).otherwise(z)
    rows = rows.withColumn("_z", F.coalesce(outer, F.lit(0.0)))
    return rows.withColumn("_z_next", ahead("_z")).drop(
        "_slope_before", "_width_next", "_width_second", "_second", "_low", "_high", "_a", "_c")


def _short_runs(rows: DataFrame, max_gap: int) -> DataFrame:
    """Mark NULLs in runs of at most ``max_gap``, also at the ends of a series."""
    frames = Frames()
    rows = rows.withColumn("_row", F.row_number().over(frames.ordered))
    known = F.when(F.col("_v").isNotNull(), F.col("_row"))
    back, ahead = frames.rows(-max_gap - 1, -1), frames.rows(1, max_gap + 1)
    # before the first and after the last row of a series the frames are cut short
    left = F.coalesce(F.last(known, ignorenulls=True).over(back),
                      F.when(F.count(F.lit(1)).over(back) <= max_gap, F.col("_row") - F.count(F.lit(1)).over(back) - 1))
    right = F.coalesce(F.first(known, ignorenulls=True).over(ahead),
                       F.when(F.count(F.lit(1)).over(ahead) <= max_gap, F.col("_row") + F.count(F.lit(1)).over(ahead) + 1))
    short = F.col("_v").isNull() & (right - left - 1 <= max_gap)
    return rows.withColumn("_short", F.coalesce(short, F.lit(False))).drop("_row")


def spline_at(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The same curve for one array of knots, by direct elimination (a reference for small series).

    Two knots give the line, three the parabola; outside the knots the end pieces go on.
    """
    n = len(x)
    if n == 0:
        return np.full(len(at), np.nan)
    if n == 1:
        return np.full(len(at), y[0])
    scale = x[-1] - x[0]
    at, x = (at - x[0]) / scale, (x - x[0]) / scale
    h, slope = np.diff(x), np.diff(y) / np.diff(x)
    z = np.zeros(n)  # a sixth of the second derivative
    if n >= 3:
        second = np.diff(slope) / (x[2:] - x[:-2])
        third = np.diff(second) / (x[3:] - x[:-3]) if n > 3 else np.zeros(1)
        low, diag, up, rhs = np.empty(n), np.empty(n), np.empty(n), np.empty(n)
        diag[0], up[0], rhs[0] = -h[0], h[0], h[0] ** 2 * third[0]
        low[1:-1], diag[1:-1], up[1:-1], rhs[1:-1] = h[:-1], 2 * (h[:-1] + h[1:]), h[1:], np.diff(slope)
        low[-1], diag[-1], rhs[-1] = h[-1], -h[-1], -(h[-1] ** 2) * third[-1]
        for i in range(1, n):
            factor = low[i] / diag[i - 1]
            diag[i] -= factor * up[i - 1]
            rhs[i] -= factor * rhs[i - 1]
        z[-1] = rhs[-1] / diag[-1]
        for i in range(n - 2, -1, -1):
            z[i] = (rhs[i] - up[i] * z[i + 1]) / diag[i]
    i = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    step, width = at - x[i], h[i]
    first = slope[i] - width * (z[i + 1] + 2 * z[i])
    return y[i] + step * (first + step * (3 * z[i] + step * (z[i + 1] - z[i]) / width))


# --- smoothing -------------------------------------------------------------

def smoothed_column(frames: Frames, value: str, passes: int) -> Column:
    """Five-tap binomial smoothing, ``passes`` times over; NULL where a tap is NULL.

    Repeating a binomial kernel gives the next even-order one, so all passes are one weighted sum.
    """
    reach = 2 * passes
    total = None
    for k in range(2 * reach + 1):
        shift = k - reach
        tap = frames.lead(value, shift) if shift > 0 else frames.lag(value, -shift) if shift else F.col(value)
        term = tap * float(comb(2 * reach, k))
        total = term if total is None else total + term
    return total / float(16 ** passes)


def low_pass(df: DataFrame, layout: Layout = Layout(), value_col: str = "mean", new_value_col: str = "smoothed_mean",
             passes: int = 3, parameters: tuple[str, ...] = ("Turbidity",)) -> DataFrame:
    """Smooth the given parameters; values already in ``new_value_col`` stay."""
    df = ensure_column(df, new_value_col, dtype="double")

    def build(rows: DataFrame, frames: Frames) -> DataFrame:
        kept = F.coalesce(F.col(new_value_col).cast("double"), smoothed_column(frames, value_col, passes))
        return rows.withColumn(new_value_col, F.when(F.col("parameter").isin(*parameters), kept))

    return over_series(df, layout, 2 * passes, 2 * passes, build)
