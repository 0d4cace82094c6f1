"""Neighbour values, rolling statistics, slopes and calendar columns."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import season_of
from ..plans.layout import Frames, Layout, over_series
from ..schema import SEASONS

WIDTH = 7


def _kept(df: DataFrame, columns: dict[str, Column]) -> dict[str, Column]:
    """Values that are already there win."""
    return {n: F.coalesce(F.col(n).cast("double"), c) if n in df.columns else c for n, c in columns.items()}


def neighbour_columns(df: DataFrame, frames: Frames) -> dict[str, Column]:
    last = frames.rows(-(WIDTH - 1), 0)
    full = F.count("mean").over(last) == WIDTH
    middle = F.array_sort(F.array("mean", *[frames.lag("mean", i) for i in range(1, WIDTH)]))
    return _kept(df, {
        "front1": frames.lead("mean"),
        "back1": frames.lag("mean"),
        "rollmed": F.when(full, F.get(middle, WIDTH // 2)),
        "rollavg": F.when(full, F.avg("mean").over(last)),
        "rollsd": F.when(full, F.stddev_samp("mean").over(last)),
    })


def slope_columns(df: DataFrame, minutes: float) -> dict[str, Column]:
    """Change per minute to the next and from the previous row (after ``neighbour_columns``)."""
    return _kept(df, {
        "slope_ahead": (F.col("front1") - F.col("mean")) / float(minutes),
        "slope_behind": (F.col("mean") - F.col("back1")) / float(minutes),
    })


def rolling_slope(df: DataFrame, frames: Frames) -> dict[str, Column]:
    last = frames.rows(-(WIDTH - 1), 0)
    full = F.count("slope_behind").over(last) == WIDTH
    return _kept(df, {"rollslope": F.when(full, F.avg("slope_behind").over(last))})


def calendar_columns(seasons=SEASONS, time_col: str = "dt_round") -> dict[str, Column]:
    month, year = F.month(time_col), F.year(time_col)
    return {"month": month, "year": year, "y_m": F.concat_ws(" - ", year, month), "season": season_of(month, seasons)}


def with_calendar(df: DataFrame, seasons=SEASONS, time_col: str = "dt_round") -> DataFrame:
    return df.withColumns(calendar_columns(seasons, time_col))


def summary_statistics(df: DataFrame, layout: Layout = Layout(), seasons=SEASONS) -> DataFrame:
    """Slopes are per minute; the minutes between rows come from the layout's interval."""
    def build(rows: DataFrame, frames: Frames) -> DataFrame:
        rows = rows.withColumns(neighbour_columns(rows, frames))
        rows = rows.withColumns({**slope_columns(rows, layout.step / 60), **calendar_columns(seasons)})
        return rows.withColumns(rolling_slope(rows, frames))

    return over_series(df, layout, WIDTH, 1, build)
