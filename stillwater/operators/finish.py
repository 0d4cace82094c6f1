"""Tidy flags, suspect data, final columns."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import contains_any, ensure_column, tidied
from ..functions.timegrid import join_stamp
from ..plans.layout import Frames, Layout, over_series
from ..schema import SITE_DISPLAY, SUSPECT, SUSPECT_EXCLUDED

# fixed values: the published column names
FINAL_COLUMNS = (
    "dt_round", "dt_join", "site", "parameter", "mean", "units", "n_obs", "spread", "auto_flag", "mal_flag",
    "sonde_moved", "sonde_employed", "season", "last_site_visit",
)


def tidy_flags(df: DataFrame, column: str = "auto_flag") -> DataFrame:
    return df.withColumn(column, tidied(F.col(column)))


def suspect_inputs() -> dict[str, Column]:
    flag = F.col("auto_flag")
    counts = flag.isNotNull() & ~contains_any(flag, SUSPECT_EXCLUDED) & (flag != SUSPECT)
    return {"_bad": counts.cast("int"), "_gone": F.col("mean").isNull().cast("int")}


def suspected(frames: Frames, width: int = 8, frac: float = 0.5, missing_frac: float = 7 / 8) -> Column:
    """Unflagged rows among mostly flagged rows, and single values among missing ones."""
    trailing, centred = (-(width - 1), 0), (-((width + 1) // 2 - 1), width // 2)

    def share(value: str, least: float, rows: tuple[int, int]) -> Column:
        return (frames.count(*rows) == width) & (frames.total(value, *rows) >= least * width)

    flag = F.col("auto_flag")
    among_bad = share("_bad", frac, trailing) | share("_bad", frac, centred)
    alone = F.col("mean").isNotNull() & share("_gone", missing_frac, trailing) & share("_gone", missing_frac, centred)
    return F.when(flag.isNull() & (among_bad | alone), F.lit(SUSPECT)).otherwise(flag)


def suspect_flag(df: DataFrame, layout: Layout = Layout(), width: int = 8, frac: float = 0.5,
                 missing_frac: float = 7 / 8) -> DataFrame:
    def build(rows: DataFrame, frames: Frames) -> DataFrame:
        rows = rows.withColumns(suspect_inputs())
        return rows.withColumn("auto_flag", suspected(frames, width, frac, missing_frac)).drop("_bad", "_gone")

    return over_series(df, layout, width - 1, width // 2, build)


def without_lone_suspect(frames: Frames) -> Column:
    flag = F.col("auto_flag")
    lone = (flag == SUSPECT) & frames.lag("auto_flag").isNull() & frames.lead("auto_flag").isNull()
    return F.when(lone, F.lit(None).cast("string")).otherwise(flag)


def drop_lone_suspect(df: DataFrame, layout: Layout = Layout()) -> DataFrame:
    return over_series(df, layout, 1, 1,
                       lambda rows, frames: rows.withColumn("auto_flag", without_lone_suspect(frames)))


def final_projection(df: DataFrame) -> DataFrame:
    """The published columns, empty flags as NULL."""
    df = df.withColumn("dt_join", join_stamp(F.col("dt_round")))
    df = df.withColumn("auto_flag", F.nullif(F.col("auto_flag"), F.lit("")))
    types = {"sonde_moved": "boolean", "sonde_employed": "int", "last_site_visit": "timestamp"}
    for name in FINAL_COLUMNS:
        df = ensure_column(df, name, dtype=types.get(name, "string"))
    return df.select(*FINAL_COLUMNS)


def dashboard_columns(df: DataFrame) -> DataFrame:
    """Display name, and the value to display: smoothed Turbidity, Temperature in Fahrenheit."""
    name = F.lit(None).cast("string")
    for site, shown in SITE_DISPLAY:
        name = F.when(F.col("site") == site, F.lit(shown)).otherwise(name)
    value = (
        F.when(F.col("parameter") == "Turbidity", F.col("smoothed_mean"))
        .when(F.col("parameter") == "Temperature", F.col("mean") * 9.0 / 5.0 + 32.0)
        .otherwise(F.col("mean"))
    )
    return df.withColumns({"site_dashboard": F.coalesce(name, F.col("site")), "mean_dashboard": value})
