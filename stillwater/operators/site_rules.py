"""Flags that look at all parameters of a site at one stamp.

"Did Temperature say so at this stamp?" is asked with a window over the stamp's few rows (one per
parameter) instead of a self join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import add_flag, contains, ensure_column
from ..functions.text import replace_first
from ..plans.layout import Frames, Layout, over_series
from ..schema import BURIAL, FROZEN, SLOPE, UNSUBMERGED

STAMP = ("site", "dt_round")
CONTEXT_PARAMETERS = ("Temperature", "Depth")
SUBMERGED_METHODS = ("depth_sc", "depth", "sc")


def any_at(condition: Column, stamp: tuple[str, ...] = STAMP) -> Column:
    return F.coalesce(F.max(condition).over(Window.partitionBy(*stamp)), F.lit(False))


def of(parameter: str) -> Column:
    return F.col("parameter") == parameter


def freezing() -> Column:
    return of("Temperature") & (F.col("mean") <= 0)


def out_of_water(method: str) -> Column:
    if method not in SUBMERGED_METHODS:
        raise ValueError(f"method must be one of {SUBMERGED_METHODS}")
    dry, empty = of("Depth") & (F.col("mean") <= 0), of("Specific Conductivity") & (F.col("mean") <= 10)
    return {"depth": dry, "sc": empty, "depth_sc": dry | empty}[method]


def frozen_flag(df: DataFrame) -> DataFrame:
    """Water at or below freezing flags every parameter of the site."""
    return add_flag(df, any_at(freezing()), FROZEN)


def unsubmerged_flag(df: DataFrame, method: str = "depth") -> DataFrame:
    return add_flag(df, any_at(out_of_water(method)), UNSUBMERGED)


def spread_burial(df: DataFrame) -> DataFrame:
    """A burial seen by the DO sensor concerns the other sensors of the sonde as well."""
    buried = any_at(of("DO") & contains(F.col("flag"), BURIAL))
    return add_flag(df, buried & ~of("DO"), BURIAL)


def explains_slope(steep: Column, frames: Frames) -> Column:
    """Steep Temperature or Depth at this row or next to it in its own series."""
    near = steep | F.coalesce(frames.lag(steep), F.lit(False)) | F.coalesce(frames.lead(steep), F.lit(False))
    return F.col("parameter").isin(*CONTEXT_PARAMETERS) & near


def without_slope(flag: Column, explained: Column) -> Column:
    """Take back a slope violation that Temperature or Depth shares; those two never keep theirs."""
    drop = F.col("parameter").isin(*CONTEXT_PARAMETERS) | explained
    return F.when(drop & contains(flag, SLOPE), F.nullif(replace_first(flag, SLOPE, ""), F.lit(""))).otherwise(flag)


def reconcile_slope(df: DataFrame, layout: Layout = Layout()) -> DataFrame:
    df = ensure_column(df, "flag")

    def build(rows: DataFrame, frames: Frames) -> DataFrame:
        return rows.withColumn("_explains", explains_slope(contains(F.col("flag"), SLOPE), frames))

    df = over_series(df, layout, 1, 1, build).withColumn("_explained", any_at(F.col("_explains")))
    return df.withColumn("flag", without_slope(F.col("flag"), F.col("_explained"))).drop("_explains", "_explained")
