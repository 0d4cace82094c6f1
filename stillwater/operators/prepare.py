"""From raw readings to regular series."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import ensure_column
from ..functions.text import matches, standard_site
from ..functions.timegrid import floor_to, join_stamp, round_time, seconds
from ..plans.layout import clock
from ..schema import EXCLUDED_EQUIPMENT, EXCLUDED_PARAMETER, SERIES, SITE_RENAMES

__all__ = [
    "clean_readings", "interval_summary", "series_bounds", "grid_markers", "fill_markers", "pad_grid",
    "standardize_site_names", "standardize_turbidity", "mask_omitted", "with_join_stamp", "prepare_series",
]

BLOCK = 32768


def clean_readings(raw: DataFrame, interval: int | str = "15 minutes") -> DataFrame:
    """Leave out unused equipment and parameters, round the time, lower the site name."""
    keep = ~matches(F.col("parameter"), EXCLUDED_PARAMETER)
    for word in EXCLUDED_EQUIPMENT:
        keep = keep & ~matches(F.col("name"), word)
    return raw.where(keep).select(
        F.lower("site").alias("site"),
        "parameter",
        F.col("units").cast("string").alias("units"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.col("value").cast("double").alias("value"),
        round_time(F.col("timestamp"), interval).alias("dt_round"),
    )


def interval_summary(raw: DataFrame, interval: int | str = "15 minutes") -> DataFrame:
    """Mean, spread and count per grid stamp and series, repeated transmissions counted once."""
    value = F.when(~F.isnan("value"), F.col("value"))
    # copies of a reading collapse before the shuffle; the rounded time follows from the rest
    return (
        clean_readings(raw, interval).drop("dt_round").dropDuplicates()
        .withColumn("dt_round", round_time(F.col("timestamp"), interval))
        .groupBy("dt_round", *SERIES, "units")
        .agg(
            F.avg(value).alias("mean"),
            (F.max(value) - F.min(value)).alias("spread"),
            F.count(F.lit(1)).alias("n_obs"),
        )
        .withColumn("flag", F.lit(None).cast("string"))
    )


def series_bounds(raw: DataFrame, interval: int | str = "15 minutes") -> DataFrame:
    """First and last grid stamp per series, straight from the readings (narrow scan, small result).

    A series has one unit: its values stand in one frame. Two units raise an error that names the series.
    """
    mixed = F.concat_ws(" ", F.lit("two units in series"), *SERIES, F.min("units"), F.max("units"))
    first = F.when(F.min("units") != F.max("units"), F.raise_error(mixed).cast("bigint")).otherwise(F.min("_s"))
    return (
        clean_readings(raw, interval).select(*SERIES, "units", clock().alias("_s"))
        .groupBy(*SERIES).agg(first.alias("_lo"), F.max("_s").alias("_hi"))
    )


def grid_markers(bounds: DataFrame, interval: int | str) -> DataFrame:
    """Every grid stamp of every series. Long series are cut into blocks that expand in parallel."""
    step = seconds(interval)
    lo, hi = floor_to(F.col("_lo"), step), floor_to(F.col("_hi"), step)
    blocks = bounds.select(
        *SERIES, lo.alias("_lo"), hi.alias("_hi"),
        F.explode(F.sequence(floor_to(lo, BLOCK), floor_to(hi, BLOCK))).alias("_block"),
    ).repartition(*SERIES, "_block")
    slots = F.sequence(F.greatest(F.col("_lo"), F.col("_block") * BLOCK),
                       F.least(F.col("_hi"), F.col("_block") * BLOCK + (BLOCK - 1)))
    return blocks.select(*SERIES, F.explode(slots).alias("_slot")).select(
        *SERIES, F.timestamp_seconds(F.col("_slot") * step).alias("dt_round"),
        F.lit(True).alias("_marker"),
    )


def fill_markers(rows: DataFrame, *keys: str) -> DataFrame:
    """Keep a marker only where its stamp has no reading."""
    stamp = Window.partitionBy(*keys)
    return (
        rows.withColumn("_present", F.max(F.col("_marker").isNull()).over(stamp))
        .where(F.col("_marker").isNull() | ~F.col("_present"))
        .drop("_marker", "_present")
    )


def pad_grid(series: DataFrame, interval: int | str = "15 minutes", bounds: DataFrame | None = None) -> DataFrame:
    """One row per grid stamp from the first to the last one of each series; new rows are NULL.

    ``bounds`` (see ``series_bounds``) spares a second pass over the upstream plan of ``series``.
    """
    if bounds is None:
        bounds = series.groupBy(*SERIES).agg(F.min(clock()).alias("_lo"), F.max(clock()).alias("_hi"))
    rows = series.unionByName(grid_markers(bounds, interval), allowMissingColumns=True)
    return fill_markers(rows, *SERIES, "dt_round")


def prepare_series(raw: DataFrame, interval: int | str = "15 minutes") -> DataFrame:
    """Clean, summarise and pad in one call."""
    return pad_grid(interval_summary(raw, interval), interval, series_bounds(raw, interval))


def with_join_stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("dt_join", join_stamp(F.col("dt_round")))


def standardize_site_names(df: DataFrame, site_col: str = "site", renames=SITE_RENAMES) -> DataFrame:
    return df.withColumn(site_col, standard_site(F.col(site_col), renames))


def standardize_turbidity(df: DataFrame, cap: float = 1000.0) -> DataFrame:
    """Keep the measured value in ``raw`` and cap Turbidity."""
    df = ensure_column(df, "raw", dtype="double")
    capped = F.when((F.col("parameter") == "Turbidity") & (F.col("mean") >= cap), F.lit(float(cap)))
    return (
        df.withColumn("raw", F.coalesce("raw", "mean"))
        .withColumn("mean", capped.otherwise(F.col("mean")))
    )


def mask_omitted(df: DataFrame, status_col: str = "approval_status", word: str = "OMIT") -> DataFrame:
    """NULL mean where the reviewer omitted the reading; an unknown status gives NULL as well."""
    return df.withColumn("mean", F.when(F.col(status_col) != word, F.col("mean")))
