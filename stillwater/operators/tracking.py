"""Bookkeeping of the repeated ingest: tracker, session start, retention."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import DEFAULT_SITES, SERIES

ZONE = "America/Denver"
RETENTION = {"main": 1, "archive": 3, "tracker": 10}


def _stamp(now: datetime | str | Column) -> Column:
    if isinstance(now, Column):
        return now
    return F.lit(now if isinstance(now, str) else now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def tracker_update(tracker: DataFrame, received: DataFrame, now: datetime | str | Column,
                   disable_after: int = 56, retry_days: float = 7) -> DataFrame:
    """Next tracker snapshot from the rows received in this run (any frame with site and parameter).

    Disabling and retrying look at the updated counters. ``try_again`` stays on once it is set, and
    keeps its value for series that never succeeded.
    """
    now = _stamp(now)
    counts = (
        received.groupBy(F.concat_ws("-", *SERIES).alias("site_parameter")).agg(F.count(F.lit(1)).alias("_rows"))
        .join(tracker.select("site_parameter").distinct(), "site_parameter", "left_semi")
    )
    success = F.coalesce(F.col("_rows"), F.lit(0)) > 0
    updated = tracker.join(counts, "site_parameter", "left").withColumns({
        "failure_count": F.when(success, 0).otherwise(F.col("failure_count") + 1).cast("int"),
        "last_success": F.when(success, now).otherwise(F.col("last_success")),
    })
    idle_days = (F.unix_micros(now) - F.unix_micros("last_success")) / 86_400_000_000.0
    return updated.withColumns({
        "auto_disabled": F.col("failure_count") >= disable_after,
        "try_again": F.when(idle_days >= retry_days, F.lit(True)).otherwise(F.col("try_again")),
    }).select(*tracker.columns)


def weekly_retry(now: Column) -> Column:
    """Sunday, the hour after midnight, on the clock of the rivers."""
    local = F.from_utc_timestamp(now, ZONE)
    return (F.dayofweek(local) == 1) & (F.hour(local) == 0)


def session_dates(spark: SparkSession, history: DataFrame | None, tracker: DataFrame | None,
                  now: datetime | str | Column, sites: tuple[str, ...] = DEFAULT_SITES) -> DataFrame:
    """(site, start_dt, end_dt): one common start for all sites.

    The start is the earliest of the sites' latest Temperature stamps, or of their latest stamps over
    all eligible parameters where those differ and Temperature is not later. Without history it is
    the first of March.
    """
    now = _stamp(now)
    every_site = F.explode(F.array(*[F.lit(s) for s in sites])).alias("site")
    if history is None:
        march = F.concat(F.year(now).cast("string"), F.lit("-03-01 00:00:00")).cast("timestamp")
        return spark.range(1).select(every_site, F.to_utc_timestamp(march, ZONE).alias("start_dt"), now.alias("end_dt"))

    disabled, again = F.col("auto_disabled"), F.col("try_again")
    eligible = F.when(weekly_retry(now), ~disabled | again).otherwise(~disabled & ~again)
    latest = history.groupBy(*SERIES).agg(F.max("dt_round").alias("latest"))
    known = latest.join(tracker.select(*SERIES, eligible.alias("eligible")), list(SERIES), "left")
    per_site = known.groupBy("site").agg(
        F.max(F.when(F.col("parameter").contains("Temperature"), F.col("latest"))).alias("by_temperature"),
        F.max(F.when(F.col("eligible"), F.col("latest"))).alias("by_any"),
    )
    same = F.bool_and(F.col("by_temperature") == F.col("by_any"))
    first_temperature, first_any = F.min("by_temperature"), F.min("by_any")
    use_any = ~F.coalesce(same, F.lit(True)) & F.coalesce(first_temperature <= first_any, F.lit(True))
    start = per_site.agg(F.when(use_any, first_any).otherwise(first_temperature).alias("start_dt"))
    return start.select(every_site, "start_dt", now.alias("end_dt"))


def retention(snapshots: DataFrame, keep: dict[str, int] = RETENTION) -> DataFrame:
    """Mark which snapshots (dataset, kind, snapshot, ts) stay: the newest few of each dataset and kind."""
    newest = Window.partitionBy("dataset", "kind").orderBy(F.col("ts").desc(), F.col("snapshot").desc())
    allowed = F.lit(0)
    for kind, n in keep.items():
        allowed = F.when(F.col("kind") == kind, n).otherwise(allowed)
    most = max(keep.values())
    # the limit on the rank lets every task cut its input down before the shuffle
    kept = (
        snapshots.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= most)
        .where(F.col("_rank") <= allowed)
        .select("dataset", "kind", "snapshot", "ts", F.lit(True).alias("keep"))
    )
    return (
        snapshots.join(kept, ["dataset", "kind", "snapshot", "ts"], "left")
        .withColumn("keep", F.coalesce("keep", F.lit(False)))
    )


def reading_counts(df: DataFrame) -> DataFrame:
    """Rows received per series."""
    return df.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("data_count"))


__all__ = ["tracker_update", "session_dates", "retention", "reading_counts", "weekly_retry"]
