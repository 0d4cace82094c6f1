"""The repeated run against a committed archive: overlap, flags, write-back, tracker and recent extract as one commit."""
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import merge_preflag
from ..operators.prepare import clean_readings, interval_summary, pad_grid, series_bounds
from ..operators.tracking import session_dates, tracker_update
from ..schema import SERIES
from ..sources.archive import Commit, Conflict, clear_unused, commit_table, read_commit, series_index, trailing_rows, write_back
from .pipeline import curated, flag_merged


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged_rows(raw: DataFrame, root: str, period: int | str, touched: DataFrame, base: Commit | None, interval: int | str) -> DataFrame:
    """New readings on their grid and the trailing rows of their series: two scans of the readings, two of those rows' folders."""
    spark = raw.sparkSession
    new = pad_grid(interval_summary(raw, interval), interval, series_bounds(raw, interval))
    past = trailing_rows(spark, root, touched, period, base)
    if past is None:
        return new.withColumns({"flag": F.lit(None).cast("string"), "historical": F.lit(False)})
    return merge_preflag(new, past, period, cut=True)


def incremental_run(spark: SparkSession, root: str, raw: DataFrame, period: int | str, *, now: datetime | None = None,
                    source: str = "direct", batch: int | None = None, interval: int | str = "15 minutes", tracker: DataFrame | None = None,
                    recent_days: int = 45, keep_commits: int | None = None, attempts: int = 5, **how) -> Commit | None:
    """One run as one transaction; returns the commit that holds it (None if an empty archive got no readings).

    Read the series' overlap by the index, flag it with the new readings, write the touched site-months, and commit them
    together with the tracker after this run and the last ``recent_days`` for the dashboards. Whatever step a run dies in,
    the archive is as before, and running it again does all of it once: a ``batch`` number of a ``source`` that is already
    committed is not run again. Where another writer came first with rows of the same series, the overlap is read and
    flagged anew. ``tracker`` is the tracker to begin with where no commit has one. With ``keep_commits`` the folders that
    only older commits read are removed at the end.
    """
    now, root = now or datetime.now(timezone.utc).replace(tzinfo=None), root.rstrip("/")
    for _ in range(attempts):
        base = read_commit(spark, root)
        if base and base.holds(source, batch):
            return base
        draft = f"{root}/drafts/{uuid.uuid4().hex}"
        touched = _stored(clean_readings(raw, interval).select(*SERIES).distinct(), f"{draft}/touched")
        rows = _stored(merged_rows(raw, root, period, touched, base, interval), f"{draft}/rows")
        if touched.isEmpty() and base is None:
            return None
        flagged = curated(flag_merged(rows, interval=interval, **how))
        before = commit_table(spark, root, "tracker", base) if base else None
        before = before if before is not None else tracker

        def tables(read: Callable, index: DataFrame) -> dict[str, DataFrame]:
            newest = index.agg(F.max(F.unix_seconds("newest"))).first()[0]
            first = (newest or 0) - int(recent_days) * 86_400
            out = {"recent": read(F.unix_seconds("newest") >= first).where(F.unix_seconds("dt_round") >= first)}
            if before is not None:
                out["tracker"] = tracker_update(before, clean_readings(raw, interval), now)
            return out

        try:
            commit = write_back(spark, root, flagged, period, base=base, source=source, batch=batch, tables=tables)
        except Conflict:
            continue
        if keep_commits:
            clear_unused(spark, root, keep_commits)
        return commit
    raise Conflict(f"other writers changed the same series {attempts} times in a row below {root}")


def next_session(spark: SparkSession, root: str, now: datetime, **sites) -> DataFrame:
    """``session_dates`` from the newest commit: latest stamps from its index, eligibility from its tracker."""
    commit = read_commit(spark, root.rstrip("/"))
    tracker = commit_table(spark, root.rstrip("/"), "tracker", commit) if commit else None
    if tracker is None:
        return session_dates(spark, None, None, now, **sites)
    latest = series_index(spark, root.rstrip("/"), commit).select(*SERIES, F.col("newest").alias("dt_round"))
    return session_dates(spark, latest, tracker, now, **sites)


def commit_batch(root: str, period: int | str, *, clock: Callable[[int], datetime] | None = None, **how) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: ``incremental_run`` with the query's id and batch number, so that a replay commits nothing."""
    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        incremental_run(spark, root, batch, period, now=clock(batch_id) if clock else None, source=query, batch=batch_id, **how)

    return process
