"""The same operators on arriving files."""
from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.timegrid import seconds
from ..operators.merge import merge_archive
from ..operators.prepare import clean_readings, interval_summary
from ..plans.incremental import commit_batch
from ..plans.pipeline import curated, run_pipeline
from ..schema import RAW_READING, SERIES
from ..sources.readers import stamped_snapshots
from ..sources.writers import write_snapshot


def read_raw_stream(spark: SparkSession, path: str, schema: T.StructType = RAW_READING, archive: str | None = None,
                    files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """New files below ``path``; with ``archive`` a file moves there once its rows are committed."""
    reader = spark.readStream.schema(schema)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def stream_interval_summary(raw: DataFrame, interval: int | str = "15 minutes",
                            lateness: int | str = "1 day") -> DataFrame:
    """``interval_summary`` of a stream, in append mode; rows later than ``lateness`` are counted
    (``late_rows``), and ``open_windows`` gives what is not closed when a query ends.

    Rounding to the nearest stamp is a tumbling window over the time moved on by half an interval,
    and the watermark sits on that moved time.
    """
    step = seconds(interval)
    moved = F.timestamp_micros(F.unix_micros("timestamp") + F.lit(step * 500_000))
    rows = (
        clean_readings(raw, interval).drop("dt_round")
        .withColumn("_moved", moved).withWatermark("_moved", f"{seconds(lateness)} seconds")
        .dropDuplicates(["_moved", *SERIES, "units", "value"])
    )
    value = F.when(~F.isnan("value"), F.col("value"))
    return (
        rows.groupBy(F.window("_moved", f"{step} seconds").alias("_w"), *SERIES, "units")
        .agg(F.avg(value).alias("mean"), (F.max(value) - F.min(value)).alias("spread"),
             F.count(F.lit(1)).alias("n_obs"))
        .select(F.col("_w.start").alias("dt_round"), *SERIES, "units", "mean", "spread", "n_obs")
    )


def archive_batch(archive_path: str, period: int | str, name: str = "curated", *,
                  clock: Callable[[int], datetime] | None = None, **inputs) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: flag the batch with its overlap of the archive, write a new archive.

    The history is the newest finished snapshot, whoever wrote it, and the new one's stamp lies above its stamp (at
    the clock's time, if that is later). A snapshot's name tells the query and batch it came from, so a batch that is
    replayed after a lost executor or driver finds its snapshot and does nothing, and a query with a new checkpoint,
    whose batches count from 0 again, goes on from the archive as it is.
    """
    clock = clock or (lambda batch: datetime.now(timezone.utc))

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        tag = f"-{query}-{batch_id}"
        done = stamped_snapshots(spark, archive_path, name)
        if any(path.endswith(f"{tag}.parquet") for _, path in done):
            return
        stamp, history = clock(batch_id).replace(tzinfo=None), None
        if done:
            stamp = max(stamp, datetime.strptime(done[-1][0], "%Y%m%d-T%H%M%SZ") + timedelta(seconds=1))
            history = spark.read.parquet(done[-1][1])
        flagged = curated(run_pipeline(batch, history=history, period=period if history is not None else None, **inputs))
        archive = merge_archive(flagged, history, period).drop("year")
        write_snapshot(archive, archive_path, name, stamp, tag)

    return process


def late_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark allows and went into no window, over the progress that Spark keeps.

    Their readings are not lost to the archive: ``archive_batch`` merges rows of any age.
    """
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def open_windows(raw: DataFrame, query: StreamingQuery, interval: int | str = "15 minutes") -> DataFrame:
    """The summary of the windows that a finished query's watermark has not closed, from the same readings as a batch."""
    mark = query.lastProgress["eventTime"].get("watermark") if query.lastProgress else None
    summary = interval_summary(raw, interval)
    if mark is None:
        return summary
    closes = F.unix_micros("dt_round") + seconds(interval) * 1_000_000
    return summary.where(closes > F.unix_micros(F.to_timestamp(F.lit(mark))))


def stream_pipeline(raw: DataFrame, archive_path: str, checkpoint: str, period: int | str, **inputs) -> DataStreamWriter:
    """Run the pipeline on every batch of new raw readings. Call ``start`` on the result."""
    return (
        raw.writeStream.foreachBatch(archive_batch(archive_path, period, **inputs))
        .option("checkpointLocation", checkpoint)
    )


def stream_to_archive(raw: DataFrame, root: str, checkpoint: str, period: int | str, **inputs) -> DataStreamWriter:
    """Every batch of new raw readings as one commit to the archive below ``root``. Call ``start`` on the result."""
    return raw.writeStream.foreachBatch(commit_batch(root, period, **inputs)).option("checkpointLocation", checkpoint)
