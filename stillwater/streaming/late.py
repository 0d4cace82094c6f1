"""The interval summary of a stream that loses no late row.

Spark's stateful aggregation drops what is behind the watermark. Here the state are tables below ``root``, written once per
micro-batch under the batch's number, so a replayed batch writes the same folders again:

``rows/slot=<day>/batch=<n>``   clean readings, by the day of their grid stamp
``late/batch=<n>``              those that came when their stamp was closed already, for the overlap path
``summary/batch=<n>``           stamps closed by the batch, and stamps summed anew because of late rows
``marks/<n>.json``              the watermark after the batch; batches run one after the other

A stamp closes when the watermark (the latest reading less ``lateness``) passes it, and is then summed from the rows of
its day; a late row makes its stamp be summed again. Reading the summary, the highest batch of a stamp counts. The rows
of a day are kept until ``forget`` removes them; rows later than that are handed on as late, but no longer summed.
"""
from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.timegrid import seconds
from ..operators.prepare import interval_summary
from ..schema import RAW_READING, SERIES

DAY = 86_400
ROW_COLUMNS = RAW_READING.names


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, value: dict) -> None:
    """Written beside and renamed: a mark is there with all its text or not at all."""
    draft, fs = _fs(spark, f"{path}.draft")
    final, _ = _fs(spark, path)
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    fs.delete(final, False)
    fs.rename(draft, final)


def finished(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the finished batches, in order."""
    folder, fs = _fs(spark, f"{root}/marks")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_mark(spark: SparkSession, root: str, batch: int | None = None) -> dict | None:
    """What the last batch (below ``batch``) left: ``mark``, the watermark, ``first``, the first stamp of all, and its ``late`` rows."""
    numbers = [n for n in finished(spark, root) if batch is None or n < batch]
    if not numbers:
        return None
    path, fs = _fs(spark, f"{root}/marks/{numbers[-1]}.json")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _stamp(interval: int | str) -> Column:
    """Seconds of the reading's grid stamp."""
    step = seconds(interval)
    shifted = F.unix_micros(F.col("timestamp").cast("timestamp")) + F.lit(step * 500_000)
    return ((shifted - F.pmod(shifted, F.lit(step * 1_000_000))) / F.lit(1_000_000)).cast("bigint")


def _slots(spark: SparkSession, root: str) -> list[int]:
    """Days that have rows."""
    folder, fs = _fs(spark, f"{root}/rows")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[5:]) for n in names if n.startswith("slot="))


def _rows_of(spark: SparkSession, root: str, low: int, high: int) -> DataFrame | None:
    """Rows kept of the days from one to another."""
    paths = [f"{root}/rows/slot={s}" for s in _slots(spark, root) if low <= s <= high]
    schema = "site string, id string, name string, timestamp timestamp, parameter string, value double, units string, _stamp bigint, slot bigint, batch bigint"
    return spark.read.schema(schema).option("basePath", f"{root}/rows").parquet(*paths) if paths else None


def summary_batch(root: str, interval: int | str = "15 minutes", lateness: int | str = "1 day",
                  on_late: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the summary below ``root``; ``on_late`` gets the late rows of each batch that has some."""
    root, step = root.rstrip("/"), seconds(interval)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_mark(spark, root, batch_id) or {"mark": None, "first": None}
        mark = before["mark"]
        rows = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_READING]).withColumn("_stamp", _stamp(interval))
        closed = F.lit(False) if mark is None else F.coalesce(F.col("_stamp") + step <= mark, F.lit(False))
        path = f"{root}/incoming/batch={batch_id}"
        rows.where("timestamp IS NOT NULL").withColumns({"slot": F.floor(F.col("_stamp") / DAY), "_late": closed}).write.mode("overwrite").parquet(path)
        rows = spark.read.parquet(path)  # once from the source; what follows reads the table
        seen = rows.agg(F.max(F.unix_seconds("timestamp") + step // 2).alias("last"), F.min("_stamp").alias("first"), F.count_if("_late").alias("late")).first()
        if seen["last"] is None:
            _put(spark, f"{root}/marks/{batch_id}.json", {**before, "late": 0})
            return
        rows.drop("_late").withColumn("batch", F.lit(batch_id)).write.partitionBy("slot", "batch").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").parquet(f"{root}/rows")
        now = max(seen["last"] - seconds(lateness), mark if mark is not None else seen["last"] - seconds(lateness))
        first = seen["first"] if before["first"] is None else min(before["first"], seen["first"])
        # stamps that the watermark passed just now, and those that late rows belong to
        low = first if mark is None else (mark - step) // step * step
        parts = []
        if now > (mark if mark is not None else first):
            passed = _rows_of(spark, root, low // DAY, now // DAY)
            if passed is not None:
                parts.append(passed.where((F.col("batch") <= batch_id) & (F.col("_stamp") + step <= now)
                                          & (F.lit(True) if mark is None else F.col("_stamp") + step > mark)))
        if seen["late"]:
            late = rows.where("_late").drop("_late")
            late.write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
            again = late.select(*SERIES, "_stamp").distinct()
            days = late.agg(F.min("slot").alias("low"), F.max("slot").alias("high")).first()
            known = _rows_of(spark, root, days["low"], days["high"])
            parts.append(known.where(F.col("batch") <= batch_id).join(again, [*SERIES, "_stamp"], "left_semi"))
        if parts:
            whole = parts[0].select(*ROW_COLUMNS)
            for part in parts[1:]:
                whole = whole.unionByName(part.select(*ROW_COLUMNS))
            interval_summary(whole, interval).write.mode("overwrite").parquet(f"{root}/summary/batch={batch_id}")
        if seen["late"] and on_late:
            on_late(spark.read.parquet(f"{root}/late/batch={batch_id}").select(*ROW_COLUMNS), batch_id)
        _put(spark, f"{root}/marks/{batch_id}.json", {"mark": now, "first": first, "late": seen["late"]})
        incoming, fs = _fs(spark, path)
        fs.delete(incoming, True)

    return process


def stream_summary(raw: DataFrame, root: str, checkpoint: str, interval: int | str = "15 minutes", lateness: int | str = "1 day",
                   on_late: Callable[[DataFrame, int], None] | None = None) -> DataStreamWriter:
    """Keep the interval summary of a stream of raw readings below ``root``. Call ``start`` on the result."""
    return raw.writeStream.foreachBatch(summary_batch(root, interval, lateness, on_late)).option("checkpointLocation", checkpoint)


def closed_summary(spark: SparkSession, root: str) -> DataFrame:
    """The summary of all closed stamps, late rows included as far as they have arrived."""
    root = root.rstrip("/")
    df = spark.read.parquet(f"{root}/summary").where(F.col("batch") <= max(finished(spark, root), default=-1))  # the next one may be half written
    newest = Window.partitionBy(*SERIES, "dt_round", "units").orderBy(F.desc("batch"))
    return df.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "batch")


def open_summary(spark: SparkSession, root: str, interval: int | str = "15 minutes") -> DataFrame | None:
    """The summary so far of the stamps that the watermark has not passed, from the rows kept; None without any."""
    root, step = root.rstrip("/"), seconds(interval)
    left = read_mark(spark, root)
    if left is None or left["mark"] is None:
        return None
    mark, last = left["mark"], max(finished(spark, root))
    rows = _rows_of(spark, root, (mark - step) // DAY, 2 ** 40)
    return interval_summary(rows.where((F.col("_stamp") + step > mark) & (F.col("batch") <= last)).select(*ROW_COLUMNS), interval) if rows else None


def late_readings(spark: SparkSession, root: str) -> DataFrame | None:
    """All readings that came behind the watermark, with the batch that brought them."""
    folder, fs = _fs(spark, f"{root.rstrip('/')}/late")
    return spark.read.parquet(f"{root.rstrip('/')}/late") if fs.exists(folder) else None


def forget(spark: SparkSession, root: str, before: int) -> list[str]:
    """Remove the kept rows of days that end before a moment (epoch seconds) and are closed; returns the removed folders."""
    root = root.rstrip("/")
    mark = (read_mark(spark, root) or {}).get("mark") or 0
    gone = [s for s in _slots(spark, root) if (s + 2) * DAY <= min(before, mark)]
    for s in gone:
        folder, fs = _fs(spark, f"{root}/rows/slot={s}")
        fs.delete(folder, True)
    return [f"slot={s}" for s in gone]
