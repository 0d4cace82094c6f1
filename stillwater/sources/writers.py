"""Sinks. Snapshots are new directories; nothing is changed in place."""
from __future__ import annotations

import uuid
import warnings
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timegrid import join_stamp


def stamp_text(now: datetime) -> str:
    return now.strftime("%Y%m%d-T%H%M%SZ")


def write_raw(readings: DataFrame, path: str, pulled_at: datetime) -> None:
    """Append one pull, a directory per site; rerunning the same pull replaces it."""
    (
        readings.withColumn("pull_ts", F.lit(stamp_text(pulled_at)))
        .write.partitionBy("site", "pull_ts").mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").parquet(path)
    )


def write_snapshot(df: DataFrame, path: str, name: str, now: datetime, tag: str = "") -> str:
    """Write ``<path>/<name><stamp><tag>.parquet``, by site and year so that readers can prune.

    Files are cut by month, so the rows of one long site spread over many tasks.
    """
    target = f"{path.rstrip('/')}/{name}{stamp_text(now)}{tag}.parquet"
    month = F.date_trunc("month", "dt_round")
    (
        df.withColumn("year", F.year("dt_round")).repartition("site", "year", month)
        .write.partitionBy("site", "year").mode("overwrite").parquet(target)
    )
    return target


def write_series_csv(df: DataFrame, path: str) -> None:
    """CSV export, a directory per series."""
    month = F.date_trunc("month", "dt_round")
    (
        df.withColumn("dt_round", join_stamp(F.col("dt_round"))).repartition("site", "parameter", month.cast("string"))
        .write.partitionBy("site", "parameter").mode("overwrite").option("header", True).csv(path)
    )


def new_to_archive(source: DataFrame, archive: DataFrame | None) -> DataFrame:
    """Rows of files that the archive does not hold yet: by ``file_id`` where both have it, else by ``source_file``."""
    if archive is None:
        return source
    key = "file_id" if "file_id" in source.columns and "file_id" in archive.columns else "source_file"
    return source.join(archive.select(key).distinct(), key, "left_anti")


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_name"))


# fixed when a file was found; ``file_id`` stands for path, length and content
FILES = ("source_file", "path", "length", "changed_at", "source_rows", "file_id")
MANIFEST = "file_id string, source_file string, path string, length bigint, archived_rows bigint"


def _content(columns: list[str]) -> list:
    """Count and two sums over the rows' hashes, the same for any order and cut of the rows."""
    row = F.xxhash64(*sorted(columns))
    return [F.count(F.lit(1)).alias("_rows"), F.sum(row.cast("decimal(38,0)")).alias("_sum"), F.bit_xor(row).alias("_xor")]


def _file_list(found: DataFrame) -> DataFrame:
    """A row per source file with the identity of its content."""
    meta = F.col("_metadata")
    place = {"source_file": meta["file_name"], "path": meta["file_path"], "length": meta["file_size"], "changed_at": meta["file_modification_time"]}
    files = found.select("*", *[v.alias(f"_f_{k}") for k, v in place.items()]).groupBy(*[F.col(f"_f_{k}").alias(k) for k in place]).agg(*_content(found.columns))
    identity = F.sha2(F.concat_ws("|", "path", "length", "_rows", "_sum", "_xor"), 256)
    return files.withColumns({"source_rows": F.col("_rows"), "file_id": F.concat(F.lit("f-"), F.substring(identity, 1, 32))})


def archive_append(spark: SparkSession, source_path: str, archive_path: str, clear: bool = False) -> DataFrame:
    """Copy files not archived yet, check that all arrived, and report rows per file.

    A file is known by path, length and content, so another file of the same name is another file, and one that was written
    anew at its old path is archived beside the earlier one. Each is written to a partition of its own, read back and
    compared, and only then entered in the manifest (``_files`` below the archive). A run that dies leaves files without
    entry; the next run writes the same partitions again. ``clear`` removes source files once every one found is in the
    manifest, and of these only those that still have the length and time they were found with; files that land in the
    meantime are neither copied nor removed. The report is a table of its own and can be read after the files are gone.
    """
    found, root = spark.read.parquet(source_path), archive_path.rstrip("/")
    run = uuid.uuid4().hex
    list_path = f"{root}/_lists/{run}"
    _file_list(found).write.parquet(list_path)
    files = spark.read.parquet(list_path)
    source = found.withColumn("path", F.col("_metadata.file_path")).join(files.select("path", "source_file", "file_id"), "path").drop("path")
    new_to_archive(source, _manifest(spark, root)).write.partitionBy("source_file", "file_id").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").parquet(root)

    known = _manifest(spark, root)
    fresh = files if known is None else files.join(known.select("file_id").distinct(), "file_id", "left_anti")
    if not fresh.isEmpty():
        back = spark.read.schema(T.StructType([*found.schema, T.StructField("source_file", T.StringType()), T.StructField("file_id", T.StringType())])).parquet(root)
        arrived = back.join(fresh.select("file_id"), "file_id", "left_semi").groupBy("file_id").agg(*_content(found.columns)).withColumnRenamed("_rows", "archived_rows")
        same = fresh.join(arrived.select("file_id", "archived_rows", F.col("_sum").alias("_s"), F.col("_xor").alias("_x")), "file_id")
        same.where("_rows = archived_rows AND _sum <=> _s AND _xor <=> _x").select(
            "file_id", "source_file", "path", "length", "archived_rows").write.mode("append").parquet(f"{root}/_files")

    known = _manifest(spark, root)
    report_path = f"{root}/_reports/{run}"
    (files if known is None else files.join(known.select("file_id", "archived_rows").dropDuplicates(["file_id"]), "file_id", "left")).withColumn(
        "complete", F.col("archived_rows").isNotNull() if known is not None else F.lit(False)).select(
        *FILES, *(["archived_rows"] if known is not None else []), "complete").write.parquet(report_path)
    report = spark.read.parquet(report_path)
    if report.where(~F.col("complete")).isEmpty():
        if clear:
            _remove_files(spark, report)
    else:
        warnings.warn(f"not all files of {source_path} arrived in {archive_path}", stacklevel=2)
    return report


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    return spark.read.schema(MANIFEST).parquet(f"{root}/_files") if _exists(spark, f"{root}/_files") else None


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _fs(spark, path)
    return fs.exists(hadoop_path)


def _remove_files(spark: SparkSession, report: DataFrame) -> None:
    """Files of the report that are as they were when they were found; the list comes part by part."""
    for r in report.select("path", "length", F.unix_millis("changed_at").alias("changed")).toLocalIterator():
        hadoop_path, fs = _fs(spark, unquote(r.path))
        if fs.exists(hadoop_path):
            status = fs.getFileStatus(hadoop_path)
            if status.getLen() == r.length and status.getModificationTime() == r.changed:
                fs.delete(hadoop_path, False)
