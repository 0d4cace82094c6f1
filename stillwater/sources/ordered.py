"""Tables in a recorded order, so that their first rows are read without reading the rest."""
from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, path: str, order: list[Column], parts: int | None = None) -> None:
    """Write the rows range-partitioned and sorted, and the rows of each file in their order below ``_order``.

    Spark chooses the number of ranges by size, unless ``parts`` is given. Rows that are alike in ``order`` stay together in one file. No task sorts more than its range.
    """
    df.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order).write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    # part numbers follow the ranges; a part may be cut into several files, which are numbered as well
    files = written.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    files.coalesce(1).write.parquet(f"{path.rstrip('/')}/_order")


def _files(spark: SparkSession, path: str) -> DataFrame:
    part, piece = (F.regexp_extract("file", p, 1).cast("int") for p in (r"^part-(\d+)-", r"-c(\d+)\."))
    first = F.sum("rows").over(Window.orderBy("_part", "_piece").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")  # one row per file
    return spark.read.parquet(f"{path.rstrip('/')}/_order").withColumns({"_part": part, "_piece": piece}).withColumn("first", first)


def read_first(spark: SparkSession, path: str, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of an ordered table: only the files that hold them are read."""
    files = [unquote(r.path) for r in _files(spark, path).where(F.col("first") < n).collect()]
    rows = spark.read.parquet(*files) if files else spark.read.parquet(path).limit(0)
    return rows.orderBy(*order).limit(n)


def with_position(spark: SparkSession, path: str, order: list[Column], name: str = "position") -> DataFrame:
    """All rows with their place in the table's order, counted from 0 within each file and from its recorded first place."""
    files = _files(spark, path).select(F.col("path").alias("_path"), F.col("first").alias("_first"))
    rows = spark.read.parquet(path).withColumn("_path", F.col("_metadata.file_path"))
    own = F.row_number().over(Window.partitionBy("_path").orderBy(*order)) - 1
    return rows.withColumn("_own", own).join(files, "_path").withColumn(name, F.col("_first") + F.col("_own")).drop("_path", "_first", "_own")
