"""Joins in which one key may hold most of the rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 16
TRACKED = 16  # keys that the sketch follows for each one that it may report


def join_per_group(rows: DataFrame, table: DataFrame, keys: tuple[str, ...], spread_by: Column,
                   how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``table`` (one row per group), the rows of a group spread over ``SALTS`` parts.

    While the table is small Spark broadcasts it. Beyond that the join shuffles by group and salt; what
    follows it has to shuffle anyway, so adaptive execution stays free to split large parts further.
    """
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(salted, [*keys, "_salt"], how).drop("_salt")


def is_small(table: DataFrame) -> bool:
    """Whether Spark knows the table to be below its broadcast threshold."""
    plan = getattr(table, "_jdf", None)
    if plan is None:  # a remote session does not tell
        return False
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return plan.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def heavy_keys(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(_key, _parts): hashes of the keys with more rows than an average shuffle partition, and how many such
    partitions each of them fills.

    A sketch of frequent items, merged over all rows, counts them; there are at most as many as shuffle partitions.
    Its counts may be too high by a small share, which only adds parts.
    """
    share = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = rows.select(F.xxhash64(*keys).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {share}, {max(1024, TRACKED * share)})").alias("_top"), F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_item.count") * share / F.col("_rows")).cast("int")
    return sketch.select(F.explode("_top").alias("_item"), "_rows").select(
        F.col("_item.item").alias("_key"), parts.alias("_parts")).where("_parts > 1")


def join_lookup(rows: DataFrame, table: DataFrame, keys: tuple[str, ...], spread_by: Column, how: str = "left") -> DataFrame:
    """Join ``rows`` with a lookup table whose key may be the same for most rows.

    A table below the broadcast threshold is joined plainly. Otherwise the heavy keys are found first, which reads the key
    columns of ``rows`` once more, and their rows are cut by a hash of ``spread_by`` into parts of an average
    partition's size; only their records in the table are copied. What is broadcast is the list of heavy keys, at most one
    row per shuffle partition. Streams, and keys whose two sides differ in type or are fractions, are joined plainly.
    """
    alike = all(rows.schema[k].dataType == table.schema[k].dataType
                and not isinstance(rows.schema[k].dataType, T.FractionalType) for k in keys)
    if rows.isStreaming or not alike or is_small(table):
        return rows.join(table, list(keys), how)
    heavy = F.broadcast(heavy_keys(rows, keys))

    def with_parts(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", F.xxhash64(*keys)).join(heavy, "_key", "left").drop("_key")

    parts = F.coalesce(F.col("_parts"), F.lit(1))
    cut = with_parts(rows).withColumn("_salt", F.pmod(F.xxhash64(spread_by), parts).cast("int")).drop("_parts")
    copies = with_parts(table).withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return cut.join(copies, [*keys, "_salt"], how).drop("_salt")
