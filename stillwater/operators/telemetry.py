"""Shaping of the sensor service's pages, names and locations (landed as files)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import join_lookup

def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per reading of every parameter of every page."""
    passed = [c for c in pages.columns if c != "parameters"]
    return (
        pages.select(*passed, F.explode("parameters").alias("_p"))
        .select(*passed, F.col("_p.parameterId").alias("parameterId"), F.col("_p.unitId").alias("unitId"),
                F.col("_p.customParameter").alias("customParameter"), F.explode("_p.readings").alias("_r"))
        .select(*passed, "parameterId", "unitId", "customParameter",
                F.col("_r.timestamp").alias("timestamp"), F.col("_r.value").alias("value"))
    )


def name_tables(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parameterId, parameter) and (unitId, units) from rows of two id -> name maps."""
    return (
        names.select(F.explode("parameters").alias("parameterId", "parameter")),
        names.select(F.explode("units").alias("unitId", "units")),
    )


def reading_names(readings: DataFrame, names: DataFrame) -> DataFrame:
    """Replace ids by names; readings with an unknown id drop out. Epoch seconds become stamps."""
    parameters, units = name_tables(names)
    named = join_lookup(readings, parameters, ("parameterId",), F.col("timestamp"), "inner")
    return (
        join_lookup(named, units, ("unitId",), F.col("timestamp"), "inner")
        .withColumn("timestamp", F.timestamp_seconds("timestamp"))
        .drop("parameterId", "unitId")
    )


def clean_locations(locations: DataFrame) -> DataFrame:
    """Distinct locations without their coordinates."""
    return locations.drop("gps").dropDuplicates()


GRAM = 3


def _pieces(name: Column, sizes: Column) -> Column:
    """The different pieces of a name that have one of the sizes."""
    length = F.length(name)
    pieces = F.transform(sizes, lambda n: F.when(length >= n, F.transform(F.sequence(F.lit(1), length - n + 1), lambda at: F.substring(name, at, n))))
    return F.array_distinct(F.flatten(F.array_compact(pieces)))


def match_locations(sites: DataFrame, locations: DataFrame) -> DataFrame:
    """(site, location columns) wherever a location's name holds the site's name, in any case.

    An inverted index: each site stands under one piece of ``GRAM`` letters (shorter sites under all of theirs), the one
    that the fewest sites have. A location looks up its own pieces, some ``GRAM`` for each letter, and what it finds is
    compared in full. An empty site name is in no name.
    """
    named = clean_locations(locations).withColumn("name", F.lower("name"))
    known = sites.select(F.lower("site").alias("site")).where(F.length("site") > 0).distinct()
    own = known.withColumn("_key", F.explode(_pieces(F.col("site"), F.array(F.least(F.length("site"), F.lit(GRAM))))))
    common = own.groupBy("_key").agg(F.count(F.lit(1)).alias("_sites"))
    index = own.join(common, "_key").groupBy("site").agg(F.min(F.struct("_sites", "_key")).alias("_rarest")).select("site", F.col("_rarest._key").alias("_key"))
    return (
        named.withColumn("_key", F.explode(_pieces(F.col("name"), F.array(*[F.lit(n) for n in range(1, GRAM + 1)]))))
        .join(index, "_key").where(F.col("name").contains(F.col("site"))).drop("_key")
    )


def located_readings(readings: DataFrame, matched: DataFrame) -> DataFrame:
    """Raw readings (site, id, name, timestamp, parameter, value, units) of the matched locations."""
    return join_lookup(readings, matched.select("site", "id", "name"), ("id",), F.col("timestamp")).select(
        "site", "id", "name", "timestamp", "parameter", "value", "units")
