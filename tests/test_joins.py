import pytest
import stillwater as sw
from pyspark.sql import functions as F
from stillwater.operators.series_rules import with_spec, with_thresholds
from stillwater.plans.joins import heavy_keys, is_small, join_lookup

ROWS = 60_000


@pytest.fixture
def unbroadcast(spark):
    """Every table counts as beyond the broadcast threshold, also at run time."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield spark
    for n, v in before.items():
        spark.conf.set(n, v)


def hot_rows(spark):
    """Nine tenths of the rows are of key 7, the others have keys of their own; some rows have none."""
    i = F.col("id")
    key = F.when(i % 10 > 0, 7).when(i % 1000 == 0, F.lit(None)).otherwise(i + 100)
    return spark.range(ROWS).select(key.cast("int").alias("k"), i.alias("n"))


def lookup(spark):
    return spark.range(ROWS + 100).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("twice"))


def test_heavy_keys_are_few_and_found(spark):
    got = {r["_key"]: r["_parts"] for r in heavy_keys(hot_rows(spark), ("k",)).collect()}
    hot = spark.sql("SELECT xxhash64(CAST(7 AS INT)) AS h").first()["h"]
    share = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert set(got) == {hot} and got[hot] in (share - 1, share)
    even = spark.range(ROWS).select((F.col("id") % 5000).alias("k"))
    assert heavy_keys(even, ("k",)).count() == 0
    assert heavy_keys(even.where("false"), ("k",)).count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_is_cut_and_nothing_is_lost(unbroadcast, how):
    spark = unbroadcast
    rows, table = hot_rows(spark), lookup(spark)
    assert not is_small(table)
    out = join_lookup(rows, table, ("k",), F.col("n"), how)
    plain = rows.join(table, "k", how)
    assert out.columns == plain.columns
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()

    def largest(df):
        return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert largest(rows.join(table, "k", how)) > 0.9 * ROWS
        assert largest(join_lookup(rows, table, ("k",), F.col("n"), how)) < 0.4 * ROWS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_missing_key_keeps_its_rows(unbroadcast):
    rows = hot_rows(unbroadcast).withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    out = join_lookup(rows, lookup(unbroadcast), ("k",), F.col("n"))
    assert out.count() == ROWS and out.where("k IS NULL AND twice IS NOT NULL").isEmpty()
    assert out.where("twice = 2 * k").count() == rows.where("k IS NOT NULL").count()


def test_several_records_per_key_and_other_types(unbroadcast):
    table = unbroadcast.createDataFrame([(7, "a"), (7, "b"), (8, "c")], "k int, v string")
    rows = hot_rows(unbroadcast)
    out = join_lookup(rows, table, ("k",), F.col("n"), "inner")
    assert {r["v"]: r["count"] for r in out.groupBy("v").count().collect()} == {"a": ROWS * 9 // 10, "b": ROWS * 9 // 10}
    wide = join_lookup(rows, table.withColumn("k", F.col("k").cast("bigint")), ("k",), F.col("n"), "inner")
    assert wide.count() == 2 * ROWS * 9 // 10


def test_lookups_of_the_rules(unbroadcast):
    """Specification, thresholds and names give the plain join's rows when one parameter holds nearly all of them."""
    spark = unbroadcast
    rows = hot_rows(spark).select(
        F.lit("a").alias("site"), F.when(F.col("k") == 7, "DO").otherwise("pH").alias("parameter"), F.lit("winter").alias("season"),
        F.timestamp_seconds("n").alias("dt_round"), F.col("n").cast("double").alias("mean"))
    spec = spark.createDataFrame([("DO", 0.0, 60.0)], "parameter string, spec_min double, spec_max double")
    assert with_spec(rows, spec).groupBy("parameter", "spec_max").count().orderBy("parameter").collect() == [
        ("DO", 60.0, ROWS * 9 // 10), ("pH", None, ROWS // 10)]
    table = spark.createDataFrame([("a", "DO", "winter", 1.0, 2.0, None, None)], (
        "site string, parameter string, season string, t_mean01 double, t_mean99 double, t_slope_behind_01 double, t_slope_behind_99 double"))
    assert with_thresholds(rows, table).where("t_mean99 = 2").count() == ROWS * 9 // 10
    names = spark.sql("SELECT map('1', 'DO') AS parameters, map('u', 'mg/L') AS units")
    readings = rows.select(F.when(F.col("parameter") == "DO", "1").otherwise("2").alias("parameterId"), F.lit("u").alias("unitId"),
                           F.unix_seconds("dt_round").alias("timestamp"), "mean")
    named = sw.reading_names(readings, names)
    assert named.where("parameter = 'DO' AND units = 'mg/L'").count() == named.count() == ROWS * 9 // 10
