"""Scans. Schemas are given, never inferred, wherever they are fixed."""
from __future__ import annotations

import json
import re
from datetime import datetime
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import standard_site
from ..schema import FRIENDLY_NAMES, NETWORKS, RAW_READING, SENSOR_SPEC, SITE_LOCATION, SOURCE_PAGE, THRESHOLDS

SNAPSHOT_STAMP = r"(\d{8}-T\d{6}Z)"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Every parquet file of raw readings below ``path``, columns matched by name."""
    return spark.read.schema(RAW_READING).option("recursiveFileLookup", "false").parquet(path)


def read_field_notes(spark: SparkSession, path: str) -> DataFrame:
    """The survey's wide CSV export as text; ``clean_notes`` gives the types."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    for name in ("sonde_moved", "sensors_cleaned", "wiper_working", "cal_report_collected"):
        if name in df.columns:
            df = df.withColumn(name, F.col(name).try_cast("boolean"))
    for name in df.columns:
        if "pre_clea" in name or "post_clea" in name:
            df = df.withColumn(name, F.col(name).try_cast("double"))
    return df


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """Columns are taken by name, so their order in the file is free."""
    df = spark.read.csv(path, header=True, nullValue="NA")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in THRESHOLDS]).withColumn(
        "site", standard_site(F.col("site")))


def _yaml(path: str):
    try:
        import yaml
    except ImportError as e:
        raise ImportError("reading YAML needs PyYAML; use the CSV form instead") from e
    with open(path) as f:
        return yaml.safe_load(f)


def read_sensor_spec(spark: SparkSession, path: str) -> DataFrame:
    """YAML ``parameter: {min, max}``. Plain numbers only; nothing is evaluated."""
    rows = [{"parameter": name, "spec_min": float(limits["min"]), "spec_max": float(limits["max"])}
            for name, limits in _yaml(path).items()]
    return literal_table(spark, rows, SENSOR_SPEC)


def literal_table(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Configuration rows as part of the plan, so that Spark knows how small they are."""
    parsed = F.from_json(F.lit(json.dumps(rows)), T.ArrayType(schema))
    return spark.range(1).select(F.inline(parsed))


def load_networks(spark: SparkSession, path: str) -> DataFrame:
    """(network_name, network array, network_order) from the YAML or CSV site order file.

    A configuration file: it names the sites once, so it is small whatever the data volume.
    """
    suffix = PurePath(path).suffix.lower()
    if suffix not in (".yaml", ".yml", ".csv"):
        raise ValueError("site order file must be .yaml, .yml or .csv")
    if suffix == ".csv":
        _must_exist(spark, path)
        table = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True)
        if not {"network_name", "network"} <= set(table.columns):
            raise ValueError("site order CSV needs the columns network_name and network")
        table = table.select("network_name", "network", F.monotonically_increasing_id().alias("network_order"))
    else:
        try:
            names = _yaml(path)
        except FileNotFoundError as e:
            raise FileNotFoundError(f"site order file not found: {path}") from e
        names = names.get("network") if isinstance(names, dict) else None
        if not isinstance(names, dict) or not names:
            raise ValueError("site order YAML needs a mapping under 'network'")
        rows = [{"network_name": n, "network": str(s), "network_order": i} for i, (n, s) in enumerate(names.items())]
        table = literal_table(spark, rows, NETWORKS)
    return normal_networks(table)


def normal_networks(table: DataFrame) -> DataFrame:
    """Split the comma list; write sites as the readings do (lower case, standard name, no underscore)."""
    def normal(c):
        return F.replace(standard_site(F.trim(c)), F.lit("_"), F.lit(""))

    network = F.col("network") if isinstance(table.schema["network"].dataType, T.ArrayType) else F.split("network", ",")
    return table.withColumns({"network_name": normal(F.col("network_name")), "network": F.transform(network, normal)})


def _must_exist(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        raise FileNotFoundError(f"site order file not found: {path}")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SOURCE_PAGE).json(path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FRIENDLY_NAMES).json(path, multiLine=True)


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SITE_LOCATION).json(path)


def snapshot_stamp(file_name):
    """The pull or run stamp in a file name, NULL where there is none."""
    stamp = F.regexp_extract(file_name, SNAPSHOT_STAMP, 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd-'T'HHmmss'Z'"))


def stamped_snapshots(spark: SparkSession, path: str, prefix: str = "") -> list[tuple[str, str]]:
    """Stamp and path of the finished snapshots below ``path``, oldest first; one still being written does not count."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{prefix}*")
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())

    def finished(folder) -> bool:
        inside = [spark._jvm.org.apache.hadoop.fs.Path(folder, name) for name in ("_SUCCESS", "_temporary")]
        return fs.exists(inside[0]) or not fs.exists(inside[1])

    stamped = []
    for status in fs.globStatus(hadoop_path) or []:
        stamp = re.search(SNAPSHOT_STAMP, status.getPath().getName())
        if stamp and finished(status.getPath()):
            stamped.append((stamp[1], status.getPath().toString()))
    return sorted(stamped)


def read_latest(spark: SparkSession, path: str, prefix: str = "", before: datetime | None = None) -> DataFrame:
    """The newest finished snapshot below ``path`` (older than ``before``), by the stamp in its name."""
    limit = before.strftime("%Y%m%d-T%H%M%SZ") if before else None
    stamped = [s for s in stamped_snapshots(spark, path, prefix) if limit is None or s[0] < limit]
    if not stamped:
        raise FileNotFoundError(f"no stamped snapshot below {path}")
    return spark.read.parquet(stamped[-1][1])
