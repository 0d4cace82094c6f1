"""The curated archive as a log of commits over files that are never changed.

``data/commit=<id>/site=../year=../month=..``   rows of the commits, a folder per site and month
``index/<id>``                                  a row per series and month: folder, rows, oldest and newest stamp
``touched/<id>``                                the series a commit brought new rows of
``tables/<id>/<name>``                          small tables that became valid with a commit (tracker, recent extract)
``log/<number>.json``                           which id is commit ``number``, its columns, and the batches it holds

A writer puts its folders below an id of its own and then renames one small file to ``log/<number>.json``, which fails if
that number is taken. Until then nobody reads its folders, afterwards they belong to the archive as a whole; a writer that
dies leaves folders without a log entry, and ``clear_unused`` removes them. Readers hold on to the folders of the
commit they began with. The index is the manifest and the zone map at once: a folder that a batch does not touch is
carried over by its index rows and is neither read nor written, and the newest stamp of a series is found without
reading the series.

An empty site name is read back as missing, as in every table partitioned by a column.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timegrid import seconds
from ..operators.merge import merge_archive
from ..plans.joins import join_per_group
from ..schema import SERIES

PLACE = ("site", "year", "month")
INDEX = T.StructType([
    T.StructField("site", T.StringType()), T.StructField("parameter", T.StringType()), T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()), T.StructField("folder", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("oldest", T.TimestampType()), T.StructField("newest", T.TimestampType()),
])


class Conflict(RuntimeError):
    """Another writer has committed new rows of the same series since this one read the archive."""


@dataclass(frozen=True)
class Commit:
    number: int
    id: str
    schema: str
    written_at: str
    batches: dict[str, int] = field(default_factory=dict)
    tables: tuple[str, ...] = ()

    def holds(self, source: str, batch: int | None) -> bool:
        return batch is not None and self.batches.get(source, -1) >= batch


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _publish(spark: SparkSession, root: str, commit: Commit) -> bool:
    """Claim the commit's number; False if another writer has it. The log entry appears with all its text or not at all."""
    jvm = spark._jvm
    draft, fs = _path(spark, f"{root}/log/_{commit.id}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(asdict(commit)).encode()))
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{root}/log/{commit.number:012d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, final, no_overwrite)
    except Exception as e:
        if "FileAlreadyExistsException" not in str(e):
            raise
        fs.delete(draft, False)
        return False
    return True


def commit_numbers(spark: SparkSession, root: str) -> list[int]:
    p, fs = _path(spark, f"{root}/log")
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_commit(spark: SparkSession, root: str, number: int | None = None) -> Commit | None:
    """The commit of that number, or the newest; None in an archive without commits."""
    numbers = commit_numbers(spark, root)
    if not numbers:
        return None
    d = json.loads(_read_text(spark, f"{root}/log/{numbers[-1] if number is None else number:012d}.json"))
    return Commit(**{**d, "tables": tuple(d["tables"])})


def series_index(spark: SparkSession, root: str, commit: Commit | None) -> DataFrame:
    """One row per series and month; of an archive without commits, none."""
    if commit is None:
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).parquet(f"{root}/index/{commit.id}")


def commit_table(spark: SparkSession, root: str, name: str, commit: Commit | None = None) -> DataFrame | None:
    """A small table that became valid with a commit (the newest), None if it has none of that name."""
    commit = commit or read_commit(spark, root)
    return spark.read.parquet(f"{root}/tables/{commit.id}/{name}") if commit and name in commit.tables else None


def _read_folders(spark: SparkSession, root: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    parts = T.StructType([*schema, *(T.StructField(c, T.IntegerType()) for c in PLACE[1:]), T.StructField("commit", T.StringType())])
    df = spark.read.schema(parts).option("basePath", f"{root}/data").parquet(*[f"{root}/data/{f}" for f in sorted(folders)])
    return df.select(*schema.names)


def _folders(index: DataFrame) -> list[str]:
    """Folders of index rows: one name per site and month that is asked for."""
    return [r.folder for r in index.select("folder").distinct().collect()]


def read_archive(spark: SparkSession, root: str, where: Column | None = None, commit: Commit | None = None) -> DataFrame:
    """The archive's rows. ``where`` is a condition on the index (``site, parameter, year, month, oldest, newest``): folders
    without such a row are not even listed, those with one are read whole."""
    commit = commit or read_commit(spark, root)
    if commit is None:
        raise FileNotFoundError(f"no commit below {root}")
    index = series_index(spark, root, commit)
    return _read_folders(spark, root, T.StructType.fromJson(json.loads(commit.schema)), _folders(index if where is None else index.where(where)))


def _cuts(index: DataFrame, touched: DataFrame, period: int) -> DataFrame:
    """Where the trailing period of each touched series begins (``_cut``), from its index rows."""
    newest = index.groupBy(*SERIES).agg((F.max(F.unix_seconds("newest")) - period).alias("_cut")).where("_cut IS NOT NULL")
    return newest.join(touched.select(*SERIES).distinct(), list(SERIES), "left_semi")


def trailing_rows(spark: SparkSession, root: str, touched: DataFrame, period: int | str, commit: Commit | None = None) -> DataFrame | None:
    """The last ``period`` of the series named in ``touched``, found by the index: only their months' folders are read."""
    commit = commit or read_commit(spark, root)
    if commit is None:
        return None
    index = series_index(spark, root, commit)
    cuts = _cuts(index, touched, seconds(period))
    folders = _folders(index.join(cuts, list(SERIES)).where(F.unix_seconds("newest") >= F.col("_cut")))
    rows = _read_folders(spark, root, T.StructType.fromJson(json.loads(commit.schema)), folders)
    return join_per_group(rows, cuts, SERIES, F.col("dt_round")).where(F.unix_seconds("dt_round") >= F.col("_cut")).drop("_cut")


def _write_rows(df: DataFrame, root: str, uid: str) -> DataFrame:
    """Write the rows below the id and give their index; every row written must be found again."""
    spark, seen = df.sparkSession, Observation(f"rows-{uid}")
    placed = df.withColumns({"year": F.year("dt_round"), "month": F.month("dt_round")}).observe(seen, F.count(F.lit(1)).alias("n"))
    folder = f"{root}/data/commit={uid}"
    placed.repartition(*PLACE).write.partitionBy(*PLACE).parquet(folder)
    schema = T.StructType([*df.schema, *(T.StructField(c, T.IntegerType()) for c in PLACE[1:])])
    rows = spark.read.schema(schema).parquet(folder)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/data/(commit=.*)/[^/]*$", 1)
    index = rows.select(*SERIES, *PLACE[1:], "dt_round", name.alias("folder")).groupBy(*SERIES, *PLACE[1:], "folder").agg(
        F.count(F.lit(1)).alias("rows"), F.min("dt_round").alias("oldest"), F.max("dt_round").alias("newest"))
    path = f"{root}/index/{uid}-new"
    index.select(*INDEX.names).write.parquet(path)
    index = spark.read.schema(INDEX).parquet(path)
    found = index.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if found != seen.get["n"]:
        raise RuntimeError(f"{seen.get['n']} rows written below {folder}, {found} found")
    return index


def _decoded(folder: str) -> str:
    return unquote(folder)  # Spark gives file names with the escapes of an address


def _same_place(a: str, b: str) -> Column:
    same = F.lit(True)
    for c in PLACE:
        same = same & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return same


def _changed_since(spark: SparkSession, root: str, base: Commit | None, now: Commit | None, touched: DataFrame) -> bool:
    for number in range((base.number if base else 0) + 1, (now.number if now else 0) + 1):
        other = spark.read.parquet(f"{root}/touched/{read_commit(spark, root, number).id}")
        if not touched.join(other, list(SERIES), "left_semi").isEmpty():
            return True
    return False


def write_back(spark: SparkSession, root: str, flagged: DataFrame, period: int | str, *, base: Commit | None = None, source: str = "direct",
               batch: int | None = None, tables: Callable[[Callable[[Column], DataFrame], DataFrame], dict[str, DataFrame]] | None = None) -> Commit:
    """Commit flagged rows: what ``merge_archive`` gives for the whole archive, written for the touched site-months only.

    ``base`` is the commit whose rows were flagged again together with the new ones (None: an empty archive). If other
    writers have committed since, the rows are merged with what they left; if they brought rows of the same series,
    ``Conflict`` is raised, since the overlap has to be flagged anew. A batch that the archive holds already is not written
    again. ``tables`` gets a reader of the archive to be and its index and returns small tables to commit with the rows.
    """
    root = root.rstrip("/")
    draft = f"{root}/drafts/{uuid.uuid4().hex}"
    flagged.write.parquet(draft)  # once; all steps below read it
    flagged = spark.read.schema(flagged.schema).parquet(draft)
    touched = flagged.select(*SERIES).distinct()
    while True:
        latest = read_commit(spark, root)
        if latest and latest.holds(source, batch):
            return latest
        if _changed_since(spark, root, base, latest, touched):
            raise Conflict(f"series of this batch were changed after commit {base.number if base else 0} of {root}")
        uid = uuid.uuid4().hex
        commit = _write_commit(spark, root, uid, latest, flagged, touched, seconds(period), source, batch, tables)
        if _publish(spark, root, commit):
            return commit


def _write_commit(spark, root, uid, latest, flagged, touched, period, source, batch, tables) -> Commit:
    index = series_index(spark, root, latest)
    if latest is None:
        merged, kept = flagged.withColumn("historical", F.lit(True)), index
    else:
        cuts = _cuts(index, touched, period)
        behind = index.join(cuts, list(SERIES)).where(F.unix_seconds("newest") >= F.col("_cut")).select(*PLACE)
        places = flagged.select("site", F.year("dt_round").alias("year"), F.month("dt_round").alias("month")).unionByName(behind).distinct()
        path = f"{root}/index/{uid}-places"
        places.write.parquet(path)
        places = spark.read.parquet(path)
        old = index.alias("i").join(places.alias("p"), _same_place("i", "p"), "left_semi")
        kept = index.alias("i").join(places.alias("p"), _same_place("i", "p"), "left_anti")
        history = _read_folders(spark, root, T.StructType.fromJson(json.loads(latest.schema)), _folders(old))
        merged = merge_archive(flagged, history, period, cuts=cuts)
    merged = merged.select(*[c for c in merged.columns if c not in PLACE[1:]])
    fresh = _write_rows(merged, root, uid)
    decode = {r.folder: _decoded(r.folder) for r in fresh.select("folder").distinct().where("folder LIKE '%\\%%'").collect()}
    if decode:
        names = spark.createDataFrame(list(decode.items()), "folder string, _name string")
        fresh = fresh.join(names, "folder", "left").withColumn("folder", F.coalesce("_name", "folder")).select(*INDEX.names)
    whole = kept.unionByName(fresh)
    whole.write.parquet(f"{root}/index/{uid}")
    touched.write.parquet(f"{root}/touched/{uid}")
    made = {}
    if tables:
        live = spark.read.schema(INDEX).parquet(f"{root}/index/{uid}")
        made = tables(lambda where: _read_folders(spark, root, merged.schema, _folders(live.where(where))), live)
        for name, table in made.items():
            table.write.parquet(f"{root}/tables/{uid}/{name}")
    batches = dict(latest.batches) if latest else {}
    if batch is not None:
        batches[source] = batch
    return Commit((latest.number if latest else 0) + 1, uid, json.dumps(merged.schema.jsonValue()), datetime.now(timezone.utc).isoformat(timespec="seconds"),
                  batches, tuple(sorted(made)))


def clear_unused(spark: SparkSession, root: str, keep: int = 3, older_than_seconds: int = 86_400) -> list[str]:
    """Remove what no commit of the last ``keep`` reads: their log entries' predecessors stay as text, folders go.

    Folders younger than ``older_than_seconds`` stay, they may belong to a writer that has not committed yet. Returns the
    removed folders; running it again, also after it was stopped half way, removes the rest.
    """
    root = root.rstrip("/")
    numbers = commit_numbers(spark, root)
    ids, live = set(), set()
    for number in numbers[-keep:]:
        commit = read_commit(spark, root, number)
        ids.add(commit.id)
        live |= set(_folders(series_index(spark, root, commit)))
    base, fs = _path(spark, root)
    limit = spark._jvm.java.lang.System.currentTimeMillis() - older_than_seconds * 1000
    gone = []

    def old(pattern: str):
        for s in fs.globStatus(_path(spark, f"{root}/{pattern}")[0]) or []:
            if s.getModificationTime() <= limit:
                yield s.getPath()

    home = fs.makeQualified(base).toUri().getPath().rstrip("/")
    for path in old("data/commit=*/site=*/year=*/month=*"):
        name = path.toUri().getPath()[len(home) + len("/data/"):]
        if name not in live:
            gone.append(path)
    for pattern in ("index/*", "tables/*", "drafts/*"):
        gone += [p for p in old(pattern) if p.getName() not in ids]
    for path in gone:
        fs.delete(path, True)
    return [p.toString() for p in gone]
