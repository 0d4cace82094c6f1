"""What the operators share: tables, the shared folder, words and text keys."""
from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# bytes.split() without arguments cuts at exactly these: blank, tab, line feed, vertical tab, form feed, return
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as a table in the shared folder and read from there: cuts the lineage."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; blanks are the six ASCII ones."""
    return text.encode().lower().split() if text else []


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; a missing text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def fold(key: Column, parts: int) -> Column:
    """remainder of the CRC-32 of a number written in decimal"""
    return F.crc32(key.cast("string").cast("binary")) % parts


def slices(batch: pa.RecordBatch, column: str, most_rows: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of bounded rows and bytes of ``column``; a row larger than that is a piece of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = min(max(int(np.searchsorted(ends, before + most_bytes, side="right")), at + 1), at + most_rows, batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop


_kept: dict[object, object] = {}


def worker_cache(key: object, make: Callable[[], object]):
    """What an operator keeps in this Python worker from task to task; another operator's goes, so that memory stays bounded."""
    if key not in _kept:
        if _kept:
            _kept.clear()
            release_memory()
        _kept[key] = make()
    return _kept[key]


def release_memory() -> None:
    """Give freed memory back to the system: what this Python worker and its Arrow pool hold on to counts against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def new_name(df: DataFrame, name: str) -> str:
    """The name, with more underscores if the table has such a column."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name
