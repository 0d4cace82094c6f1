"""Token ids in ORC files.

One row per document in ascending order of ids: ``doc_id, part, part_start, n_tokens, ids``. ORC stores the ids as
run-length encoded integers, keeps a row index and a Bloom filter of ``doc_id`` for every few rows, and cuts files
into stripes that tasks read on their own; a filter on ``doc_id`` skips files, stripes and row groups by metadata.

Texts are sorted before they are encoded: a text takes less room in a shuffle than its ids. Each task numbers its
tokens from 0 (``part_start``); the place in the whole is that plus the length of the parts before, of which there is
one number per task.

Defined results: a missing text is empty and has the end id alone; a missing ``doc_id`` comes first; rows with the
same ``doc_id`` are documents of their own, ordered by their texts' hash; an empty table gives an empty store; other
columns are left out.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices
from .tokens import encoder

STORE = "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"


def write_token_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, stripe_bytes: int = 16 << 20,
                    index_rows: int = 1000) -> None:
    """Encode ``doc_id, text`` and write the store to ``path`` (a folder that all executors reach)."""
    def rows(batches):
        encode, part, at = encoder(vocabulary).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            for b in slices(batch, "text", 2000, 8 << 20):
                raw = encode(b.column("text").to_pylist(), end_id)
                n = np.array([len(r) // 4 for r in raw], np.int64)
                ends = np.cumsum(n)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                               pa.array(np.frombuffer(b"".join(raw), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(at + ends - n), pa.array(n), ids],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"])
                at += int(ends[-1])

    order = [F.col("doc_id"), F.xxhash64("text")]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    (texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(rows, STORE).write
     .option("compression", "zstd").option("orc.stripe.size", str(stripe_bytes))
     .option("orc.row.index.stride", str(index_rows)).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").orc(path))


def _parts_before(rows: DataFrame) -> DataFrame:
    """Tokens in the parts before each part; there is one part per written file."""
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    return parts.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))


def read_token_ids(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the store; ``doc_ids`` reads only those: the ORC reader leaves out what statistics and Bloom filters exclude."""
    rows = spark.read.schema(STORE).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def summary(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files; the checksum is of little-endian 32-bit ids."""
    def digest(batches):
        for b in batches:
            ids = b.column("ids")
            raw, at = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B"), ids.offsets.to_numpy()
            crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), b.column("part_start"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    rows = read_token_ids(spark, path)
    digests = rows.mapInArrow(digest, "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids_crc32 bigint")
    return digests.join(_parts_before(rows), "part").select(
        "doc_id", (F.col("_before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")
