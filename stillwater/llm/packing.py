"""Best-fit packing of documents into sequences of bounded length.

Documents are encoded; one that is longer than a sequence is cut into full pieces behind a first one that may be
shorter. Pieces are rows of a few numbers from then on. They are dealt over tasks by hash, ``per_task`` to a task, and
each task packs its own: bounded-space best fit, longest pieces first. A fixed number of bins is open; a bitset marks
which amounts of free space some open bin has, so that the fullest bin a piece fits into is its lowest set bit from
the piece's length on. A piece that fits nowhere opens a bin; if all are in use, the fullest closes first.

Defined results: a missing text is empty and makes a piece of its end id; rows with the same ``doc_id`` are documents
of their own; an empty table gives no rows; other columns are left out.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored
from .tokens import encoder

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = "sequence_id bigint, offset bigint"


class OpenBins:
    """Open bins by free space, at most ``most`` of them."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.open, self.made, self.bits = capacity, most, 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece of 1 to ``capacity`` tokens."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # closed
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """A row per piece: its document, number, start in the document, length and checksum; ``ids`` on demand."""
    def cut(batches):
        encode = encoder(vocabulary).encode
        for batch in batches:
            for b in slices(batch, "text", 2000, 8 << 20):
                rows = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
                for doc, raw in zip(b.column("doc_id").to_pylist(), encode(b.column("text").to_pylist(), end_id)):
                    n = len(raw) // 4
                    edges = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    for i, (x, y) in enumerate(zip(edges, edges[1:])):
                        part = raw[4 * x:4 * y]
                        for name, v in zip(rows, (doc, i, x, y - x, zlib.crc32(part), part)):
                            rows[name].append(v)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(rows[k], t) for k, t in list(zip(rows, types))[:6 if keep_ids else 5]],
                                                 list(rows)[:6 if keep_ids else 5])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return texts.mapInArrow(cut, PIECE + (", ids binary" if keep_ids else ""))


def best_fit(rows: DataFrame, capacity: int = 1024, open_bins: int = 16_384, per_task: int = 65_536) -> DataFrame:
    """Places rows of ``doc_id, piece, length`` (1 to ``capacity``): adds ``sequence_id`` and a gapless ``offset``."""
    def pack(batches):
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for b in batches:
            placed = [bins.place(n) for n in b.column("length").to_pylist()]
            at = np.array(placed, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at[:, 0] + base), pa.array(at[:, 1])],
                                             [*b.schema.names, "sequence_id", "offset"])

    tasks = max(1, -(-rows.count() // per_task))
    dealt = rows.repartition(tasks, F.xxhash64("doc_id", "piece")).sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return dealt.mapInArrow(pack, f"{schema}, {PLACED}")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False,
                   open_bins: int = 16_384, per_task: int = 65_536) -> DataFrame:
    """``doc_id, text`` to pieces with their places; the pieces are stored once, so that texts are encoded once."""
    return best_fit(stored(pieces(docs, vocabulary, capacity, end_id, keep_ids), "pieces"), capacity, open_bins, per_task)
