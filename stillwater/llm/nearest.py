"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes: vectors are lengthened by one place so that all have the same norm (largest inner product then means smallest
angle), and multiplied by ``turns`` rotations, each learned by iterative quantisation on a bounded sample to lie close
to its own signs. The signs are the code. The search radius is the Hamming distance within which, on the sample, a
share ``reach`` of true neighbours lies.

Index: rows are dealt into blocks of bounded size, queries too, and every query block meets every row block in a task
of its own: a stated query set against all rows. In a task the codes are cut into bytes and each byte is indexed: rows
sorted by its value. Two codes within the radius differ, by the pigeonhole principle, in at least one byte by no more
than the radius over the number of bytes; so the rows under all byte values that near contain every code within the
radius. Their whole codes are compared, and those within it are ranked by the inner product of the original vectors
in double precision. Where a block gives a query fewer than ``k`` rows, all of that block's rows are ranked.

Defined results: rows without id or vector, with null, NaN or infinite components, zero vectors and those of another
length than most sampled ones take no part; a query that is not a row's own id meets all rows; rows with the same id
are one vector each; ties go to the smaller id; an empty table gives no rows; other columns are left out.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored


class Model(NamedTuple):
    norm: float  # the largest of all rows
    turns: np.ndarray  # [place, bit]
    radius: int

    def codes(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Packed sign bits, [row, byte]."""
        return np.packbits(lengthened(x, self.norm, query) @ self.turns > 0, axis=1)


def lengthened(x: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """Unit vectors of one more place whose inner products order like those of the vectors with a query's."""
    size = np.linalg.norm(x, axis=1)
    if query:
        return np.hstack([x / size[:, None], np.zeros((len(x), 1))])
    return np.hstack([x / norm, np.sqrt(np.maximum(1 - (size / norm) ** 2, 0))[:, None]])


def rotation(x: np.ndarray, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """A rotation after which the sample lies close to its signs."""
    r = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.sign(x @ r).T @ x)
        r = (u @ v).T
    return r


def fit(sample: np.ndarray, norm: float, bits: int, k: int, reach: float, rounds: int = 20, probes: int = 300, seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    rows = lengthened(sample, norm, False)
    turns = np.hstack([rotation(rows, rounds, rng) for _ in range(-(-bits // rows.shape[1]))])[:, :bits]
    model = Model(norm, turns, bits)
    asked = sample[:probes]
    near = asked @ sample.T
    near[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    top = np.argsort(-near, axis=1)[:, :min(k, max(1, len(sample) - 1))]
    a, b = model.codes(asked, True), model.codes(sample, False)
    apart = np.bitwise_count(a[:, None] ^ b[top]).sum(2)
    return model._replace(radius=int(np.quantile(apart, reach, method="higher")))


class Index:
    """The rows of a block, found by the bytes of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable").astype(np.int32)  # per byte: rows by its value
        self.first = np.stack([np.searchsorted(codes[o, j], np.arange(257)) for j, o in enumerate(self.order.T)])
        self.words = np.ascontiguousarray(codes).view(np.uint64) if codes.shape[1] % 8 == 0 else codes

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits."""
        n, m = self.codes.shape
        hit = np.zeros(n, bool)
        values = np.arange(256, dtype=np.uint8)
        for j in range(m):
            for v in np.flatnonzero(np.bitwise_count(values ^ code[j]) <= radius // m).tolist():
                hit[self.order[self.first[j, v]:self.first[j, v + 1], j]] = True
            if 2 * np.count_nonzero(hit) > n:  # more look-ups would hardly spare a comparison
                hit[:] = True
                break
        rows = np.flatnonzero(hit)
        own = np.ascontiguousarray(code).view(np.uint64) if self.words.dtype == np.uint64 else code
        return rows[np.bitwise_count(self.words[rows] ^ own).sum(1) <= radius]


def usable(vector: str) -> Column:
    """Whether a vector has only finite components and is not zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def search(spark: SparkSession, vectors: DataFrame, queries: Column, k: int = 20, bits: int = 256, reach: float = 0.97,
           sample: int = 8192, block_rows: int = 32_768, block_queries: int = 8192) -> DataFrame:
    """``vec_id, embedding`` to ``query_id, rank, vec_id, score``; ``queries`` says which rows are queries."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("asked")).where(F.col("vec_id").isNotNull() & usable("v"))
    drawn = rows.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not drawn:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sizes = np.array([len(r["v"]) for r in drawn])
    length = int(np.bincount(sizes).argmax())
    rows = rows.where(F.size("v") == length)
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    whole = rows.agg(F.count("*").alias("n"), F.sum(F.col("asked").cast("long")).alias("q"), F.max(norm2).alias("norm2")).first()
    if not whole["q"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    model = fit(np.array([r["v"] for r in drawn if len(r["v"]) == length]), float(np.sqrt(whole["norm2"])), bits, k, reach)
    row_blocks, query_blocks = -(-whole["n"] // block_rows), -(-whole["q"] // block_queries)
    shared = spark.sparkContext.broadcast(model)

    def encode(batches):
        model = shared.value
        for b in batches:
            x = _matrix(b.column("v"), length)
            if not len(x):
                continue
            ask = np.array(b.column("asked"), bool)
            code = np.where(ask[:, None], model.codes(x, True), model.codes(x, False))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), b.column("asked"), pa.array([c.tobytes() for c in code], pa.binary())],
                                             ["vec_id", "v", "asked", "code"])

    place = F.xxhash64("vec_id", "v")
    indexed = rows.withColumn("asked", F.lit(False))
    asking = rows.where("asked")
    schema = "vec_id bigint, v array<double>, asked boolean, code binary"
    # every row goes once to each block of queries, every query once to each block of rows
    parts = (indexed.mapInArrow(encode, schema).withColumn("row_block", F.pmod(place, F.lit(row_blocks)))
             .withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint")))).unionByName(
        asking.mapInArrow(encode, schema).withColumn("query_block", F.pmod(place, F.lit(query_blocks)))
        .withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(row_blocks - 1).cast("bigint"))))))

    def find(group: pa.Table) -> pa.Table:
        ask = np.array(group.column("asked"), bool)
        ids = group.column("vec_id").to_numpy()
        x = np.concatenate([_matrix(c, length) for c in group.column("v").chunks])
        codes = np.frombuffer(b"".join(c.as_py() for c in group.column("code")), np.uint8).reshape(len(ids), -1)
        have, have_x, index = ids[~ask], x[~ask], Index(codes[~ask])
        out = {"query_id": [], "vec_id": [], "score": []}
        for q, vector, code in zip(ids[ask].tolist(), x[ask], codes[ask]):
            near = index.within(code, shared.value.radius)
            if (have[near] != q).sum() < k:
                near = np.arange(len(have))
            near = near[have[near] != q]
            score = have_x[near] @ vector
            best = np.lexsort((have[near], -score))[:k]
            out["query_id"] += [q] * len(best)
            out["vec_id"] += have[near][best].tolist()
            out["score"] += score[best].tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    found = parts.groupBy("row_block", "query_block").applyInArrow(find, "query_id bigint, vec_id bigint, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (stored(found, "nearest").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
