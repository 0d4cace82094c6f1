"""Near duplicates by min-max hashing.

A document is the set of its different word shingles. Under each of ``permutations`` hash orders both the smallest and
the largest value are kept, so one hash evaluation gives two signature places that are equal, each, with a probability
of the similarity. Bands of ``rows`` places are hashed; documents that share a band are candidates: with 100
permutations in bands of five, a pair of similarity 0.8 is missed by all 40 bands with a probability of about 1e-7.

Texts of the same shingles are one node from the start. In a bucket no pairs are listed: every node is compared with
one of the bucket's nodes, the pivot, on the full sets, and what is linked becomes one component. Links between
components that still share a bucket are found by an exact prefix filter: shingles are ordered from rare to frequent,
and two sets with enough in common share one of their first few. Nodes far from all others begin with shingles of
their own and so meet nobody; pairs whose parity bits show more differing members than a link allows do not meet
either; those that meet are compared on the full sets. No link between different texts that
share a band is lost, while most pairs of a group of many moderately edited copies are never formed.

Defined results: a missing or blank text has an empty set and is linked with nothing; a text with fewer words than a
shingle is one shingle; a row without ``doc_id`` is linked with nothing, has no component and is kept; rows with the
same ``doc_id`` count as one document and are linked; an empty table gives no rows; other columns are left out.
"""
from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_name, slices, stored, text_key, worker_cache, words
from .graph import connected_components

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_KEEP = 300_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _known() -> dict[bytes, int]:
    """Hashes of words this Python worker has met."""
    return worker_cache("word hashes", dict)


def _hashes(tokens: list[bytes]) -> np.ndarray:
    known = _known()
    found = list(map(known.get, tokens))
    if None in found:
        new = {w for w, h in zip(tokens, found) if h is None}
        if len(known) + len(new) > _KEEP:
            known.clear()
            new = set(tokens)
        known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        found = list(map(known.__getitem__, tokens))
    return np.array(found, np.uint64)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles of ``size`` words; of the whole sequence if it is shorter."""
    tokens = words(text)
    if not tokens:
        return np.empty(0, np.uint64)
    h = _hashes(tokens)
    k = min(size, len(h))
    s = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        s = _mix(s * _A + h[i:len(h) - k + 1 + i])
    return np.unique(s)


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


class MinMax:
    """Bands of the smallest and largest values of a set under fixed hash orders."""

    def __init__(self, permutations: int = 100, rows: int = 5, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.a = draw.integers(0, 1 << 31, permutations, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
        self.b = draw.integers(0, 1 << 32, permutations, dtype=np.uint32)[:, None]
        self.rows, self.bands = rows, 2 * permutations // rows

    def __call__(self, s: np.ndarray) -> np.ndarray:
        x = (s >> np.uint64(32)).astype(np.uint32)
        low, high = np.full(len(self.a), 0xFFFFFFFF, np.uint32), np.zeros(len(self.a), np.uint32)
        for at in range(0, len(x), 2048):
            v = self.a * x[None, at:at + 2048] + self.b
            np.minimum(low, v.min(1), out=low)
            np.maximum(high, v.max(1), out=high)
        places = np.concatenate([low, high])[:self.bands * self.rows].astype(np.uint64).reshape(self.rows, self.bands)
        key = np.arange(self.bands, dtype=np.uint64)
        for row in places:
            key = _mix(key * _A + row)
        return key.view(np.int64)


def _signed(docs: DataFrame, shingle: int, permutations: int, rows: int) -> DataFrame:
    """``doc_id, set_key, n_shingles, bands`` of every row; no bands for an empty set."""
    def sign(batches):
        bands = MinMax(permutations, rows)
        for batch in batches:
            for b in slices(batch, "text", 512, 2 << 20):
                sets = [shingle_set(t, shingle) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([set_key(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([bands(s) if len(s) else np.empty(0, np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "set_key", "n_shingles", "bands"])
    return docs.mapInArrow(sign, "doc_id bigint, set_key binary, n_shingles bigint, bands array<bigint>")


PARITY = 8  # words of 64 bits


def parity(s: np.ndarray) -> np.ndarray:
    """One bit per hash class: whether it holds an odd number of the set. Two sets differ in at least as many members as bits."""
    odd = np.bincount((s & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``node, set_key, text`` to ``node, shingles`` (hashes as bytes) and their ``parity``; other texts of the id are left out."""
    def make(batches):
        for batch in batches:
            for b in slices(batch, "text", 512, 2 << 20):
                sets = [shingle_set(t, shingle) for t in b.column("text").to_pylist()]
                own = pa.array([set_key(x) == k for x, k in zip(sets, b.column("set_key").to_pylist())], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [b.column("node"), pa.array([x.tobytes() for x in sets], pa.binary()), pa.array([parity(x) for x in sets], pa.list_(pa.int64()))],
                    ["node", "shingles", "parity"]).filter(own)
    return texts.mapInArrow(make, "node bigint, shingles binary, parity array<bigint>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` whose full sets are similar enough."""
    def check(batches):
        for batch in batches:
            for b in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                keep = []
                for x, y in zip(b.column("x"), b.column("y")):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"))
    return full.mapInArrow(check, "a bigint, b bigint")


def _sizes_allow(percent: int):
    return F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * percent


def _prefix_pairs(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``nodes`` (``node, component, size``) of different components that can be similar enough."""
    def spread(batches):
        for b in batches:
            raw = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column("shingles")]
            n = [len(x) for x in raw]
            if sum(n):
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.repeat(b.column(c).to_numpy(), n)) for c in ("node", "component", "size")], pa.array(np.concatenate(raw))],
                    ["node", "component", "size", "shingle"])

    rows = stored(sets.join(nodes, "node").select("node", "component", "size", "shingles").mapInArrow(
        spread, "node bigint, component bigint, size bigint, shingle bigint"), "shingles")
    shared = rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    rare_first = Window.partitionBy("node").orderBy(F.coalesce("n", F.lit(1)), "shingle")
    first = (rows.join(shared, "shingle", "left").withColumn("at", F.row_number().over(rare_first))
             .where((F.col("at") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1) & F.col("n").isNotNull()).drop("n"))
    first = stored(first.join(sets.select("node", "parity"), "node"), "prefixes")
    a, b = (first.select("shingle", *[F.col(c).alias(f"{x}_{c}") for c in ("node", "component", "size", "at", "parity")]) for x in "ab")
    common = F.ceil((F.col("a_size") + F.col("b_size")) * percent / (100 + percent))
    differ = reduce(add, [F.bit_count(F.get("a_parity", F.lit(i)).bitwiseXOR(F.get("b_parity", F.lit(i)))) for i in range(PARITY)])
    met = a.join(b, "shingle").where((F.col("a_component") < F.col("b_component")) & _sizes_allow(percent)
                                     & (F.col("a_at") <= F.col("a_size") - common + 1) & (F.col("b_at") <= F.col("b_size") - common + 1)
                                     & (differ <= F.col("a_size") + F.col("b_size") - 2 * common))
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def components(docs: DataFrame, shingle: int = 5, percent: int = 80, permutations: int = 100, rows: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``doc_id, text``.

    Links are pairs with ``100 * common >= percent * all`` shingles; ``component_id`` is the smallest ``doc_id`` reached.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = stored(_signed(texts, shingle, permutations, rows), "signed")
    # one node per set; the numbers stay because the table is written
    nodes = stored(signed.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("least"), F.max("n_shingles").alias("size")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    bands = (signed.where("doc_id IS NOT NULL").select("doc_id", "set_key", "bands").join(nodes, "set_key").where("doc_id = least")
             .select("node", "size", F.explode("bands").alias("bucket")).distinct())
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = stored(bands.join(shared, "bucket"), "members")
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", "set_key", "least")
    sets = stored(_sets(texts.join(wanted, texts.doc_id == wanted.least).select("node", "set_key", "text"), shingle)
                  .dropDuplicates(["node"]), "sets")

    # an id that stands for several sets links them
    several = signed.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").agg(
        F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low <> high")
    ends = signed.select("doc_id", "set_key").join(several, "doc_id").where("set_key <> low").select("low", "set_key").distinct()
    edges = stored(ends.join(nodes.select("set_key", F.col("node").alias("b")), "set_key").join(
        nodes.select(F.col("set_key").alias("low"), F.col("node").alias("a")), "low").select("a", "b"), "links")
    pivots = members.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node"), "node", "size")).alias("pivot"))
    pairs = members.join(pivots, "bucket").where("node <> pivot.node").select(
        F.col("pivot.node").alias("a"), F.col("node").alias("b"), F.col("pivot.size").alias("a_size"), F.col("size").alias("b_size"))
    pairs = pairs.where(_sizes_allow(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stored(edges.unionByName(_linked(pairs, sets, percent)), "links")
    first = connected_components(edges)
    own = members.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = own.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    open_nodes = stored(own.join(apart, "bucket").select("node", "component", "size").distinct(), "open-nodes")
    more = stored(_linked(_prefix_pairs(sets, open_nodes, percent).distinct(), sets, percent), "links")
    # from here on components are the nodes: many links between two of them are one
    end = {x: open_nodes.select(F.col("node").alias(x), F.col("component").alias(f"{x}_component")) for x in "ab"}
    between = more.join(end["a"], "a").join(end["b"], "b").select(F.col("a_component").alias("a"), F.col("b_component").alias("b")).distinct()
    second = connected_components(between).select(F.col("node").alias("_first"), F.col("component").alias("_second"))
    grouped = (nodes.select("set_key", "node", "least").join(first, "node", "left").withColumn("_first", F.coalesce("component", "node"))
               .join(second, "_first", "left").select("set_key", "least", F.coalesce("_second", "_first").alias("component")))
    named = grouped.join(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("set_key", "component_id")
    return signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(
        named, "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """All columns of the documents kept: one row of each group; rows without ``doc_id`` stay.

    Where the id that is kept has several texts, the row whose text has the smallest MD5 stays.
    """
    mark, place = new_name(docs, "_kept"), new_name(docs, "_place")
    kept = components(docs, **how).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(mark)).distinct()
    same = Window.partitionBy("doc_id").orderBy(text_key(F.col("text")))
    chosen = docs.join(kept, F.col("doc_id") == F.col(mark)).drop(mark).withColumn(place, F.row_number().over(same)).where(F.col(place) == 1).drop(place)
    return chosen.unionByName(docs.where("doc_id IS NULL"))
