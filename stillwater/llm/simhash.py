"""Near duplicates by fingerprints of 64 bits, found by fuzzy hashing with a Golay code.

A bit of a document's fingerprint is set if it is set in over half of the XXH64 values of its word shingles, repeats
included. Two fingerprints are linked if at most four bits differ.

The binary Golay code of length 23 is perfect: every word of 23 bits lies within three bits of exactly one codeword.
The *keys* of a word are the numbers of the codewords that it and its one-bit neighbours are decoded to (one key, or
some six where the word is three bits off its codeword). Words that differ by two bits or less have a neighbour in
common and so share a key. The fingerprint is cut into three segments of 22, 21 and 21 bits. Of four differing bits,
either no segment holds more than two, and then one of the segments' combined keys is shared; or one segment holds
three or four, and then of the other two one is equal and the other is at most one bit off: equal bits of one with the
keys of another are shared. No link can be missed.

Different fingerprints with a key in common stand side by side after a sort by key and are compared there; a key with
more than ``crowd`` fingerprints is not compared but goes another exact way: each of its fingerprints is written
to all words within two bits of it (2081), and fingerprints that meet in a word are linked, since two are linked if and
only if such a word exists. The work is so bounded per fingerprint, no pairs are listed, and large groups of near copies
are chained by one row for each fingerprint and word.

Defined results: a missing or blank text has the fingerprint zero, which is linked like any other; a text with fewer
words than a shingle is one shingle; rows of one ``doc_id`` are judged row by row; a row without ``doc_id`` is linked,
but names no component (``component_id`` is the smallest id reached, null if there is none); an empty table gives no rows;
other columns are left out.
"""
from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, words, worker_cache
from .graph import connected_components

BITS = 4  # linked fingerprints differ by no more
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, length
GENERATOR = 0xAE3  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the Golay code
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Majority bits of the hashes of the text's word shingles; zero without words."""
    tokens = words(text)
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(tokens))
    at, to, n = starts[:len(tokens) - k + 1].tolist(), ends[k - 1:].tolist(), len(tokens) - k + 1
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        cut = [joined[a:b] for a, b in zip(at[i:i + _BLOCK], to[i:i + _BLOCK])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(seed)), "<u8", len(cut))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def codewords() -> np.ndarray:
    """The 4096 codewords: multiples of the generator, bits as coefficients of a polynomial."""
    message = np.arange(1 << 12)
    code = np.zeros(1 << 12, np.int64)
    for i in range(12):
        code ^= (message >> i & 1) * (GENERATOR << i)
    return code


def _nearest() -> np.ndarray:
    code, near = codewords(), np.empty(1 << 23, np.int16)
    for bits in range(4):
        for places in combinations(range(23), bits):
            near[code ^ sum(1 << i for i in places)] = np.arange(1 << 12)
    return near


def decoder() -> np.ndarray:
    """For every word of 23 bits the number of the codeword within three bits of it; kept per Python worker."""
    return worker_cache("golay", _nearest)


def segment_keys(part: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of each segment, and which of them are the first of their kind."""
    near = decoder()
    keys = np.stack([near[part], *(near[part ^ (1 << i)] for i in range(length))], 1)
    keys.sort(1)
    return keys, np.concatenate([np.ones((len(keys), 1), bool), keys[:, 1:] != keys[:, :-1]], 1)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the fingerprints and their keys; keys of different kinds are different numbers."""
    parts = [(prints >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    found = [segment_keys(p, n) for p, (_, n) in zip(parts, SEGMENTS)]
    flat, count, first = [], [], []
    for keys, new in found:
        flat.append(keys[new].astype(np.int64))
        count.append(new.sum(1))
        first.append(np.cumsum(count[-1]) - count[-1])

    def product(segments):
        """Row and, for each segment, place in ``flat`` of every combination."""
        rows = np.arange(len(prints))
        places = []
        for s in segments:
            n = count[s][rows]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            places = [np.repeat(p, n) for p in places]
            rows = np.repeat(rows, n)
            places.append(first[s][rows] + inner)
        return rows, places

    rows, (a, b, c) = product((0, 1, 2))
    all_rows, all_keys = [rows], [flat[0][a] << 24 | flat[1][b] << 12 | flat[2][c]]
    kind = 1
    for equal in range(3):
        for fuzzy in range(3):
            if equal != fuzzy:
                rows, (a,) = product((fuzzy,))
                all_rows.append(rows)
                all_keys.append(kind << 40 | parts[equal][rows] << 12 | flat[fuzzy][a])
                kind += 1
    return np.concatenate(all_rows), np.concatenate(all_keys)


def _forest(x: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what is linked among these fingerprints, one less than the members of each group."""
    group, out = np.arange(len(x)), []
    for j in range(1, len(x)):
        near = np.flatnonzero(np.bitwise_count(x[:j] ^ x[j]) <= BITS)
        for i in near[np.unique(group[near], return_index=True)[1]].tolist():
            out.append((i, j))
            group[group == group[i]] = group[j]
    return out


def _link_runs(keys: np.ndarray, prints: np.ndarray, crowd: int):
    """Links ``a, b`` among neighbours of one key; ``a, null`` for the members of a crowded key."""
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(start, len(keys)))
    two = start[size == 2]
    two = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= BITS]
    a, b = [prints[two]], [prints[two + 1]]
    for at, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
        if n <= crowd and (edges := _forest(run := prints[at:at + n])):
            i, j = np.array(edges).T
            a.append(run[i])
            b.append(run[j])
    alone = np.concatenate([np.empty(0, np.uint64), *(prints[s:s + n] for s, n in zip(start[size > crowd], size[size > crowd]))])
    left, right = np.concatenate([*a, alone]).view(np.int64), np.concatenate(b).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(left), pa.concat_arrays([pa.array(right), pa.nulls(len(alone), pa.int64())])], ["a", "b"])


def links(prints: DataFrame, crowd: int = 1024) -> DataFrame:
    """``a, b``: links between different fingerprints of the column ``print`` that connect what is linked."""
    def spread(batches):
        for batch in batches:
            for b in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                x = b.column("print").to_numpy().view(np.uint64)
                rows, keys = keys_of(x)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(x[rows].view(np.int64))], ["key", "print"])

    def meet(batches):
        """Rows sorted by key; the last key of a batch waits for the next one, and if crowded, flows on unjoined."""
        kept_keys, kept_prints, flowing = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for b in batches:
            keys = np.concatenate([kept_keys, b.column("key").to_numpy()])
            x = np.concatenate([kept_prints, b.column("print").to_numpy().view(np.uint64)])
            if flowing is not None:
                n = int(np.searchsorted(keys, flowing, side="right"))
                if n:
                    yield _crowd(x[:n])
                keys, x = keys[n:], x[n:]
                flowing = flowing if not len(keys) else None
            if not len(keys):
                kept_keys, kept_prints = keys, x
                continue
            cut = int(np.searchsorted(keys, keys[-1]))
            yield _link_runs(keys[:cut], x[:cut], crowd)
            kept_keys, kept_prints = keys[cut:], x[cut:]
            if len(kept_keys) > crowd:
                yield _crowd(kept_prints)
                flowing, kept_keys, kept_prints = keys[-1], keys[:0], x[:0]
        if len(kept_keys):
            yield _link_runs(kept_keys, kept_prints, crowd)

    def _crowd(x):
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.nulls(len(x), pa.int64())], ["a", "b"])

    def midpoints(batches):
        near = np.array([sum(1 << i for i in places) for bits in range(BITS // 2 + 1) for places in combinations(range(64), bits)], np.uint64)
        for batch in batches:
            for b in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                x = b.column("print").to_numpy().view(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array((x[:, None] ^ near).ravel().view(np.int64)), pa.array(np.repeat(x, len(near)).view(np.int64))],
                                                 ["word", "print"])

    met = stored(prints.mapInArrow(spread, "key bigint, print bigint").repartition("key").sortWithinPartitions("key")
                 .mapInArrow(meet, "a bigint, b bigint").distinct(), "met")
    crowded = met.where("b IS NULL").select(F.col("a").alias("print"))
    words_near = crowded.mapInArrow(midpoints, "word bigint, print bigint")
    stars = (words_near.groupBy("word").agg(F.min("print").alias("a"), F.max("print").alias("z")).where("a <> z").select("word", "a")
             .join(words_near, "word").where("a <> print").select("a", F.col("print").alias("b")))
    return met.where("b IS NOT NULL").unionByName(stars).distinct()


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, print`` of every row; the 64 bits as a signed number."""
    def make(batches):
        for batch in batches:
            for b in slices(batch, "text", 1024, 2 << 20):
                x = np.array([fingerprint(t, shingle, seed) for t in b.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x.view(np.int64))], ["doc_id", "print"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        make, "doc_id bigint, print bigint")


def components(docs: DataFrame, shingle: int = 4, seed: int = 42, crowd: int = 1024) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``doc_id, text``."""
    rows = stored(fingerprints(docs, shingle, seed), "prints")
    nodes = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "nodes")
    joined = connected_components(links(nodes.select("print"), crowd)).withColumnRenamed("node", "print")
    named = nodes.join(joined, "print", "left").withColumn("component", F.coalesce("component", "print"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").select("print", "component_id")
    return rows.join(named, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
