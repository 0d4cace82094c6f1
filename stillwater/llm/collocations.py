"""Phrases whose words stand together more often than chance, from a weighted de Bruijn graph.

Texts are cut into pieces at punctuation and line ends, pieces into words. Nodes of the graph are four words in a row,
edges five: a text's walk through the graph is one edge per place, weighted by its occurrences, plus the last two to four
words of a piece, which no edge begins with. Only these longest grams are counted. The rest follows from the graph:

* a node's flow is what its edges carry away plus the pieces that end in it;
* a frequent edge goes on into the next one without choice if both carry the whole flow of the node between them; such
  unary ways are compacted by pointer jumping into one path with one weight (``compact``);
* every place on a path or single edge is one edge; the shorter counts follow length by length, as flows of the nodes that
  the longer ones leave and the pieces that end there.

Exact filters keep the graph small; none ever gives a count. Words rarer than a candidate can be end a piece, and from each
place the walk goes on only while its pairs, triples and fours of words can be frequent: where it stops within five words, it
ends like a piece. All are told by bits of fixed number, set from sums over all of the corpus per hash address, which are
never smaller than the true counts. If many words share an address, more is let through, which costs time and changes no
result. Walks are dealt to tasks by language, and a task counts a gram over all of its walks, so that few tasks hand on the same gram.

Defined results: a missing text is empty; a missing language is ``und``; repeated rows count as often as they occur; texts are
read whole, in portions that end with a piece (one piece without any end needs memory of its size); an empty table
gives no rows; other columns are left out.
"""
from __future__ import annotations

import re
import uuid
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, stored, worker_cache

LONGEST = 5
_ENDS = bytes.maketrans(b",;:!?\x0A\x0B\x0C\x0D", b"." * 9)
_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_PORTION = 4 << 20
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _portions(text: bytes):
    at = 0
    while len(text) - at > _PORTION and (end := _END.search(text, at + _PORTION)):
        yield text[at:end.end()]
        at = end.end()
    yield text[at:]


def _walks(batches):
    """``lang, vocabulary, places``: the words of some texts in a row as numbers, the sign ``.`` between pieces."""
    for batch in batches:
        for b in slices(batch, "text", 4096, _PORTION):
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                if text:
                    texts.setdefault("und" if lang is None else lang, []).append(text.encode())
            for lang, parts in texts.items():
                for raw in _portions(b".".join(parts)):
                    tokens = raw.lower().translate(_ENDS).replace(b".", b" . ").split()
                    number = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
                    if number:
                        yield lang, list(number), np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, n`` of all words."""
    def count(batches):
        for lang, vocabulary, places in _walks(batches):
            n = np.bincount(places, minlength=len(vocabulary))
            keep = [i for i, w in enumerate(vocabulary) if w != b"."]
            if keep:
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(keep)), pa.array([vocabulary[i].decode() for i in keep], pa.string()), pa.array(n[keep])], ["lang", "word", "n"])
    return docs.mapInArrow(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word, 42)


class Bits:
    """A set of numbers below ``2 ** power``, in at most that many bits; hashes go in by their last bits."""

    def __init__(self, blocks: list[tuple[int, bytes]], power: int):
        self.bits, self.mask = np.zeros(1 << (power - 3), np.uint8), np.uint64((1 << power) - 1)
        for block, bitmap in blocks:  # of 32768 bits, counted from 1
            at = (block - 1) * 4096
            self.bits[at:at + 4096] = np.frombuffer(bitmap, np.uint8)[:len(self.bits) - at]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & self.mask).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7) & 1).astype(bool)


def _bitmap(places: DataFrame) -> list[tuple[int, bytes]]:
    """The column ``place``, numbers below ``2 ** power``, as blocks of bits: at most ``2 ** power / 8`` bytes reach the driver."""
    at = F.col("place") + 1  # blocks and bits are counted from 1
    blocks = places.groupBy(F.bitmap_bucket_number(at).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    return [(r.block, bytes(r.bits)) for r in blocks.collect()]


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = (first * _ODD[0]) ^ (second * _ODD[1] + _ODD[0])
    return (x ^ (x >> np.uint64(29))) * _ODD[1] >> np.uint64(20)


def _marked_walks(docs: DataFrame, frequent, words_power: int) -> DataFrame:
    """``lang, words, places, kind``: walks of the words that can be part of a candidate, as numbers; the highest one stands for all else."""
    def mark(batches):
        known = worker_cache(("bits", frequent.value[0]), lambda: Bits(frequent.value[1], words_power))
        for lang, vocabulary, places in _walks(batches):
            can = known.has(_hashes(lang, vocabulary)) & np.fromiter((w != b"." for w in vocabulary), bool, len(vocabulary))
            p = np.concatenate([[-1], np.where(can, np.cumsum(can) - 1, -1)[places], [-1]])
            p[1:-1][(p[:-2] < 0) & (p[2:] < 0)] = -1  # a word by itself
            p = p[1:][(p[1:] >= 0) | (p[:-1] >= 0)]
            kind = "<u2" if can.sum() < 65_535 else "<u4"
            if len(p):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()), pa.array([[w.decode() for w, c in zip(vocabulary, can) if c]], pa.list_(pa.string())),
                     pa.array([p.astype(kind).tobytes()], pa.binary()), pa.array([kind], pa.string())], ["lang", "words", "places", "kind"])
    return docs.mapInArrow(mark, "lang string, words array<string>, places binary, kind string")


def _hashes(lang: str, vocabulary: list[bytes]) -> np.ndarray:
    return np.fromiter((word_hash(lang, w) for w in vocabulary), np.uint64, len(vocabulary))


def _read_walks(batches):
    """``lang, words, places, hashes, pairs``: with the hash of each place's word, and whether it and the next one are words."""
    for b in batches:
        for i in range(b.num_rows):
            lang, words, raw, kind = (b.column(c)[i] for c in ("lang", "words", "places", "kind"))
            places = np.frombuffer(raw.as_buffer(), kind.as_py()).astype(np.int64)
            real = places < len(words.values)
            words = words.as_py()
            h = np.append(_hashes(lang.as_py(), [w.encode() for w in words]), np.uint64(0))[np.minimum(places, len(words))]
            yield lang.as_py(), words, places, h, np.append(real[1:] & real[:-1], False)


def _gram_hash(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    out = h[at]
    for i in range(1, k):
        out = _pair_hash(out, h[at + i])
    return out


def _reach(h: np.ndarray, both: np.ndarray, known: list[Bits]) -> list[np.ndarray]:
    """Whether a gram of two words that can be frequent begins at each place, of three words and so on: as many as ``known`` tells, and
    below ``LONGEST`` one more, whose two parts can be frequent.
    """
    out, can = [], both
    for k in range(2, min(len(known) + 2, LONGEST) + 1):
        at, found = np.flatnonzero(can), np.zeros(len(h) + LONGEST, bool)
        found[at] = known[k - 2].has(_gram_hash(h, at, k)) if k - 2 < len(known) else True
        out.append(found)
        can = found[:-1] & found[1:]
    return out


def _known(shared: list, power: int) -> list[Bits]:
    """The broadcast bits, shorter grams first."""
    return worker_cache(("bits", *(s.value[0] for s in shared)), lambda: [Bits(s.value[1], power) for s in shared])


def _load(walks: DataFrame, shared: list, power: int) -> DataFrame:
    """``place, n``: the grams of one word more than ``shared`` tells, if their two parts can be frequent, counted by hash address, each task's sum once."""
    def load(batches):
        n, known, k = np.zeros(1 << power, np.int32), _known(shared, power), len(shared) + 2
        for *_, h, both in _read_walks(batches):
            h = _gram_hash(h, np.flatnonzero(_reach(h, both, known)[-1][:len(h)]), k)
            place, times = np.unique(h & np.uint64((1 << power) - 1), return_counts=True)
            n[place.astype(np.int64)] += times.astype(np.int32)
        at = np.flatnonzero(n)
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(n[part].astype(np.int64))], ["place", "n"])
    return walks.mapInArrow(load, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))


def _summed(batches, most: int):
    """Counts of the same gram as one row, over all batches of a task; more than ``most`` rows are not held."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size > most:
            total = _added(held)
            held, size = total.to_batches(), total.num_rows
            if 2 * size > most:
                yield from held
                held, size = [], 0
    if held:
        yield from _added(held).to_batches()


def _added(batches: list[pa.RecordBatch]) -> pa.Table:
    keys = ["lang", "k", "gram"]
    return pa.Table.from_batches(batches).group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select([*keys, "n"])


def _grams(walks: DataFrame, shared: list, power: int, hold: int = 1 << 19) -> DataFrame:
    """``lang, k, gram, n``: edges (five words), and the two to four words from places where a way stops earlier.

    A task counts a gram over all of its walks before it hands it on.
    """
    def found(batches):
        known = _known(shared, power)
        for lang, words, places, h, both in _read_walks(batches):
            size = len(h)
            steps = [can[:size] for can in _reach(h, both, known)]
            reach = np.ones(size, np.int8) + np.logical_and.accumulate(steps).sum(0, dtype=np.int8)
            for k in range(2, LONGEST + 1):
                at = np.flatnonzero(reach == k)
                if len(at):
                    rows = np.ascontiguousarray(places[at[:, None] + np.arange(k)].astype(np.int32))
                    kinds, n = np.unique(rows.view(f"V{4 * k}").ravel(), return_counts=True)
                    grams = [" ".join([words[i] for i in r]) for r in kinds.view(np.int32).reshape(-1, k).tolist()]
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(n)), pa.repeat(pa.scalar(k, pa.int32()), len(n)), pa.array(grams, pa.string()),
                                                      pa.array(n.astype(np.int64))], ["lang", "k", "gram", "n"])

    def count(batches):
        yield from _summed(found(batches), hold)
    return walks.mapInArrow(count, "lang string, k int, gram string, n bigint").groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))


def _first(k: int):
    return F.substring_index("gram", " ", k)


def _last(k: int):
    return F.substring_index("gram", " ", -k)


def compact(grams: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """``lang, path, n, starts``, ways through the graph without a choice, and the edges of ``grams`` that are on none.

    A path of m edges holds m + 4 words and begins a phrase at each of its first ``starts`` = m words. Edges rarer than
    ``min_count`` and those of rings stay single.
    """
    node = LONGEST - 1
    edges, ends = grams.where(F.col("k") == LONGEST), grams.where(F.col("k") < LONGEST)
    flow = edges.select("lang", _first(node).alias("node"), "n").unionByName(
        ends.where(F.col("k") == node).select("lang", F.col("gram").alias("node"), "n")).groupBy("lang", "node").agg(F.sum("n").alias("flow"))
    often = edges.where(F.col("n") >= min_count)
    # all of a node's flow leaves by one edge, all of it came by one edge: no two of either can exist
    leaves = often.select("lang", _first(node).alias("node"), F.col("gram").alias("next"), "n").join(flow, ["lang", "node"]).where("n = flow")
    comes = often.select("lang", _last(node).alias("node"), F.col("gram").alias("edge"), F.col("n").alias("flow"))
    follows = stored(leaves.join(comes, ["lang", "node", "flow"]).select("lang", "edge", "next", "n"), "follows")
    rank = stored(follows.select("lang", F.col("next").alias("gram"), F.col("edge").alias("head"), F.lit(1).alias("place")).unionByName(
        follows.join(follows.select("lang", F.col("next").alias("edge")), ["lang", "edge"], "left_anti")
        .select("lang", F.col("edge").alias("gram"), F.col("edge").alias("head"), F.lit(0).alias("place"))), "rank")
    for _ in range(ceil(log2(rank.count() + 1)) + 1):
        far = rank.select("lang", F.col("gram").alias("head"), F.col("head").alias("_head"), F.col("place").alias("_place"))
        moved = stored(rank.join(far, ["lang", "head"], "left").select(
            "lang", "gram", F.coalesce("_head", "head").alias("head"), (F.col("place") + F.coalesce("_place", F.lit(0))).cast("int").alias("place"),
            F.coalesce(F.col("_head") != F.col("head"), F.lit(False)).alias("moved")), "rank")
        rank = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    heads = rank.where("place = 0").select("lang", "head")
    on_path = rank.join(heads, ["lang", "head"]).join(often.select("lang", "gram", "n"), ["lang", "gram"])
    part = F.floor(F.col("place") / 256)  # a long way is several paths, so that no group grows with it
    sorted_edges = F.array_sort(F.collect_list(F.struct("place", "gram")))
    paths = on_path.groupBy("lang", "head", "n", part.alias("part")).agg(sorted_edges.alias("edges")).select(
        "lang", F.concat(F.split(F.col("edges")[0]["gram"], " "), F.transform(F.slice("edges", 2, 256), lambda e: F.substring_index(e["gram"], " ", -1))).alias("path"),
        "n", F.size("edges").alias("starts"))
    single = often.join(on_path.select("lang", "gram"), ["lang", "gram"], "left_anti").select(*grams.columns)
    return paths, single.unionByName(edges.where(F.col("n") < min_count))


def phrase_counts(docs: DataFrame, min_count: int = 100, words_power: int = 23, grams_power: int = 24) -> tuple[DataFrame, DataFrame]:
    """``lang, k, phrase, n`` of all phrases of one to five words that occur often enough, and ``lang, n``: all words."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    words = stored(word_counts(texts), "words")
    frequent_words = words.where(F.col("n") >= min_count)
    place = F.xxhash64(F.concat("lang", F.lit("\0"), "word")).bitwiseAND(F.lit((1 << words_power) - 1))
    def shared(places: DataFrame):
        return spark.sparkContext.broadcast((uuid.uuid4().hex, _bitmap(places)))

    def heavy(load: DataFrame):
        return shared(load.where(F.col("n") >= min_count).select(F.col("place").cast("bigint").alias("place")))

    frequent = shared(frequent_words.select(place.alias("place")))
    walks = stored(_marked_walks(texts, frequent, words_power).repartitionByRange("lang", F.xxhash64("places")), "walks")
    filters: list = []
    while len(filters) < LONGEST - 2:
        filters.append(heavy(_load(walks, filters, grams_power)))
    grams = stored(_grams(walks, filters, grams_power), "grams")
    paths, single = compact(grams, min_count)
    on_paths = stored(paths, "paths").select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), "starts"), lambda i: F.array_join(
        F.slice("path", i, LONGEST), " "))).alias("gram"))
    flow = on_paths.unionByName(single.select("lang", "gram", "n"))
    long = flow.select("lang", F.lit(LONGEST).alias("k"), "gram", "n")
    for k in range(LONGEST - 1, 1, -1):  # what leaves a node, and the pieces that end in it
        ends = grams.where(F.col("k") == k).select("lang", "gram", "n")
        flow = flow.select("lang", _first(k).alias("gram"), "n").unionByName(ends).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        long = long.unionByName(flow.select("lang", F.lit(k).alias("k"), "gram", "n"))
    long = long.where(F.col("n") >= min_count).withColumnRenamed("gram", "phrase")
    counts = stored(long.unionByName(frequent_words.select("lang", F.lit(1).alias("k"), F.col("word").alias("phrase"), "n")), "phrases")
    return counts, words.groupBy("lang").agg(F.sum("n").alias("n"))


def cut_score():
    """``floor(1000 * a * n / (l * r))`` in whole numbers of 38 digits."""
    big = {c: F.col(c).cast("decimal(18,0)") for c in "alrn"}
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (big["a"] * big["n"]), big["l"] * big["r"])


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000, **filters) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of two to five words of each language.

    A phrase is scored at its weakest cut; one that only occurs inside a longer candidate is left out.
    """
    counts, total = phrase_counts(docs, min_count, **filters)
    longer = counts.where("k > 2").withColumnRenamed("phrase", "gram")
    inside = longer.select("lang", F.explode(F.array(F.expr("substring_index(gram, ' ', 1 - k)"), F.expr("substring_index(gram, ' ', k - 1)"))).alias("phrase"),
                           F.col("n").alias("a"))
    candidates = counts.where("k > 1").withColumnRenamed("n", "a").join(inside, ["lang", "phrase", "a"], "left_anti")
    cut = candidates.select("lang", "k", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at")).select(
        "*", F.expr("substring_index(phrase, ' ', at)").alias("left"), F.expr("substring_index(phrase, ' ', at - k)").alias("right"))
    parts = counts.select("lang", "phrase", "n")
    cut = cut.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]).join(total, "lang")
    scored = cut.select("lang", "phrase", "a", "l", "r", "n", "at", cut_score().alias("score"))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "at", "a", "l", "r", "n")).alias("best")).select("lang", "phrase", "best.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return weakest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
ws AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM ws, range(1, 6) AS ks(k) WHERE len(w) >= k)),
c AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
tot AS (SELECT lang, sum(len(w)) AS n FROM ws GROUP BY lang),
cand AS (SELECT * FROM c WHERE k > 1),
cuts AS (SELECT x.lang, x.phrase, x.f AS a, l.f AS l, r.f AS r, n, cut, (1000::HUGEINT * x.f * n) // (l.f::HUGEINT * r.f) AS score
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) x
         JOIN c l ON l.lang = x.lang AND l.phrase = array_to_string(list_slice(string_split(x.phrase, ' '), 1, cut), ' ')
         JOIN c r ON r.lang = x.lang AND r.phrase = array_to_string(list_slice(string_split(x.phrase, ' '), cut + 1, x.k), ' ')
         JOIN tot ON tot.lang = x.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM cand q WHERE q.lang = b.lang AND q.f = b.a AND len(q.phrase) > len(b.phrase)
                                                AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
