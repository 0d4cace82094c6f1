"""Language-model scores by logistic context mixing over bits.

A text is the sequence of its words (lower-cased) and an end. Where the two words before stand together earlier in the
text, the word that followed them there last is recalled, and a first decision says whether it comes again. Its
probability is an adaptive map's, gated by how many words in a row have just been recalled rightly; the map holds the counts of
all training texts. A recalled word costs that decision alone. Any other word is spelled byte by byte, a byte by the binary
decisions of a Huffman tree over the training bytes. Several predictors give each decision a probability, each from
a table addressed by a hash of its own context; their logits are mixed with weights that a gate selects by how much
the longest contexts have been seen, and the result is refined by an adaptive probability map. The spelling's contexts
end at the word's start, which knows of the words before only the class of the last short one, that is, as a rule, the
language; so the length of a spelled word is the same wherever that class and word meet, and is computed where all its places meet.
The classes come from what words of at most three bytes stand in one text, over all training texts.

Tables are counts over the whole training corpus: tasks count (class, word) pairs, pairs are summed, tasks spell the
sums into tables of fixed size, tables are summed in blocks. The same tasks count recalls. Mixing weights and the map are learnt
from all pairs, each without one occurrence of itself, so that rare words look as unseen as they will be in new texts: every task learns
online, decision by decision in small steps, from its share; the tasks' weights are averaged by the curvature that each has gathered, and
the maps are summed.

The plain base beside it is a smoothed unigram model of words. What the ``head`` most frequent pairs (of at most
``HEAD_BYTES`` bytes each) cost by both is broadcast, its size is thus bounded; the others are looked up and spelled by a join.

Defined results: a missing or blank text is the end alone; a row without ``doc_id`` is in no training set and is not held
out; rows with the same id are scored one by one; an empty table gives no rows; without training documents
the predictors know nothing and the base is that of an unknown word; other columns are left out.
"""
from __future__ import annotations

import heapq
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, slices, stored, worker_cache, words

BITS = (18, 20, 22, 22, 22)  # of the tables' addresses
PREDICTORS = len(BITS)
BLOCK = 1 << 14
SEEN_BY = (2, 3, 4)  # contexts whose counts select the weights
GATES = 5 ** len(SEEN_BY)
TONGUES = 6  # classes of short words; a text begins in one more
END = b"\n"
RECALLED = -1  # in place of a class: how often recalls came true
RUNS = np.array([1, 2, 3, 5, 9, 17])  # steps of the words recalled in a row
HEAD_BYTES = 64
PRIOR = 0.05
START, STIFF = 0.3, 50.0  # weights and curvature before anything is learnt
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class Code(NamedTuple):
    """The decisions that spell a byte: inner nodes and branches, one behind the other, from ``first`` on."""
    first: np.ndarray
    length: np.ndarray
    node: np.ndarray
    branch: np.ndarray


def huffman(counts: np.ndarray) -> Code:
    heap = [(float(c) + 1, b, b) for b, c in enumerate(counts)]  # every byte has a code
    heapq.heapify(heap)
    ways: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    groups, number = {b: [b] for b in range(256)}, 256
    while len(heap) > 1:
        (x, _, i), (y, _, j) = heapq.heappop(heap), heapq.heappop(heap)
        for branch, g in ((0, i), (1, j)):
            for b in groups[g]:
                ways[b].append((number - 256, branch))
        groups[number] = groups.pop(i) + groups.pop(j)
        heapq.heappush(heap, (x + y, number, number))
        number += 1
    length = np.array([len(w) for w in ways])
    flat = [step for w in ways for step in reversed(w)]
    return Code(np.cumsum(length) - length, length, np.array([n for n, _ in flat], np.uint64), np.array([b for _, b in flat], bool))


def spell(pairs: list[tuple[int, bytes]], code: Code) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Per decision: its address in each table, its branch, the pair it belongs to and its place in the byte's code."""
    spelled = [w if w == END else w + b" " for _, w in pairs]
    size = np.array([len(s) for s in spelled])
    text = np.frombuffer(b"".join(spelled), np.uint8)
    pair = np.repeat(np.arange(len(pairs)), size)
    begin = np.cumsum(size) - size
    place = np.arange(len(text)) - begin[pair]
    kind = np.array([c for c, _ in pairs], np.uint64)[pair]
    wide = text.astype(np.uint64) + np.uint64(1)
    back = [np.where(place >= k, np.concatenate([np.zeros(k, np.uint64), wide[:-k]])[:len(wide)], np.uint64(0)) for k in range(1, 6)]
    power = np.ones(int(size.max()), np.uint64)
    power[1:] = _M[0]
    power = np.multiply.accumulate(power)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(wide * power[place], dtype=np.uint64)])
    prefix = sums[:-1] - sums[begin][pair]  # of the bytes before, in the word
    two = back[0] * _M[0] + back[1] * _M[1]
    three = two + back[2] * _M[2]
    whole = (prefix + np.uint64(3)) * _M[1]
    contexts = (two + kind * _M[3], three, three + back[3] * _M[3] + back[4] * (_M[0] ^ _M[2]), whole, whole + (kind + np.uint64(1)) * _M[2])
    n = code.length[text]
    byte = np.repeat(np.arange(len(text)), n)
    step = np.arange(len(byte)) - np.repeat(np.cumsum(n) - n, n)
    at = code.first[text][byte] + step
    node = (code.node[at] + np.uint64(1)) * _M[2]
    slots = []
    for i, c in enumerate(contexts):
        c = (c ^ (c >> np.uint64(29))) * _M[i % 4]
        h = (c[byte] + node) * _M[3]
        slots.append((h >> np.uint64(64 - BITS[i])).astype(np.int64))
    return slots, code.branch[at], pair[byte], np.minimum(step, 15)


def keys(text: str | None, classes: dict[bytes, int]) -> list[tuple[int, bytes]]:
    """The (class, word) pairs of a text and its end; the class is that of the last word before that has one."""
    tokens = words(text)
    tokens.append(END)
    out, now = [], TONGUES
    for w in tokens:
        out.append((now, w))
        if len(w) < 4:
            now = classes.get(w, now)
    return out


def recalls(docs: list[list[tuple[int, bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    """Per word of the texts, one text behind the other: the step of ``RUNS`` it is met at (-1: nothing to recall), and
    whether it is the recalled one.
    """
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for d in docs for _, w in d], np.int64)
    return _recalls(ids, len(number), np.array([len(d) for d in docs]))


def _recalls(ids: np.ndarray, kinds: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of numbered words."""
    owner, every = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(ids))
    at = np.flatnonzero(every - (np.cumsum(sizes) - sizes)[owner] >= 2)
    before = ids[at - 2] * kinds + ids[at - 1]
    if kinds ** 2 * (len(ids) + 1) < 1 << 63:  # pairs and places fit into one number each, which sorts faster
        pair, order = np.divmod(np.sort(before * len(ids) + at), max(1, len(ids)))
    else:
        order = np.argsort(before, kind="stable")
        pair, order = before[order], at[order]
    again = (pair[1:] == pair[:-1]) & (owner[order[1:]] == owner[order[:-1]])
    earlier = np.full(len(ids), -1)
    earlier[order[1:][again]] = order[:-1][again]
    hit = (earlier >= 0) & (ids[earlier] == ids)
    missed = np.maximum.accumulate(np.where(hit, -1, every))
    run = np.append(0, every[:-1] - missed[:-1])
    return np.where(earlier >= 0, np.searchsorted(RUNS, run, side="right"), -1), hit


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of the texts and the number of each one's text; some are empty."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))  # at the six blanks of bytes.split()
    return found.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(found).to_numpy())


CODES = TONGUES + 2  # a pair's number is its word's number times this, plus its class


def numbered(texts: pa.Array, classes: dict[bytes, int]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """What ``keys`` gives for the texts, one behind the other: different words, each place's word and class, the texts' sizes."""
    names, *rest = _numbered(texts, classes)
    return names.to_pylist(), *rest


def _numbered(texts: pa.Array, classes: dict[bytes, int]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The same with the words as an array."""
    parts, owner = _split(texts)
    full = pc.binary_length(parts).to_numpy() > 0
    word = parts.filter(pa.array(full)).dictionary_encode()
    names = pa.concat_arrays([word.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
    sizes = np.bincount(owner[full], minlength=len(texts)) + 1
    ids = np.full(int(sizes.sum()), len(names) - 1)
    ids[np.delete(np.arange(len(ids)), np.cumsum(sizes) - 1)] = word.indices.to_numpy()
    tells, short = np.full(len(names), -1), np.flatnonzero(pc.binary_length(names).to_numpy() < 4)
    tells[short] = [classes.get(w, -1) for w in names.take(pa.array(short)).to_pylist()]
    tells = tells[ids]
    every = np.arange(len(ids))
    last = np.maximum.accumulate(np.where(tells >= 0, every, -1))
    before = np.append(-1, last[:-1])
    return names, ids, np.where(before >= np.repeat(np.cumsum(sizes) - sizes, sizes), tells[before], TONGUES), sizes


SLICE = 2048, 4 << 20  # rows and bytes of texts that are numbered together
MOST_SHORT = 400  # words that can have a class


def _short(text: list[bytes]) -> Counter:
    return Counter(w for w in text if len(w) < 4)


def _together(texts: list[tuple[list[bytes], list[int]]], common: list[bytes]) -> tuple[np.ndarray, int]:
    """How much each two common words occur in the same texts (a text's counts as a unit vector), and the number of texts with some."""
    place = {w: i for i, w in enumerate(common)}
    x = np.zeros((len(texts), len(common)))
    for row, (found, n) in zip(x, texts):
        for w, k in zip(found, n):
            if w in place:
                row[place[w]] = k
    x = x[x.sum(1) >= 5]
    unit = np.sqrt(x)
    unit /= np.sqrt(x.sum(1))[:, None]
    return unit.T @ unit, len(x)


def _classes(common: list[bytes], together: np.ndarray, texts: int, rounds: int = 20) -> dict[bytes, int]:
    """Classes of words by the words they occur with: spherical k-means, begun far apart.

    A word gets the group it mainly occurs with, and none if it is at home with several.
    """
    if texts < TONGUES:
        return {}
    weight = np.diag(together)
    profile = together / np.sqrt(np.outer(np.maximum(weight, 1e-12), np.maximum(weight, 1e-12)))
    profile /= np.maximum(np.linalg.norm(profile, axis=1), 1e-12)[:, None]
    centres = profile[[int(weight.argmax())]]
    while len(centres) < TONGUES:
        centres = np.vstack([centres, profile[(np.sqrt(weight) * (1 - (profile @ centres.T).max(1))).argmax()]])
    for _ in range(rounds):
        own = (profile @ centres.T).argmax(1)
        centres = np.stack([weight[own == k] @ profile[own == k] if (own == k).any() else centres[k] for k in range(TONGUES)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1), 1e-12)[:, None]
    alike = centres @ centres.T > 0.75  # groups that only split a language are one
    own = alike.argmax(1)[own]
    share = np.stack([together[:, own == k].sum(1) / max(1e-12, together[:, own == k].sum()) for k in range(TONGUES)])
    share = share / np.maximum(share.sum(0), 1e-12)
    return {w: int(share[:, i].argmax()) for i, w in enumerate(common) if share[:, i].max() > 0.7}


def tongues(texts: list[list[bytes]], most: int = MOST_SHORT) -> dict[bytes, int]:
    """Classes of the commonest words of at most three bytes, by the texts they occur in together."""
    found = [_short(t) for t in texts]
    total = Counter()
    for f in found:
        total.update(f)
    common = [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:most]]
    return _classes(common, *_together([(list(f), list(f.values())) for f in found], common))


def corpus_tongues(texts: DataFrame, most: int = MOST_SHORT) -> dict[bytes, int]:
    """The same of all texts of a table; a matrix of fixed size reaches the driver."""
    def short(batches):
        for batch in batches:
            for b in slices(batch, "text", *SLICE):
                parts, owner = _split(b.column("text"))
                size = pc.binary_length(parts).to_numpy()
                few = (size > 0) & (size < 4)
                word = parts.filter(pa.array(few)).dictionary_encode()
                kinds = max(1, len(word.dictionary))
                pair, times = np.unique(owner[few] * kinds + word.indices.to_numpy(), return_counts=True)
                ends = pa.array(np.searchsorted(pair, np.arange(b.num_rows + 1) * kinds), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, word.dictionary.cast(pa.binary()).take(pa.array(pair % kinds))), pa.ListArray.from_arrays(ends, pa.array(times))],
                    ["words", "times"])

    found = stored(texts.select("text").mapInArrow(short, "words array<binary>, times array<bigint>").where(F.size("words") > 0), "short-words")
    total = found.select(F.explode(F.arrays_zip("words", "times")).alias("s")).groupBy(F.col("s.words").alias("word")).agg(F.sum("s.times").alias("n"))
    common = [bytes(r["word"]) for r in total.orderBy(F.desc("n"), "word").limit(most).collect()]

    def meet(batches):
        all_of, n = np.zeros((len(common), len(common))), 0
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                some = b.slice(i, 2000)
                more, k = _together(list(zip(some.column("words").to_pylist(), some.column("times").to_pylist())), common)
                all_of, n = all_of + more, n + k
        yield pa.RecordBatch.from_arrays([pa.array(range(len(common)), pa.int32()), pa.array([n] * len(common), pa.int64()), pa.array([r.tobytes() for r in all_of], pa.binary())],
                                         ["word", "texts", "row"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(r.as_py()) for r in group.column("row"))
        return pa.table({"word": pa.array([group.column("word")[0].as_py()], pa.int32()), "texts": pa.array([sum(group.column("texts").to_pylist())], pa.int64()),
                         "row": [total.tobytes()]})

    schema, together, n = "word int, texts bigint, row binary", np.zeros((len(common), len(common))), 0
    for r in found.mapInArrow(meet, schema).groupBy("word").applyInArrow(add, schema).collect():
        together[r["word"]], n = np.frombuffer(r["row"]), r["texts"]
    return _classes(common, together, n)


def _pair_rows(kind: np.ndarray, word: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), word, pa.array(n)], ["class", "word", "n"])


def _added(rows: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """Counts of the same pair as one row, in the order in which pairs come first."""
    table = pa.Table.from_batches(rows)
    total = table.append_column("at", pa.array(np.arange(len(table)))).group_by(["class", "word"], use_threads=False).aggregate([("n", "sum"), ("at", "min")])
    return total.take(pc.sort_indices(total["at_min"])).select(["class", "word", "n_sum"]).rename_columns(["class", "word", "n"]).combine_chunks().to_batches()


def _count_pairs(texts: DataFrame, classes: dict[bytes, int], most: int = 200_000) -> DataFrame:
    """How often each (class, word) occurs; in rows of the class ``RECALLED``, whose word is a step and whether the recall
    came true, how often that was.
    """
    def count(batches):
        worker_cache("none", dict)  # room for this step
        held, size, came = [], 0, np.zeros((len(RUNS) + 1) * 2, np.int64)
        for batch in batches:
            for b in slices(batch, "text", *SLICE):
                names, ids, kind, sizes = _numbered(b.column("text"), classes)
                step, hit = _recalls(ids, len(names), sizes)
                came += np.bincount((2 * step + hit)[step >= 0], minlength=len(came))
                pair = ids * CODES + kind
                times = np.bincount(pair)
                first = np.zeros(len(times), np.int64)
                first[pair[::-1]] = np.arange(len(pair))[::-1]
                at = np.flatnonzero(times)
                at = at[np.argsort(first[at])]  # as they come in the texts: what is learnt online depends on the order
                held.append(_pair_rows(at % CODES, names.take(pa.array(at // CODES)), times[at]))
                size += len(at)
                if size > 2 * most:
                    held = _added(held)
                    size = sum(h.num_rows for h in held)
                    if size > most:
                        yield from held
                        held, size = [], 0
        if held:
            yield from _added(held)
        code = np.flatnonzero(came)
        yield _pair_rows(np.full(len(code), RECALLED), pa.array([bytes(divmod(c, 2)) for c in code.tolist()], pa.binary()), came[code])
    return texts.mapInArrow(count, "class int, word binary, n bigint").groupBy("class", "word").agg(F.sum("n").alias("n"))


def _chances(recalled: DataFrame) -> np.ndarray:
    """The probability of each step of ``RUNS`` that a recall comes true."""
    out = np.full((len(RUNS) + 1, 2), 0.5)
    for r in recalled.collect():  # a row for each step and outcome
        out[tuple(bytes(r["word"]))] += r["n"]
    return out[:, 1] / out.sum(1)


def _byte_counts(pairs: DataFrame) -> np.ndarray:
    def count(batches):
        total = np.zeros(256)
        for b in batches:
            spelled = [w if w == END else w + b" " for w in b.column("word").to_pylist()]
            size = [len(s) for s in spelled]
            total += np.bincount(np.frombuffer(b"".join(spelled), np.uint8), np.repeat(b.column("n").to_numpy().astype(float), size), 256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["byte", "n"])
    out = np.zeros(256)
    for r in pairs.select("word", "n").mapInArrow(count, "byte bigint, n double").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        out[r["byte"]] = r["n"]
    return out


def _chunks(batch: pa.RecordBatch, most_bytes: int = 24_000):
    """(class, word) pairs and their counts, in chunks of bounded text."""
    pairs, n, size = [], [], 0
    for c, w, k in zip(batch.column("class").to_pylist(), batch.column("word").to_pylist(), batch.column("n").to_pylist()):
        pairs.append((c, w))
        n.append(k)
        size += len(w) + 1
        if size >= most_bytes:
            yield pairs, np.array(n, float)
            pairs, n, size = [], [], 0
    if pairs:
        yield pairs, np.array(n, float)


class Tables(NamedTuple):
    """Per predictor and slot what the counts of both branches say."""
    logits: list[np.ndarray]
    seen: list[np.ndarray]  # of the contexts in SEEN_BY, how often, in five steps
    counts: list[np.ndarray]  # [branch, slot], scaled to at most MOST_COUNT together, to take one occurrence away


MOST_COUNT = 30_000.0


def _scaled(counts: np.ndarray) -> np.ndarray:
    return (counts * np.minimum(1, MOST_COUNT / np.maximum(counts.sum(0), 1))).astype(np.float16)


def in_tables(counts: list[np.ndarray]) -> Tables:
    return Tables([_logit(c[0], c[1]).astype(np.float16) for c in counts], [_seen(counts[i].sum(0)) for i in SEEN_BY], [_scaled(c) for c in counts])


def _packed(block: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(block), codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, 2 * BLOCK * 4, codec="zstd"), np.float32)


def _tables(pairs: DataFrame, code: Code) -> Tables:
    """Counts over all pairs; tasks send blocks of their tables, blocks are summed."""
    first = np.cumsum([0, *[(1 << b) // BLOCK for b in BITS]])  # number of each table's first block

    def count(batches):
        total = None
        for batch in batches:
            for chunk, n in _chunks(batch):
                total = total or [np.zeros((2, 1 << b), np.float32) for b in BITS]
                slots, branch, owner, _ = spell(chunk, code)
                weight = n.astype(np.float32)[owner]
                for t, s in zip(total, slots):
                    np.add.at(t.reshape(-1), s + branch * t.shape[1], weight)
        for i, t in enumerate(total or ()):
            rows = [(int(first[i]) + b, _packed(part)) for b in range(t.shape[1] // BLOCK)
                    if (part := t[:, b * BLOCK:(b + 1) * BLOCK]).any()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(2 * BLOCK, np.float32)
        for raw in group.column("counts"):
            total += _unpacked(raw.as_py())
        return pa.table({"block": pa.array([group.column("block")[0].as_py()], pa.int32()), "counts": [_packed(total)]})

    schema = "block int, counts binary"
    out = Tables([np.zeros(1 << b, np.float16) for b in BITS], [np.zeros(1 << BITS[i], np.uint8) for i in SEEN_BY], [np.zeros((2, 1 << b), np.float16) for b in BITS])
    for r in pairs.mapInArrow(count, schema).groupBy("block").applyInArrow(add, schema).toLocalIterator():  # tables of fixed size
        i = int(np.searchsorted(first, r["block"], side="right")) - 1
        at = (r["block"] - int(first[i])) * BLOCK
        block = _unpacked(bytes(r["counts"])).reshape(2, BLOCK)
        out.logits[i][at:at + BLOCK] = _logit(*block)
        out.counts[i][:, at:at + BLOCK] = _scaled(block)
        if i in SEEN_BY:
            out.seen[SEEN_BY.index(i)][at:at + BLOCK] = _seen(block.sum(0))
    return out


def _logit(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + PRIOR) / (n0 + PRIOR)).astype(np.float32)


def _seen(n: np.ndarray) -> np.ndarray:
    out = (n >= 0.5).astype(np.uint8)
    for least in (1.5, 4.5, 20.5):
        out += n >= least
    return out


class Model(NamedTuple):
    code: Code
    logits: list[np.ndarray]  # per predictor and slot
    seen: list[np.ndarray]  # of the contexts in SEEN_BY, per slot: how often, in five steps
    weights: np.ndarray  # [gate, predictor]
    refined: np.ndarray  # [place in the byte's code, step of the logit]: probability

    def bits(self, pairs: list[tuple[int, bytes]]) -> np.ndarray:
        """log10 probability of each pair."""
        slots, branch, owner, place = spell(pairs, self.code)
        x = np.stack([self.logits[i].take(s) for i, s in enumerate(slots)]).astype(np.float32)
        gate = _gate([self.seen[k].take(slots[i]) for k, i in enumerate(SEEN_BY)])
        p = self.probability(x, gate, place)
        cost = np.log10(np.where(branch, p, 1 - p))
        ends = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
        sums = np.cumsum(cost, dtype=np.float64)[ends]
        return np.diff(sums, prepend=0.0)

    def probability(self, x: np.ndarray, gate: np.ndarray, place: np.ndarray) -> np.ndarray:
        z = np.clip(_mixed(self.weights, gate, x), -11.9, 11.9)
        p = 1 / (1 + np.exp(-z))
        at = (z + 12) * (self.refined.shape[1] - 1) / 24
        low = at.astype(np.int64)
        part = at - low
        cell = place * self.refined.shape[1] + low
        q = self.refined.take(cell) * (1 - part) + self.refined.take(cell + 1) * part
        return np.clip((p + q) / 2, 1e-6, 1 - 1e-6)


def _mixed(weights: np.ndarray, gate: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The predictors' logits, weighted as the gate says."""
    out = weights[:, 0].take(gate) * x[0]
    for w, more in zip(weights.T[1:], x[1:]):
        out += w.take(gate) * more
    return out


def _gate(steps: list[np.ndarray]) -> np.ndarray:
    out = steps[0].astype(np.int64)
    for s in steps[1:]:
        out = out * 5 + s
    return out


_FIRST, _SECOND = np.tril_indices(PREDICTORS)
_CELLS = np.zeros((PREDICTORS, PREDICTORS), np.int64)  # of a symmetric matrix, where its half is in these
_CELLS[_FIRST, _SECOND] = _CELLS[_SECOND, _FIRST] = np.arange(len(_FIRST))


class Learner:
    """Mixing weights and the probability map, learnt online from pairs of the corpus without one occurrence each.

    Every step moves a gate's weights by the error's gradient over the curvature gathered so far.
    """

    def __init__(self, code: Code, counts: list[np.ndarray]):
        self.code, self.both = code, [np.ascontiguousarray(c.T).view(np.uint32).ravel() for c in counts]  # a slot's two counts side by side
        self.steps = np.linspace(-12, 12, 49)
        self.weights = np.full((GATES, PREDICTORS), START)
        self.curvature = np.tile(STIFF * np.eye(PREDICTORS), (GATES, 1, 1))
        self.hits = np.zeros((16, 49))
        self.ones = np.zeros((16, 49))

    def feed(self, pairs: list[tuple[int, bytes]], n: np.ndarray, step: int = 4096, most_times: float = 1000.0) -> None:
        times = np.minimum(n, most_times)
        slots, branch, owner, place = spell(pairs, self.code)
        own1 = branch.astype(np.float32)
        x, steps = np.empty((PREDICTORS, len(branch)), np.float32), []
        for i, slot in enumerate(slots):
            n0, n1 = np.ascontiguousarray(self.both[i].take(slot).view(np.float16).reshape(-1, 2).T).astype(np.float32)
            x[i] = _logit(np.maximum(n0 - (1 - own1), 0), np.maximum(n1 - own1, 0))
            if i in SEEN_BY:
                steps.append(_seen(np.maximum(n0 + n1 - 1, 0)))
        gate = _gate(steps)
        for at in range(0, len(branch), step):
            cut = slice(at, at + step)
            g, y = gate[cut], x[:, cut].astype(np.float64)
            z = np.clip(_mixed(self.weights, g, y), -11.9, 11.9)
            p = 1 / (1 + np.exp(-z))
            w = times[owner[cut]]
            order = np.argsort(g.astype(np.uint8), kind="stable")
            met = g.take(order)
            starts = np.flatnonzero(np.append(True, met[1:] != met[:-1]))
            met, y = met[starts], y.take(order, axis=1)
            slope = np.add.reduceat(((branch[cut] - p) * w).take(order) * y, starts, axis=1).T
            bent = (p * (1 - p) * w).take(order) * y
            self.curvature[met] += np.add.reduceat(bent[_FIRST] * y[_SECOND], starts, axis=1)[_CELLS].transpose(2, 0, 1)
            self.weights[met] += np.linalg.solve(self.curvature[met], slope[:, :, None])[:, :, 0]
            cell = place[cut] * 49 + np.rint((z + 12) * 2).astype(int)
            self.hits += np.bincount(cell, w, self.hits.size).reshape(self.hits.shape)
            self.ones += np.bincount(cell, w * branch[cut], self.ones.size).reshape(self.ones.shape)

    def learnt(self) -> bytes:
        return b"".join(x.tobytes() for x in (self.weights, self.curvature, self.hits, self.ones))

    def join(self, learnt: list[bytes]) -> None:
        """What others have learnt from their shares: weights averaged by the curvature gathered, maps summed."""
        if not learnt:
            return
        edges = np.cumsum([self.weights.size, self.curvature.size, self.hits.size])
        pull, shapes = np.zeros((GATES, PREDICTORS, 1)), [x.shape for x in (self.weights, self.curvature, self.hits, self.ones)]
        self.curvature, self.hits, self.ones = (np.zeros(shape) for shape in shapes[1:])
        for raw in learnt:
            weights, curvature, hits, ones = (v.reshape(shape) for v, shape in zip(np.split(np.frombuffer(raw), edges), shapes))
            pull += curvature @ weights[:, :, None]
            self.curvature += curvature
            self.hits += hits
            self.ones += ones
        self.weights = np.linalg.solve(self.curvature, pull)[:, :, 0]

    def model(self, tables: Tables) -> Model:
        refined = (self.ones + 4 / (1 + np.exp(-self.steps))) / (self.hits + 4)
        return Model(self.code, tables.logits, tables.seen, self.weights.astype(np.float32), refined.astype(np.float32))


def learn(code: Code, counts: list[np.ndarray], pairs: list[tuple[int, bytes]], n: np.ndarray) -> Model:
    """A model learnt in one place."""
    tables = in_tables(counts)
    learner = Learner(code, tables.counts)
    for start in range(0, len(pairs), 5000):
        learner.feed(pairs[start:start + 5000], n[start:start + 5000])
    return learner.model(tables)


def corpus_learner(pairs: DataFrame, code: Code, tables: Tables) -> Learner:
    """What all pairs of the corpus teach: each task learns from its share."""
    shared = pairs.sparkSession.sparkContext.broadcast((code, tables.counts))

    def teach(batches):
        learner = None
        for batch in batches:
            for some, n in _chunks(batch, 40_000):
                learner = learner or Learner(*shared.value)
                learner.feed(some, n)
        if learner:
            yield pa.RecordBatch.from_arrays([pa.array([learner.learnt()], pa.binary())], ["learnt"])

    out = Learner(code, tables.counts)
    out.join([bytes(r["learnt"]) for r in pairs.mapInArrow(teach, "learnt binary").collect()])
    shared.destroy()
    return out


def _costs(model: Model, pairs: list[tuple[int, bytes]], most_bytes: int = 24_000) -> np.ndarray:
    """log10 probabilities, spelled in chunks of bounded text."""
    out, at, size = [], 0, 0
    for i, (_, w) in enumerate(pairs):
        size += len(w) + 1
        if size > most_bytes or i + 1 == len(pairs):
            out.append(model.bits(pairs[at:i + 1]))
            at, size = i + 1, 0
    return np.concatenate(out) if out else np.zeros(0)


def _by_word(pairs: list[tuple[int, bytes]]) -> tuple[pa.Array, np.ndarray]:
    """The pairs' different words, and the number of the pair of each word and class; that of no pair is ``len(pairs)``, also in a row more."""
    word = pa.array([w for _, w in pairs], pa.binary()).dictionary_encode()
    number = np.full((len(word.dictionary) + 1, CODES), len(pairs), np.int32)
    number[word.indices.to_numpy(), [c for c, _ in pairs]] = np.arange(len(pairs))
    return word.dictionary, number


SCORED = ("row bigint, doc_id bigint, n_tokens bigint, known bigint, plain double, score double, n_bytes bigint, "
          "rest array<struct<class:int,word:binary,times:bigint,spelled:bigint>>")


def score_documents(spark: SparkSession, docs: DataFrame, held_out: tuple[int, int] = (7, 2), head: int = 131_072) -> DataFrame:
    """Scores of every document; learnt from those whose ``crc32(id) mod n`` is not ``r``."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    out = F.coalesce(fold(F.col("doc_id"), held_out[0]) == held_out[1], F.lit(False))
    train = texts.where(F.col("doc_id").isNotNull() & ~out)
    classes = corpus_tongues(train)
    counted = stored(_count_pairs(train.select("text"), classes), "pairs")
    pairs, chances = counted.where(F.col("class") != RECALLED), _chances(counted.where(F.col("class") == RECALLED))
    counts = stored(pairs.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    code = huffman(_byte_counts(pairs))
    tables = _tables(pairs, code)
    model = corpus_learner(pairs, code, tables).model(tables)
    del tables
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(total["n"]), int(total["v"])
    frequent = pairs.where(F.length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "class", "word").limit(head).join(counts, "word").collect()
    kinds = [(r["class"], bytes(r["word"])) for r in frequent]
    base = np.log10((np.array([r["c"] for r in frequent], float) + 1) / (n + v + 1))
    known = spark.sparkContext.broadcast((*_by_word(kinds), np.append(base, 0.0), np.append(_costs(model, kinds), 0.0), classes, chances))
    shared = spark.sparkContext.broadcast(model)
    del frequent, kinds, base

    def score(batches):
        known_words, number, bases, costs, classes, chances = known.value
        worker_cache("none", dict)  # room for this step
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for b in slices(batch, "text", *SLICE):
                names, ids, kind, sizes = _numbered(b.column("text"), classes)
                starts = np.cumsum(sizes) - sizes
                step, hit = _recalls(ids, len(names), sizes)
                told = np.where(step >= 0, np.log10(np.where(hit, chances[step], 1 - chances[step])), 0.0)
                row_of = pc.fill_null(pc.index_in(names, value_set=known_words), len(known_words)).to_numpy()
                found = number[row_of[ids], kind]
                seen, base, cost = found < len(bases) - 1, bases[found], costs[found]
                add = lambda x: np.add.reduceat(x, starts)
                lost = np.flatnonzero(~seen)
                owner = np.repeat(np.arange(len(sizes)), sizes)[lost]
                codes = len(names) * CODES
                rest, which = np.unique(owner * codes + ids[lost] * CODES + kind[lost], return_inverse=True)
                text, code = np.divmod(rest, codes)
                ends = np.searchsorted(text, np.arange(len(sizes) + 1))
                lists = [pa.array(code % CODES, pa.int32()), names.take(pa.array(code // CODES)),
                         pa.array(np.bincount(which, minlength=len(rest)), pa.int64()),
                         pa.array(np.bincount(which, ~hit[lost], len(rest)).astype(np.int64), pa.int64())]
                rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(lists, ["class", "word", "times", "spelled"]))
                length = pc.binary_length(names).to_numpy().astype(np.int64)[ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(sizes))), b.column("doc_id"), pa.array(sizes), pa.array(add(seen.astype(np.int64))),
                     pa.array(add(base)), pa.array(add(np.where(hit, 0.0, cost) + told)), pa.array(add(length) + sizes - 1), rest],
                    ["row", "doc_id", "n_tokens", "known", "plain", "score", "n_bytes", "rest"])
                row += len(sizes)

    def spelled(batches):
        model = shared.value
        worker_cache("none", dict)
        for b in batches:
            if not b.num_rows:
                continue
            word = b.column("word").dictionary_encode()  # rows come by word
            kind, place = np.unique(word.indices.to_numpy().astype(np.int64) * 8 + b.column("class").to_numpy(), return_inverse=True)
            names = word.dictionary.to_pylist()
            costs = _costs(model, [(int(k) % 8, names[int(k) // 8]) for k in kind.tolist()])[place]
            c, times = b.column("c").to_numpy(), b.column("times").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(np.where(c > 0, times, 0)), pa.array(times * np.log10((c + 1) / (n + v + 1))), pa.array(b.column("spelled").to_numpy() * costs)],
                ["row", "more", "other", "cost"])

    scored = stored(texts.mapInArrow(score, SCORED), "scored")
    rest = scored.select("row", F.explode("rest").alias("r")).select("row", "r.class", "r.word", "r.times", "r.spelled")
    met = rest.join(counts, "word", "left").select("row", "class", "word", "times", "spelled", F.coalesce("c", F.lit(0)).alias("c"))
    looked_up = met.mapInArrow(spelled, "row bigint, more bigint, other double, cost double").groupBy("row").agg(
        F.sum("more").alias("more"), F.sum("other").alias("other"), F.sum("cost").alias("cost"))
    score_of = F.col("score") + F.coalesce("cost", F.lit(0.0))
    return scored.drop("rest").join(looked_up, "row", "left").select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), held_out[0]) == held_out[1], F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("plain") + F.coalesce("other", F.lit(0.0))).alias("base_score"), score_of.alias("score"),
        (-score_of * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
