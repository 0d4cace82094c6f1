"""Removal of repeated byte strings by a distributed sort of suffixes.

A byte goes if it is covered by a string of ``length`` bytes that starts anywhere else, too, in the same or another text.

Which suffixes are sorted. Every position begins a gram of ``GRAM`` bytes with a hash. Of all grams in a stretch of
``length`` bytes the one of the smallest hash is the stretch's anchor; equal stretches have equal anchors at equal
places, so repeated stretches are found at repeated anchors. Anchors are rare (about two per stretch), and only the
suffixes behind anchors whose gram occurs elsewhere are sorted, with the bytes before them at hand.

The sort. Tasks hold the suffixes (``length`` bytes) of their texts and write sorted runs: per bucket of grams one row,
front-coded, that is each suffix as the length of the prefix it shares with the one before and the rest. Buckets are
merged by a tree of losers that keeps for every run the prefix length shared with the last output: of two suffixes the
one that shares more is smaller, and only if both share the same are bytes compared, from there on. So known prefixes
are never compared again, and the merge gives each suffix's common prefix with its neighbour for nothing.

Neighbours that share a gram form a group. Two of its members with ``l`` equal bytes before and ``r`` behind the anchor
share ``length`` bytes iff ``l + r >= length``, and then the bytes from ``l`` before to ``r`` behind go. Places of equal
surroundings are one kind from the start: they settle each other, only one of them is sorted, and what it learns goes back to all by
a join on the kind; so a line or passage that very many texts hold is sorted once for each different neighbourhood. Members are compared
with their neighbours in the order of suffixes and in the order of reversed prefixes, which settles nearly all of them. Groups of more
than ``hot`` kinds are not gathered: their stretches are hashed into rows and counted.

Equal texts are one text with a count from the start.

Where a number of ``words`` is given, bytes also go if they are covered by that many words, with the blanks between them,
that occur elsewhere. Such stretches of ``length`` bytes or more are found by the sort. Shorter ones have anchors of words in the
same way; those that hold a repeated anchor are hashed and compared among the anchor's places.

Defined results: a missing text is empty; rows with the same ``doc_id`` are texts of their own, so repeated rows are
repeats; an empty table gives no rows; columns other than ``text`` are kept by ``without_repeats``, which drops
characters that are cut inside and sets ``n_chars`` where there is such a column.
"""
from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import new_name, release_memory, slices, stored, text_key, worker_cache

GRAM = 64
GRAM_WORDS = 12
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_BYTES = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
SPANS = "array<struct<start:int,stop:int>>"


def window_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all stretches of ``size`` bytes along the last axis, by doubling; size of at least 2."""
    h, have = _BYTES[raw], 1
    while have * 2 <= size:
        h = _join(h[..., :-have], h[..., have:])
        have *= 2
    if have < size:
        h = _join(h[..., :h.shape[-1] - (size - have)], h[..., size - have:])
    return h


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _M[0] + b
    x ^= x >> np.uint64(29)
    x *= _M[1]
    x ^= x >> np.uint64(32)
    return x


def _sliding(best, x: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of every stretch of ``width`` values; shorter by ``width - 1``."""
    have = 1
    while have * 2 <= width:
        x = best(x[:-have], x[have:])
        have *= 2
    return best(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, anchor places and gram hashes of each text of at least ``length`` bytes; grouped for speed."""
    group, size = [], 0
    for i, t in enumerate(texts):
        if len(t) >= length:
            group.append(i)
            size += len(t)
        if group and (size >= 1 << 17 or i + 1 == len(texts)):
            yield from _anchors([texts[j] for j in group], group, length)
            group, size = [], 0
    if group:
        yield from _anchors([texts[j] for j in group], group, length)


def _anchors(texts: list[bytes], numbers: list[int], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    width = length - GRAM + 1
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    h = window_hashes(np.frombuffer(b"".join(texts), np.uint8), GRAM)
    least = _sliding(np.minimum, h, width)  # of the stretch that starts here
    inside = np.ones(len(least), bool)
    for end in ends[:-1].tolist():
        inside[max(0, end - length + 1):end] = False  # it would go on into the next text
    least = np.where(inside, least, np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    found = np.flatnonzero(_sliding(np.maximum, padded, width) == h)
    owner = np.searchsorted(ends, found, side="right")
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if b > a:
            yield numbers[i], found[a:b] - (ends[i] - sizes[i]), h[found[a:b]].view(np.int64)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differ = int.from_bytes(x) ^ int.from_bytes(y)
    return known + (8 * len(x) - differ.bit_length()) // 8


def front_code(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Sorted suffixes as shared prefix lengths and rests."""
    shared = [0, *map(common_prefix, suffixes, suffixes[1:])] if suffixes else []
    return shared, [s[n:] for s, n in zip(suffixes, shared)]


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, bytes, int]]:
    """Merges front-coded sorted runs: run, place in it, suffix, and the prefix shared with the suffix given before."""
    k = 1
    while k < len(runs):
        k *= 2
    now: list[bytes | None] = [None] * k  # None: at its end, larger than all
    shared, at = [0] * k, [0] * k
    for i, (lengths, rests) in enumerate(runs):
        if rests:
            now[i] = rests[0]

    def play(i: int, j: int) -> tuple[int, int]:
        """Winner (the smaller) and loser; the loser then knows what it shares with the winner."""
        if now[i] is None or now[j] is None:
            return (j, i) if now[i] is None else (i, j)
        if shared[i] != shared[j]:
            return (i, j) if shared[i] > shared[j] else (j, i)
        n = common_prefix(now[i], now[j], shared[i])
        a, b = now[i], now[j]
        first = (n >= len(a), n < len(b) and n < len(a) and a[n] < b[n])
        if first[0] or first[1]:
            shared[j] = n
            return i, j
        shared[i] = n
        return j, i

    losers = [0] * k
    winners = list(range(k))
    level = k
    while level > 1:
        level //= 2
        games = [play(winners[2 * x], winners[2 * x + 1]) for x in range(level)]
        winners = [w for w, _ in games]
        for x, (_, loser) in enumerate(games):
            losers[level + x] = loser
    best = winners[0]
    while now[best] is not None:
        yield best, at[best], now[best], shared[best]
        at[best] += 1
        lengths, rests = runs[best]
        if at[best] < len(rests):
            n = lengths[at[best]]
            now[best] = now[best][:n] + rests[at[best]]
            shared[best] = n
        else:
            now[best] = None
        node = (best + k) // 2
        while node:
            winner, losers[node] = play(best, losers[node])
            best = winner
            node //= 2


def extents(members: list[tuple[bytes, bytes]], length: int, few: int = 20_000) -> list[tuple[int, int] | None]:
    """For each member (bytes before, bytes from the anchor on): how far before and behind the anchor bytes go, or None.

    Members are of one gram. The stretches that hold it and occur with another member are all from the leftmost to the
    rightmost one; these ends are given. No member shares more bytes behind the anchor than a neighbour in the order of
    suffixes, and none more bytes before it than a neighbour in the order of reversed prefixes: where these neighbours
    reach that far with enough on the other side, nothing is left to do. The few other members are compared with all, or,
    if that makes more than ``few`` pairs, the group's starts are hashed.
    """
    classes: dict[tuple[bytes, bytes], list[int]] = defaultdict(list)
    for i, m in enumerate(members):
        classes[m].append(i)
    kinds = list(classes)
    back = [k[0][::-1] for k in kinds]
    reach: list[tuple[int, int] | None] = [None] * len(kinds)
    most_before, most_behind = [0] * len(kinds), [0] * len(kinds)

    def widen(c: int, before: int, behind: int) -> None:
        if before + behind >= length:
            old = reach[c] or (0, 0)
            reach[c] = (max(old[0], before), max(old[1], behind))

    def meet(i: int, j: int) -> tuple[int, int]:
        before, behind = common_prefix(back[i], back[j]), common_prefix(kinds[i][1], kinds[j][1])
        widen(i, before, behind)
        widen(j, before, behind)
        return before, behind

    for c, kind in enumerate(kinds):
        if len(classes[kind]) > 1:
            widen(c, len(kind[0]), len(kind[1]))
            most_before[c], most_behind[c] = len(kind[0]), len(kind[1])
    for order, most_of, side in ((sorted(range(len(kinds)), key=lambda c: kinds[c][1]), most_behind, 1),
                                 (sorted(range(len(kinds)), key=back.__getitem__), most_before, 0)):
        for i, j in zip(order, order[1:]):
            shared = meet(i, j)[side]
            most_of[i], most_of[j] = max(most_of[i], shared), max(most_of[j], shared)
    unsettled = [c for c in range(len(kinds)) if most_before[c] + most_behind[c] >= length and reach[c] != (most_before[c], most_behind[c])]
    if len(unsettled) * len(kinds) <= few:
        for i in unsettled:
            for j in range(len(kinds)):
                if i != j:
                    meet(i, j)
    else:
        most = length - GRAM
        raw = np.zeros((len(kinds), most + length), np.uint8)
        before, behind = (np.array([len(k[s]) for k in kinds]) for s in (0, 1))
        for c, (x, y) in enumerate(kinds):
            raw[c, most - len(x):most] = np.frombuffer(x, np.uint8)
            raw[c, most:most + len(y)] = np.frombuffer(y, np.uint8)
        left, right = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        width = min(most + 1, max(16, 4_000_000 // len(kinds)))
        for low in range(0, most + 1, width):  # starts this far from the left, as many at a time as memory allows
            h = np.concatenate([window_hashes(raw[i:i + 512, low:low + width + length - 1], length) for i in range(0, len(kinds), 512)])
            for x in range(h.shape[1]):
                start = most - (low + x)  # bytes before the anchor
                fits = np.flatnonzero((before >= start) & (behind >= length - start))
                column = h[fits, x]
                order = np.argsort(column)
                same = column[order[1:]] == column[order[:-1]]
                twice = fits[order[np.append(same, False) | np.append(False, same)]] if len(fits) else fits
                left[twice] = np.maximum(left[twice], start)
                right[twice] = np.maximum(right[twice], length - start)
        for c in np.flatnonzero(right).tolist():
            widen(c, int(left[c]), int(right[c]))
    out: list[tuple[int, int] | None] = [None] * len(members)
    for c, kind in enumerate(kinds):
        for i in classes[kind]:
            out[i] = reach[c]
    return out


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


PLACE = ["gram", "content", "key", "place", "before", "behind"]
ANCHOR = "gram bigint, content bigint, key binary, place int, before int, behind int, times int"


def _content(piece: bytes, before: int) -> int:
    """Stands for an anchor's surroundings: the same bytes with the anchor at the same place."""
    return xxhash.xxh3_64_intdigest(piece, before)


def _anchor_batch(keys: list[bytes], times: list[int], found: list[tuple[int, list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows of anchors, per text with some: its number, and their contents, grams, places and how far their surroundings reach before and behind."""
    owner = np.repeat(np.array([f[0] for f in found], np.int64), [len(f[1]) for f in found])
    content = np.array([c for f in found for c in f[1]], np.uint64).view(np.int64)
    gram, place, before, behind = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(2, 6))
    return pa.RecordBatch.from_arrays(
        [pa.array(gram), pa.array(content), pa.array(keys, pa.binary()).take(pa.array(owner)),
         *(pa.array(v.astype(np.int32)) for v in (place, before, behind, np.array(times, np.int64)[owner]))], [*PLACE, "times"])


def _different(part: pa.RecordBatch) -> tuple[list[bytes], list[bytes], list[int]]:
    """Keys and bytes of the different texts, and how often each is there."""
    raws, times = {}, Counter(keys := part.column("_key").to_pylist())
    for key, raw in zip(keys, _bytes(part.column("text"))):
        raws.setdefault(key, raw)
    return list(raws), list(raws.values()), [times[k] for k in raws]


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """Anchors with what stands for the ``length - GRAM`` bytes before them and the ``length`` bytes from them on."""
    def find(batches):
        worker_cache("none", dict)  # room for this operator
        release_memory()
        for b in batches:
            for part in slices(b, "text", 500, 4 << 20):
                (keys, raws, times), rows = _different(part), []
                for i, places, grams in anchors(raws, length):
                    raw, before, behind = raws[i], np.minimum(places, length - GRAM), np.minimum(len(raws[i]) - places, length)
                    rows.append((i, [_content(raw[p - x:p + y], x) for p, x, y in zip(places.tolist(), before.tolist(), behind.tolist())], grams, places, before, behind))
                yield _anchor_batch(keys, times, rows)
    return texts.mapInArrow(find, ANCHOR)


KEY_BITS = 24


def _flagged(rows: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """The rows with a column ``name`` that is true where ``key`` is one of ``keys``, and for few others.

    Told by ``2 ** KEY_BITS`` bits set by hash address, which go to the rows as broadcast blocks of 4096 bytes.
    """
    def at(value: str) -> Column:
        return F.xxhash64(value).bitwiseAND(F.lit((1 << KEY_BITS) - 1)) + 1  # blocks and bits are counted from 1

    block, bits = new_name(rows, "_block"), new_name(rows, "_bits")
    blocks = keys.groupBy(F.bitmap_bucket_number(at("key")).alias(block)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at("key"))).alias(bits))
    place = F.bitmap_bit_position(at(key)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1))
    met = rows.withColumn(block, F.bitmap_bucket_number(at(key))).join(F.broadcast(blocks), block, "left")
    return met.withColumn(name, F.coalesce(bit == 1, F.lit(False))).select(*rows.columns, name)


def _with_texts(texts: DataFrame, which: DataFrame) -> DataFrame:
    per_text = which.groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.struct("gram", "content", "place", "same")).alias("anchors"))
    return texts.join(per_text, "_key")


def _per_text(batches) -> Iterator[tuple[bytes, bytes, list[dict]]]:
    """Key, bytes and anchors of each text, copies of a text once as far as they follow each other."""
    last = None
    for b in batches:
        for key, text, found in zip(b.column("_key").to_pylist(), b.column("text").to_pylist(), b.column("anchors").to_pylist()):
            if key != last:
                yield key, text.encode(), found
            last = key


def _kinds(rows: DataFrame, name: str, n: Column) -> tuple[DataFrame, DataFrame]:
    """Anchors whose gram occurs elsewhere, and their kinds: one place for all of a gram with the same surroundings.

    Of a kind ``same`` is the number of its places, ``kinds`` how many kinds its gram has. ``n`` is what rows of the same place
    count. All of it is told where the rows of a gram meet: anchors are shuffled once and not stored before they are known to repeat.
    """
    of_gram, of_kind = Window.partitionBy("gram"), Window.partitionBy("gram", "content")
    places = rows.repartition("gram").groupBy(*PLACE).agg(n.alias("n"))
    repeated = places.withColumn("_all", F.sum("n").over(of_gram)).where("_all > 1")
    told = repeated.withColumn("same", F.sum("n").over(of_kind)).withColumn("_one", F.row_number().over(of_kind.orderBy("key", "place", "before", "behind")) == 1)
    known = stored(told.withColumn("kinds", F.count_if("_one").over(of_gram)).select(*PLACE, "same", "kinds", "_one"), f"repeated-{name}")
    return known, stored(known.where("_one").drop("_one"), f"kinds-of-{name}")


REACH = "gram bigint, content bigint, before int, behind int"


def _members(known: DataFrame, reach: DataFrame) -> DataFrame:
    """What goes around a kind goes around each of its places."""
    far = reach.groupBy("gram", "content").agg(F.max("before").alias("_before"), F.max("behind").alias("_behind"))
    return known.join(far, ["gram", "content"]).select("key", (F.col("place") - F.col("_before")).alias("start"), (F.col("place") + F.col("_behind")).alias("stop"))


RUN = "bucket bigint, shared array<int>, rests array<binary>, before array<binary>, grams array<bigint>, contents array<bigint>"


def _runs(placed: DataFrame, length: int, buckets: int, hold: int) -> DataFrame:
    """``text, anchors`` (grams and places) to front-coded sorted runs."""
    types = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()))
    names = ["bucket", "shared", "rests", "before", "grams", "contents"]

    def sort(batches):
        def write():
            for bucket in list(held):
                rows = sorted(held.pop(bucket))
                shared, rests = front_code([r[0] for r in rows])
                cells = (bucket, shared, rests, [r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows])
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], names)

        held: dict[int, list[tuple[bytes, bytes, int, int]]] = defaultdict(list)
        n = 0
        for _, raw, found in _per_text(batches):
            for a in found:
                p = a["place"]
                held[a["gram"] % buckets].append((raw[p:p + length], raw[max(0, p - length + GRAM):p], a["gram"], a["content"]))
            n += len(found)
            if n >= hold:
                yield from write()
                n = 0
        yield from write()
    return placed.mapInArrow(sort, RUN)


def _merged(runs: DataFrame, length: int) -> DataFrame:
    """Runs of a bucket to how far its groups tell that bytes go."""
    def merge(group: pa.Table) -> pa.Table:
        columns = {n: group.column(n).to_pylist() for n in ("shared", "rests", "before", "grams", "contents")}
        out: tuple[list, list, list, list] = ([], [], [], [])
        members: dict[tuple[int, int], tuple[bytes, bytes]] = {}

        def close() -> None:
            if len(members) > 1:
                for (gram, content), reach in zip(members, extents(list(members.values()), length)):
                    if reach:
                        for values, v in zip(out, (gram, content, *reach)):
                            values.append(v)
            members.clear()

        for run, i, suffix, shared in merge_runs(list(zip(columns["shared"], columns["rests"]))):
            if shared < GRAM:
                close()
            members[columns["grams"][run][i], columns["contents"][run][i]] = (columns["before"][run][i], suffix)
        close()
        columns.clear()
        release_memory()
        return _reach_table(*out)
    return runs.groupBy("bucket").applyInArrow(merge, REACH)


def _reach_table(gram: list, content: list, before: list, behind: list) -> pa.Table:
    return pa.table({"gram": pa.array(gram, pa.int64()), "content": pa.array(content, pa.int64()),
                     "before": pa.array(before, pa.int32()), "behind": pa.array(behind, pa.int32())})


STRETCH = "hash bigint, key binary, start int, gram bigint, content bigint, same bigint, before int, behind int"


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """The reach that ``rows`` tell, one for each stretch around an anchor: a stretch that occurs twice goes.

    A place of which several anchors tell the same stretch is one place.
    """
    rows = stored(rows.distinct(), name)
    places = rows.groupBy("hash", "key", "start").agg(F.max("same").alias("same"))
    twice = places.groupBy("hash").agg(F.sum("same").alias("n")).where("n > 1").select("hash")
    return rows.join(twice, "hash").select("gram", "content", "before", "behind")


def _hot_spans(placed: DataFrame, length: int) -> DataFrame:
    """How far bytes go around anchors of grams of very many kinds: the hashes of their stretches, counted as rows."""
    def spread(batches):
        for key, raw, found in _per_text(batches):
            wide = np.frombuffer(raw, np.uint8)
            for a in found:
                p = a["place"]
                low = max(0, p - length + GRAM)
                piece = wide[low:p + length]
                if len(piece) >= length:
                    h = window_hashes(piece, length).view(np.int64)
                    start = np.arange(low, low + len(h), dtype=np.int32)
                    same = [pa.repeat(pa.scalar(a[n], pa.int64()), len(h)) for n in ("gram", "content", "same")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array([key] * len(h), pa.binary()), pa.array(start), *same, pa.array(p - start, pa.int32()),
                         pa.array(start + (length - p), pa.int32())], ["hash", "key", "start", "gram", "content", "same", "before", "behind"])
    return _counted(placed.mapInArrow(spread, STRETCH), "stretches")


def word_edges(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of all words."""
    blank = np.concatenate([[True], _BLANK[np.frombuffer(raw, np.uint8)], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[::2], edges[1::2]


def word_anchors(raw: bytes, count: int, below: int) -> list[tuple[int, int, int, int, int]]:
    """Anchors of all stretches of ``count`` words that are shorter than ``below`` bytes: gram, content, place (byte), and how many
    bytes before and behind it the stretches that hold the gram reach.
    """
    found = _word_anchors(raw, count, below)
    if found is None:
        return []
    contents, grams, *rest = found
    return list(zip(grams.tolist(), contents, *(v.tolist() for v in rest)))


def _word_anchors(raw: bytes, count: int, below: int) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """The same as columns, contents first; None if there are none."""
    starts, stops = word_edges(raw)
    last = len(starts) - count
    if last < 0:
        return None
    short = stops[count - 1:] - starts[:last + 1] < below
    if not short.any():
        return None
    size = min(GRAM_WORDS, count)
    width = count - size + 1
    inside = _sliding(np.maximum, np.concatenate([np.zeros(width - 1, bool), short, np.zeros(width - 1, bool)]), width)
    h = np.full(len(inside), _NONE)
    at = np.flatnonzero(inside)
    h[at] = _stretch_hashes(raw, starts[at], stops[at + size - 1])
    least = np.where(short, _sliding(np.minimum, h, width), np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    found = np.flatnonzero(inside & (_sliding(np.maximum, padded, width) == h))
    every = np.arange(last + 1)
    first = np.minimum.accumulate(np.where(short, every, last)[::-1])[::-1]  # of the short stretches from here on, and up to here
    final = np.maximum.accumulate(np.where(short, every, 0))
    place, low = starts[found], starts[first[np.maximum(0, found - width + 1)]]
    high = stops[final[np.minimum(found, last)] + count - 1]
    before, behind = place - low, high - place
    contents = [_content(raw[p - x:p + y], x) for p, x, y in zip(place.tolist(), before.tolist(), behind.tolist())]
    return contents, h[found].view(np.int64), place, before, behind


_powers = np.ones((2, 1), np.uint64)  # of an odd number and its inverse


def _stretch_hashes(raw: bytes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of many stretches of a text, as differences of running sums; the same for equal bytes, wherever they stand."""
    global _powers
    if _powers.shape[1] < len(raw):
        more = np.ones((2, 2 * len(raw)), np.uint64)
        for row, m in zip(more, (int(_M[0]), pow(int(_M[0]), -1, 1 << 64))):
            row[1:] = m
        _powers = np.multiply.accumulate(more, axis=1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[np.frombuffer(raw, np.uint8)] * _powers[0, :len(raw)], dtype=np.uint64)])
    return _join((sums[stop] - sums[start]) * _powers[1, start], (stop - start).astype(np.uint64))


def word_stretches(raw: bytes, places: list[int], count: int, below: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per anchor the hashes, starts and stops of the stretches that hold its gram."""
    ends, *told = _word_stretches(raw, np.array(places), count, below)
    return list(zip(*(np.split(v, ends[1:-1]) for v in told)))


def _word_stretches(raw: bytes, places: np.ndarray, count: int, below: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same of all anchors one behind the other, and where each one's begin and the last one's end."""
    starts, stops = word_edges(raw)
    word = np.searchsorted(starts, places)
    first = np.maximum(0, word - (count - min(GRAM_WORDS, count)))
    size = np.minimum(word, len(starts) - count) + 1 - first
    owner = np.repeat(np.arange(len(places)), size)
    at = np.arange(len(owner)) + np.repeat(first - (np.cumsum(size) - size), size)
    short = stops[at + count - 1] - starts[at] < below
    at, owner = at[short], owner[short]
    different, which = np.unique(at, return_inverse=True)
    x, y = starts[different], stops[different + count - 1]
    h = np.array([xxhash.xxh3_64_intdigest(raw[p:q]) for p, q in zip(x.tolist(), y.tolist())], np.uint64).view(np.int64)
    return np.searchsorted(owner, np.arange(len(places) + 1)), h[which], x[which].astype(np.int32), y[which].astype(np.int32)


def repeated_stretches(members: list[tuple[bytes, int, np.ndarray, np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
    """Of members (text's key, how many places are the same, hashes, starts and stops of stretches) those with a stretch that occurs
    twice: their number, and start and stop of the bytes in such stretches.
    """
    number: dict[bytes, int] = {}
    text = np.array([number.setdefault(m[0], len(number)) for m in members])
    return _repeated(text, np.array([m[1] for m in members]), np.array([len(m[2]) for m in members]), *(np.concatenate([m[i] for m in members]) for i in (2, 3, 4)))


def _repeated(text: np.ndarray, same: np.ndarray, size: np.ndarray, h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int, int]]:
    """The same of numbered texts, with the number of each member's stretches and all stretches one behind the other."""
    owner = np.repeat(np.arange(len(size)), size)
    if not len(h):
        return []
    order = np.argsort(h)
    again = h[order[1:]] == h[order[:-1]]
    often = order[np.append(again, False) | np.append(False, again) | (same[owner[order]] > 1)]  # all others occur once
    if not len(often):
        return []
    h, start, stop, owner = (v[often] for v in (h, start, stop, owner))
    text, same = text[owner], same[owner]
    order = np.lexsort((-same, start, text, h))  # a place that two anchors tell is one
    h, start, stop, owner, text, same = (v[order] for v in (h, start, stop, owner, text, same))
    other = np.append(True, h[1:] != h[:-1])
    first = other | np.append(True, (text[1:] != text[:-1]) | (start[1:] != start[:-1]))
    kind = np.cumsum(other) - 1
    twice = np.bincount(kind, np.where(first, same, 0))[kind] > 1
    low, high = np.full(len(size), np.iinfo(np.int32).max), np.full(len(size), -1)
    np.minimum.at(low, owner[twice], start[twice])
    np.maximum.at(high, owner[twice], stop[twice])
    return [(i, int(low[i]), int(high[i])) for i in np.flatnonzero(high >= 0).tolist()]


AROUND = "bucket bigint, gram bigint, content bigint, key binary, place int, same bigint, hashes array<bigint>, starts array<int>, stops array<int>"


def _word_kinds(texts: DataFrame, count: int, below: int) -> tuple[DataFrame, DataFrame]:
    """Repeated anchors of the stretches of ``count`` words shorter than ``below`` bytes, and their kinds; equal texts repeat each other.

    Of all grams of ``GRAM_WORDS`` words in a stretch the one of the smallest hash is its anchor.
    """
    def find(batches):
        release_memory()
        for b in batches:
            for part in slices(b, "text", 500, 4 << 20):
                keys, raws, times = _different(part)
                yield _anchor_batch(keys, times, [(i, *found) for i, raw in enumerate(raws) if (found := _word_anchors(raw, count, below))])
    return _kinds(texts.mapInArrow(find, ANCHOR), "word-anchors", F.sum("times"))


def _word_spans(texts: DataFrame, known: DataFrame, kinds: DataFrame, count: int, below: int, hot: int, per_bucket: int) -> DataFrame:
    """The repeated stretches of ``count`` words among those shorter than ``below`` bytes.

    Only the stretches that hold an anchor whose gram occurs elsewhere are hashed, once for each kind of surroundings; those of a
    gram meet in one bucket. Grams of more than ``hot`` kinds are not gathered: their stretches are counted as rows.
    """
    reach = kinds.where("same > 1").select("gram", "content", "before", "behind")
    several = kinds.where("kinds > 1")
    size = several.agg(F.count("*").alias("n"), F.max("kinds").alias("most")).first()
    buckets = max(1, -(-size["n"] // per_bucket))

    def around(batches):
        for key, raw, found in _per_text(batches):
            for i in range(0, len(found), 2000):
                some = found[i:i + 2000]
                ends, *told = _word_stretches(raw, np.array([a["place"] for a in some]), count, below)
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a["gram"] % buckets for a in some]), *(pa.array([a[n] for a in some], pa.int64()) for n in ("gram", "content")),
                     pa.array([key] * len(some), pa.binary()), pa.array([a["place"] for a in some], pa.int32()), pa.array([a["same"] for a in some], pa.int64()),
                     *(pa.ListArray.from_arrays(ends, pa.array(t)) for t in told)],
                    ["bucket", "gram", "content", "key", "place", "same", "hashes", "starts", "stops"])

    def meet(group: pa.Table) -> pa.Table:
        text = group.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
        lists = [pc.list_flatten(group.column(n).combine_chunks()).to_numpy() for n in ("hashes", "starts", "stops")]
        found = _repeated(text, group.column("same").to_numpy(), pc.list_value_length(group.column("hashes").combine_chunks()).to_numpy(), *lists)
        lists.clear()
        release_memory()
        gram, content, place = (group.column(n).to_pylist() for n in ("gram", "content", "place"))
        return _reach_table([gram[i] for i, _, _ in found], [content[i] for i, _, _ in found], [place[i] - x for i, x, _ in found], [y - place[i] for i, _, y in found])

    reach = reach.unionByName(_with_texts(texts, several.where(F.col("kinds") <= hot)).mapInArrow(around, AROUND).groupBy("bucket").applyInArrow(meet, REACH))
    if (size["most"] or 0) > hot:
        told = _with_texts(texts, several.where(F.col("kinds") > hot)).mapInArrow(around, AROUND)
        rows = told.withColumn("s", F.explode(F.arrays_zip("hashes", "starts", "stops")))
        reach = reach.unionByName(_counted(rows.select(
            F.col("s.hashes").alias("hash"), "key", F.col("s.starts").alias("start"), "gram", "content", "same",
            (F.col("place") - F.col("s.starts")).alias("before"), (F.col("s.stops") - F.col("place")).alias("behind")), "word-stretches"))
    return _members(known, reach)


def spans(docs: DataFrame, length: int = 400, hot: int = 100_000, per_bucket: int = 20_000, hold: int = 40_000,
          words: int | None = None) -> DataFrame:
    """``_key`` (of the text) and ``_spans`` (bytes to remove, overlapping ones unmerged) of texts with repeats.

    With ``words`` each span also says whether only so many words tell it (``by_words``).
    """
    least = min(length, 2 * words - 1) if words else length  # both ways read the same texts, which are then shuffled once for both
    texts = docs.select(text_key(F.col("text")).alias("_key"), "text").where(F.octet_length("text") >= least)
    copies = texts.where(F.octet_length("text") >= length).groupBy("_key").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("size")).where("n > 1")
    known, kinds = _kinds(_anchor_rows(texts, length), "anchors", F.max(F.lit(1)))
    reach = kinds.where((F.col("same") > 1) & (F.col("before") + F.col("behind") >= length)).select("gram", "content", "before", "behind")
    several = kinds.where("kinds > 1")
    keys = several.select("key")
    if words:
        of_words = _word_kinds(texts, words, length)
        keys = keys.unionByName(of_words[1].where("kinds > 1").select("key"))
    sought = _flagged(texts, "_key", keys, "_sought").where("_sought").drop("_sought")
    size = several.agg(F.count("*").alias("n"), F.max("kinds").alias("most")).first()
    runs = _runs(_with_texts(sought, several.where(F.col("kinds") <= hot)), length, max(1, -(-size["n"] // per_bucket)), hold)
    reach = reach.unionByName(_merged(runs, length))
    if (size["most"] or 0) > hot:
        reach = reach.unionByName(_hot_spans(_with_texts(sought, several.where(F.col("kinds") > hot)), length))
    found = _members(known, reach)
    found = found.unionByName(copies.select(F.col("_key").alias("key"), F.lit(0).alias("start"), F.col("size").alias("stop")))
    if words:
        found = found.withColumn("by_words", F.lit(False)).unionByName(
            _word_spans(sought, *of_words, words, length, hot, per_bucket).withColumn("by_words", F.lit(True)))
    columns = [c for c in found.columns if c != "key"]
    return stored(found.groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.struct(*columns)).alias("_spans")), "spans")


def merged_spans(found: list[dict] | None) -> list[tuple[int, int]]:
    """Disjoint spans that do not touch."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in found or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept(raw: bytes, away: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for span in away for x in span], len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _marked(docs: DataFrame, length: int, found: str = "_spans", **how) -> DataFrame:
    """The rows with the spans to remove from their text, in a column of that name.

    Only rows whose text may have spans are shuffled to them.
    """
    key, may = new_name(docs, "_text_key"), new_name(docs, "_may_have")
    by_text = spans(docs, length, **how).select(F.col("_key").alias(key), F.col("_spans").alias(found))
    rows = _flagged(docs.withColumn(key, text_key(F.col("text"))), key, by_text.select(F.col(key).alias("key")), may)
    met = rows.where(F.col(may)).join(by_text, key, "left")
    whole = rows.where(~F.col(may)).withColumn(found, F.lit(None).cast(by_text.schema[found].dataType))
    return met.select(*docs.columns, found).union(whole.select(*docs.columns, found))


def removal_report(docs: DataFrame, length: int = 400, words: int | None = None, **how) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of documents.

    With ``words`` also ``n_in_passages``, the bytes in passages of ``length`` bytes or so many words that occur elsewhere, of which
    those below ``length`` bytes are told but not removed.
    """
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["n_in_passages"] if words else [])]

    def report(batches):
        for b in batches:
            rows = []
            for raw, found in zip(_bytes(b.column("text")), b.column("_spans").to_pylist()):
                away = merged_spans([s for s in found or () if not s.get("by_words")])
                told = merged_spans(found) if words else []
                rows.append((len(raw), sum(y - x for x, y in away), len(away), hashlib.sha256(kept(raw, away)).hexdigest(), sum(y - x for x, y in told)))
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, t) for c, t, _ in zip(columns, types, names)]], ["doc_id", *names])
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", n_in_passages bigint" if words else "")
    return _marked(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), length, words=words, **how).mapInArrow(report, schema)


def without_repeats(docs: DataFrame, length: int = 400, **how) -> DataFrame:
    """The documents with their columns, repeated bytes taken out of ``text``."""
    mark = new_name(docs, "_spans")

    def cut(batches):
        for b in batches:
            texts = [t if not found else kept(t.encode(), merged_spans(found)).decode(errors="ignore")
                     for t, found in zip(b.column("text").to_pylist(), b.column(mark).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == "text" else b.column(n) for n in b.schema.names if n != mark],
                [n for n in b.schema.names if n != mark])
    out = _marked(docs, length, mark, **how).mapInArrow(cut, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
