import hashlib
import random
import re
from collections import defaultdict

import pytest

from stillwater.llm.repeats import common_prefix, extents, front_code, merge_runs, removal_report, repeated_stretches, without_repeats, word_anchors, word_edges, word_stretches

from .conftest import documents


def covered(texts, length):
    seen = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            seen[t[p:p + length]].append((i, p))
    out = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                out[i][p:p + length] = b"\1" * length
    return out


def report(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), t, away in zip(rows, raw, covered(raw, length)):
        kept = bytes(x for x, a in zip(t, away) if not a)
        out.append((i, len(t), sum(away), len([s for s in bytes(away).split(b"\0") if s]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def patched():
    """Texts glued together of passages of one source, so that repeats begin and end anywhere."""
    draw = random.Random(4)
    source = "".join(draw.choices("abcdefgh é", k=3000))
    rows = []
    for i in range(60):
        t = ""
        for _ in range(draw.randint(0, 4)):
            a = draw.randint(0, 2900)
            t += source[a:a + draw.randint(20, 300)] + "".join(draw.choices("xyzw", k=draw.randint(0, 80)))
        rows.append((i, t + "q" * draw.choice([0, 0, 0, 170])))
    return rows + [(100, rows[3][1]), (None, rows[5][1]), (3, rows[3][1]), (7, None), (8, "")]


@pytest.mark.parametrize("how", [{}, {"hot": 1}, {"per_bucket": 5, "hold": 10}])
def test_like_all_strings(spark, patched, how):
    got = removal_report(documents(spark, patched), 100, **how).collect()
    assert sorted(map(tuple, got), key=str) == report(patched, 100)


def test_odd_rows(spark, odd, odd_rows, empty):
    assert sorted(map(tuple, removal_report(odd, 400).collect()), key=str) == report(odd_rows, 400)
    assert removal_report(empty, 400).count() == 0
    left = without_repeats(odd, 400)
    assert left.columns == odd.columns
    texts = sorted(((r.doc_id, r.text, r.n_chars) for r in left.collect()), key=str)
    away = {5, 8}
    assert texts == sorted(((i, "" if i in away else t, None if t is None else 0 if i in away else len(t)) for i, t in odd_rows), key=str)


def test_merge_never_looks_back():
    draw = random.Random(1)
    for _ in range(100):
        runs = [sorted(bytes(draw.choices(b"ab", k=draw.randint(0, 12))) for _ in range(draw.randint(0, 8))) for _ in range(draw.randint(1, 7))]
        got = list(merge_runs([front_code(r) for r in runs]))
        assert [s for _, _, s, _ in got] == sorted(s for r in runs for s in r)
        assert all(runs[run][i] == s for run, i, s, _ in got)
        assert all(shared == common_prefix(a, s) for (_, _, a, _), (_, _, s, shared) in zip(got, got[1:]))


def test_large_groups_like_small_ones():
    draw = random.Random(2)
    gram = bytes(draw.choices(b"abc", k=64))
    members = [(bytes(draw.choices(b"ab", k=2)) * draw.randint(0, 18), gram + bytes(draw.choices(b"ab", k=1)) * draw.randint(0, 36)) for _ in range(80)]
    assert extents(members, 100, few=0) == extents(members, 100, few=10 ** 9)


def by_words(texts, count):
    """What is left without the stretches of so many words that occur twice."""
    places = defaultdict(list)
    for i, t in enumerate(texts):
        found = [m.span() for m in re.finditer(r"\S+", t)]
        for (a, _), (_, b) in zip(found, found[count - 1:]):
            places[t[a:b]].append((i, a, b))
    away = [bytearray(len(t)) for t in texts]
    for where in places.values():
        if len(where) > 1:
            for i, a, b in where:
                away[i][a:b] = b"\1" * (b - a)
    return sorted("".join(c for c, x in zip(t, gone) if not x) for t, gone in zip(texts, away))


def test_short_words(spark):
    import corpus_pipeline
    draw = random.Random(9)
    some = lambda n: " ".join("".join(draw.choices("abcdefgh", k=draw.choice((1, 2)))) for _ in range(n))
    over, under, copy = some(51), some(50), some(55)
    assert len(over) < 250
    texts = [f"{some(30)} {over}\n{some(30)}", f"{over} {some(9)}", f"{some(20)} {under} {some(20)}", f"{under} {some(7)}", copy, copy,
             f"{some(5)} {over}", some(300), some(20)]
    docs = documents(spark, enumerate(texts))
    left = {r.doc_id: r.text for r in corpus_pipeline.without_repeats(spark, docs, "").collect()}
    assert over not in left[0] and over not in left[1] and under in left[2] and under in left[3] and not {4, 5} & set(left)
    assert left[7] == texts[7] and left[8] == texts[8]
    assert sorted(r.text for r in without_repeats(docs, 250, words=51).collect()) == by_words(texts, 51)


@pytest.mark.parametrize("how", [{}, {"hot": 1}, {"per_bucket": 3}])
def test_word_passages_like_all_stretches(spark, how):
    """Few words, blanks of many kinds, repeats inside one text: what goes is what all stretches tell."""
    draw = random.Random(12)
    blank = lambda: draw.choice([" ", " ", " ", "\n", "  "])
    source = [draw.choice("abcdefgh") + blank() for _ in range(400)]
    texts = ["".join("".join(source[a:a + draw.randint(5, 40)]) + "".join(draw.choice("xyz") + " " for _ in range(draw.randint(0, 9)))
                     for a in draw.choices(range(360), k=draw.randint(1, 4))) for _ in range(40)]
    texts += ["e f " * 60, texts[3], texts[4] + "a", "é" * 30 + " a b c"]
    left = without_repeats(documents(spark, enumerate(texts)), 2000, words=20, **how)
    assert sorted(r.text for r in left.collect()) == by_words(texts, 20)


def test_a_passage_of_many_texts_gives_few_rows():
    """A row per anchor and text, not one per stretch: a passage of 120 words has 70 stretches of 51."""
    draw = random.Random(6)
    some = lambda n: " ".join("".join(draw.choices("abcdefgh", k=2)) for _ in range(n))
    passage = some(120)
    texts = [f"{some(59)} a{i} {passage} b{i} {some(59)}".encode() for i in range(30)]
    anchors = [word_anchors(t, 51, 250) for t in texts]
    shared = set.intersection(*({g for g, *_ in found} for found in anchors))
    assert 2 <= len(shared) <= 15
    members = [(t, 1, *s) for t, found in zip(texts, anchors) for s in word_stretches(t, [p for g, _, p, *_ in found if g in shared], 51, 250)]
    assert len(members) < 30 * 15
    found = repeated_stretches(members)
    for t in texts:
        mine = [(a, b) for i, a, b in found if members[i][0] == t]
        at = t.index(passage.encode())
        assert (min(a for a, _ in mine), max(b for _, b in mine)) == (at, at + len(passage))
    assert len(word_edges(texts[0])[0]) == 240


def test_lines_in_a_row_are_few_kinds(spark, monkeypatch):
    """A line that many texts hold many times makes no rows per stretch: its places are few kinds."""
    from stillwater.llm import repeats
    counts, stored = {}, repeats.stored

    def count(df, name):
        out = stored(df, name)
        counts[name] = out.count()
        return out
    monkeypatch.setattr(repeats, "stored", count)
    draw = random.Random(7)
    some = lambda n: "".join(draw.choices("abcdefgh", k=n))
    line = some(40) + " " + some(39) + "\n"
    rows = [(i, some(150) + line * 40 + some(150)) for i in range(20)]
    got = removal_report(documents(spark, rows), 100, hot=500).collect()
    assert sorted(map(tuple, got), key=str) == report(rows, 100)
    assert counts["kinds-of-anchors"] < counts["repeated-anchors"] / 5 and "stretches" not in counts


def test_report_tells_short_passages(spark):
    """A passage of over 50 words below 400 bytes stays in the text, as the contract has it, and is told."""
    draw = random.Random(8)
    some = lambda n: " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))
    passage = some(53)
    assert len(passage) < 400
    texts = [f"{some(70)} {passage} {some(70)}", f"{passage} {some(90)}", some(200), some(30), None, ""]
    got = sorted(removal_report(documents(spark, enumerate(texts)), 400, words=51).collect())
    assert [r.n_removed for r in got] == [0] * 6
    assert [r.n_in_passages for r in got] == [len(passage), len(passage), 0, 0, 0, 0]


def test_anchors_are_shuffled_once(spark, monkeypatch):
    """What repeats is told where the anchors of a gram meet, and only texts with such anchors are shuffled."""
    from stillwater.llm import repeats
    seen, stored = {}, repeats.stored

    def look(df, name):
        seen[name] = df._jdf.queryExecution().toString()
        return stored(df, name)
    monkeypatch.setattr(repeats, "stored", look)
    draw = random.Random(10)
    some = lambda n: " ".join("".join(draw.choices("abcdefgh", k=4)) for _ in range(n))
    passage = some(60)
    texts = [f"{some(90)} {passage} {some(90)}", f"{passage} {some(99)}", *[some(150) for _ in range(20)], None, ""]
    rows = list(enumerate(texts))
    got = removal_report(documents(spark, rows), 200, words=51).drop("n_in_passages").collect()
    assert sorted(map(tuple, got), key=str) == report(rows, 200)
    assert not {"anchors", "word-anchors"} & set(seen)
    for name in ("repeated-anchors", "repeated-word-anchors"):
        assert seen[name].partition("== Physical Plan ==")[2].count("Exchange hashpartitioning") == 1
    keys = spark.createDataFrame([(bytes([i] * 16),) for i in range(0, 200, 2)], "key binary")
    every = spark.createDataFrame([(bytes([i] * 16),) for i in range(200)], "key binary")
    may_have = {bytes(r.key)[0] for r in repeats._flagged(every, "key", keys, "_bits").where("_bits").collect()}
    assert set(range(0, 200, 2)) <= may_have and len(may_have) < 110


def test_stretches_and_anchors_as_columns():
    """Columns of all anchors tell what each anchor by itself tells, and only stretches that occur twice are sorted by all keys."""
    import numpy as np

    from stillwater.llm.repeats import _anchor_batch, _repeated, _word_anchors, _word_stretches
    draw = random.Random(6)
    words = [f"w{i}".encode() for i in range(9)]
    texts = [b" ".join(draw.choices(words, k=n)) + b" " + b"x" * n for n in (3, 60, 200, 200, 90)]
    assert _word_anchors(texts[0], 51, 250) is None and _anchor_batch([], [], []).num_rows == 0
    for raw in texts[1:]:
        contents, grams, place, before, behind = _word_anchors(raw, 51, 250)
        assert list(zip(grams.tolist(), contents, place.tolist(), before.tolist(), behind.tolist())) == word_anchors(raw, 51, 250)
        starts, stops = (x.tolist() for x in word_edges(raw))
        ends, h, first, last = _word_stretches(raw, place, 51, 250)
        for i, p in enumerate(place.tolist()):
            w, told = starts.index(p), slice(ends[i], ends[i + 1])
            want = [(starts[j], stops[j + 50]) for j in range(max(0, w - 39), min(w, len(starts) - 51) + 1) if stops[j + 50] - starts[j] < 250]
            assert list(zip(first[told].tolist(), last[told].tolist())) == want and len(h[told]) == len(want)
    for seed in range(30):
        draw = random.Random(seed)
        members = [(draw.choice("abc"), draw.choice([1, 1, 1, 2]), *(np.array([draw.randrange(4) for _ in range(n)], np.int64) for _ in range(2))) for n in draw.choices(range(4), k=6)]
        places, want = defaultdict(dict), []
        for key, same, h, x in members:
            for a, b in zip(h.tolist(), x.tolist()):
                places[a][key, b] = max(same, places[a].get((key, b), 0))
        for i, (*_, h, x) in enumerate(members):
            away = [b for a, b in zip(h.tolist(), x.tolist()) if sum(places[a].values()) > 1]
            want += [(i, min(away), max(away) + 5)] if away else []
        number = np.array(["abc".index(m[0]) for m in members])
        flat = [np.concatenate([m[k] for m in members]) for k in (2, 3)]
        got = _repeated(number, np.array([m[1] for m in members]), np.array([len(m[2]) for m in members]), *flat, flat[1] + 5)
        assert got == want == repeated_stretches([(*m, m[3] + 5) for m in members])
    none = np.zeros(0, np.int64)
    assert _repeated(np.array([0]), np.array([1]), np.array([0]), none, none, none) == _repeated(np.array([0]), np.array([1]), np.array([1]), *np.ones((3, 1), np.int64)) == []
