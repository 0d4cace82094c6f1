import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stillwater.llm.collocations import collocations, compact, phrase_counts, word_hash

from .conftest import SCHEMA, prose


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, None, *["x"] * 9) for i, (t, lang) in enumerate(rows)], SCHEMA)


def grams(rows):
    count, total = defaultdict(Counter), Counter()
    for t, lang in rows:
        lang = "und" if lang is None else lang
        t = (t or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\x0A-\x0D]", t):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                count[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return count, total


def brute(rows, least, top):
    out = []
    count, total = grams(rows)
    for lang, f in count.items():
        often = {p: n for p, n in f.items() if n >= least and len(p) > 1}
        inside = {q[i:i + k] for q, n in often.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if f[q[i:i + k]] == n}
        found = []
        for p, a in often.items():
            if p in inside:
                continue
            score, _, left, right = min((1000 * a * total[lang] // (f[p[:j]] * f[p[j:]]), j, f[p[:j]], f[p[j:]]) for j in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, total[lang], -score) for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    phrases = ["Over the hills and far away we go", "ring a ring a ring a", "one Two three", "été ÉTÉ naïve"]
    out = []
    for i in range(120):
        parts = []
        for _ in range(draw.randint(0, 12)):
            parts.append(draw.choice(phrases) if draw.random() < 0.4 else prose(draw.randint(1, 9), draw.randrange(30), 25))
        out.append((draw.choice([" ", ". ", "\n", " ,\t"]).join(parts), draw.choice(["en", "fr", None])))
    return out + [("so so so so so so so so so so", "en"), ("lead in the same boiler plate line that goes on and on for ever", "de")] * 9


@pytest.mark.parametrize("least, top, filters", [(4, 2000, {}), (9, 5, {"words_power": 4, "grams_power": 5}), (2, 50, {"grams_power": 12}), (10 ** 6, 9, {})])
def test_like_plain_counting(spark, rows, least, top, filters):
    """Whatever the filters let through."""
    assert result(collocations(docs(spark, rows), least, top, **filters)) == brute(rows, least, top)


def test_every_count(spark, rows):
    counts, total = phrase_counts(docs(spark, rows), 3)
    want, words = grams(rows)
    assert result(counts) == sorted((lang, len(p), " ".join(p), n) for lang, f in want.items() for p, n in f.items() if n >= 3)
    assert dict(result(total)) == dict(words)


def test_unary_ways_become_one_path(spark):
    way = [f"w{i}" for i in range(700)]
    edges = [("en", 5, " ".join(way[i:i + 5]), 7) for i in range(696)] + [("en", 5, "x w0 w1 w2 w3", 3), ("en", 5, "y w0 w1 w2 w3", 4)]
    rings = [("en", 5, "o o o o o", 9), ("en", 5, "p q p q p", 8), ("en", 5, "q p q p q", 8)]
    ends = [("en", 4, " ".join(way[-4:]), 7), ("en", 4, "r q p q", 1)]
    paths, single = compact(spark.createDataFrame(edges + rings + ends, "lang string, k int, gram string, n bigint"), 4)
    got, single = paths.collect(), single.collect()
    long = sorted((r for r in got if r.starts > 1), key=lambda r: -r.starts)
    assert [(r.starts, len(r.path), r.n) for r in long] == [(256, 260, 7), (256, 260, 7), (184, 188, 7)]
    assert {w for r in long for w in r.path} == set(way)
    assert len(got) == 3 and sorted(r.gram for r in single) == sorted(g for _, _, g, _ in edges[-2:] + rings)


def test_filters_hash_alike(spark):
    row = spark.createDataFrame([("fr", "été")], "lang string, word string").select(F.xxhash64(F.concat("lang", F.lit("\0"), "word")).alias("h")).first()
    assert row.h % (1 << 64) == word_hash("fr", "été".encode())


def test_odd_rows(spark, odd_rows, empty):
    rows = [(t, None if i is None else "" if i == 9 else "xx") for i, t in odd_rows] * 3
    for least in (1, 3, 6):
        assert result(collocations(docs(spark, rows), least)) == brute(rows, least, 2000)
    assert collocations(empty).count() == 0


def test_large_products_stay_exact(spark):
    from stillwater.llm.collocations import cut_score
    big = 10 ** 12 + 39
    got = spark.createDataFrame([(big, big + 2, big + 4, 10 ** 15 + 7)], "a bigint, l bigint, r bigint, n bigint").select(cut_score()).first()[0]
    assert got == 1000 * big * (10 ** 15 + 7) // ((big + 2) * (big + 4))


def test_a_task_hands_on_each_gram_once(spark, rows):
    """Counts of a task's walks are summed before they leave it, whatever it may hold."""
    import pyarrow as pa

    from stillwater.llm.collocations import _summed
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array([2, 2, 3], pa.int32()), pa.array(["a b", "b c", "a b c"]), pa.array([1, 2, 3])], ["lang", "k", "gram", "n"])
    for most, times in ((1 << 19, 1), (3, 3), (8, 1)):
        found = pa.Table.from_batches(_summed(iter([batch] * 6), most)).to_pylist()
        assert len(found) == 3 * times
        assert sum(r["n"] for r in found if r["gram"] == "b c") == 12
    assert list(_summed(iter([]), 9)) == []
