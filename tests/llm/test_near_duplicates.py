import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stillwater.llm.common import words
from stillwater.llm.graph import connected_components
from stillwater.llm.near_duplicates import MinMax, components, shingle_set, without_near_duplicates

from .conftest import documents, prose


def brute(rows, k, percent=80):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] == rows[j][0] and sets[i] and sets[j]
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and (same or 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    low = {}
    for (i, _), x in zip(rows, label):
        low[x] = min(i, low.get(x, i))
    return sorted((i, len(s), low[x], i == low[x]) for (i, _), s, x in zip(rows, sets, label))


@pytest.fixture(scope="module")
def families():
    """Chains of edits (ends are not similar), exact copies and strangers."""
    draw, rows = random.Random(3), []
    for family in range(12):
        base = prose(120, family, 3000).split()
        for step in range(10):
            rows.append((draw.randrange(10 ** 6), " ".join(base)))
            for _ in range(draw.randint(0, 6)):
                base[draw.randrange(len(base))] = f"new{draw.randrange(10 ** 6)}"
    return rows + [(10 ** 7 + i, t) for i, (_, t) in enumerate(rows[:7])]


@pytest.mark.parametrize("shingle, rows", [(2, 5), (5, 5), (2, 2)])
def test_like_all_pairs(spark, families, shingle, rows):
    got = components(documents(spark, families), shingle=shingle, rows=rows).collect()
    assert sorted(map(tuple, got)) == brute(families, shingle)


def test_odd_rows(spark, odd, odd_rows, empty):
    got = components(odd, shingle=2).collect()
    assert [tuple(r)[2:] for r in got if r.doc_id is None] == [(None, True)]
    rows = [r for r in odd_rows if r[0] is not None]
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == brute(rows, 2)
    assert components(empty).count() == 0
    kept = without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 9]


def test_two_texts_of_one_id(spark):
    """Each text's links hold, whatever the order of the rows: 1 has the texts A and B, 2 is near A, 3 near B."""
    a, b = prose(100, 1, 3000), prose(100, 2, 3000)
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, prose(100, 3, 3000))]
    for order in (rows, rows[::-1], rows[1::-1] + rows[2:]):
        got = components(documents(spark, order), shingle=5).collect()
        assert sorted(map(tuple, got)) == brute(order, 5)
        assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 1, 4: 4}
        left = without_near_duplicates(documents(spark, order).withColumns({"_kept": F.lit(1), "_place": F.lit(2)}))
        assert sorted((r.doc_id, r.text) for r in left.collect()) == sorted([(1, min(a, b, key=lambda t: hashlib.md5(t.encode()).digest())), rows[4]])


def test_places_agree_as_often_as_sets_do():
    x, y = (np.unique(np.concatenate([shingle_set(prose(300, 1, 10 ** 6), 1), shingle_set(prose(n, s, 10 ** 6), 1)])) for n, s in ((100, 2), (100, 3)))
    alike = np.mean([np.mean(MinMax(100, 1, seed)(x) == MinMax(100, 1, seed)(y)) for seed in range(20)])
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs(alike - true) < 0.03


def test_components_of_long_ways(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(1000, 999), (999, 1000)], "a bigint, b bigint"))
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 999: 999, 1000: 999}
