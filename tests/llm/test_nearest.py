import numpy as np
import pytest
from pyspark.sql import functions as F

from stillwater.llm.nearest import Index, search


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "x") for i, v in rows],
                                 "vec_id bigint, embedding array<float>, code string, v string")


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(20, 24))
    x = (centres[draw.integers(0, 20, 1500)] + draw.normal(size=(1500, 24)) * 0.7).astype(np.float32)
    x *= draw.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    x[40:60] = x[40]  # ties
    return x


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 400, "block_queries": 30}])
def test_recall_and_scores(spark, vectors, blocks):
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [None] * 24), (5080, [1.0]), (None, [1.0] * 24), (5100, [float("inf")] * 24)]
    df = frame(spark, [*enumerate(vectors.tolist()), *odd])
    got = search(spark, df, F.col("vec_id") % 20 == 0, k=10, **blocks).collect()
    x, found = vectors.astype(float), {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        assert r.query_id != r.vec_id and abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-9
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert set(found) == set(range(0, 1500, 20)) and all(len(v) == 10 and v == sorted(v) for v in found.values())
    recall = []
    for q, v in found.items():
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(np.mean([-s >= np.sort(score)[-10] - 1e-9 for s, _ in v]))
    assert np.mean(recall) >= 0.9


def test_few_and_no_rows(spark, vectors):
    got = search(spark, frame(spark, [(0, vectors[0].tolist()), (1, vectors[1].tolist()), (2, vectors[2].tolist())]), F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id in (1, 2)) for r in got) == [(1, True), (2, True)]
    assert search(spark, frame(spark, []), F.col("vec_id") == 0).count() == 0
    assert search(spark, frame(spark, [(1, [1.0, 2.0])]), F.col("vec_id") == 0).count() == 0


def test_index_finds_every_code_within_the_radius():
    draw = np.random.default_rng(2)
    codes = draw.integers(0, 256, (400, 8), dtype=np.uint8)
    codes[200:] = codes[:200] ^ (1 << draw.integers(0, 8, (200, 8))).astype(np.uint8) * (draw.random((200, 8)) < 0.5)
    index = Index(codes)
    for radius in (0, 3, 7, 20, 64):
        for code in codes[:40]:
            want = np.flatnonzero(np.bitwise_count(codes ^ code).sum(1) <= radius)
            assert index.within(code, radius).tolist() == want.tolist()
