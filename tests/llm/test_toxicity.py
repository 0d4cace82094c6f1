import itertools
import random

import numpy as np
import pytest

from stillwater.llm.toxicity import fit, marginals, score_documents, tag

from .conftest import documents, prose


def test_marginals_like_all_labelings():
    draw = np.random.default_rng(0)
    sizes, chain = [1, 5, 2, 7], draw.normal(size=(2, 2))
    e = draw.normal(size=sum(sizes))
    first = np.zeros(len(e), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    want, at = [], 0
    for n in sizes:
        weight, hit = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(e[at + i] * y[i] for i in range(n)) + sum(chain[a, b] for a, b in zip(y, y[1:])))
            weight, hit = weight + w, hit + w * np.array(y)
        want += list(hit / weight)
        at += n
    assert np.allclose(marginals(e, first, chain), want)
    assert len(marginals(e[:0], first[:0], chain)) == 0


@pytest.fixture(scope="module")
def corpus(spark):
    draw, rows, labels = random.Random(5), [], []
    for i in range(600):
        w, bad = prose(60, i % 40, 300).split(), i % 3 == 0
        for _ in range(4 * bad):
            w[draw.randrange(60)] = draw.choice(["rotter", "scoundrel,", "Zlubaa", "zlubbee", "zlubcii"])
        rows.append((i, " ".join(w)))
        if i % 2 == 0 or i > 300:
            labels.append((i, 1, int(bad), "x"))
    labels += [(None, 1, 1, "x"), (3, 1, None, "x")]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")


def test_held_out_documents(spark, corpus):
    docs, labels = corpus
    got = score_documents(spark, docs, labels).collect()
    assert len(got) == 600 and all((r.score >= 0.5) == (r.predicted == 1) for r in got)
    assert np.mean([(r.doc_id % 3 == 0) == r.predicted for r in got]) > 0.97
    hot = next(r for r in tag(spark, docs, fit(docs, labels)).where("doc_id = 300").collect())
    words = [hot.text.encode()[s.start:s.stop].decode().lower() for s in hot.tox_spans]
    assert words and all(w.startswith(("rotter", "scoundrel", "zlub")) for w in words)


def test_odd_rows(spark, corpus, odd, odd_rows, empty):
    model = fit(*corpus)
    got = tag(spark, odd, model)
    assert got.columns == [*odd.columns, "tox_score", "tox_spans"]
    scores = {r.doc_id: r.tox_score for r in got.collect()}
    assert len(scores) == len({i for i, _ in odd_rows}) and scores[1] == scores[2] == scores[3] < 0.5
    assert tag(spark, empty, model).count() == 0
    assert fit(corpus[0], corpus[1].where("toxic = 0")) is None
    assert {(r.score, r.predicted) for r in score_documents(spark, odd, corpus[1].limit(0)).collect()} == {(0.0, 0)}


def test_large_and_repeated_labelled_texts(spark, corpus):
    docs, labels = corpus
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    # more than the bound: every one, one id many times, or all texts of a class
    huge = documents(spark, [*rows, *[(i, prose(40_000, 3)) for i in range(1000, 1012)]])
    marked = labels.unionByName(spark.createDataFrame([(i, 1, i % 2, "x") for i in range(1000, 1012)], labels.schema))
    again = documents(spark, [*rows, *[(1000, prose(60, 3, 300))] * 3000])
    for more in (huge, again):
        model = fit(more, marked, sample_bytes=100_000)
        assert model is not None
        found = [(r.doc_id % 3 == 0) == (r.tox_score >= 0.5) for r in tag(spark, docs, model).collect()]
        assert np.mean(found) > 0.9
    only = labels.where("toxic = 0").unionByName(spark.createDataFrame([(i, 1, 1, "x") for i in range(1000, 1012)], labels.schema))
    assert fit(huge, only, sample_bytes=100_000) is not None
    assert fit(docs, labels, sample=2) is not None


def test_driver_gets_the_model_alone(spark, corpus, monkeypatch):
    from stillwater.llm import toxicity

    docs, labels = corpus[:2]
    want = fit(docs, labels)
    monkeypatch.setattr(toxicity, "train", None)  # of this process; tasks import their own
    monkeypatch.setattr(toxicity, "words", None)
    got = fit(docs, labels)
    assert all(np.array_equal(a, b) for a, b in zip(want, got)) and got.chain.shape == (2, 2) and got.weights.any()
