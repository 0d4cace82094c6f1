import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stillwater.llm.common import words
from stillwater.llm.lm_score import BITS, END, RUNS, SEEN_BY, Learner, _gate, corpus_learner, corpus_tongues, huffman, in_tables, learn, recalls, score_documents, spell, tongues

from .conftest import documents, prose


def base(rows):
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if i is not None and not out(i) for w in [*words(t), END])
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        tokens = [*words(t), END]
        yield i, out(i), len(tokens), sum(c[w] > 0 for w in tokens), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)


@pytest.mark.parametrize("head", [131_072, 20])
def test_base_like_counting(spark, odd, odd_rows, head):
    got = sorted(((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in score_documents(spark, odd, head=head).collect()))
    assert got == sorted((i or 0, h, a, b, n, round(s, 6)) for i, h, a, b, n, s in base(odd_rows))


def test_better_than_the_base_on_new_texts(spark, empty):
    names = [prose(40, s, 40).split() for s in (1, 2, 3)]  # three languages, told by their short words
    draw = random.Random(9)
    rows = [(i, " ".join(x for _ in range(100) for x in (f"l{i % 3}", draw.choice(names[i % 3]) + draw.choice(names[i % 3])))) for i in range(400)]
    got = [r for r in score_documents(spark, documents(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) and all(r.score < 0 and r.bits_per_byte > 0 for r in got)
    assert score_documents(spark, empty).count() == 0


def test_probabilities_of_a_byte_sum_to_one():
    code = huffman(np.arange(256.0))
    pairs = [(1, bytes([b])) for b in range(33, 127)]
    counts = [np.random.default_rng(i).integers(0, 9, (2, 1 << b)).astype(np.float32) for i, b in enumerate(BITS)]
    model = learn(code, counts, pairs, np.ones(len(pairs)))
    total = 0.0
    for b in range(256):  # the first byte of a word, spelled alone
        s, br, ow, pl = spell([(3, bytes([b]))], code)
        n = code.length[b]
        x = np.stack([model.logits[i][v[:n]] for i, v in enumerate(s)]).astype(np.float32)
        p = model.probability(x, _gate([model.seen[k][s[i][:n]] for k, i in enumerate(SEEN_BY)]), pl[:n])
        total += float(np.prod(np.where(br[:n], p, 1 - p)))
    assert abs(total - 1) < 1e-4


def test_short_words_get_the_language_they_live_in():
    draw = random.Random(3)
    texts = [[draw.choice([f"a{i % 3}", f"b{i % 3}", f"c{i % 3}", "xyz"]).encode() for _ in range(40)] for i in range(60)]
    classes = tongues(texts)
    assert b"xyz" not in classes and tongues(texts[:2]) == {}
    for group in "012":
        assert len({classes.get(f"{x}{group}".encode()) for x in "abc"}) <= 2
    assert len(set(classes.values())) >= 3


def test_recalls_like_looking_back():
    draw = random.Random(5)
    docs = [[(0, draw.choice("abcd").encode()) for _ in range(n)] for n in (1, 2, 3, 0, 40, 400)]
    docs = [[*d, (0, END)] for d in docs] + [[(0, b"x"), (0, b"y"), (0, b"z")] * 20]
    step, hit = recalls(docs)
    want = []
    for d in docs:
        run = 0
        for i, (_, w) in enumerate(d):
            earlier = [j for j in range(2, i) if d[j - 2:j] == d[i - 2:i]] if i >= 2 else []
            right = bool(earlier) and d[earlier[-1]][1] == w
            want.append((sum(run >= r for r in RUNS) if earlier else -1, right))
            run = run + 1 if right else 0
    assert list(zip(step.tolist(), hit.tolist())) == want
    assert [len(x) for x in recalls([[(0, END)]])] == [1, 1]


def test_order_and_repeats_count(spark):
    """The same words in another order are another text, and a text that repeats itself costs little more than once."""
    draw = random.Random(2)
    vocabulary = prose(300, 7, 300).split()
    rows = []
    for i in range(300):
        line = [draw.choice(vocabulary) for _ in range(30)]
        rows.append((i, " ".join(line * (3 if i % 2 else 1))))
    once = [draw.choice(vocabulary) for _ in range(60)]
    mixed = once * 3
    draw.shuffle(mixed)
    rows += [(1000, " ".join(once)), (1001, " ".join(once * 3)), (1002, " ".join(mixed))]
    got = {r.doc_id: r.score for r in score_documents(spark, documents(spark, rows)).collect()}
    assert got[1001] > 1.3 * got[1000] and got[1002] < 2 * got[1001]


def test_classes_come_from_all_texts(spark):
    """Also from more than 1000 texts, and from texts of more than 20 kB, in which alone some words occur."""
    draw = random.Random(4)
    names = {g: [f"{x}{g}" for x in "abcd"] for g in "012"}
    rows = [(i, " ".join(draw.choice(names["01"[i % 2]]) for _ in range(20))) for i in range(1200)]
    rows += [(2000 + i, " ".join(draw.choice(names["2"]) for _ in range(8000))) for i in range(8)]
    docs = documents(spark, rows).repartition(5)
    classes = corpus_tongues(docs)
    assert len({classes[w.encode()] for w in names["2"]}) == 1 and not {classes[w.encode()] for w in names["2"]} & {classes[w.encode()] for w in names["0"] + names["1"]}
    assert classes == tongues([words(t) for _, t in rows])


def test_weights_come_from_all_pairs(spark):
    """Whatever the tasks, each decision of each pair is learnt from; pairs of all lengths."""
    draw = random.Random(8)
    pairs = [(draw.randint(0, 6), "".join(draw.choices("abcdef", k=draw.choice([1, 3, 8, 100]))).encode()) for _ in range(3000)]
    n = [draw.choice([1, 2, 5, 3000]) for _ in pairs]
    code = huffman(np.arange(256.0))
    tables = in_tables([np.random.default_rng(i).integers(0, 9, (2, 1 << b)).astype(np.float32) for i, b in enumerate(BITS)])
    rows = spark.createDataFrame([(c, w, k) for (c, w), k in zip(pairs, n)], "class int, word binary, n bigint")
    *_, owner, _ = spell(pairs, code)
    for parts in (1, 4):
        got = corpus_learner(rows.repartition(parts), code, tables)
        assert got.hits.sum() == np.minimum(np.array(n), 1000)[owner].sum()
    alone = Learner(code, tables.counts)
    alone.feed(pairs, np.array(n, float))
    joined = Learner(code, tables.counts)
    joined.join([alone.learnt()])
    assert np.allclose(joined.weights, alone.weights) and np.allclose(joined.curvature, alone.curvature)


@pytest.mark.parametrize("head", [131_072, 3])
def test_scores_do_not_depend_on_the_head(spark, odd, odd_rows, head):
    rows = odd_rows + [(100 + i, f"a word{i % 3} and a word{i % 5} a word{i % 3}") for i in range(40)]
    got = sorted((r.doc_id or 0, r.n_tokens, round(r.score, 3)) for r in score_documents(spark, documents(spark, rows), head=head).collect())
    assert got == sorted((r.doc_id or 0, r.n_tokens, round(r.score, 3)) for r in score_documents(spark, documents(spark, rows), head=50).collect())


def test_numbered_places_are_the_keys():
    """Places told by arrays, a slice of texts at once, are the pairs and recalls of the texts one by one; no pair is made per place."""
    from stillwater.llm.lm_score import keys, numbered, recalls
    draw = random.Random(3)
    classes = {b"a": 0, b"b": 1, b"cc": 2, b"dddd": 3}
    for _ in range(30):
        texts = [" ".join(draw.choices(["A", "b", "cc", "dddd", "e", "long"], k=draw.randint(0, 30))) for _ in range(draw.randint(1, 9))] + [None, "", "a b a b a b", " \n ", "É\u00a0x\x1cy\x0b\x0cZ a  É"]
        names, ids, kind, sizes = numbered(pa.array(texts, pa.string()), classes)
        docs = [keys(t, classes) for t in texts]
        assert [(k, names[i]) for i, k in zip(ids.tolist(), kind.tolist())] == [p for d in docs for p in d] and sizes.tolist() == list(map(len, docs))
        step, hit = recalls(docs)
        at, out = 0, []
        for d in docs:  # the plain way: what followed the same two words last in this text
            followed: dict = {}
            for i, (_, w) in enumerate(d):
                two = tuple(x for _, x in d[i - 2:i]) if i >= 2 else None
                out.append((two in followed, followed.get(two) == w))
                if two:
                    followed[two] = w
        assert [(bool(s >= 0), bool(h)) for s, h in zip(step, hit)] == out


def test_pairs_are_summed_in_the_order_of_the_texts():
    import pyarrow as pa

    from stillwater.llm.lm_score import _added, _by_word, _pair_rows
    draw = random.Random(4)
    rows = [[(draw.randrange(7), bytes([draw.randrange(97, 123)] * draw.randint(1, 3)), draw.randint(1, 9)) for _ in range(3000)] for _ in range(3)]
    want: dict = {}
    for c, w, n in (r for some in rows for r in some):
        want[c, w] = want.get((c, w), 0) + n
    batches = [_pair_rows(np.array([r[0] for r in some]), pa.array([r[1] for r in some], pa.binary()), np.array([r[2] for r in some])) for some in rows]
    got = pa.Table.from_batches(_added(batches)).to_pydict()
    assert list(zip(zip(got["class"], got["word"]), got["n"])) == list(want.items())
    pairs = list(want)[:40]
    words, number = _by_word(pairs)
    words = words.to_pylist()
    assert all(number[words.index(w), c] == i for i, (c, w) in enumerate(pairs))
    assert (number < len(pairs)).sum() == len(pairs) and (number[-1] == len(pairs)).all()
    assert _by_word([])[1].shape == (1, 8)


def test_gates_learn_like_one_by_one():
    """What a step gathers for the gates that it meets is what each decision tells."""
    from stillwater.llm import lm_score as m
    draw = random.Random(3)
    pairs = [(draw.randrange(7), bytes(draw.choices(range(97, 105), k=draw.randint(1, 6)))) for _ in range(300)]
    n = np.array([float(draw.randint(1, 1500)) for _ in pairs])
    code = m.huffman(np.ones(256))
    slots, branch, owner, place = m.spell(pairs, code)
    counts = [np.zeros((2, 1 << b), np.float32) for b in m.BITS]
    for t, s in zip(counts, slots):
        np.add.at(t, (branch.astype(int), s), n[owner].astype(np.float32))
    counts = m.in_tables(counts).counts
    learner = m.Learner(code, counts)
    learner.feed(pairs, n, step=len(branch))
    curvature, slope = np.tile(m.STIFF * np.eye(m.PREDICTORS), (m.GATES, 1, 1)), np.zeros((m.GATES, m.PREDICTORS))
    for i, b in enumerate(branch.tolist()):
        seen = [[max(float(c[k, s[i]]) - (k == b), 0) for k in (0, 1)] for c, s in zip(counts, slots)]
        x = np.array([np.log((one + m.PRIOR) / (zero + m.PRIOR)) for zero, one in seen])
        gate = 0
        for k in m.SEEN_BY:
            gate = gate * 5 + sum(sum(seen[k]) >= least for least in (0.5, 1.5, 4.5, 20.5))
        p, w = 1 / (1 + np.exp(-np.clip(m.START * x.sum(), -11.9, 11.9))), min(n[owner[i]], 1000)
        curvature[gate] += p * (1 - p) * w * np.outer(x, x)
        slope[gate] += (b - p) * w * x
    assert np.allclose(learner.curvature, curvature, rtol=1e-4)
    assert np.allclose(learner.weights, m.START + np.linalg.solve(curvature, slope[:, :, None])[:, :, 0], rtol=1e-3, atol=1e-4)
