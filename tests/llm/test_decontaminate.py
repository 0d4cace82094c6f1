import pytest

from stillwater.llm.decontaminate import clean_documents, decontaminate

from .conftest import documents, prose

ITEMS = [(1, prose(40, 100, 2000)), (2, prose(8, 101, 2000)), (3, None), (4, "too short"), (5, prose(40, 100, 2000)), (None, "")]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(*i, "x", "x") for i in ITEMS], "item_id bigint, text string, item string, diagonal string")


def replaced(text, at):
    w = text.split()
    for i in at:
        w[i] = f"other{i}"
    return " ".join(w)


def rows():
    item, short = ITEMS[0][1], ITEMS[1][1]
    around = lambda t, s: f"{prose(30, s, 2000)} {t}\n{prose(30, s + 1, 2000)}"
    return {
        1: (around(item.upper(), 1), True), 2: (around(" ".join(item.split()[9:21]), 3), True), 3: (prose(300, 5, 2000), False),
        4: (around(replaced(item, range(4, 40, 5)), 6), True), 5: (around(replaced(item, range(2, 40, 3)), 8), False),
        6: (around(short, 10), True), 7: (around(replaced(short, [6]), 12), True), 8: (around(replaced(short, [1, 3, 5]), 14), False),
        9: (around(" ".join(item.split()[:20] + ["more"] + item.split()[20:]), 16), True), 10: (None, False), 11: ("", False),
        12: (" ".join(item.split()[:5]), False), 13: (item, True)}


@pytest.mark.parametrize("block", [100_000, 7])
def test_passages_and_replaced_words(spark, bench, block):
    docs = documents(spark, [(i, t) for i, (t, _) in rows().items()] + [(None, ITEMS[0][1]), (13, "another text of the same id")])
    got = decontaminate(docs, bench, block_seeds=block).collect()
    assert len(got) == len(rows()) + 2
    assert {r.doc_id for r in got if r.contaminated} == {i for i, (_, bad) in rows().items() if bad} | {None}
    full = next(r for r in got if r.doc_id == 1)
    assert (full.n_items, full.best_overlap, full.item_ids) == (2, 1.0, [1, 5])
    left = clean_documents(docs, bench)
    assert left.columns == docs.columns  # judged by row: the other text of a contaminated id stays
    assert sorted(r.doc_id for r in left.collect()) == sorted([*(i for i, (_, bad) in rows().items() if not bad), 13])


def test_empty_and_odd(spark, bench, odd, odd_rows, empty):
    assert decontaminate(empty, bench).count() == 0
    assert not [r for r in decontaminate(odd, bench).collect() if r.contaminated]
    assert decontaminate(odd, bench.limit(0)).where("NOT contaminated").count() == len(odd_rows)


def plain(texts, items, similarity=0.8, span=12):
    """Every item on every diagonal of every text: ids found, best share."""
    out = []
    for t in texts:
        w, found, best = (t or "").lower().split(), set(), 0.0
        for n, (i, item) in enumerate(items):
            x = (item or "").lower().split()
            width = min(span, len(x))
            for d in range(-len(x), len(w)):
                equal = [0 <= d + k < len(w) and w[d + k] == x[k] for k in range(len(x))]
                share = max((sum(equal[a:a + width]) / width for a in range(len(x) - width + 1)), default=0) if x else 0
                if share >= similarity:
                    found.add(f"text {n}" if i is None else i)
                    best = max(best, share)
        out.append((bool(found), len(found), sorted(i for i in found if isinstance(i, int)), round(best, 9)))
    return out


def test_items_of_all_lengths_like_every_diagonal(spark):
    """Any allowed number of replaced words at any places, items without id, items of two texts."""
    from itertools import combinations
    items = [(n, prose(n, 200 + n, 4000)) for n in range(1, 15)] + [(None, prose(9, 300, 4000)), (None, prose(5, 301, 4000)), (3, prose(12, 302, 4000))]
    texts = []
    for _, t in items:
        n = len(t.split())
        for away in range(0, min(n, 12) // 5 + 2):
            for at in list(combinations(range(n), away))[::1 if n < 12 else 5]:
                texts.append(f"{prose(3, len(texts), 4000)} {replaced(t, at)} {prose(3, len(texts) + 7, 4000)}")
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_ids, round(r.best_overlap, 9)) for r in decontaminate(documents(spark, list(enumerate(texts))), bench).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, items)


def test_rows_without_id_stand_for_themselves(spark, bench):
    item = ITEMS[0][1]
    texts = [item, prose(60, 30, 2000), None, prose(60, 31, 2000), item]
    docs = documents(spark, [*[(None, t) for t in texts], (7, item), (8, prose(60, 32, 2000))])
    left = sorted(((r.doc_id, r.text) for r in clean_documents(docs, bench).collect()), key=str)
    assert left == sorted([*[(None, t) for t in texts if t != item], (8, prose(60, 32, 2000))], key=str)
    got = decontaminate(docs, bench)
    assert got.columns == ["doc_id", "contaminated", "n_items", "best_overlap", "item_ids"]
    assert sorted((r.doc_id or 0, r.contaminated) for r in got.collect()) == [(0, False)] * 3 + [(0, True)] * 2 + [(7, True), (8, False)]


def test_hits_are_grouped_by_row(spark, bench):
    from stillwater.llm.decontaminate import row_key
    docs = documents(spark, [(None, "a"), (None, "b"), (1, "a"), (1, "a"), (None, None)])
    assert docs.select(row_key(docs).alias("k")).distinct().count() == 4


def test_every_two_replaced_words_leave_a_seed():
    from itertools import combinations

    from stillwater.llm.decontaminate import MASKS
    for away in combinations(range(12), 2):
        assert any(not {o + i for i in m} & set(away) for m in MASKS for o in range(12 - m[-1]))
