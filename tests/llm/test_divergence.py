import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stillwater.llm.divergence import SMOOTH, audit, scaled, term_counts

from .conftest import SCHEMA, prose


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, None, *["x"] * 9) for i, (t, lang, source) in enumerate(rows)], SCHEMA)


def brute(rows, min_docs, top):
    held, count, groups = Counter(), defaultdict(Counter), set()
    for t, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [m.group().translate({i: i + 32 for i in range(65, 91)}) for m in re.finditer("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
        held.update((lang, x) for x in set(terms))
        count[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [x for (l, x), n in held.items() if l == lang and n >= min_docs]
        sources = [s for l, s in groups if l == lang]
        of_lang = sum((count[lang, s] for s in sources), Counter())

        def p(c):
            return {x: 1 + 10 ** 9 * (c[x] + SMOOTH) // (sum(c[y] for y in kept) + SMOOTH * len(kept)) for x in kept}
        q, every = p(of_lang), {s: p(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(every[s][x] - every[o][x]) for x in kept)) for o in sources if o != s]
            terms = [(x, every[s][x] - q[x]) for x in kept if count[lang, s][x] and every[s][x] > q[x]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                best = sorted(found, key=lambda f: (-f[1], f[0].encode()))[:most]
                out += [(lang, s, part, x, v, r) for r, (x, v) in enumerate(best, 1)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    return [(prose(draw.randint(0, 200), draw.randrange(40), 60) + draw.choice(["", " Été ÉTÉ \U0001F600x naïve", " 1a2b A_b\x00c\x7fd"]),
             draw.choice(["en", "fr"]), "hot" if draw.random() < 0.4 else f"s{draw.randrange(5)}") for _ in range(150)]


@pytest.mark.parametrize("min_docs, top, cells", [(3, 50, 1 << 20), (30, 4, 32), (1, 7, 1)])
def test_like_plain_counting(spark, rows, min_docs, top, cells):
    """Whatever the size of the shards."""
    assert result(audit(docs(spark, rows), min_docs, top, cells)) == brute(rows, min_docs, top)


def test_odd_rows(spark, odd_rows, empty):
    rows = [(t, None if i is None else "xx", None if i == 1 else "a") for i, t in odd_rows] * 3
    for min_docs in (1, 3, 1000):
        assert result(audit(docs(spark, rows), min_docs)) == brute(rows, min_docs, 50)
    assert audit(empty).count() == 0


def test_a_task_hands_on_partial_tables(spark, rows):
    df = docs(spark, rows)
    assert sorted(map(str, term_counts(df, 1000).collect())) == sorted(map(str, term_counts(df).collect()))


def test_large_counts_stay_exact():
    count, total = np.array([3, 10 ** 12 - 7, 0]), np.array([2 * 10 ** 12 + 1])
    want = [1 + 10 ** 9 * (int(c) + SMOOTH) // (int(total[0]) + SMOOTH * 11) for c in count]
    assert scaled(count, total, 11).tolist() == want
