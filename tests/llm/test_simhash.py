import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from stillwater.llm.simhash import codewords, components, decoder, fingerprint, keys_of, links

from .conftest import documents, prose


def plain(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    w = [re.sub(rb"[A-Z]", lambda m: m.group().lower(), x) for x in w]
    grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def grouped(nodes, edges):
    label = {n: n for n in nodes}
    for a, b in edges:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = {n: new if x == old else x for n, x in label.items()}
    return label


def brute(rows):
    prints = [plain(t) for _, t in rows]
    label = grouped(set(prints), [p for p in combinations(set(prints), 2) if (p[0] ^ p[1]).bit_count() <= 4])
    low = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            low[label[p]] = min(i, low.get(label[p], i))
    return sorted((-1 if i is None else i, f"{p:016x}", low.get(label[p])) for (i, _), p in zip(rows, prints))


def result(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, r.component_id) for r in df.collect())


def test_the_code_is_perfect():
    code, near = codewords(), decoder()
    assert min(np.bitwise_count(code[1:])) == 7
    x = np.random.default_rng(1).integers(0, 1 << 23, 10_000)
    assert np.bitwise_count(code[near[x]] ^ x).max() == 3


def test_no_difference_of_four_bits_is_missed():
    draw = np.random.default_rng(2)
    for bits in (1, 2, 3, 4):
        x = draw.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        flip = np.array([sum(1 << int(i) for i in draw.choice(64, bits, replace=False)) for _ in x], np.uint64)
        (rows, keys), (others, more) = keys_of(x), keys_of(x ^ flip)
        have = set(zip(rows.tolist(), keys.tolist()))
        assert {r for r, k in zip(others.tolist(), more.tolist()) if (r, k) in have} == set(range(len(x)))


def near_prints(n, seed, bases=4, flips=6):
    draw = random.Random(seed)
    starts = [draw.getrandbits(64) for _ in range(bases)]
    return sorted({b ^ sum(1 << i for i in draw.sample(range(64), draw.randint(0, flips))) for b in draw.choices(starts, k=n)})


@pytest.mark.parametrize("crowd", [0, 3, 1024])
def test_links_like_all_pairs(spark, crowd):
    """Crowded keys give the same groups as compared ones."""
    prints = near_prints(400, crowd)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in prints], "print bigint")
    got = grouped(map(signed, prints), [tuple(r) for r in links(df, crowd).collect()])
    want = grouped(map(signed, prints), [(signed(a), signed(b)) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 4])
    assert got == want


def test_families_like_all_pairs(spark):
    draw, rows = random.Random(5), []
    for family in range(8):
        base = prose(150, family, 3000).split()
        for _ in range(12):
            rows.append((draw.randrange(10 ** 6), " ".join(base)))
            base[draw.randrange(len(base))] = f"New{draw.randrange(10 ** 6)}"
    rows += [(10 ** 7 + i, t) for i, (_, t) in enumerate(rows[:9])]
    assert result(components(documents(spark, rows))) == brute(rows)


def test_odd_rows(spark, odd, odd_rows, empty):
    assert result(components(odd)) == brute(odd_rows)
    assert components(empty).count() == 0


def test_long_texts_in_blocks():
    text = prose(70_000, 9)
    assert fingerprint(text) == plain(text)


def test_the_whole_table(spark):
    from stillwater.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op13_golay_simhash"](spark, folder)) == brute(rows)
