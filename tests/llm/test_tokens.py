"""Encoding, packing and the token store: compared with the library text by text."""
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from stillwater.llm.common import work_dir
from stillwater.llm.packing import OpenBins, best_fit, pack_documents
from stillwater.llm.token_store import read_token_ids, summary, write_token_ids
from stillwater.llm.tokens import Encoder, chunk_starts, default_vocabulary


@pytest.fixture(scope="module")
def ids():
    library = Tokenizer.from_file(default_vocabulary())
    return lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")


def test_chunks_encode_like_whole_texts(ids, odd_rows):
    texts = [t for _, t in odd_rows] + ["a  b", " a\n\n b ", "\n", "! ? x", "a\tb \t c", "x \n y", "'s 's't"]
    for keep in (600_000, 50):  # also when the table overflows all the time
        encoder = Encoder(default_vocabulary(), keep)
        for _ in range(2):
            assert [np.frombuffer(r, "<u4").tolist() for r in encoder.encode(texts, 2)] == [ids(t).tolist() for t in texts]


def test_special_tokens_and_bounded_memory(ids):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "<|endoftext", *[f"word{i} <|endoftext|>" for i in range(3)]]
    assert 50256 in ids(texts[0]).tolist()
    encoder = Encoder(default_vocabulary(), most_bytes=5000)
    for _ in range(2):
        assert [np.frombuffer(r, "<u4").tolist() for r in encoder.encode(texts, 2)] == [ids(t).tolist() for t in texts]
    for i in range(200):
        encoder.encode([f"new{i} other{i}"])
    assert len(encoder.seen) + len(encoder.older) < 60


def test_chunks_begin_at_texts_and_runs_of_blanks(ids):
    texts = ["a  b\t\nc ", "", " x", "é\u00a0y", "", "\n", "z"]
    raw, sizes = "".join(texts).encode(), [len(t.encode()) for t in texts]
    starts = chunk_starts(np.frombuffer(raw, np.uint8), np.cumsum([0, *sizes[:-1]])).tolist()
    assert [raw[x:y].decode() for x, y in zip(starts, [*starts[1:], len(raw)])] == ["a", "  b", "\t\nc", " ", " x", "é\u00a0y", "\n", "z"]
    encoder = Encoder(default_vocabulary())
    for some in ([], [None], [""], ["<|endoftext|>"], ["a\u00a0b", None], ["", "a", "", None], texts):
        assert [np.frombuffer(r, "<u4").tolist() for r in encoder.encode(some, 2)] == [ids(t).tolist() for t in some]


def test_a_chunk_is_looked_up_once_for_all_its_places():
    encoder, asked = Encoder(default_vocabulary()), []
    look_up = encoder._look_up
    encoder._look_up = lambda chunks: asked.extend(chunks) or look_up(chunks)
    encoder.encode([" one two one two"] * 1000)
    assert sorted(asked) == [b" one", b" two"]


def test_store_round_trip(spark, odd, odd_rows, ids):
    path = work_dir(spark, "store")
    write_token_ids(odd, path, default_vocabulary())
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start), r.n_tokens, r.ids_crc32) for r in summary(spark, path).collect())
    start = 0
    want = defaultdict(list)
    for i, t in odd_rows:
        want[i].append(ids(t))
    for (some, i, at), n, crc in got:
        own = want[i if some else None].pop(0)
        assert (at, n, crc) == (start, len(own), zlib.crc32(own.tobytes()))
        start += n
    assert not any(want.values())
    one = read_token_ids(spark, path, [4])
    assert "doc_id" in one._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    assert [np.array(r.ids, "<u4").tolist() for r in one.collect()] == [ids(dict(odd_rows)[4]).tolist()]


def test_empty_tables(spark, empty):
    path = work_dir(spark, "store")
    write_token_ids(empty, path, default_vocabulary())
    assert summary(spark, path).count() == 0
    assert pack_documents(empty, default_vocabulary()).count() == 0


def test_bins_take_the_tightest_and_close_the_fullest():
    bins = OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7)] == [(0, 0), (1, 0)]
    assert bins.place(3) == (1, 7)  # fits both, the fuller one is filled up
    assert bins.place(8) == (2, 0)
    assert bins.place(9) == (3, 0)  # two are open; bin 2 is the fullest and closes
    assert bins.place(4) == (0, 6)
    assert bins.place(2) == (4, 0) and bins.place(1) == (3, 9)


@pytest.mark.parametrize("open_bins, per_task", [(16_384, 65_536), (3, 4)])
def test_packing(spark, odd, odd_rows, ids, open_bins, per_task):
    rows = pack_documents(odd, default_vocabulary(), keep_ids=True, open_bins=open_bins, per_task=per_task).collect()
    texts = defaultdict(list)
    for i, t in odd_rows:
        texts[i].append(ids(t).tolist())
    whole = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id or 0, r.start)):
        part = np.frombuffer(r.ids, "<u4")
        assert len(part) == r.length and zlib.crc32(r.ids) == r.ids_crc32 and 1 <= r.length <= 1024
        assert r.length == 1024 or r.piece == 0
        if r.doc_id != 5:
            whole[r.doc_id] += part.tolist()
    assert all([whole[i]] == t for i, t in texts.items() if i != 5)
    assert sum(r.doc_id == 5 for r in rows) == 2
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 1024


def test_packing_is_near_the_bound(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "0 AS piece", "1 + pmod(xxhash64(id), 700) AS length")
    packed = best_fit(rows).collect()
    assert len({r.sequence_id for r in packed}) <= 1.02 * sum(r.length for r in packed) / 1024
