import gzip
import hashlib
import io
from base64 import b32encode

import pytest

from stillwater.llm.common import work_dir
from stillwater.llm.warc import member, read_warc, records, write_warc

ROWS = [(1, "http://a/x", "same"), (2, None, "same"), (3, "http://b/ y\n", "é" * 300_000), (4, "u", None), (5, "u", ""), (None, "u", "alone"),
        (7, "u", "same"), (7, "u", "same")]


def sha(text):
    return b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least, file_bytes", [(0, 1 << 28), (1, 10), (5, 500)])
def test_round_trip(spark, least, file_bytes):
    pages = spark.createDataFrame([(*r, "x", "y", "z") for r in ROWS], "page_id bigint, url string, html string, digest string, size string, path string")
    folder = work_dir(spark, "warc")
    got = read_warc(spark, folder, write_warc(pages, folder, least, file_bytes)).collect()
    response = {"same": 7, "": 5, "é" * 300_000: 3, "alone": None}
    want = []
    for i, _, t in ROWS:
        first = response[t or ""]
        revisit = i != first and len(t or "") >= least
        want.append((i, len((t or "").encode()), sha(t), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_members_are_gzip_and_verified():
    raw = member(1, "http://a", b"x" * 100_000, False, None) + member(2, "http://b", b"", True, 1)
    assert gzip.decompress(raw).count(b"WARC/1.1") == 2
    for step in (1, 7, 1 << 16):
        assert [r.header["warc-type"] for r in records(io.BytesIO(raw), step)] == ["response", "revisit"]
    with pytest.raises(ValueError):
        list(records(io.BytesIO(raw[:-5]), 64))
    plain = gzip.decompress(member(1, "http://a", b"hello", False, None)).replace(b"hello", b"jello")
    with pytest.raises(ValueError, match="digest"):
        list(records(io.BytesIO(gzip.compress(plain))))


def test_empty_table(spark):
    folder = work_dir(spark, "warc")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert read_warc(spark, folder, write_warc(pages, folder)).count() == 0
