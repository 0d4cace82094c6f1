"""Web archives: one gzip member per record, written by tasks and read back in sequence.

Writing: each task writes files of about ``file_bytes`` to a shared folder under names of its own attempt, and returns
one row per finished file. That manifest is stored; only files it names are read, so what a lost or doubled attempt
left behind does not count.

Reading: a file is read in blocks and inflated step by step, member by member; a record's header is read to its blank
line and its block by ``Content-Length``, never more than a record at a time. Digests are verified: a mismatch raises.

Of records with equal payloads of at least ``revisit_from`` bytes the one with the largest id is a response, the
others are revisits that keep the HTTP header and leave the payload out. Equal means equal SHA-1 and length.

Defined results: a missing payload is empty, a missing url is recorded as ``about:blank``; a missing id is the smallest,
and refers to nothing; repeated rows of the largest id are all responses; an empty table gives no rows; other columns
are left out.
"""
from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

MANIFEST = "path string, records bigint, bytes bigint"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
DATE = "1970-01-01T00:00:00Z"  # pages have no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Record(NamedTuple):
    header: dict[str, str]
    block: bytes

    def http(self) -> tuple[dict[str, str], bytes]:
        """Header fields and body of the HTTP message in the block."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        return _fields(head.split(b"\r\n")[1:]), body


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(text: str | None) -> int | None:
    number = (text or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def member(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None, level: int = 6) -> bytes:
    """A response or revisit record as a gzip member."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {' '.join((url or 'about:blank').split())}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest(payload)}",
            f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    if revisit:
        head[2:2] = [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class _Inflated:
    """Bytes of consecutive gzip members, inflated as they are asked for."""

    def __init__(self, file: BinaryIO, step: int):
        self.file, self.step, self.raw, self.out, self.unpack = file, step, b"", bytearray(), None

    def _more(self) -> bool:
        """Inflate a further step; False at the end of the member."""
        if self.unpack is None:
            return False
        self.raw = self.raw or self.file.read(self.step)
        end_of_file = not self.raw
        data = self.unpack.decompress(self.raw, 4 * self.step)
        self.out += data
        if self.unpack.eof:
            self.raw, self.unpack = self.unpack.unused_data, None
        elif end_of_file and not data:
            raise ValueError("the archive ends inside a member")
        else:
            self.raw = self.unpack.unconsumed_tail
        return True

    def next_member(self) -> bool:
        if self.out or self.unpack is not None:
            raise ValueError("bytes are left behind a record")
        self.raw = self.raw or self.file.read(self.step)
        if self.raw:
            self.unpack = zlib.decompressobj(31)
        return bool(self.raw)

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.out.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.out)
            if not self._more():
                raise ValueError("a member ends inside a header")
        head = bytes(self.out[:at])
        del self.out[:at + len(mark)]
        return head

    def take(self, n: int) -> bytes:
        while len(self.out) < n:
            if not self._more():
                raise ValueError("a member ends inside a block")
        data = bytes(self.out[:n])
        del self.out[:n]
        return data

    def close_member(self) -> None:
        while self.unpack is not None:
            self._more()


def records(file: BinaryIO, step: int = 1 << 16) -> Iterator[Record]:
    """The records of an archive, one after the other, with verified digests."""
    source = _Inflated(file, step)
    while source.next_member():
        lines = source.until(b"\r\n\r\n").split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        header = _fields(lines[1:])
        block = source.take(int(header["content-length"]))
        if source.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        source.close_member()
        record = Record(header, block)
        _verify(record)
        yield record


def _verify(record: Record) -> None:
    want = record.header.get("warc-block-digest")
    if want and want != f"sha1:{digest(record.block)}":
        raise ValueError(f"wrong block digest in {record.header.get('warc-record-id')}")
    want = record.header.get("warc-payload-digest")
    if want and record.header.get("warc-type") == "response" and want != f"sha1:{digest(record.http()[1])}":
        raise ValueError(f"wrong payload digest in {record.header.get('warc-record-id')}")


def write_warc(pages: DataFrame, folder: str, revisit_from: int = 0, file_bytes: int = 256 << 20) -> DataFrame:
    """``page_id, url, html`` to archives in ``folder``; returns the stored manifest of files."""
    plain = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    digested = plain.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    equal = digested.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"))
    linked = digested.join(equal, ["digest", "size"]).select(
        "page_id", "url", "payload", "refers_to",
        ((F.col("size") >= revisit_from) & ~F.col("page_id").eqNullSafe(F.col("refers_to"))).alias("revisit"))

    def write(batches):
        fs, base = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        task, number, out, path, done = TaskContext.get(), 0, None, "", []
        count = size = 0
        for b in batches:
            columns = [b.column(n) for n in ("page_id", "url", "payload", "revisit", "refers_to")]
            for i in range(b.num_rows):
                if out is None:
                    path, count, size = f"{base}/{task.partitionId():06d}-{task.taskAttemptId()}-{number:05d}.warc.gz", 0, 0
                    out, number = fs.open_output_stream(path, compression=None), number + 1
                data = member(*[c[i].as_py() for c in columns])
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        yield pa.RecordBatch.from_pydict({"path": [x[0] for x in done], "records": [x[1] for x in done], "bytes": [x[2] for x in done]},
                                         schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return stored(linked.mapInArrow(write, MANIFEST), "warc-manifest")


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """A row per record of the archives that the manifest names; sizes and digests are of the whole payload."""
    def read(batches):
        fs, _ = pa.fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, expected in zip(b.column("path").to_pylist(), b.column("records").to_pylist()):
                rows = []
                with fs.open_input_stream(path, compression=None) as file:
                    for r in records(file):
                        h = r.header
                        rows.append((page_of(h["warc-record-id"]), int(r.http()[0]["content-length"]),
                                     h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"], page_of(h.get("warc-refers-to"))))
                if len(rows) != expected:
                    raise ValueError(f"{path} has {len(rows)} records, not {expected}")
                for at in range(0, len(rows), 10_000):
                    columns = list(zip(*rows[at:at + 10_000]))
                    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                     ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = manifest.repartition(max(1, min(manifest.count(), 10_000)), "path")
    return files.mapInArrow(read, RECORD)
