"""Token ids of texts by a public byte-level BPE vocabulary."""
from __future__ import annotations

import gc
import os
import re

import numpy as np
import pyarrow as pa

from .common import worker_cache

# Blanks that libraries class differently: a text that holds one is encoded in one piece.
_OTHER_BLANKS = re.compile("[{}]".format("".join(map(chr, (
    0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F,
    0x3000, 0xFEFF)))))
_ENTRY = 200  # bytes of an entry of the table besides its text
_PART = 8 << 20  # bytes of text that are cut at a time
_BLANKS = b" \t\n\r"
_BLANK = np.isin(np.arange(256), list(_BLANKS))
_SUSPECT = np.isin(np.arange(256), [0x0B, 0x0C, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])  # begins one of the other blanks in UTF-8


def chunk_starts(raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where chunks begin in the bytes of texts: at each text's start (``texts``, ascending, may repeat) and each run of blanks."""
    blank = _BLANK[raw]
    begins = np.append(blank[:1], blank[1:] & ~blank[:-1])
    begins[texts[texts < len(raw)]] = True
    return np.flatnonzero(begins)


class Encoder:
    """Encodes texts with the ``tokenizers`` library, each different chunk once.

    The vocabulary's pattern never lets a piece go on from a non-blank into a blank, so a text may be cut before
    every run of blanks without changing its ids. Chunks repeat a lot; the ids of those seen are kept, up to
    ``keep`` chunks or some ``most_bytes`` of memory, and as many before them. New chunks are encoded many in one text; an
    id stands for a fixed number of bytes, which tells where each chunk's ids end. Chunks are cut, numbered and put
    together as arrays; only different ones are looked up. A text that holds the name of a special
    token, which the library reads as that token, is encoded in one piece.
    """

    def __init__(self, path: str, keep: int = 600_000, most_bytes: int = 64 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alone = re.compile("|".join([_OTHER_BLANKS.pattern, *map(re.escape, special)]))
        self.suspect = _SUSPECT.copy()
        self.suspect[[t.encode()[0] for t in special if t]] = True
        self.keep, self.most_bytes, self.bytes = keep, most_bytes, 0
        self.seen: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        size = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            size[i] = len(token)  # one character stands for each byte
        self.size = size

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[bytes]) -> None:
        size = sum(map(len, chunks)) + _ENTRY * len(chunks)
        if len(self.seen) + len(chunks) > self.keep or self.bytes + size > self.most_bytes:
            self.seen, self.older, self.bytes = {}, self.seen, 0
        self.bytes += size
        alone, behind = [], []
        for c in chunks:  # most can stand behind any chunk
            (behind if c[0] in _BLANKS and c[-1] not in _BLANKS else alone).append(c)
        for c, ids in zip(alone, self._ids([c.decode() for c in alone])):
            self.seen[c] = ids.tobytes()
        groups = [behind[i:i + 1000] for i in range(0, len(behind), 1000)]
        for group, ids in zip(groups, self._ids([b"".join(g).decode() for g in groups])):
            ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(list(map(len, group)))) + 1
            raw, at = ids.tobytes(), 0
            for c, end in zip(group, (ends * 4).tolist()):
                self.seen[c] = raw[at:end]
                at = end

    def encode(self, texts: list[str | None], end: int | None = None) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit numbers, ``end`` behind each text's; a missing text is empty."""
        collecting = gc.isenabled()
        gc.disable()  # many strings, no cycles
        try:
            return self._encode(texts, end)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str | None], end: int | None) -> list[bytes]:
        last = b"" if end is None else np.array([end], "<u4").tobytes()
        out: list[bytes] = []
        at = 0
        while at < len(texts):  # some megabytes at a time
            part, size = [], 0
            while at < len(texts) and (not part or size < _PART):
                part.append((texts[at] or "").encode())
                size += len(part[-1])
                at += 1
            out.extend(self._part(part, last))
        return out

    def _part(self, texts: list[bytes], last: bytes) -> list[bytes]:
        raw = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        suspect = np.flatnonzero(self.suspect[raw])
        whole = {i: self._whole(t) for i in np.unique(np.searchsorted(ends, suspect, side="right")).tolist()
                 if self.alone.search(t := texts[i].decode())}
        if len(whole) == sum(map(bool, texts)):  # no chunks
            return [whole.get(i, b"") + last for i in range(len(texts))]
        starts = chunk_starts(raw, ends - [len(t) for t in texts])
        offsets = np.append(starts, len(raw))
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        first = np.searchsorted(starts, ends - [len(t) for t in texts])  # of each text
        after = np.append(first[1:], len(starts))
        if whole:  # their chunks are not to be learnt
            used = np.ones(len(starts), bool)
            for i in whole:
                used[first[i]:after[i]] = False
            chunks = chunks.filter(pa.array(used))
            moved = np.append(0, np.cumsum(used))
            first, after = moved[first], moved[after]
        found = chunks.dictionary_encode()
        _, offsets, data = found.dictionary.buffers()
        cut, data = np.frombuffer(offsets, np.int64)[:len(found.dictionary) + 1].tolist(), data.to_pybytes() if data else b""
        ids = pa.array(self._look_up([data[x:y] for x, y in zip(cut, cut[1:])]), pa.large_binary())
        _, offsets, tokens = ids.take(found.indices).buffers()
        edge, tokens = np.frombuffer(offsets, np.int64)[:len(chunks) + 1], tokens.to_pybytes() if tokens else b""
        return [whole[i] + last if i in whole else tokens[x:y] + last
                for i, (x, y) in enumerate(zip(edge[first].tolist(), edge[after].tolist()))]

    def _look_up(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of different chunks."""
        found = list(map(self.seen.get, chunks))
        if None in found:
            lost = [i for i, ids in enumerate(found) if ids is None]
            again = {c: ids for c in map(chunks.__getitem__, lost) if (ids := self.older.get(c)) is not None}
            self.bytes += sum(map(len, again)) + _ENTRY * len(again)
            self._learn([c for c in map(chunks.__getitem__, lost) if c not in again])
            self.seen.update(again)
            for i in lost:
                found[i] = self.seen[chunks[i]]
        return found

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker: later tasks find the vocabulary loaded and frequent chunks known."""
    return worker_cache(("encoder", path), lambda: Encoder(path))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
