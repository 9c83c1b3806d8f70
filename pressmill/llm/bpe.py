"""Byte-level BPE as a tree reduction over each text.

A segment's tokens form a monoid. A text is cut in halves down to leaves; two
neighbours join by encoding anew a window around their border. The window grows
until both its ends lie at safe cuts: a place where a white-space character
follows another character. There the splitting pattern always starts a new
match, whatever stands around it (a run of letters, digits or marks ends before
white space, and white space joins only what follows it), and merges never cross
matches. So the tokens outside the window are those of the whole text, and those
inside follow from the window alone. Without safe cuts the window grows to the
whole segment. Decoding joins the bytes of halves up the same tree.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pressmill.llm.common import slices, texts

LEAF_CHARS = 512
WINDOW_CHARS = 32
#: Only ASCII, so that every Unicode version agrees on what is white space.
_SAFE = re.compile(r"[!-~](?=[ \t\n\r])")


def read_ranks(path: str) -> bytes:
    """A rank file as it is: a line for each token, base64 and rank. Some 800 kB."""
    with open(path, "rb") as f:
        return f.read()


class TreeCodec:
    """Encodes and decodes one text at a time, by halves."""

    def __init__(self, ranks: bytes, pattern: str, leaf_chars: int = LEAF_CHARS, window_chars: int = WINDOW_CHARS):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self._leaf = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self._bytes = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            self._bytes[rank] = token
        self._leaf_chars, self._window = leaf_chars, window_chars

    def encode(self, text: str) -> list[int]:
        return self._halves(text, 0, len(text))

    def _halves(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self._leaf_chars:
            return self._leaf(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(text, lo, mid, hi, self._halves(text, lo, mid), self._halves(text, mid, hi))

    def _join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        width = self._window
        while True:
            a, b = max(lo, mid - width), min(hi, mid + width)
            cuts = [m.end() for m in _SAFE.finditer(text, a, mid)]
            after = _SAFE.search(text, mid, b)
            start = cuts[-1] if cuts else lo if a == lo else None
            end = after.end() if after else hi if b == hi else None
            if start is not None and end is not None:
                break
            width *= 2
        keep = self._split(left, len(text[start:mid].encode()), from_end=True)
        drop = self._split(right, len(text[mid:end].encode()), from_end=False)
        return left[:keep] + self._leaf(text[start:end]) + right[drop:]

    def _split(self, ids: list[int], n_bytes: int, from_end: bool) -> int:
        """The place in ``ids`` that ``n_bytes`` from an end reach; a safe cut is always such a place."""
        at, step = (len(ids), -1) if from_end else (0, 1)
        while n_bytes > 0:
            n_bytes -= len(self._bytes[ids[at - 1 if from_end else at]])
            at += step
        if n_bytes:
            raise AssertionError("a token crosses a safe cut")
        return at

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self._leaf_chars:
            return b"".join(map(self._bytes.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


_CODECS: dict[tuple, TreeCodec] = {}


def _codec(ranks: bytes, pattern: str, leaf_chars: int) -> TreeCodec:
    key = (hash(ranks), pattern, leaf_chars)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = TreeCodec(ranks, pattern, leaf_chars)
    return _CODECS[key]


def encode(docs: DataFrame, path: str, pattern: str, leaf_chars: int = LEAF_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for every row of ``docs``.

    ``path`` names a rank file the driver can read; it goes to the tasks as a
    broadcast (a fixed vocabulary of under a megabyte). ``ids`` are unsigned
    32-bit integers, little-endian, in one binary; ``decoded`` are the bytes that
    decoding the ids gives. A null text is empty: no tokens, no bytes. Repeated
    rows encode alike; ids may be null. Nothing is shuffled.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern, leaf_chars)
        for batch in slices(batches):
            ids = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
            arrays = [
                batch.column("doc_id"),
                pa.array(map(len, ids), pa.int64()),
                pa.array((np.array(x, "<u4").tobytes() for x in ids), pa.binary()),
                pa.array(map(codec.decode, ids), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids", "decoded"])

    return texts(docs, id_col=id_col, text_col=text_col).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
