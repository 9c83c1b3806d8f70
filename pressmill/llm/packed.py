"""Keyed entries in packed blocks: few bytes each through a shuffle, whole buckets in numpy.

An entry is a key of a few bytes, the 64-bit id of its owner and a byte of flags. A task
sorts a chunk of entries by key and cuts it into buckets by key range; in a block
owners are places in a table, and bytes lie in planes, which compress well. The
number of buckets follows the number of entries, so a bucket stays the same size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

KEY_BITS = 48
CHUNK = 2_000_000  # entries a task sorts at once
BUCKET = 2_000_000  # entries a bucket should hold
SCHEMA = "bucket int, n int, owners int, block binary"
_NAMES = ["bucket", "n", "owners", "block"]


def bucket_count(entries: int) -> int:
    return max(64, -(-entries // BUCKET))


def key_width(entries: int) -> int:
    """Bytes a key needs so that few different ones of so many entries fall together by chance."""
    return min(8, max(4, -(-(max(1, entries).bit_length() + 12) // 8)))


def key_of(hashes: np.ndarray, key_bytes: int = KEY_BITS // 8) -> np.ndarray:
    return hashes >> np.uint64(64 - 8 * key_bytes)


def _planes(x: np.ndarray, width: int) -> bytes:
    return x.view(np.uint8).reshape(len(x), -1)[:, :width].T.tobytes()


def pack(keys: np.ndarray, owners: np.ndarray, flags: np.ndarray, buckets: int, key_bytes: int = KEY_BITS // 8) -> pa.RecordBatch:
    """A row for each bucket that has entries; keys have no more than ``key_bytes`` bytes."""
    order = np.argsort(keys)
    keys, owners, flags = keys[order], owners[order], flags[order]
    # 32 bits of the key times the count: no overflow, and ascending with the key.
    bucket = ((keys >> np.uint64(8 * key_bytes - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows: tuple[list, ...] = ([], [], [], [])
    for a, b in zip(cuts, [*cuts[1:], len(keys)]):
        table, place = np.unique(owners[a:b], return_inverse=True)
        raw = _planes(keys[a:b], key_bytes) + _planes(place.astype(np.uint32), 4) + flags[a:b].astype(np.uint8).tobytes()
        raw += _planes(table.astype(np.int64), 8)
        for column, v in zip(rows, (int(bucket[a]), int(b - a), len(table), pa.compress(raw, codec="zstd", asbytes=True))):
            column.append(v)
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=_NAMES)


def unpack(group: pa.Table, key_bytes: int = KEY_BITS // 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, owners and flags of all blocks of a bucket, sorted by key."""
    parts, at = [], key_bytes
    for n, m, block in zip(*(group.column(c).to_pylist() for c in _NAMES[1:])):
        raw = np.frombuffer(pa.decompress(block, decompressed_size=(at + 5) * n + 8 * m, codec="zstd", asbytes=True), np.uint8)
        keys = np.zeros((n, 8), np.uint8)
        keys[:, :at] = raw[: at * n].reshape(at, n).T
        place = np.ascontiguousarray(raw[at * n : (at + 4) * n].reshape(4, n).T).view(np.uint32).ravel()
        table = np.ascontiguousarray(raw[(at + 5) * n :].reshape(8, m).T).view(np.int64).ravel()
        parts.append((keys.view(np.uint64).ravel(), table[place], raw[(at + 4) * n : (at + 5) * n]))
    keys, owners, flags = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    return keys[order], owners[order], flags[order]


def chunks(parts: Iterable[tuple[np.ndarray, ...]], size: int = CHUNK) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of entries gathered until they reach ``size``."""
    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= size:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held))


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each run of equal keys in a sorted array."""
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return start, np.diff(np.append(start, len(keys)))
