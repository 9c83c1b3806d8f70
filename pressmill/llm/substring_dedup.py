"""Removal of repeated passages by recompression of the word sequences.

Each round names maximal runs of a symbol, deals the symbols into left and right
by a hash, and names each left one with the right one that follows it. A name is
a hash of what it stands for, so equal content gets one name in every task, and
naming moves nothing. A symbol carries its context: the words that settle it
whatever lies beyond. So of any two equal windows, both hold the same symbols
whose contexts lie inside; the longest of the last round is the window's anchor.
Windows without such a symbol (one word over and over) anchor in themselves.

Anchors, one for several windows, are far fewer than windows. Those shared by
documents reveal where repeats may lie; only windows there are compared, by the
hash of all their words, for the smallest document that has them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm import packed
from pressmill.llm.common import mix, slices, split_words, texts, word_hashes
from pressmill.session import materialize

WIDTH = 13
ROUNDS = 3
GAP = 64  # positions between the documents of a slice, and beyond a document's ends
SHARED = 1  # flag of an entry
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Sequences:
    """The words of a slice's documents in a row, with hashes of any stretch of one document."""

    def __init__(self, column: pa.Array):
        self.words, self.rows = split_words(column)
        self.symbols = word_hashes(self.words)
        n = len(self.symbols)
        turn = self.rows[1:] != self.rows[:-1]
        self.document = np.concatenate([[0], np.cumsum(turn)]) if n else np.zeros(0, int)
        starts = np.flatnonzero(np.concatenate([[True], turn])) if n else np.zeros(0, int)
        self.first, self.last = starts, np.append(starts[1:], n)
        with np.errstate(over="ignore"):
            self._power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _ODD)]))
            self._back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _INVERSE)]))
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.symbols) * self._power[:n])])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the words from start to end, the same wherever they stand."""
        total = (self._sums[end] - self._sums[start]) * self._back[start]
        return mix(total + mix((end - start).astype(np.uint64)))

    def window_starts(self, width: int) -> np.ndarray:
        n = len(self.rows)
        at = np.arange(max(0, n - width + 1))
        return at[self.rows[at] == self.rows[at + width - 1]] if len(at) else at

    def place(self, at: np.ndarray) -> np.ndarray:
        """Positions with gaps between documents, so that contexts beyond an end stay apart."""
        return at + GAP * self.document[at]


def recompress(seq: Sequences, rounds: int = ROUNDS) -> list[tuple[np.ndarray, ...]]:
    """For each round the symbols' names, lengths, and starts and ends of their contexts, all ascending by place.

    Where a neighbour is wanted beyond a document's end, the context reaches beyond it too, so no window holds it.
    """
    n = len(seq.symbols)
    if not n:
        return []
    place = seq.place(np.arange(n))
    low, high = place[seq.first] - GAP // 2, place[seq.last - 1] + GAP // 2
    name, doc, size, begin, end = seq.symbols, seq.document, np.ones(n, np.int64), place, place + 1
    levels = []
    for r in range(rounds):
        # Runs. Whether one ends is up to its neighbours.
        new = np.concatenate([[True], (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])])
        st = np.flatnonzero(new)
        en = np.append(st[1:], len(name))
        times = en - st
        run = mix(name[st] + mix(times.astype(np.uint64) ^ np.uint64(0x51ED + r)))
        own = doc[st]
        before, after = np.maximum(st - 1, 0), np.minimum(en, len(name) - 1)
        left = np.where((st > 0) & (doc[before] == own), begin[before], low[own])
        right = np.where((en < len(name)) & (doc[after] == own), end[after], high[own])
        name, size = np.where(times > 1, run, name[st]), np.add.reduceat(size, st)
        doc, begin, end = own, left, right
        # Pairs. A left symbol looks at what follows it, a right one at what it follows.
        is_left = (mix(name ^ np.uint64(0xC0FFEE + r)) & np.uint64(1)).astype(bool)
        same = doc[1:] == doc[:-1]
        pair = np.append(is_left[:-1] & ~is_left[1:] & same, False)
        follows = np.concatenate([[False], pair[:-1]])
        nxt_end = np.where(np.append(same, False), np.append(end[1:], 0), high[doc])
        prv_begin = np.where(np.concatenate([[False], same]), np.concatenate([[0], begin[:-1]]), low[doc])
        new_begin = np.where(pair | is_left, begin, prv_begin)
        new_end = np.where(pair | is_left, nxt_end, end)
        both = mix(name * _ODD + mix(np.append(name[1:], np.uint64(0)) + np.uint64(r)))
        name = np.where(pair, both, name)
        size = size + np.where(pair, np.append(size[1:], 0), 0)
        keep = ~follows
        name, doc, size, begin, end = name[keep], doc[keep], size[keep], new_begin[keep], new_end[keep]
        levels.append((name, size, begin, end))
    return levels


def anchors(seq: Sequences, starts: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """For each window the hash of its anchor's context; equal for equal windows."""
    at = seq.place(starts)
    left, right = starts.copy(), starts + width  # of the window itself, where nothing else is settled
    todo = np.arange(len(starts))
    for name, size, begin, end in reversed(recompress(seq)):
        if not len(todo):
            break
        w = at[todo]
        a, b = np.searchsorted(begin, w, "left"), np.searchsorted(end, w + width, "right")
        some = a < b
        if not some.any():
            continue
        rows, a, b = todo[some], a[some], b[some]
        rank = (np.uint64(255) - np.minimum(size, 255).astype(np.uint64)) << np.uint64(56) | name >> np.uint64(8)
        best = a.copy()
        for k in range(1, int((b - a).max())):
            more = a + k < b
            better = more.copy()
            better[more] = rank[a[more] + k] < rank[best[more]]
            best[better] = a[better] + k
        shift = starts[rows] - at[rows]
        left[rows], right[rows] = begin[best] + shift, end[best] + shift
        todo = todo[~some]
    return seq.stretch(left, right)


def _least_owner(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries once each by key and owner, with group starts and sizes; the first of a group is its least owner."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])]) if len(keys) else np.zeros(0, bool)
    keys, owners = keys[once], owners[once]
    return keys, owners, *packed.groups(keys)


def _by_owner(keys: np.ndarray, owners: np.ndarray) -> pa.Table:
    """``doc_id, keys``: a row for each owner, its keys as one binary."""
    order = np.argsort(owners, kind="stable")
    keys, owners = keys[order], owners[order]
    start, size = packed.groups(owners)
    blobs = [keys[a : a + n].tobytes() for a, n in zip(start.tolist(), size.tolist())]
    return pa.table({"doc_id": pa.array(owners[start].astype(np.int64)), "keys": pa.array(blobs, pa.binary())})


def _send(found: Callable, only_later: bool, key_bytes: int, buckets: int) -> Callable:
    """A task's entries, combined chunk by chunk.

    Of the owners of a key in a chunk only the least goes on to the key's bucket. What
    the chunk alone settles is sent along as it is: the later owners, or all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, owners in packed.chunks(found(batches)):
            keys, owners, start, size = _least_owner(keys, owners)
            first = np.zeros(len(keys), bool)
            first[start] = True
            settled = ~first if only_later else np.repeat(size > 1, size)
            flags = np.where(size > 1, SHARED, 0).astype(np.uint8)
            sent = packed.pack(keys[start], owners[start], flags, buckets, key_bytes)
            none = pa.nulls(sent.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*sent.columns, none], names=[*sent.schema.names, "doc_id"])
            if settled.any():
                rows = _by_owner(keys[settled], owners[settled])
                n = len(rows)
                zero = pa.array(np.zeros(n, np.int32))
                bucket = pa.array((np.arange(n) % buckets).astype(np.int32))
                blobs = rows.column("keys").combine_chunks()
                yield pa.RecordBatch.from_arrays([bucket, zero, zero, blobs, rows.column("doc_id").combine_chunks()], names=[*sent.schema.names, "doc_id"])

    return run


def _receive(only_later: bool, key_bytes: int) -> Callable:
    """Of one bucket, each owner's keys that are shared, or that an earlier owner has."""

    def each(group: pa.Table) -> pa.Table:
        plain = np.asarray(group.column("doc_id").is_null())
        settled = group.filter(pa.array(~plain)).select(["doc_id", "block"]).rename_columns(["doc_id", "keys"])
        out = [settled]
        if plain.any():
            keys, owners, flags = packed.unpack(group.filter(pa.array(plain)), key_bytes)
            order = np.lexsort((owners, keys))
            keys, owners, flags = keys[order], owners[order], flags[order]
            start, size = packed.groups(keys)
            if only_later:
                chosen = owners != np.repeat(owners[start], size)
            else:
                chosen = np.repeat((size > 1) & (owners[start] != owners[start + size - 1]), size) | (flags & SHARED > 0)
            out.append(_by_owner(keys[chosen], owners[chosen]))
        return pa.concat_tables(out)

    return each


_SENT = packed.SCHEMA + ", doc_id bigint"
_KEYS = "doc_id bigint, keys binary"


def _first_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in slices(batches):
        seq = Sequences(batch.column("text"))
        starts = seq.window_starts(WIDTH)
        ids = np.asarray(batch.column("doc_id"))
        yield packed.key_of(anchors(seq, starts)), ids[seq.rows[starts]].astype(np.int64)


def _second_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in _unzipped(batches):
        seq = Sequences(batch.column("text"))
        starts = seq.window_starts(WIDTH)
        if not len(starts):
            continue
        key, row = packed.key_of(anchors(seq, starts)), seq.rows[starts]
        chosen = _listed(key, row, batch.column("keys").to_pylist())
        ids = np.asarray(batch.column("doc_id"))
        yield seq.stretch(starts[chosen], starts[chosen] + WIDTH), ids[row[chosen]].astype(np.int64)


def _listed(key: np.ndarray, row: np.ndarray, lists: list) -> np.ndarray:
    """Which entries are among the keys listed for their row."""
    out = np.zeros(len(key), bool)
    start, size = packed.groups(row)
    for a, n in zip(start.tolist(), size.tolist()):
        if lists[row[a]]:
            out[a : a + n] = np.isin(key[a : a + n], np.concatenate([np.frombuffer(x, np.uint64) for x in lists[row[a]]]))
    return out


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts move compressed."""
    for batch in slices(batches):
        raw = [t.encode() for t in batch.column("text").to_pylist()]
        z = pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in raw], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), z, pa.array(map(len, raw), pa.int64())], names=["doc_id", "z", "size"])


def _unzipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(batch.column("size"))
        group = (np.cumsum(sizes) - sizes) // (4 << 20)
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            text = [pa.decompress(z, n, codec="zstd", asbytes=True) for z, n in zip(part.column("z").to_pylist(), part.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(text, pa.binary()).cast(pa.string()), part.column("keys")], names=["doc_id", "text", "keys"])


def _joined(words: list[str], n_words: int) -> tuple[int, int, str, str]:
    text = " ".join(words)
    return n_words, n_words - len(words), hashlib.sha256(text.encode()).hexdigest(), text


_RESULT = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
_RESULT_SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"


def _result(ids: pa.Array, rows: list[tuple], with_text: bool) -> pa.RecordBatch:
    n, removed, sha, text = zip(*rows)
    kept = pa.array(text, pa.string()) if with_text else pa.nulls(len(rows), pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha), kept], names=_RESULT)


def _whole(with_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
            yield _result(batch.column("doc_id"), [_joined([x.decode() for x in w], len(w)) for w in words], with_text)

    return run


def _cut(with_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _unzipped(batches):
            seq = Sequences(batch.column("text"))
            starts = seq.window_starts(WIDTH)
            hit = starts[_listed(seq.stretch(starts, starts + WIDTH), seq.rows[starts], batch.column("keys").to_pylist())]
            edge = np.zeros(len(seq.rows) + 1, np.int64)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + WIDTH, -1)
            kept = np.cumsum(edge[:-1]) == 0
            words = seq.words.filter(pa.array(kept)).to_pylist()
            row = seq.rows[kept]
            ids = np.arange(batch.num_rows)
            a, b = np.searchsorted(row, ids, "left"), np.searchsorted(row, ids, "right")
            total = np.bincount(seq.rows, minlength=batch.num_rows)
            yield _result(batch.column("doc_id"), [_joined(words[i:j], int(n)) for i, j, n in zip(a, b, total)], with_text)

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` for every row of ``docs``.

    A word goes if a window of 13 words over it also starts in a document with a
    smaller id; what is kept is joined by single spaces (``kept_text`` if
    ``with_text``, else null). A null text has no words. Rows without an id, and
    texts under 13 words, lose nothing. Repeats inside one document stay, and
    repeated rows of one id are one document. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = texts(docs)
    known = rows.where("doc_id is not null and text is not null")
    # Only sets the number of buckets; six bytes is a word's usual length.
    size = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = packed.bucket_count(size // 12)
    sent = known.mapInArrow(_send(_first_scan, False, 6, buckets), _SENT)
    shared = sent.groupBy("bucket").applyInArrow(_receive(False, 6), _KEYS)
    shared = shared.groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    near = known.mapInArrow(_zipped, "doc_id bigint, z binary, size bigint").join(shared, "doc_id")
    near = materialize(spark, near.select("doc_id", "z", "size", "keys"), "repeats")

    sent = near.mapInArrow(_send(_second_scan, True, 8, buckets), _SENT)
    later = sent.groupBy("bucket").applyInArrow(_receive(True, 8), _KEYS)
    later = later.groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    cut = near.select("doc_id", "z", "size").join(later, "doc_id").mapInArrow(_cut(with_text), _RESULT_SCHEMA)
    cut = cut.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("c_id"), *[F.col(c).alias(f"c_{c}") for c in _RESULT[1:]])
    whole = rows.mapInArrow(_whole(with_text), _RESULT_SCHEMA)
    both = whole.join(cut, F.col("doc_id") == F.col("c_id"), "left")
    return both.select("doc_id", *[F.when(F.col("c_id").isNotNull(), F.col(f"c_{c}")).otherwise(F.col(c)).alias(c) for c in _RESULT[1:]])
