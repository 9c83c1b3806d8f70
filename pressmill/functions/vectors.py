"""Numpy kernels that run inside Arrow batches: text hashing and top-k scoring."""

from __future__ import annotations

import hashlib
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCORE_DIGITS = 9  # scores equal to this many decimals tie, and ties go by id
_TILE_ROWS, _TILE_QUESTIONS = 1024, 1024  # scores held at once: 4 MiB of floats


def process_cache() -> dict:
    """A dictionary that lives as long as the Python worker process."""
    name = "_pressmill_process_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].entries = {}
    return sys.modules[name].entries


def hash_vectors(texts: list[str], dim: int) -> np.ndarray:
    """Signed feature hashing of lower-case words, L2-normalized.

    The first eight hex digits of a word's md5 choose the bucket, the ninth
    the sign. Each distinct word of a batch is hashed once.
    """
    split = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.string())))
    words = split.flatten().dictionary_encode()
    rows = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    head, fifth = md5_heads(words.dictionary)
    bucket = head.astype(np.int64) % dim
    sign = np.where(fifth < 128, 1.0, -1.0)
    sign[pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False).astype(bool)] = 0.0
    codes = words.indices.to_numpy(zero_copy_only=False)
    cells = rows * dim + bucket[codes] if len(codes) else np.zeros(0, dtype=np.int64)
    weights = sign[codes] if len(codes) else np.zeros(0)
    dense = np.bincount(cells, weights=weights, minlength=len(texts) * dim).reshape(len(texts), dim)
    return unit_rows(dense).astype(np.float32)


_SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint32)
_ONE_BLOCK = 55  # bytes; longer words are hashed one by one


def md5_heads(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The first four bytes of each word's md5 as a big-endian number, and the fifth.

    Words of one block are hashed together, a column of their bytes at a time.
    """
    words = words.cast(pa.large_binary())
    head, fifth = np.zeros(len(words), np.uint32), np.zeros(len(words), np.uint8)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8) if len(words) else np.zeros(0, np.uint8)
    sizes = np.diff(ends)
    for at in range(0, len(words), 8192):
        some = at + np.flatnonzero(sizes[at : at + 8192] <= _ONE_BLOCK)
        n = sizes[some]
        blocks = np.zeros((len(some), 64), np.uint8)
        row = np.repeat(np.arange(len(some)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        blocks[row, place] = raw[np.repeat(ends[some], n) + place]
        blocks[np.arange(len(some)), n] = 0x80
        blocks[:, 56:58] = (8 * n).astype("<u2").view(np.uint8).reshape(-1, 2)
        a, b = _md5_block(np.ascontiguousarray(blocks.view("<u4").T))
        head[some], fifth[some] = a.astype(np.uint32).byteswap(), b & np.uint32(255)
    for i in np.flatnonzero(sizes > _ONE_BLOCK).tolist():
        digest = hashlib.md5(words[i].as_py()).digest()
        head[i], fifth[i] = int.from_bytes(digest[:4], "big"), digest[4]
    return head, fifth


def _md5_block(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first two words of the md5 of messages of one block, given as 16 rows of little-endian numbers."""
    start = [np.full(m.shape[1], x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = start
    for i in range(64):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f = f + a + _SINES[i] + m[g]
        turn = _SHIFTS[i // 16][i % 4]
        a, b, c, d = d, b + (f << np.uint32(turn) | f >> np.uint32(32 - turn)), b, c
    return a + start[0], b + start[1]


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=np.zeros_like(matrix, dtype=np.float64), where=norms > 0)


def list_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as an ``(n, dim)`` double matrix; a wrong length is an error."""
    lengths = pc.list_value_length(column)
    if len(column) and not pc.all(pc.equal(pc.fill_null(lengths, -1), dim)).as_py():
        raise ValueError(f"every vector must have {dim} elements")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


class TopK:
    """Running exact top-k of many questions over a stream of vector batches.

    Holds at most k candidates per question. Order is score (rounded to
    ``SCORE_DIGITS``) descending, then id ascending. Tiles of scores are made in
    single precision and only sieve: whatever the error of such a score could
    lift to the floor is scored again in double precision, and those scores count.
    """

    def __init__(self, questions: np.ndarray, limits: np.ndarray, threshold: float | None = None):
        self._questions = unit_rows(questions)
        self._coarse = self._questions.astype(np.float32)
        self._limits = limits
        self._threshold = -np.inf if threshold is None else threshold
        # Twice the bound of a single-precision dot product of unit vectors, and of the rounding of scores.
        self._slack = (questions.shape[1] + 8) * 2.0**-23 + 2 * 10.0**-SCORE_DIGITS
        self._floor = np.full(len(limits), self._threshold)  # no lower score can enter
        self.q = np.zeros(0, dtype=np.int64)
        self.score = np.zeros(0)
        self.ids = None
        self._tile = np.empty(_TILE_QUESTIONS * _TILE_ROWS, np.float32)  # fresh pages would cost as much as the product
        self._found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for at in range(0, len(ids), _TILE_ROWS):
            self._add_rows(ids[at : at + _TILE_ROWS], unit_rows(vectors[at : at + _TILE_ROWS]))
            if 16 * sum(len(f[0]) for f in self._found) > len(self._limits):
                self._take_up()
        self._take_up()

    def _take_up(self) -> None:
        """Merge what the tiles found: at the end of a batch, or sooner while lists fill and floors still rise."""
        if self._found:
            self._merge(*(np.concatenate(x) for x in zip(*self._found)))
            self._found = []

    def _add_rows(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        bad = np.isnan(vectors).any(axis=1)
        if bad.any():  # no score, so never a hit
            ids, vectors = ids[~bad], vectors[~bad]
        coarse = np.ascontiguousarray(vectors.astype(np.float32).T)
        found = [self._sieve(at, coarse) for at in range(0, len(self._limits), _TILE_QUESTIONS)] if len(ids) else []
        q = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        if not len(q):
            return
        row = np.concatenate([f[1] for f in found])
        score = np.round(np.einsum("ij,ij->i", vectors[row], self._questions[q]), SCORE_DIGITS)
        good = (score >= self._threshold) & (score >= self._floor[q])
        if good.any():
            self._found.append((q[good], score[good], ids[row[good]]))

    def _sieve(self, at: int, coarse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Questions of the tile from ``at`` and rows whose score may enter. Most questions' best score is below their
        floor, and their other scores are not looked at."""
        part, rows = slice(at, at + _TILE_QUESTIONS), coarse.shape[1]
        tile = self._tile[: len(self._coarse[part]) * rows].reshape(-1, rows)
        scores = np.matmul(self._coarse[part], coarse, out=tile)
        floor = (self._floor[part] - self._slack).astype(np.float32)[:, None]
        some = np.flatnonzero(scores.max(axis=1) >= floor[:, 0])
        if len(some) < len(scores):
            scores, floor = scores[some], floor[some]
        enter = scores >= floor
        widest = int(self._limits[part].max(initial=0))
        if rows > widest and np.count_nonzero(enter) > 4 * widest * len(scores):
            # Lists that are not full yet let too many in: the tile's own k-th best bounds them.
            kth = np.partition(scores, rows - widest, axis=1)[:, rows - widest, None] - np.float32(2 * self._slack)
            enter &= scores >= np.fmax(floor, kth)
        at_q, row = np.divmod(np.flatnonzero(enter), rows)
        return some[at_q] + at, row

    def _merge(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Take up candidates; lists of other questions stay as they are."""
        rest = None
        if self.ids is not None:
            touched = np.zeros(len(self._limits), bool)
            touched[q] = True
            mine = touched[self.q]
            rest = self.q[~mine], self.score[~mine], self.ids[~mine]
            q, score = np.concatenate([self.q[mine], q]), np.concatenate([self.score[mine], score])
            ids = np.concatenate([self.ids[mine], ids])
        order = np.lexsort((-score, q))
        q, score, ids = q[order], score[order], ids[order]
        same = (q[1:] == q[:-1]) & (score[1:] == score[:-1])
        tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
        if len(tied):
            # Ids are looked at only where scores tie; tied rows lie together.
            names = ids[tied] if ids.dtype != object else ids[tied].astype(str)
            ids[tied] = ids[tied][np.lexsort((names, -score[tied], q[tied]))]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < self._limits[q]
        q, score, ids, last = q[best], score[best], ids[best], (place == self._limits[q] - 1)[best]
        self._floor[q[last]] = score[last]
        if rest is not None:
            q, score, ids = (np.concatenate(pair) for pair in zip(rest, (q, score, ids)))
            order = np.argsort(q, kind="stable")
            q, score, ids = q[order], score[order], ids[order]
        self.q, self.score, self.ids = q, score, ids
