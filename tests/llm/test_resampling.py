"""Importance resampling against a plain Python version over the same rows."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa

from pressmill.llm import resampling
from test_operators import ODD, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, targets, share=25):
    """Every rule of the contract, one document at a time."""

    def feats(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return [zlib.crc32(f.encode()) % 10000 for f in words + [a + " " + b for a, b in zip(words, words[1:])]], len(words)

    s, t = np.zeros(10000, np.int64), np.zeros(10000, np.int64)
    seen = [(d, *feats(x)) for d, x in docs]
    for _, b, _ in seen:
        np.add.at(s, b, 1)
    for x in targets:
        np.add.at(t, feats(x)[0], 1)
    big_s, big_t = float(s.sum()), float(t.sum())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for d, b, n in seen:
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"7:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(b), weight, score, n >= 20 and d is not None])
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0]))
    drawn = drawn[: share * len(drawn) // 100]
    rank = {id(r): i + 1 for i, r in enumerate(drawn)}
    return sorted(((d, n, w, sc, rank.get(id(r))) for r in rows for d, n, w, sc, _ in [r]), key=repr)


def got(spark, docs, targets):
    df = resampling.resample(docs, spark.createDataFrame([(x,) for x in targets], "text string"))
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


def test_crc_matrix_equals_crc32():
    values = pa.array(["", "a", "ab", "ba", "é ü", "x" * 5000, "y" * 5000, None, "z" * 9000, *[prose(3, k) for k in range(50)]])
    want = [zlib.crc32((v or "").encode()) for v in values.to_pylist()]
    assert resampling.crc_strings(values).tolist() == want
    assert resampling.crc_strings(values.slice(3, 4)).tolist() == want[3:7]


def test_resample_equals_plain_version(spark, documents):
    rows = [(i, prose(10 + i % 40, i) + (" Benchmark words here" if i % 3 else "")) for i in range(60)]
    rows += [rows[5], (61, rows[7][1]), (62, prose(30, 1).upper())]
    targets = ["benchmark words here and there", prose(20, 3), "Déjà vu, ça va 42x"]
    docs = documents(*ODD, *rows)
    assert got(spark, docs, targets) == plain([(r[0], r[1]) for r in [*ODD, *rows]], targets)


def test_resample_odd_tables(spark, documents):
    long_text = prose(200_000, 4) + " " + "q" * 300_000
    docs = documents(*ODD, (9, long_text))
    assert got(spark, docs, ["x"]) == plain([*ODD, (9, long_text)], ["x"])
    assert got(spark, docs.limit(0), []) == []
    empty = got(spark, documents((1, None)), [])
    assert empty == [(1, 0, 0, plain([(1, None)], [])[0][3], None)]


def test_ties_go_to_smaller_id_and_repeats_get_their_own_ranks(spark, documents):
    text = prose(40, 9)
    docs = documents(*[(7, text)] * 8, *[(i, text) for i in range(20, 28)])
    out = got(spark, docs, [text])
    ranks = sorted(r[4] for r in out if r[4] is not None)
    assert ranks == [1, 2, 3, 4]
    assert out == plain([(7, text)] * 8 + [(i, text) for i in range(20, 28)], [text])
