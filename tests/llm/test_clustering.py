"""Sharded Lloyd rounds against the same rounds on whole vectors in numpy."""

import hashlib
import math

import numpy as np

from pressmill.llm import clustering


def plain(rows, k=40, rounds=5):
    """Every rule of the contract on whole vectors, one row at a time where it matters."""
    used = []
    for vec_id, v in rows:
        if v is None or len(v) != 64 or any(x is None or not math.isfinite(x) for x in v):
            continue
        used.append((vec_id, np.array([math.floor(256 * float(x)) for x in v], np.int64)))
    if not used:
        return []
    seeds = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), tuple(v)) for i, v in used if i is not None)[:k]
    cent = np.array([s[1] for s in seeds], np.int64)
    mat = np.stack([v for _, v in used])

    def assign():
        d = ((mat[:, None, :] - cent[None, :, :]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        c, _ = assign()
        for j in range(len(cent)):
            if (c == j).any():
                cent[j] = np.floor_divide(mat[c == j].sum(0), (c == j).sum())
    c, d = assign()
    per = {j: int(d[c == j].sum()) for j in range(len(cent))}
    digest = [hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest() for row in cent]
    return sorted(((i, int(c[n]), int(d[n]), per[int(c[n])], int(d.sum()), digest[c[n]]) for n, (i, _) in enumerate(used)), key=repr)


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3).withColumn("_r", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x"))
    out = clustering.cluster_vectors(df, **kw).collect()
    return sorted((tuple(r) for r in out), key=repr)


def vectors(n, seed, dim=64):
    r = np.random.RandomState(seed)
    centers = r.standard_normal((6, dim)) * 0.3
    return [(i, [float(np.float32(x)) for x in centers[i % 6] + r.standard_normal(dim) * 0.05]) for i in range(n)]


def test_clusters_equal_whole_vector_rounds(spark):
    rows = vectors(300, 1)
    rows += [rows[3], (None, rows[4][1]), (900, None), (901, [1.0] * 63), (902, [float("nan")] + [0.0] * 63), (903, [None] + [0.0] * 63), (904, [0.0] * 64)]
    assert got(spark, rows) == plain(rows)


def test_few_vectors_ties_and_empty(spark):
    same = [(i, [0.5] * 64) for i in range(5)]
    assert got(spark, same) == plain(same)
    assert got(spark, same[:0]) == []
    two = [(1, [0.0] * 64), (2, [1.0] * 64), (3, [0.5] * 64)]
    assert got(spark, two, k=2) == plain(two, k=2)
