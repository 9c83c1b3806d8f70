"""Near-duplicate vectors: sign hashes in several tables, exact cosines, distributed components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import small_batches
from pressmill.llm.components import components
from pressmill.session import materialize

#: Vectors of a hash bucket that one task compares with as many others; larger buckets are dealt out in blocks.
BLOCK = 2048
BUCKET = 48  # vectors a bucket should hold on average
RECALL = 0.998  # of pairs right at the threshold, on average over hyperplanes


def hash_shape(n: int, threshold: float, bucket: int = BUCKET, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a hash and number of tables for ``n`` vectors.

    Bits follow the logarithm of ``n``, so buckets stay the same size. Two vectors
    at angle a agree on a bit with chance 1 - a/pi, and a pair at the threshold
    meets in one of the tables with chance ``recall``.
    """
    bits = min(30, max(4, math.ceil(math.log2(max(n, 1) / bucket + 1))))
    agree = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _hashes(matrix: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    planes = np.random.RandomState(seed).standard_normal((matrix.shape[1], bits * tables))
    signs = (matrix @ planes >= 0).reshape(len(matrix), tables, bits)
    return (signs @ (1 << np.arange(bits))).astype(np.int32)


def _unit(blobs: list[bytes]) -> np.ndarray:
    rows = np.stack([np.frombuffer(x, np.float64) for x in blobs])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _merge(labels: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Join the label trees of linked rows, in place; each label ends as the smallest row of its tree."""
    while len(p):
        a, b = labels[p], labels[q]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]
        open_ = labels[p] != labels[q]
        p, q = p[open_], q[open_]


def _compare(group: pa.Table, threshold: float, step: int = 512) -> pa.Table:
    """Link counts and local roots of the vectors of one bucket, or of two blocks of one.

    A pair counts in the first table where it meets, so the later ones skip it.
    """
    table = group.column("t")[0].as_py()
    two = group.column("i")[0].as_py() != group.column("j")[0].as_py()
    ids = np.asarray(group.column("vec"))
    order = np.argsort(ids, kind="stable")
    ids, group = ids[order], group.take(pa.array(order))
    block = np.asarray(group.column("block"))
    weight = np.asarray(group.column("n")).astype(np.float64)
    sigs = np.stack([np.frombuffer(x, np.int32) for x in group.column("sigs").to_pylist()])[:, :table]
    blobs = group.column("v").to_pylist()
    size = np.array([len(x) for x in blobs])
    links, labels = np.zeros(len(ids)), np.arange(len(ids))
    for width in np.unique(size):
        rows = np.flatnonzero(size == width)
        unit = _unit([blobs[k] for k in rows])
        for a in range(0, len(rows), step):
            for b in range(a, len(rows), step):
                ra, rb = rows[a : a + step], rows[b : b + step]
                near = unit[a : a + step] @ unit[b : b + step].T >= threshold
                if a == b:
                    near &= np.tri(len(ra), k=-1, dtype=bool).T
                if two:
                    near &= block[ra][:, None] != block[rb][None, :]
                p, q = np.nonzero(near)
                if table and len(p):
                    first = ~(sigs[ra[p]] == sigs[rb[q]]).any(axis=1)
                    p, q = p[first], q[first]
                p, q = ra[p], rb[q]
                np.add.at(links, p, weight[q])
                np.add.at(links, q, weight[p])
                _merge(labels, p, q)
    some = links > 0
    return pa.table({"vec": ids[some], "links": links[some].astype(np.int64), "root": ids[labels[some]]})


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Equal vectors become one with a count. Each is hashed by the signs of random
    projections in several tables; vectors of a bucket are compared by cosine in
    double precision, and links of ``threshold`` or more count once. Buckets above
    ``BLOCK`` are dealt out as pairs of blocks, so no task holds a whole hot one.
    A pair that meets in no table is missed (see ``RECALL``); no pair below the
    threshold is linked.

    Vectors that are null, empty, zero, or hold null or non-finite components,
    and rows without id, link with nothing and keep their own id. Vectors of
    different length never link. Repeated rows are other vectors and link.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("e"))
    usable = _usable(F.col("e")) & F.col("vec_id").isNotNull()
    keys = [F.xxhash64("e").alias("k1"), F.xxhash64(F.lit(seed), F.col("e")).alias("k2")]
    rows = rows.select("vec_id", "e", usable.alias("ok"), *keys)
    distinct = rows.where("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("vec"), F.count("*").alias("n"), F.min_by("e", "vec_id").alias("e"))
    distinct = materialize(spark, distinct, "vectors")
    count = distinct.count()
    bits, tables = hash_shape(count, threshold)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("e")
            sizes = np.asarray(lists.value_lengths())
            flat = np.asarray(lists.flatten())
            at = np.cumsum(sizes) - sizes
            for width in np.unique(sizes):
                here = np.flatnonzero(sizes == width)
                matrix = flat[at[here][:, None] + np.arange(width)]
                scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
                sigs = _hashes(scaled, bits, tables, seed)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec").take(pa.array(here)),
                        batch.column("n").take(pa.array(here)),
                        pa.array([r.tobytes() for r in matrix], pa.binary()),
                        pa.array([r.tobytes() for r in sigs], pa.binary()),
                        pa.array(list(sigs), pa.list_(pa.int32())),
                    ],
                    names=["vec", "n", "v", "sigs", "keys"],
                )

    coded = distinct.select("vec", "n", "e").mapInArrow(hashed, "vec bigint, n bigint, v binary, sigs binary, keys array<int>")
    coded = materialize(spark, coded, "vectors")
    place = F.posexplode("keys").alias("t", "bucket")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    hot = coded.select(place).groupBy("t", "bucket").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    hot = materialize(spark, hot.select("t", "bucket", blocks), "vectors")
    placed = coded.select("vec", "n", "v", "sigs", place).join(hot, ["t", "bucket"], "left")
    placed = placed.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("t", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "vec", "n", "v", "sigs")
    found = placed.groupBy("t", "bucket", "i", "j").applyInArrow(lambda g: _compare(g, threshold), "vec bigint, links bigint, root bigint")
    found = materialize(spark, found, "vectors")
    whole = components(found.select("vec", "root"), "vec", "root")
    links = found.groupBy("vec").agg(F.sum("links").alias("links"))
    classes = distinct.select("k1", "k2", "vec", "n").join(links, "vec", "left").join(whole, F.col("vec") == F.col("node"), "left")
    own = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    classes = materialize(spark, classes.select("k1", "k2", own.alias("n_links"), F.coalesce("component", "vec").alias("component_id")), "vectors")
    good = rows.where("ok").select("vec_id", "k1", "k2").join(classes, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(F.col("ok"), F.lit(False))).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
