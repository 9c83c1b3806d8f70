"""Centroid clustering of integer vectors by dimension-sharded Lloyd rounds.

Each vector is cut into column blocks (shards). A task holding block j of many
vectors computes the exact partial squared distances of each to block j of
every centroid; the blocks of one vector are then added up by its row key
(at most ``shards`` rows per key, so no group grows with the data) and the
argmin is taken. Each shard updates its own slice of the centroids: the
componentwise sums and counts per (cluster, shard) are summed map-side first,
so a cluster holding a third of all vectors moves one row per task.

Centroids (k x d integers) are the only thing that passes through the driver.

Defined results:

* a vector is used when it has exactly ``DIM`` components, none null or
  non-finite, and every floor(256 x) lies within +-2^27 (so distances are exact
  in 64 bits); others are left out of the result;
* initial centroids are the ``K`` used rows of smallest sha256(``2:<vec_id>``),
  ascending, ties by the components; rows without vec_id are clustered but
  never seed; with fewer used rows than ``K``, all of them seed;
* ties of distance go to the smaller centroid number; an empty cluster keeps
  its centroid; repeated rows count as often as they occur;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.session import materialize

#: Fixed values of the method.
DIM = 64
K = 40
ROUNDS = 5
SEED = 2
SCALE = 256
#: Column blocks a vector is cut into.
SHARDS = 4
LIMIT = 1 << 27


def _width(shards: int) -> int:
    if DIM % shards:
        raise ValueError(f"{shards} shards do not divide {DIM} components")
    return DIM // shards


def _prepared(spark: SparkSession, vectors: DataFrame, id_col: str, vector_col: str, shards: int) -> DataFrame:
    """``_r, vec_id, shard, part``: integer slices of every usable vector, one row per shard, written once."""
    values = F.col(vector_col).cast("array<double>")
    usable = (
        values.isNotNull()
        & (F.size(values) == DIM)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < LIMIT))
    )
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), values.alias("_v")).where(usable)
    ints = rows.select("vec_id", F.transform(F.col("_v"), lambda x: F.floor(x * SCALE)).alias("ints"))
    ints = ints.withColumn("_r", F.monotonically_increasing_id())
    width = _width(shards)
    cut = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(s.alias("shard"), F.slice("ints", s * width + 1, width).alias("part")))
    return materialize(spark, ints.select("_r", "vec_id", F.inline(cut)), "clusters")


def _seeds(parts: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` used rows of smallest sha256(``seed:vec_id``), as a k x d array.

    The k-th smallest hash is found first (top k per task); only rows up to it
    are put together, and again only k of them reach the driver.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    keyed = parts.where(F.col("vec_id").isNotNull()).withColumn("h", key)
    last = keyed.where("shard = 0").select("h").orderBy("h").limit(k).collect()  # k rows
    if not last:
        return np.zeros((0, DIM), np.int64)
    near = keyed.where(F.col("h") <= last[-1].h)
    whole = near.groupBy("_r", "h").agg(F.flatten(F.array_sort(F.collect_list(F.struct("shard", "part")))["part"]).alias("ints"))
    first = whole.orderBy("h", "ints").limit(k).collect()  # k rows
    return np.array([r.ints for r in first], np.int64).reshape(len(first), DIM)


def _partial(centroids: np.ndarray, shards: int):
    width = _width(shards)
    blocks = [centroids[:, s * width : (s + 1) * width] for s in range(shards)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard").to_numpy()
            flat = batch.column("part").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, width)
            out = np.empty((batch.num_rows, len(centroids)), np.int64)
            for s in np.unique(shard):
                rows = np.flatnonzero(shard == s)
                part, block = flat[rows], blocks[s]
                # Exact: components lie within +-2^27, so every term stays inside 64 bits.
                out[rows] = (part * part).sum(1)[:, None] - 2 * part @ block.T + (block * block).sum(1)[None, :]
            dists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, len(centroids), dtype=np.int32)), pa.array(out.ravel()))
            names = ["_r", "vec_id", "shard", "part"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), dists], [*names, "d"])

    return run


def _assign(parts: DataFrame, centroids: np.ndarray, shards: int) -> DataFrame:
    """``_r, vec_id, cluster, distance, slices``: partial distances added by row key, then the argmin."""
    k = len(centroids)
    partial = parts.mapInArrow(_partial(centroids, shards), "_r bigint, vec_id bigint, shard int, part array<bigint>, d array<bigint>")
    zero = F.array_repeat(F.lit(0).cast("bigint"), k)
    whole = partial.groupBy("_r", "vec_id").agg(
        F.aggregate(F.collect_list("d"), zero, lambda acc, d: F.zip_with(acc, d, lambda a, b: a + b)).alias("d"),
        F.collect_list(F.struct("shard", "part")).alias("slices"),  # at most `shards` entries
    )
    best = F.array_min("d")
    return whole.select("_r", "vec_id", (F.array_position("d", best) - 1).cast("int").alias("cluster"), best.alias("distance"), "slices")


def _update(assigned: DataFrame, centroids: np.ndarray, shards: int) -> np.ndarray:
    """Each shard's slice of every non-empty centroid becomes floor(sum / count) of its vectors."""
    width = _width(shards)
    cells = assigned.select("cluster", F.inline("slices")).select("cluster", "shard", F.posexplode("part").alias("j", "x"))
    sums = cells.groupBy("cluster", "shard", "j").agg(F.sum("x").alias("s"), F.count("*").alias("n")).collect()  # k * d rows
    new = centroids.copy()
    for r in sums:
        new[r.cluster, r.shard * width + r.j] = r.s // r.n
    return new


def cluster_vectors(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, shards: int = SHARDS, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per used vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    spark = vectors.sparkSession
    parts = _prepared(spark, vectors, id_col, vector_col, shards)
    centroids = _seeds(parts, k, seed)
    if not len(centroids):
        empty = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    for _ in range(rounds):
        # One job per round; a lost task recomputes from the written slices.
        centroids = _update(_assign(parts, centroids, shards), centroids, shards)
    final = materialize(spark, _assign(parts, centroids, shards).drop("slices"), "assigned")
    per = {r.cluster: r.s for r in final.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    total = sum(per.values())
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    table = spark.createDataFrame(
        [(c, int(per.get(c, 0)), int(total), digests[c]) for c in range(len(centroids))], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return final.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
