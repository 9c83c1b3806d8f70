"""Text to vectors through a named, pluggable batch function."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.functions.vectors import hash_vectors, process_cache

DIMENSION = 768
EmbedBatch = Callable[[list[str]], np.ndarray]

# name -> loader; a loader takes the dimension and returns the batch function.
_LOADERS: dict[str, Callable[[int], EmbedBatch]] = {"hash": lambda dim: partial(hash_vectors, dim=dim)}


_REGISTERED: dict[str, int] = {}


def register_embedder(name: str, loader: Callable[[int], EmbedBatch]) -> None:
    """Add or replace a provider. ``loader(dim)`` runs once per Python worker process and registration."""
    _LOADERS[name] = loader
    _REGISTERED[name] = _REGISTERED.get(name, 0) + 1


def embedder(provider: str) -> Callable[[int], EmbedBatch]:
    if provider not in _LOADERS:
        raise ValueError(f"unknown embedding provider: {provider}")
    return _LOADERS[provider]


def embed_batch(embed: EmbedBatch, texts: list[str], dim: int) -> np.ndarray:
    """Call the batch function and hold it to its contract."""
    if not texts:
        return np.zeros((0, dim), dtype=np.float32)
    vectors = np.asarray(embed(texts), dtype=np.float32)
    if vectors.shape != (len(texts), dim):
        raise ValueError(f"expected {len(texts)} vectors of {dim} elements, got shape {vectors.shape}")
    return vectors


def embed_each(embed: EmbedBatch, texts: list[str], dim: int) -> list[np.ndarray | None]:
    """As :func:`embed_batch`, but a text that fails gives None.

    A failing batch is halved until the failing texts stand alone.
    """
    try:
        return list(embed_batch(embed, texts, dim))
    except Exception:
        if len(texts) == 1:
            return [None]
        half = len(texts) // 2
        return embed_each(embed, texts[:half], dim) + embed_each(embed, texts[half:], dim)


def embedding_of(
    text: Column, provider: str = "hash", dim: int = DIMENSION, keep_failures: bool = False, batch_size: int | None = None
) -> Column:
    """Embedding expression. Only the text crosses to Python, in Arrow batches
    that span items, and the model is loaded once per worker process.

    An error of the provider fails the job; with ``keep_failures`` the texts
    it fails on get a null vector instead. ``batch_size`` bounds the texts a
    provider gets at once; without it they come by whole Arrow batches.
    """
    loader = embedder(provider)
    key = (provider, dim, _REGISTERED.get(provider, 0))

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = process_cache()
        if key not in cache:
            cache[key] = loader(dim)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.to_pylist()]
            step = batch_size or max(1, len(texts))
            parts = [texts[i : i + step] for i in range(0, len(texts), step)]
            if keep_failures:
                each = [v for part in parts for v in embed_each(cache[key], part, dim)]
                yield pa.array(each, pa.list_(pa.float32()))
                continue
            done = [embed_batch(cache[key], part, dim) for part in parts]
            vectors = np.concatenate(done) if done else np.zeros((0, dim), np.float32)
            offsets = pa.array(np.arange(0, vectors.size + 1, dim, dtype=np.int32))
            yield pa.ListArray.from_arrays(offsets, pa.array(vectors.reshape(-1)))

    return run(text)


def embed(
    rows: DataFrame,
    text: str = "chunk_text",
    provider: str = "hash",
    dim: int = DIMENSION,
    partitions: int | None = None,
    keep_failures: bool = False,
    batch_size: int | None = None,
) -> DataFrame:
    """Adds ``embedding``.

    Long documents leave uneven chunk counts per task; with a slow model give
    ``partitions`` to even them out first. A cheap model is faster without.
    """
    balanced = rows.repartition(partitions) if partitions else rows
    return balanced.withColumn("embedding", embedding_of(F.col(text), provider, dim, keep_failures, batch_size))


def require_dimension(rows: DataFrame, dim: int, column: str = "embedding", nullable: bool = False) -> DataFrame:
    """Fail the job on a vector that is not ``dim`` long, or (unless
    ``nullable``) missing."""
    length = F.coalesce(F.size(column), F.lit(dim if nullable else 0))
    bad = F.when(F.col(column).isNull(), F.lit(not nullable)).otherwise(length != dim)
    message = F.concat(F.lit(f"expected vectors of {dim} elements, got "), length.cast("string"))
    return rows.withColumn(column, F.when(bad, F.raise_error(message).cast("array<float>")).otherwise(F.col(column)))
