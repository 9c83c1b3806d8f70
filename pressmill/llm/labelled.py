"""Bounded samples of labelled documents, and scoring of all documents by a small model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import slices, texts

#: Labelled rows a classifier is fitted on at most.
SAMPLE_ROWS = 20_000
#: Rows of this remainder are held out: their labels are never read.
FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, y, text`` of at most ``rows`` labelled documents outside the held-out fold.

    The sample is the first ids by a hash of the id, each with one label (that of
    most of its label rows, 0 in a tie) and one text (the smallest of its document
    rows). It is broadcast to the documents, so texts outside it do not move, and
    of a repeated id one text for each task does.
    """
    some = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    some = some.where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    some = some.groupBy("doc_id").agg((F.avg("y") > 0.5).cast("int").alias("y"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return texts(docs).join(F.broadcast(some), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def sample_features(sample: DataFrame, features: Callable[[str | None], list[float]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, features and labels of a bounded sample, in the order of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = pa.array([features(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), x], names=["doc_id", "y", "x"])

    got = sample.mapInArrow(run, "doc_id bigint, y int, x array<double>").toArrow()
    order = np.lexsort((np.asarray(got["y"]), np.asarray(got["doc_id"])))
    x = np.array(got["x"].to_pylist(), float).reshape(-1, width)
    return np.asarray(got["doc_id"])[order], x[order], np.asarray(got["y"])[order]


def score_texts(docs: DataFrame, *more: str, features: Callable[[str | None], list[float]], score: Callable[[np.ndarray], np.ndarray], width: int) -> DataFrame:
    """``doc_id, text, *more, score`` of every row, in one pass over the texts."""
    rows = texts(docs, *more)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([features(t) for t in batch.column("text").to_pylist()], float).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score(x), pa.float64())], names=[*names, "score"])

    from pyspark.sql import types as T

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]))
