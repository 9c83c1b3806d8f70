"""Importance resampling towards a target text distribution.

Features of a text are its word 1-grams and 2-grams, hashed into buckets by
CRC-32. Distinct features of a batch are grouped by byte length into
two-dimensional uint8 arrays, the CRCs of a whole array are updated column by
column, and the values are scattered back to every occurrence.

Counts per bucket over all documents (S, s) and over the target texts (T, t)
give a gain per bucket; a document's weight is the floored mean gain of its
features, its score adds a Gumbel key drawn from its id, and the highest
scores are drawn. Counts are partial sums per task, so only one row per bucket
and task moves; the draw is a distributed sort ranked by partition offsets.

Defined results:

* null text, or no words: no features, weight 0;
* null doc_id: scored by the text, never drawn, not counted in N;
* fewer than ``MIN_WORDS`` words: scored, never drawn, not counted in N;
* ties of score go to the smaller doc_id; repeated rows of one id and text
  are ranked one after the other, in an order fixed by a seeded draw;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm.common import slices, small_batches
from pressmill.session import materialize

#: Fixed values of the method.
BUCKETS = 10000
MAX_GRAM = 2
MIN_WORDS = 20
SHARE_PERCENT = 25
SEED = 7
#: Anything but ASCII letters and digits separates words (A-Z are lower-cased first).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A length group of fewer rows than this, each longer than ``LONG_BYTES``, is hashed row by row:
#: a column loop over a few very long features would cost a Python step per byte.
FEW_ROWS, LONG_BYTES = 4, 4096


def _crc_table() -> np.ndarray:
    """The 256 entries of reflected CRC-32 (polynomial 0xEDB88320), from the rule."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1).astype(np.uint32)
    return crc


_TABLE = _crc_table()


def crc_matrix(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of an ``(n, L)`` uint8 array, updated one column at a time."""
    crc = np.full(matrix.shape[0], 0xFFFFFFFF, np.uint32)
    for j in range(matrix.shape[1]):
        crc = _TABLE[(crc ^ matrix[:, j]) & 0xFF] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def crc_strings(values: pa.Array) -> np.ndarray:
    """CRC-32 of the UTF-8 bytes of each string: equal lengths share one matrix, results go back in place."""
    values = values.cast(pa.large_string()) if values.type != pa.large_string() else values
    n = len(values)
    out = np.zeros(n, np.uint32)
    if not n:
        return out
    values = pc.fill_null(values, "")
    buffers = values.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[values.offset : values.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, edges):
        width = int(lengths[group[0]])
        if width == 0:
            out[group] = 0
        elif len(group) < FEW_ROWS and width > LONG_BYTES:
            out[group] = [zlib.crc32(data[offsets[i] : offsets[i] + width]) for i in group]
        else:
            matrix = data[offsets[group][:, None] + np.arange(width)]
            out[group] = crc_matrix(matrix)
    return out


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature occurrence, the row it belongs to, and words per row."""
    n_rows = len(column)
    lowered = pc.ascii_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    parts = pc.split_pattern_regex(lowered, SEPARATORS)
    flat = pc.list_flatten(parts)
    rows = np.asarray(pc.list_parent_indices(parts))
    some = np.asarray(pc.binary_length(flat)) > 0
    words, rows = flat.filter(pa.array(some)), rows[some]
    n_words = np.bincount(rows, minlength=n_rows).astype(np.int64)
    grams, gram_rows = [words], [rows]
    for k in range(2, MAX_GRAM + 1):
        if len(words) < k:
            break
        same = rows[k - 1 :] == rows[: len(rows) - k + 1]
        joined = words.slice(0, len(words) - k + 1)
        for j in range(1, k):
            joined = pc.binary_join_element_wise(joined, words.slice(j, len(words) - k + 1), pa.scalar(" ", pa.large_string()))
        grams.append(joined.filter(pa.array(same)))
        gram_rows.append(rows[: len(rows) - k + 1][same])
    every = pa.concat_arrays([g.cast(pa.large_string()) for g in grams])
    coded = every.dictionary_encode()
    buckets = (crc_strings(coded.dictionary) % np.uint32(BUCKETS)).astype(np.int64)
    return buckets[np.asarray(coded.indices)], np.concatenate(gram_rows), n_words


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket this task saw, with its count of feature occurrences."""
    total = np.zeros(BUCKETS, np.int64)
    for part in slices(batches):
        buckets, _, _ = features(part.column("text"))
        total += np.bincount(buckets, minlength=BUCKETS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Feature occurrences per bucket over all texts; tasks send partial sums of at most ``BUCKETS`` rows."""
    small_batches(texts.sparkSession)
    partial = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_histograms, "bucket int, n bigint")
    counts = np.zeros(BUCKETS, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        counts[row.bucket] = row.n
    return counts


def gains(doc_counts: np.ndarray, target_counts: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) per bucket, in doubles."""
    big_s, big_t = float(doc_counts.sum()), float(target_counts.sum())
    out = np.empty(BUCKETS, np.int64)
    for b in range(BUCKETS):
        ratio = (float(target_counts[b]) + 1) * (big_s + BUCKETS) / ((float(doc_counts[b]) + 1) * (big_t + BUCKETS))
        out[b] = math.floor(1000 * math.log(ratio))
    return out


def _weigher(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n = part.num_rows
            buckets, rows, n_words = features(part.column("text"))
            n_features = np.bincount(rows, minlength=n).astype(np.int64)
            total = np.zeros(n, np.int64)
            np.add.at(total, rows, gain[buckets])
            weight = np.where(n_features > 0, np.floor_divide(total, np.maximum(n_features, 1)), 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("_tie"), part.column("doc_id"), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                ["_tie", "doc_id", "n_words", "n_features", "weight"],
            )

    return run


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h the first 8 hex digits of sha256(``seed:doc_id``)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, share_percent: int = SHARE_PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with ``doc_id, n_words, n_features, weight, score, rank``; rank is null for undrawn ones.

    Of the N documents with an id and at least ``MIN_WORDS`` words, the
    floor(share_percent * N / 100) highest scores are drawn.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    gain = gains(bucket_counts(rows), bucket_counts(target.select(F.col(text_col).alias("text"))))
    small_batches(spark)
    keyed = rows.withColumn("_tie", F.xxhash64("text"))
    weighed = keyed.mapInArrow(_weigher(gain), "_tie bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    # Written once (five longs a row): the sort samples its input and then reads it, and would weigh every text twice.
    weighed = materialize(spark, weighed, "weights")
    scored = weighed.withColumns({"score": (F.col("weight") + gumbel(F.col("doc_id"))).cast("bigint"),
                                  "_eligible": F.col("doc_id").isNotNull() & (F.col("n_words") >= MIN_WORDS)})
    # Eligible rows first, best score first; equal rows are told apart by a seeded draw, so no sort key holds a hot group.
    ordered = scored.orderBy(F.desc("_eligible"), F.desc("score"), F.asc("doc_id"), "_tie", F.rand(SEED))
    placed = materialize(spark, ordered.withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()}), "resample")
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_n"), F.count_if("_eligible").alias("_e"))  # one row per partition
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"), F.sum("_e").over(Window.partitionBy()).alias("_N"))
    position = F.col("_o") + F.col("_m") - F.shiftleft(F.col("_p").cast("bigint"), 33) + 1
    drawn = F.col("_eligible") & (position <= F.floor(F.col("_N") * share_percent / 100))
    return placed.join(F.broadcast(offsets), "_p").select(
        "doc_id", "n_words", "n_features", "weight", "score", F.when(drawn, position).cast("bigint").alias("rank")
    )
