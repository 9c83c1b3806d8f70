"""What the operators share: tables, Arrow slices of whole texts, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these characters.
SPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Bytes of text a Python task works on at once; a longer text stands alone.
SLICE_BYTES = 4 << 20
#: Rows in one Arrow batch. Texts are long, so batches hold few of them.
BATCH_ROWS = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *more: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` and the named columns alone: other columns can't clash, and the scan skips them."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), *more)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, unless the session's bound is lower."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def word_count(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("bigint")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut where their texts reach ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def lower_ascii(column: pa.Array) -> pa.Array:
    return pc.ascii_lower(column)


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words in one array, and the row each belongs to (ascending). A null has none."""
    parts = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    flat, rows = pc.list_flatten(parts), np.asarray(pc.list_parent_indices(parts))
    some = np.asarray(pc.binary_length(flat)) > 0
    if not some.all():
        flat, rows = flat.filter(pa.array(some)), rows[some]
    return flat, rows


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    coded = words.dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    if not len(names):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(names, categorize=False)[np.asarray(coded.indices)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` values; entry i covers i .. i+width-1."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mix(out)


def spans_of(rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one position of each row in an ascending row array."""
    ids = np.arange(n_rows)
    return np.searchsorted(rows, ids, "left"), np.searchsorted(rows, ids, "right")


def running_sums(values: Column, block: int = 256) -> Column:
    """For each entry of an array of longs, the sum of those before it.

    Sums go by blocks, and in each block by entries: an append copies at most
    a block, or one entry per block, so long arrays stay cheap.
    """
    n = F.size(values)
    empty = F.array().cast("array<bigint>")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(block))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda s: F.slice(values, s + 1, F.lit(block)))

    def prefix(x: Column, base: Column) -> Column:
        step = lambda acc, v: F.struct(F.concat(acc["o"], F.array(acc["s"])).alias("o"), (acc["s"] + v).alias("s"))
        return F.aggregate(x, F.struct(empty.alias("o"), base.alias("s")), step)["o"]

    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, v: a + v))
    return F.flatten(F.zip_with(blocks, prefix(totals, F.lit(0).cast("bigint")), prefix))
