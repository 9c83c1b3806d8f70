"""Items as keyed JSON records, the shape they travel in between jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.schemas import EMBEDDED_CHUNK, ITEM


def to_records(items: DataFrame) -> DataFrame:
    """``key`` = url, ``value`` = JSON with every field, nulls written out."""
    fields = F.struct(*[F.col(n) for n in ITEM.fieldNames()])
    return items.select(F.col("url").alias("key"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def embedded_chunks(chunks: DataFrame) -> DataFrame:
    """The eleven-column projection written for consumers of embedded chunks."""
    return chunks.select(*EMBEDDED_CHUNK.fieldNames())


def embedded_chunk_records(chunks: DataFrame) -> DataFrame:
    """Embedded chunks as keyed JSON records."""
    fields = F.struct(*[F.col(n) for n in EMBEDDED_CHUNK.fieldNames()])
    return chunks.select(F.col("url").alias("key"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def items_per_source(items: DataFrame) -> DataFrame:
    """How many items each source gave."""
    return items.groupBy("source_id").agg(F.count("*").alias("items"))


def ingest_summary(items_chunked: DataFrame, item_key: list[str]) -> DataFrame:
    """``url, chunks`` once per processed item.

    ``item_key`` names the columns that tell two versions of one url apart.
    Chunks are counted by position, so an item read twice counts once.
    """
    return (
        items_chunked.groupBy("url", *item_key)
        .agg(F.count_distinct("chunk_index").alias("chunks"))
        .select("url", *item_key, "chunks")
    )


def summary_json(summary: DataFrame) -> DataFrame:
    """The summary as the JSON text ``{"url":…,"chunks":…}``."""
    return summary.select(F.to_json(F.struct("url", "chunks")).alias("value"))
