"""One item to many sentence-aligned, overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.ids import chunk_id
from pressmill.functions.sentences import has_single_spaces, join_spans, pack_spans, spaced_word_count, split_sentences, word_count
from pressmill.functions.text import first_filled

MAX_TOKENS = 512
OVERLAP_TOKENS = 64


def pick_text() -> Column:
    """The text an item is chunked from: content, else summary, else title."""
    return first_filled(F.col("content"), F.col("summary"), F.col("title"))


def split_items(items: DataFrame) -> DataFrame:
    """One row per sentence: ``url, sentence_index, sentence, words``."""
    return (
        items.select("url", pick_text().alias("text"))
        .where(F.col("text").isNotNull())
        .select("url", F.posexplode(split_sentences(F.col("text"))).alias("sentence_index", "sentence"))
        .withColumn("words", word_count(F.col("sentence")))
    )


def chunk_items(
    items: DataFrame,
    max_tokens: int = MAX_TOKENS,
    overlap_tokens: int = OVERLAP_TOKENS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Chunk rows of every item; items without text give none.

    A narrow transformation: each step is a projection and the packing fold
    sees word counts only, so no text is copied until the chunks are cut.
    ``carry`` names further item columns to keep (such as an ingest order).
    """
    payload = ["title", "language", "published_at", "source_id", "tags", *carry]
    sentences = (
        items.select("url", *payload, pick_text().alias("_text"))
        .where(F.col("_text").isNotNull())
        .withColumn("_spaced", has_single_spaces(F.col("_text")))
        .withColumn("_sentences", split_sentences(F.col("_text")))
        .drop("_text")
    )
    words = F.when(F.col("_spaced"), F.transform("_sentences", spaced_word_count)).otherwise(F.transform("_sentences", word_count))
    spans = sentences.withColumn("_words", words).withColumn(
        "_spans", pack_spans(F.col("_words"), max_tokens, overlap_tokens)
    )
    cut = spans.select(
        "url",
        *payload,
        F.size("_spans").alias("total_chunks"),
        F.posexplode(join_spans(F.col("_sentences"), F.col("_spans"))).alias("chunk_index", "chunk_text"),
    )
    return cut.select(
        chunk_id(F.col("url"), F.col("chunk_index")).alias("chunk_id"),
        "url",
        "title",
        "chunk_text",
        "chunk_index",
        "total_chunks",
        "language",
        "published_at",
        "source_id",
        "tags",
        *carry,
    )
