"""Item normalization: clean texts, trimmed url, lower-case tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.text import clean_text, trim_space
from pressmill.operators.filters import keep_where

TEXT_COLUMNS = ["title", "summary", "content", "author"]


def normalize_tags(tags: Column) -> Column:
    """Lower-case, distinct and sorted (a set has no order of its own)."""
    return F.array_sort(F.array_distinct(F.transform(tags, F.lower)))


def has_text() -> Column:
    return F.coalesce(F.col("title"), F.col("summary"), F.col("content")).isNotNull()


def normalize_fields(items: DataFrame) -> DataFrame:
    """Clean every field and keep every row."""
    return clean_text(items, TEXT_COLUMNS).withColumns(
        {"url": trim_space(F.col("url")), "tags": normalize_tags(F.col("tags"))}
    )


def normalize_items(items: DataFrame) -> DataFrame:
    """Clean every field; drop items that are left without any text."""
    return keep_where(normalize_fields(items), has_text())
