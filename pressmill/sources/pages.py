"""HTML pages to items: title, and the paragraphs of the article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.text import (
    empty_to_null,
    join_nodes,
    mark_nodes,
    remove_non_text,
    trim_space,
    unescape,
)
from pressmill.schemas import ITEM

# Elements whose start ends an open paragraph in HTML.
_CLOSES_P = (
    "address|article|aside|blockquote|details|div|dl|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|"
    "main|menu|nav|ol|p|pre|section|table|ul"
)
_TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
_ARTICLE = r"(?is)<article\b[^>]*>(.*?)(?:</article\s*>|\z)"
_PARAGRAPH = rf"(?is)<p\b[^>]*>(.*?)(?=<(?:{_CLOSES_P})\b|</(?:p|article|section|div|main|body)\s*>|\z)"


def paragraph_texts(html: Column) -> Column:
    """Text of each paragraph; an open one ends where HTML says it must."""
    texts = F.regexp_extract_all(html, F.lit(_PARAGRAPH), F.lit(1))
    for step in (mark_nodes, unescape, join_nodes):
        texts = F.transform(texts, step)
    return texts


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``title`` and ``content``: the first title, and the paragraphs of
    the first article (of the whole page where there is none)."""
    visible = pages.withColumn("_page", remove_non_text(F.col(html)))
    scoped = visible.withColumn(
        "_scope", F.coalesce(empty_to_null(F.regexp_extract("_page", _ARTICLE, 1)), F.col("_page"))
    ).withColumn("_title", F.when(F.rlike("_page", F.lit(_TITLE)), F.regexp_extract("_page", _TITLE, 1)))
    return scoped.withColumns(
        {
            "title": trim_space(unescape(F.col("_title"))),
            "content": empty_to_null(F.array_join(paragraph_texts(F.col("_scope")), " ")),
        }
    ).drop("_page", "_scope", "_title")


def page_items(pages: DataFrame, fetched_at: int) -> DataFrame:
    """``(source_id, url, html, language, tags)`` to one item per page."""
    return extract_pages(pages).withColumns(
        {
            "summary": F.lit(None).cast("string"),
            "author": F.lit(None).cast("string"),
            "published_at": F.lit(None).cast("bigint"),
            "fetched_at": F.lit(fetched_at).cast("bigint"),
        }
    ).select(*ITEM.fieldNames())
