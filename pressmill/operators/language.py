"""Language detection and the language allow-list.

Counting happens inside the row: words are never exploded, so detection is a
narrow projection with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions.language import ALLOWED, FUNCTION_WORDS, best_language, language_hits
from pressmill.operators.filters import keep_where


def language_scores(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``hits_<lang>``: function words of each language in ``text``."""
    counted = rows.withColumn("_hits", language_hits(F.col(text)))
    return counted.withColumns({f"hits_{lang}": F.col("_hits")[lang] for lang in FUNCTION_WORDS}).drop("_hits")


def detect_language(rows: DataFrame, text: str, target: str = "language", keep_known: bool = False) -> DataFrame:
    """Set ``target`` to the detected language; ``keep_known`` fills gaps only."""
    found = best_language(language_hits(F.col(text)))
    return rows.withColumn(target, F.coalesce(F.col(target), found) if keep_known else found)


def allow_languages(rows: DataFrame, allowed: list[str] = ALLOWED, column: str = "language") -> DataFrame:
    """Keep rows in one of the allowed languages."""
    return keep_where(rows, F.col(column).isin(allowed))
