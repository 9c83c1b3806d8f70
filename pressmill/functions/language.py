"""Language guess by function words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


ALLOWED = ["en", "es", "fr", "de"]

# Frequent function words of each language.
FUNCTION_WORDS = {
    "en": "the and of to in is that it for was on are with as at be this have from or by not but".split(),
    "es": "el la de que y en los se del las por un para con no una su al lo como pero sus".split(),
    "fr": "le la de et les des en un une du que est pour qui dans sur au par pas ce avec sont".split(),
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an".split(),
}


def words(text: Column) -> Column:
    """Lower-case words split at white space, punctuation and symbols."""
    return F.split(F.lower(text), r"(?U)[\s\x1c-\x1f\p{P}\p{S}]+")


def language_hits(text: Column) -> Column:
    """Struct with the number of function words of each language in ``text``."""

    def count(tokens: Column, known: list[str]) -> Column:
        return F.size(F.filter(tokens, lambda w: w.isin(known)))

    counted = F.transform(
        F.array(words(text)),
        lambda tokens: F.struct(*[count(tokens, known).alias(lang) for lang, known in FUNCTION_WORDS.items()]),
    )
    return counted[0]


def best_language(hits: Column) -> Column:
    """Language with most hits; ties to the first by code; null without a hit."""
    by_code = sorted(FUNCTION_WORDS, reverse=True)
    ranked = F.transform(
        F.array(hits),
        lambda h: F.array_max(
            F.array(*[
                F.struct(h[lang].alias("hits"), F.lit(i).alias("place"), F.lit(lang).alias("lang"))
                for i, lang in enumerate(by_code)
            ])
        ),
    )[0]
    return F.transform(F.array(ranked), lambda r: F.when(r["hits"] > 0, r["lang"]))[0]
