"""Sentence splitting, word counts and the greedy packing of sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill.functions.text import SPACE

# Fixed value: a sentence ends at . ! or ? followed by white space.
SENTENCE_BREAK = f"(?U)(?<=[.!?]){SPACE}+"


def split_sentences(text: Column) -> Column:
    return F.split(text, SENTENCE_BREAK, -1)


def word_count(text: Column) -> Column:
    """Number of white-space separated words."""
    return F.size(F.filter(F.split(text, f"(?U){SPACE}+"), lambda w: w != ""))


def has_single_spaces(text: Column) -> Column:
    """Whether U+0020 is the text's only white space and stands alone, between words: so cleaned texts look."""
    other = F.rlike(text, F.lit(r"(?U)[\s\x1c-\x1f&&[^ ]]"))
    return ~(F.contains(text, F.lit("  ")) | F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" ")) | other)


def spaced_word_count(text: Column) -> Column:
    """As :func:`word_count`, for parts of a text with single spaces: no pattern is compiled and no word is copied."""
    return F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)


def pack_spans(counts: Column, max_tokens: int, overlap_tokens: int) -> Column:
    """Greedy packing over word counts: array of half-open spans ``(lo, hi)``.

    Works on word counts only, so the fold copies no text. A span closes when the
    next sentence would pass ``max_tokens``; the following span starts with the
    longest run of closing sentences that fits ``overlap_tokens``. A sentence
    longer than the limit stays whole.

    The closed spans are gathered as text, ``"lo:hi lo:hi "``: appending to text
    is a block copy, while an array is rebuilt element by element, which makes
    a very long document slow.
    """
    start = F.struct(
        F.lit(0).alias("lo"),
        F.lit(0).alias("at"),
        F.lit(0).alias("words"),
        F.lit("").alias("spans"),
    )

    def tail(acc: Column) -> Column:
        # Elements are fetched one by one; slice() would read the whole array.
        empty = F.struct(F.lit(0).alias("kept"), F.lit(0).alias("words"), F.lit(True).alias("open"))

        def take(t: Column, i: Column) -> Column:
            fits = t["open"] & (t["words"] + F.get(counts, i) <= overlap_tokens)
            kept = F.struct(
                (t["kept"] + 1).alias("kept"), (t["words"] + F.get(counts, i)).alias("words"), F.lit(True).alias("open")
            )
            stop = F.struct(t["kept"].alias("kept"), t["words"].alias("words"), F.lit(False).alias("open"))
            return F.when(fits, kept).otherwise(stop)

        return F.aggregate(F.sequence(acc["at"] - 1, acc["lo"], F.lit(-1)), empty, take)

    def add(acc: Column) -> Column:
        return F.concat(acc["spans"], acc["lo"].cast("string"), F.lit(":"), acc["at"].cast("string"), F.lit(" "))

    def step(acc: Column, n: Column) -> Column:
        # The tail is worked out once per field that needs it.
        closed = F.struct(
            (acc["at"] - tail(acc)["kept"]).alias("lo"),
            (acc["at"] + 1).alias("at"),
            (tail(acc)["words"] + n).alias("words"),
            add(acc).alias("spans"),
        )
        grown = F.struct(
            acc["lo"].alias("lo"),
            (acc["at"] + 1).alias("at"),
            (acc["words"] + n).alias("words"),
            acc["spans"].alias("spans"),
        )
        full = (acc["at"] > acc["lo"]) & (acc["words"] + n > max_tokens)
        return F.when(full, closed).otherwise(grown)

    found = F.split(F.rtrim(F.aggregate(counts, start, step, add)), " ")
    return F.transform(
        found,
        lambda s: F.struct(
            F.split_part(s, F.lit(":"), F.lit(1)).cast("int").alias("lo"),
            F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("hi"),
        ),
    )


def join_spans(sentences: Column, spans: Column) -> Column:
    """The text of each span. Sentences are fetched one by one; slice() would
    read the whole array for every span."""

    def text(span: Column) -> Column:
        places = F.sequence(span["lo"], span["hi"] - 1)
        return F.array_join(F.transform(places, lambda i: F.get(sentences, i)), " ")

    return F.transform(spans, text)
