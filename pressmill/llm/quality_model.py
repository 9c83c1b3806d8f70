"""Quality as a generalised additive model with pairwise interactions over measures of the text."""

from __future__ import annotations

import operator
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame

from pressmill.llm.boosting import AdditiveModel, fit_additive
from pressmill.llm.labelled import SAMPLE_ROWS, sample_features, score_texts, training_texts

THRESHOLD = 0.7
FEATURES = (
    "log_words", "chars_per_word", "symbol_rate", "pipe_rate", "bang_rate", "capital_rate", "digit_rate", "mark_rate", "comma_rate",
    "distinct_words", "commonest_word", "echoed_words", "log_lines", "words_per_line", "duplicate_lines", "ended_lines", "upper_words",
    "other_bytes",
)
_SYMBOLS = [ord(c) for c in "#*$%&<>"]


def features(text: str | None) -> list[float]:
    """The measures of one whole text; a null text is empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, count = raw.split(), np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, size = max(len(words), 1), max(len(raw), 1)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    often = Counter(words)
    top = max(often.values()) if often else 0
    return [
        np.log1p(len(words)),
        size / n,
        count[_SYMBOLS].sum() / n,
        count[ord("|")] / n,
        count[ord("!")] / n,
        upper / max(upper + lower, 1),
        count[48:58].sum() / size,
        (count[ord(".")] + count[ord("?")]) / n,
        count[ord(",")] / n,
        len(often) / n,
        top / n,
        sum(map(operator.eq, words, words[1:])) / n,
        np.log1p(len(lines)),
        len(words) / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1),
        sum(x.rstrip()[-1:] in b".!?:" for x in lines) / max(len(lines), 1),
        sum(w.isupper() for w in words) / n,
        count[128:].sum() / size,
    ]


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold; without any, every score is one half."""
    _, x, y = sample_features(training_texts(docs, labels, "quality", rows), features, len(FEATURES))
    return fit_additive(x, y)


def score_quality(docs: DataFrame, model: AdditiveModel, *more: str) -> DataFrame:
    """``doc_id, text, *more, score``: the model's chance of label 1, for every row.

    Null and empty texts are scored as empty; repeated rows score alike; ids may be null.
    """
    return score_texts(docs, *more, features=features, score=model.score, width=len(FEATURES))
