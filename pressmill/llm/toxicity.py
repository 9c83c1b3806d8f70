"""Toxicity by gradient-boosted trees over dense measures, with isotonic calibration.

Measures: densities of a fixed and a learned lexicon, how near second-person
words stand to lexicon words, capitals, marks, and obfuscated spellings.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.boosting import Isotonic, TreeModel, fit_isotonic, fit_trees
from pressmill.llm.common import slices
from pressmill.llm.labelled import SAMPLE_ROWS, sample_features, score_texts, training_texts

THRESHOLD = 0.3
#: Insults, on lower case.
INSULTS = frozenset(
    "arschloch bastard bastardo clown coward creep crétin cretin depp disgusting dumb dummkopf estúpido filth filthy fool freak"
    " garbage hate idiot idiota idiote imbécil imbécile jerk kill loser lowlife lügner maldito merde mierda moron nazi pathetic pig"
    " puta scum shut stupid stupide trash trottel ugly useless vermin worthless abschaum ordure salaud connard basura asqueroso".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre tú tu usted vosotros".split())
STEM = 5  # letters of the stems a lexicon is learned from, beside whole words
LEARNED = 2_000  # entries it has at most
LEAST_DOCS, LEAST_ODDS = 6, 2.0
NEAR = 6  # words
#: Digits and marks that stand for letters.
_LEET = str.maketrans("013457@$!|", "oieastasil")
_WORD = re.compile(r"[^\s.,;:!?\"()\[\]]+")
_MIXED = re.compile(r"[^\W\d_](?:[\d@$*!|]+[^\W\d_]|(?:[-._*][^\W\d_]){2,})")
#: A substitute at the start or end of a word of three letters or more; "!" at the end is a mark.
_EDGE = r"(?<![\w@$|!])(?:[013457]|[@$|!]+)[^\W\d_]{3,}|(?<=[^\W\d_]{3})(?:[013457]|[@$|]+)(?!\w)"
_ODD = re.compile(f"{_MIXED.pattern}|{_EDGE}")
_LONG = re.compile(r"([^\W\d_])\1\1")
FEATURES = (
    "log_words", "insult_rate", "insults", "learned_rate", "learned_most", "learned_words", "near_second", "second_rate", "capital_rate",
    "upper_words", "bang_rate", "question_rate", "obfuscated_rate", "hidden_insults", "long_runs", "symbol_rate", "distinct_words",
)


def _items(word: str) -> tuple[str, ...]:
    return (word, word[:STEM] + "~") if len(word) > STEM else (word,)


def learn_lexicon(sample: DataFrame, size: int = LEARNED, least_docs: int = LEAST_DOCS, least_odds: float = LEAST_ODDS) -> dict[str, float]:
    """Words and stems that mark label 1 in a bounded sample, with their log-odds; at most ``size`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, labels = [], []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                own = {i for w in set(_WORD.findall((text or "").lower())) for i in _items(w)}
                words += own
                labels += [y] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.int32())], names=["item", "y"])

    total, ones = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    found = sample.select("text", "y").mapInArrow(run, "item string, y int").groupBy("item").agg(F.sum("y").alias("a"), F.count("*").alias("n"))
    odds = F.log((F.col("a") + 0.5) / (ones + 1.0)) - F.log((F.col("n") - F.col("a") + 0.5) / (total - ones + 1.0))
    found = found.where(F.col("a") >= least_docs).withColumn("odds", odds).where(F.col("odds") >= least_odds)
    return {r["item"]: r["odds"] for r in found.orderBy(F.desc(F.col("odds") * F.col("a")), "item").limit(size).collect()}


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The measures of one whole text; a null text is empty."""
    text = text or ""
    cased = _WORD.findall(text)
    words = text.lower() and _WORD.findall(text.lower())
    n = max(len(words), 1)
    odds = [0.0] * len(words)
    insult_at, second_at, hidden = [], [], 0
    get = lexicon.get
    for k, w in enumerate(words):
        v = get(w, 0.0)
        if len(w) > STEM:
            v = max(v, get(w[:STEM] + "~", 0.0))
        odds[k] = v
        if w in INSULTS:
            insult_at.append(k)
        elif w in SECOND_PERSON:
            second_at.append(k)
        elif not w.isalpha():
            plain = w.translate(_LEET)
            hidden += plain != w and (plain in INSULTS or re.sub(r"[^\w]|_", "", plain) in INSULTS)
    odd = _ODD.findall(text)
    near = 0
    if second_at and insult_at:
        a, b = np.array(insult_at), np.array(second_at)
        at = np.searchsorted(b, a)
        gap = np.minimum(np.abs(b[np.minimum(at, len(b) - 1)] - a), np.abs(b[np.maximum(at - 1, 0)] - a))
        near = int((gap <= NEAR).sum())
    upper = sum(map(str.isupper, cased))
    marked = sum(v > 0 for v in odds)
    letters = max(len(text), 1)
    return [
        np.log1p(len(words)),
        len(insult_at) / n,
        np.log1p(len(insult_at)),
        sum(odds) / n,
        max(odds, default=0.0),
        np.log1p(marked),
        near / n,
        len(second_at) / n,
        sum(w[:1].isupper() for w in cased) / n,
        upper / n,
        text.count("!") / n,
        text.count("?") / n,
        len(odd) / n,
        np.log1p(hidden),
        len(_LONG.findall(text)) / n,
        sum(map(text.count, "#*$%&|<>")) / letters,
        len(set(words)) / n,
    ]


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: TreeModel
    calibration: Isotonic

    def features(self) -> Callable[[str | None], list[float]]:
        lexicon = self.lexicon
        return lambda text: features(text, lexicon)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibration(self.trees.logits(x))


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold.

    By a hash of the id, a third of them teaches the lexicon, of the rest three
    quarters the trees and one quarter the calibration, so that no stage learns
    from rows the one before has seen. Without rows every score is one half.
    """
    sample = training_texts(docs, labels, "toxic", rows)
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id")), F.lit(12))
    lexicon = learn_lexicon(sample.where(part < 4))
    rest = sample.where(part >= 4)
    ids, x, y = sample_features(rest, lambda t: features(t, lexicon), len(FEATURES))
    last = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(60)) < 4
    trees = fit_trees(x[~last], y[~last])
    return ToxicityModel(lexicon, trees, fit_isotonic(trees.logits(x[last]), y[last]))


def score_toxicity(docs: DataFrame, model: ToxicityModel, *more: str) -> DataFrame:
    """``doc_id, text, *more, score``: the model's chance of label 1, for every row.

    Null and empty texts are scored as empty; repeated rows score alike; ids may be null.
    """
    return score_texts(docs, *more, features=model.features(), score=model.score, width=len(FEATURES))
