"""Line-first cleaning: rules judge each line, failing lines go, and documents that lose too much text go too."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pressmill.llm.common import SPACE, slices, texts

SYMBOLS = "#*$%&|<>"
#: Phrases of page furniture, on lower case.
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "enable javascript", "log in to", "lorem ipsum", "privacy policy",
    "read more", "sign up", "skip to content", "subscribe to", "terms of service", "terms of use",
)


@dataclass(frozen=True)
class LineRules:
    """Shares are of a line's words. A line must break a rule clearly: single odd lines of clean text stay."""

    symbol_share: float = 0.3  # characters of SYMBOLS for each word
    separators: int = 3  # stand-alone separators that make a navigation line ...
    separator_share: float = 0.2  # ... if they are so many of its words
    shout_words: int = 5  # words from which a line without lower case shouts
    mark_share: float = 0.5  # words that end in ! or ?
    repeat_words: int = 10  # words from which repetition counts
    distinct_share: float = 0.2  # fewer distinct words than this share fail
    kept_share: float = 0.5  # a document that keeps fewer of its words goes
    boilerplate_share: float = 0.25  # words inside phrases of BOILERPLATE


SEPARATORS = frozenset(("|", "»", "•", "·", ">", "::", "/"))
_APART, _SYMBOLS = ({x.encode() for x in some} for some in (SEPARATORS, SYMBOLS))
_PHRASES = re.compile(rf"\b(?:{'|'.join(BOILERPLATE)})\b")
_LOWER, _UPPER = re.compile("[a-z]"), re.compile("[A-Z]")
_MARKED = re.compile(r"[!?](?=[ \t-\r]|$)")


def line_fault(line: str, seen: set[str], rules: LineRules) -> str:
    """The first rule a line with words breaks, or an empty string."""
    words = line.encode("utf-8", "surrogatepass").split()
    n = len(words)
    if line in seen:
        return "duplicate"
    low = line.lower()
    if any(x in low for x in BOILERPLATE):
        if sum(len(x.split()) for x in _PHRASES.findall(low)) >= rules.boilerplate_share * n:
            return "boilerplate"
    apart = [w for w in words if w in _APART] if any(x in line for x in SEPARATORS) else []
    if len(apart) >= rules.separators and len(apart) >= rules.separator_share * n:
        return "navigation"
    # Stand-alone separators are judged above, so those that are symbols too don't count twice.
    if sum(map(line.count, SYMBOLS)) - sum(w in _SYMBOLS for w in apart) >= rules.symbol_share * n:
        return "symbols"
    if n >= rules.shout_words and _UPPER.search(line) and not _LOWER.search(line):
        return "shouting"
    if n >= rules.shout_words and len(_MARKED.findall(line)) >= rules.mark_share * n:
        return "punctuation"
    if n >= rules.repeat_words and len(set(words)) < rules.distinct_share * n:
        return "repetition"
    return ""


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside a run of ``width`` words that the text has twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    key = ids[:n]
    for k in range(1, width):
        # Renumbering first keeps each product below the square of the text's length.
        key = np.unique(key, return_inverse=True)[1] * len(names) + ids[k : k + n]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    hit, covered = count[back] > 1, np.zeros(len(words), bool)
    for k in range(width):
        covered[k : k + n] |= hit
    return int(covered.sum())


def judge(text: str | None, rules: LineRules) -> tuple:
    """The measures of one text, its verdict and what the line rules leave of it."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, SPACE))
    n_symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    duplicates = n_lines = kept_words = 0
    kept_lines, faults = [], {}
    for line in text.split("\n"):
        if not (words_in := len(line.encode("utf-8", "surrogatepass").split())):
            continue
        n_lines += 1
        duplicates += line in seen
        if fault := line_fault(line, seen, rules):
            faults[fault] = faults.get(fault, 0) + 1
        else:
            kept_lines.append(line)
            kept_words += words_in
        seen.add(line)
    repeats = repeated_words(words)
    failed = n_words < 50 or 100 * repeats > 50 * n_words
    kept = not failed and kept_words >= rules.kept_share * n_words
    return n_words, word_chars, n_symbols, duplicates, repeats, failed, kept, n_lines, kept_words, faults, "\n".join(kept_lines)


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, n_lines bigint, kept_words bigint, faults map<string,int>, clean_text string"
)


def apply_rules(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures, verdict, broken rules and cleaned text of every row; nothing moves between tasks.

    A null text is an empty one: no words, failed, not kept. Repeated rows are
    judged alike; ids may be null. Lines without a word are left out of the
    cleaned text. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = list(zip(*[judge(t, rules) for t in batch.column("text").to_pylist()]))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2 + [pa.map_(pa.string(), pa.int32()), pa.string()]
            columns[9] = [list(f.items()) for f in columns[9]]
            arrays = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=NAMES)

    return texts(docs, id_col=id_col, text_col=text_col).mapInArrow(run, SCHEMA)


NAMES = [x.split()[0] for x in SCHEMA.replace("map<string,int>", "map").split(",")]
