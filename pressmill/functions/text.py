"""Text functions: white space, markup, character references, Unicode form.

Everything is a Catalyst expression except NFKC, which Spark lacks; that one
runs in Arrow batches and sees only the texts it can change.

The multi-step cleaners work on whole DataFrames, one projection per step:
each step names its input column more than once, and nesting them as one
expression would repeat the earlier steps inside the later ones.
"""

from __future__ import annotations

from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what Python's str.split() and \s treat as white space. Java's
# Unicode \s lacks the four separators U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"

# Marks the border between two text nodes while markup is being removed. It is
# a Unicode noncharacter, so no text can contain it by right.
NODE = "\ufdd0"

# One left-to-right pass, so a comment that mentions <script> stays a comment
# and a script that prints </p> stays a script. "=" starts an attribute value,
# the only place where quotes may hide ">".
_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_HIDDEN = rf"<!--.*?(?:-->|\z)|<(script|style|template)\b{_ATTRS}>.*?(?:</\1\s*>|\z)"
NON_TEXT = f"(?is){_HIDDEN}"
MARKUP = rf"(?is){_HIDDEN}|<r[tp]\b{_ATTRS}>[^<]*+|<[a-z/!?]{_ATTRS}>"

# NFKC changes nothing in ASCII or in U+00C0..U+0131 (a test checks this
# against the Unicode tables). Text made of these never leaves the JVM.
NFKC_STABLE = r"\x00-\x7f\xc0-\u0131"


def collapse_space(c: Column) -> Column:
    """Each run of white space becomes one space; both ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"(?U){SPACE}+", " "))


def trim_space(c: Column) -> Column:
    """Trim every kind of white space, not only U+0020.

    The lookbehind lets a run be tried only at its start, so a long run in the
    middle of a text stays linear.
    """
    return F.regexp_replace(c, rf"(?U)\A{SPACE}++|(?<!{SPACE}){SPACE}++\z", "")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[empty_to_null(c) for c in columns])


def remove_non_text(html: Column) -> Column:
    """Drop comments, scripts, styles and templates; other markup stays."""
    return F.regexp_replace(html, NON_TEXT, NODE)


def mark_nodes(html: Column) -> Column:
    """Replace every piece of markup by the node border mark."""
    return F.when(F.contains(html, F.lit("<")), F.regexp_replace(html, MARKUP, NODE)).otherwise(html)


def unescape(c: Column) -> Column:
    """Decode character references once. ``&apos;`` is not in the HTML 4 table."""
    decoded = F.java_method(
        F.lit("org.apache.commons.text.StringEscapeUtils"),
        F.lit("unescapeHtml4"),
        F.replace(c, F.lit("&apos;"), F.lit("'")),
    )
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def join_nodes(c: Column) -> Column:
    """Trim each text node and join the non-empty ones by one space."""
    joined = F.regexp_replace(c, rf"(?U)(?<!{SPACE}){SPACE}*+{NODE}[\s\x1c-\x1f{NODE}]*+", " ")
    return trim_space(joined)


@F.arrow_udf(T.StringType())
def _nfkc_collapsed(texts: pa.Array) -> pa.Array:
    def clean(text: str) -> str:
        return " ".join(normalize("NFKC", text).split())

    # One text at a time: a batch may hold whole documents.
    return pa.array((clean(t.as_py()) if t.is_valid else None for t in texts), pa.string(), size=len(texts))


def nfkc_collapsed(c: Column) -> Column:
    """NFKC, then collapsed white space, then empty to null.

    Only text outside ``NFKC_STABLE`` crosses to Python; the rest needs no
    normal form and is collapsed in the JVM.
    """
    needs = F.when(F.rlike(c, F.lit(f"[^{NFKC_STABLE}]")), c)
    return empty_to_null(F.coalesce(_nfkc_collapsed(needs), collapse_space(c)))


def _apply(df: DataFrame, names: list[str], *steps) -> DataFrame:
    for step in steps:
        df = df.withColumns({n: step(F.col(n)) for n in names})
    return df


def strip_html(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns of HTML become their visible text; inner white space stays."""
    return _apply(df, names, mark_nodes, unescape, join_nodes, empty_to_null)


def clean_text(df: DataFrame, names: list[str]) -> DataFrame:
    """Markup out, references decoded, NFKC, white space collapsed, empty to null."""
    return _apply(
        df,
        names,
        mark_nodes,
        unescape,
        lambda c: F.replace(c, F.lit(NODE), F.lit(" ")),
        nfkc_collapsed,
    )
