"""Personal data in SQL functions alone: patterns propose, checksums confirm, context words score.

Each pattern is matched from the left without overlaps. Positions come from
``split`` and ``regexp_extract_all`` with the same pattern: the lengths of gaps
and matches, summed, so a text is never indexed by character. The patterns start
at the beginning of a run of their characters (or where the last match ended) and
use possessive loops, which takes the same matches in linear time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import running_sums


@dataclass(frozen=True)
class Kind:
    """``score`` is what a confirmed match has; a context word nearby adds ``CONTEXT_BONUS``."""

    name: str
    pattern: str
    confirm: str  # name of the check below
    words: str  # context words, a pattern on lower case
    score: float
    mask: str


CONTEXT_BONUS = 0.35
LEAST_SCORE = 0.6
CONTEXT_BEFORE, CONTEXT_AFTER = 48, 24
N_BASE = 4
_MAIL = "A-Za-z0-9._%+-"

KINDS = (
    Kind("email", rf"(?:(?<![{_MAIL}])|\G)[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "any", r"mail|contact|write|@", 0.8, "[EMAIL]"),
    Kind("ip", r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++", "ip", r"\bip\b|host|server|address|login", 0.65, "[IP]"),
    Kind("card", r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", "luhn", r"card|visa|credit|payment|karte|carte|tarjeta", 0.8, "[CARD]"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "phone", r"phone|call|tel|mobile|fax", 0.65, "[PHONE]"),
    Kind("iban", r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])", "iban", r"iban|account|konto|compte|cuenta", 0.9, "[IBAN]"),
    Kind("ssn", r"[0-9](?<![A-Za-z0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])", "ssn", r"ssn|social|security|tax", 0.5, "[SSN]"),
    Kind("secret", r"[A-Za-z0-9_/+=-](?<![A-Za-z0-9_/+=-]{2})[A-Za-z0-9_/+=-]{19,}+", "mixed", r"token|secret|passw|api.?key|key\b|bearer|credential", 0.3, "[SECRET]"),
    # Inside longer runs of digits and separators, which the patterns above take whole and then drop.
    Kind("card_part", r"[0-9](?<![0-9][0-9])(?:(?<=[0-9][\x20-][0-9])[0-9]{13,18}+(?![0-9])|[0-9]{13,18}+(?=[\x20-][0-9]))", "luhn", r"card|visa|credit|payment", 0.7, "[CARD]"),
    Kind("phone_part", r"\+[0-9]{1,3}\x20\([0-9]{2,4}\)\x20?[0-9]{3}[\x20-][0-9]{4}(?=[\x20().-]*[0-9])", "any", r"phone|call|tel|mobile", 0.7, "[PHONE]"),
)
COUNTED = tuple(k.name for k in KINDS)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.lit(1)))


def _luhn(match: Column) -> Column:
    """From the right, every second digit doubles; digits above nine lose nine; the sum divides by ten."""
    step = lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))
    return F.aggregate(F.transform(_chars(F.reverse(_digits(match))), step), F.lit(0), lambda a, x: a + x) % 10 == 0


def _mod97(match: Column) -> Column:
    """Four characters go to the end, letters count 10 to 35, and the number leaves 1 when divided by 97."""
    code = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))
    digit = lambda c: F.when(c < "A", c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, c: (a * F.when(c < "A", 10).otherwise(100) + digit(c)) % 97
    return F.aggregate(_chars(turned), F.lit(0), step) == 1


_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
CHECKS = {
    "any": lambda m: F.lit(True),
    "ip": lambda m: F.rlike(m, F.lit(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
    "luhn": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
    "iban": _mod97,
    "ssn": lambda m: ~F.rlike(m, F.lit("^(?:000|666|9..)|-00-|-0000$")),
    "mixed": lambda m: F.rlike(m, F.lit("[0-9]")) & F.rlike(m, F.lit("[A-Za-z]")),
}


def _score(kind: Kind, before: Column, after: Column) -> Column:
    near = F.lower(F.concat(F.right(before, F.lit(CONTEXT_BEFORE)), F.lit(" "), F.left(after, F.lit(CONTEXT_AFTER))))
    return F.lit(kind.score) + F.when(F.rlike(near, F.lit(kind.words)), CONTEXT_BONUS).otherwise(0.0)


def _guard(kind: Kind) -> Column:
    """What a text must hold for the pattern to have a chance."""
    if kind.name == "email":
        return F.contains(F.col("_t"), F.lit("@"))
    return F.col("_d") & F.contains(F.col("_t"), F.lit("+")) if kind.name.startswith("phone") else F.col("_d")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``doc_id, spans`` for every row; ``spans`` are ``(start, kind_no, end, kind, score)`` by start, then kind.

    Positions are code points, the end exclusive. Of the first four kinds every
    confirmed match stays; of the others those whose score reaches ``LEAST_SCORE``.
    A null or empty text has no spans; repeated rows get the same spans; ids may
    be null. Every other column is left out.
    """
    df = _matches(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")), kinds)
    for no, kind in enumerate(kinds):
        m, g, n = F.col(f"_m{no}"), F.col(f"_g{no}"), F.size(f"_m{no}")
        lengths = F.zip_with(m, F.slice(g, F.lit(1), n), lambda a, b: (F.length(a) + F.length(b)).cast("bigint"))
        df = df.withColumn(f"_b{no}", F.when(n > 0, running_sums(lengths)))
    for no, kind in enumerate(kinds):
        df = df.withColumn(f"_s{no}", F.when(F.size(f"_m{no}") > 0, _spans(no, kind)).otherwise(F.array().cast(_SPANS)))
    return df.select("doc_id", F.sort_array(F.flatten(F.array(*[F.col(f"_s{no}") for no in range(len(kinds))]))).alias("spans"))


_SPANS = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,score:double>>"


def _matches(df: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    df = df.withColumn("_d", F.rlike(F.col("_t"), F.lit("[0-9]")))
    none = F.array().cast("array<string>")
    for no, kind in enumerate(kinds):
        found = F.regexp_extract_all(F.col("_t"), F.lit(kind.pattern), F.lit(0))
        df = df.withColumn(f"_m{no}", F.when(_guard(kind), found).otherwise(none))
    for no, kind in enumerate(kinds):
        df = df.withColumn(f"_g{no}", F.when(F.size(f"_m{no}") > 0, F.split("_t", kind.pattern, -1)))
    return df


def _spans(no: int, kind: Kind) -> Column:
    m, g, n = F.col(f"_m{no}"), F.col(f"_g{no}"), F.size(f"_m{no}")
    around = F.zip_with(F.slice(g, F.lit(1), n), F.slice(g, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    both = F.zip_with(m, around, lambda x, y: F.struct(x.alias("m"), y["a"].alias("a"), y["b"].alias("b")))

    def span(x: Column, base: Column) -> Column:
        start = base + F.length(x["a"])
        made = F.struct(
            start.alias("start"),
            F.lit(no).alias("kind_no"),
            (start + F.length(x["m"])).alias("end"),
            F.lit(kind.name).alias("kind"),
            _score(kind, x["a"], x["b"]).alias("score"),
        )
        return F.when(CHECKS[kind.confirm](x["m"]), made)

    keep = lambda s: s.isNotNull() if no < N_BASE else s.isNotNull() & (s["score"] >= LEAST_SCORE)
    return F.filter(F.zip_with(both, F.col(f"_b{no}"), span), keep).cast(_SPANS)


def _piece(no: int, kind: Kind):
    """The gap before a match, and the match or its label."""

    def piece(m: Column, y: Column) -> Column:
        good = CHECKS[kind.confirm](m)
        if no >= N_BASE:
            good &= _score(kind, y["a"], y["b"]) >= LEAST_SCORE
        return F.concat(y["a"], F.when(good, F.lit(kind.mask)).otherwise(m))

    return piece


def mask_pii(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every confirmed match in ``text_col`` replaced by its kind's label; all columns stay.

    Kinds go one after the other, each on what the ones before left, so text
    under several spans is gone as well. Null texts stay null.
    """
    names = docs.columns
    df = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"), F.col(text_col).alias("_t"))
    for no, kind in enumerate(kinds):
        df = df.withColumn("_d", F.rlike(F.col("_t"), F.lit("[0-9]")))
        found = F.regexp_extract_all(F.col("_t"), F.lit(kind.pattern), F.lit(0))
        df = df.withColumn("_m", F.when(_guard(kind), found))
        df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split("_t", kind.pattern, -1)))
        n = F.size("_m")
        around = F.zip_with(F.slice("_g", F.lit(1), n), F.slice("_g", F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        masked = F.concat(F.array_join(F.zip_with("_m", around, _piece(no, kind)), ""), F.element_at("_g", -1))
        df = df.withColumn("_t", F.when(F.size("_m") > 0, masked).otherwise(F.col("_t"))).drop("_m", "_g", "_d")
    return df.select(*[F.col("_t").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names])
