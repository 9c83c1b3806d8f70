"""Mixing sources to target weights by subset-sum budget fitting.

A source's budget of words is met by whole copies of the source, then by a set
of its documents whose sizes sum to what is left. That set is found on the
count of documents per exact size: each size gives its share, rounded down,
and a bounded-knapsack dynamic programme over the sizes fits the small rest.
Documents of a size are then picked in the order of a seeded hash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm.common import word_count
from pressmill.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
#: Hash ranges a size group is counted by; only the range at the border is ranked.
RANGES = 64
#: Words the dynamic programme fits at most; a larger rest is first filled by whole documents, largest first.
FIT_WORDS = 1 << 17


def fit_subset(counts: dict[int, int], budget: int, fit_words: int = FIT_WORDS) -> dict[int, int]:
    """How many documents of each size to take so that their sizes sum to ``budget``, or else next below it.

    Returns at most ``counts[size]`` for a size. The rest left by rounding down
    is filled from the largest size until the table of reachable sums is small;
    the table is a bit set, one step per size and power of two of its copies.
    """
    counts = {s: c for s, c in counts.items() if s > 0 and c > 0}
    total = sum(s * c for s, c in counts.items())
    budget = max(0, min(budget, total))
    take = {s: c * budget // total for s, c in counts.items()} if total else {}
    rest = budget - sum(s * n for s, n in take.items())
    order = sorted(counts, reverse=True)
    for s in order:
        if rest > fit_words:
            n = min(counts[s] - take[s], -(-(rest - fit_words) // s), rest // s)
            take[s] += n
            rest -= n * s
    steps, reach, mask = [], 1, (1 << rest + 1) - 1
    for s in order:
        left, power = min(counts[s] - take[s], rest // s), 1
        while left > 0 and not reach >> rest & 1:
            n = min(power, left)
            steps.append((s, n, reach))
            reach |= reach << n * s & mask
            left, power = left - n, power * 2
    at = reach.bit_length() - 1
    for s, n, before in reversed(steps):
        if not before >> at & 1:
            take[s] += n
            at -= n * s
    return take


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source: its sizes with their counts and its budget, to a number of documents for each size."""
    budget = int(pdf["rest"].iloc[0])
    take = fit_subset(dict(zip(pdf["size"].tolist(), pdf["n"].tolist())), budget)
    return pd.DataFrame({"src": pdf["src"], "size": pdf["size"], "n_take": [take.get(s, 0) for s in pdf["size"]]})


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """``src, source_size, target`` from ``src, source_size``, one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the sum of all sizes. A target stops at ``most`` times its source's size; the
    excess goes to the others by weight, again until none is above. Only sums
    over all sources reach the driver.
    """
    # A rank over all sources without one task that holds them: sorted partitions, numbered across.
    ranked = sizes.orderBy(F.col("src").isNull(), F.col("src")).rdd.zipWithIndex()
    ranked = ranked.map(lambda x: (x[0]["src"], x[0]["source_size"], x[1]))
    spark = sizes.sparkSession
    df = spark.createDataFrame(ranked, "src string, source_size bigint, rank bigint")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    df = df.select("src", "source_size", weight.alias("weight"))
    cap = F.col("source_size") * float(most)
    total = df.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, before = None, 0  # words for each unit of weight; targets that stop
    while True:
        free = F.lit(True) if level is None else F.col("weight") * level <= cap
        held, open_weight, n = df.agg(
            F.coalesce(F.sum(F.when(~free, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(~free, 1)),
        ).first()
        if level is not None and n == before:
            break
        before, level = n, (total - held) / open_weight if open_weight else 0.0
    target = F.least(F.col("weight") * F.lit(float(level or 0.0)), cap)
    return df.select("src", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs``.

    ``size`` counts words, none for a null text. ``copies`` says how often the
    mix takes the document (0 to ``most``), ``taken`` is ``copies * size``. A null
    source is a source of its own. Empty documents are never taken. Repeated
    rows of one id are told apart by nothing, so they rank alike and may be
    taken together. An empty table gives an empty mix. Reruns agree: the order
    of documents is a hash of the seed and the id.
    """
    spark = docs.sparkSession
    order = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("key"),
        word_count(text_col).alias("size"),
        order.alias("order"),
        F.shiftrightunsigned(order, 64 - RANGES.bit_length() + 1).cast("int").alias("range"),
    )
    rows = materialize(spark, rows, "mix")
    counts = materialize(spark, rows.groupBy("key", "source", "size", "range").agg(F.count("*").alias("n")), "mix")
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sources.withColumnRenamed("source", "src"), weights, most)
    key = F.coalesce(F.concat(F.lit("s"), F.col("src")), F.lit("n"))
    full = F.least(F.lit(most), F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))).cast("bigint")
    targets = targets.select(key.alias("key"), "source_size", "target", full.alias("full"))
    targets = targets.withColumn("rest", F.when(F.col("full") < most, F.round(F.col("target") - F.col("full") * F.col("source_size"))).otherwise(0).cast("bigint"))
    targets = materialize(spark, targets, "mix")

    sizes = counts.groupBy("key", "size").agg(F.sum("n").alias("n")).join(targets.select("key", "rest"), "key")
    fitted = sizes.select(F.col("key").alias("src"), "size", "n", "rest").groupBy("src").applyInPandas(_fit, "src string, size bigint, n_take bigint")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("key", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = counts.select("key", "size", "range", "n", before.alias("before"))
    ranges = ranges.join(fitted.withColumnRenamed("src", "key"), ["key", "size"])
    part = F.greatest(F.lit(0), F.least(F.col("n"), F.col("n_take") - F.col("before")))
    ranges = ranges.select("key", "size", "range", "n", part.alias("part")).where("part > 0")
    ranges = materialize(spark, ranges.select("key", "size", "range", "n", "part"), "mix")

    on = ["key", "size", "range"]
    whole = rows.join(ranges.where("part = n").select(*on, F.lit(1).alias("more")), on, "left")
    border = rows.join(ranges.where("part < n").select(*on, "part"), on)
    rank = F.row_number().over(Window.partitionBy(*on).orderBy("order", "doc_id"))
    chosen = border.withColumn("rank", rank).where("rank <= part")
    chosen = chosen.select(F.col("doc_id").alias("c_id"), *[F.col(c).alias(f"c_{c}") for c in on], F.lit(1).alias("border")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("c_id"))
    for c in on:
        same &= F.col(c) == F.col(f"c_{c}")
    out = whole.join(chosen, same, "left")
    copies = F.col("full") + F.coalesce("more", "border", F.lit(0))
    copies = F.when(F.col("size") > 0, copies).otherwise(0).cast("bigint")
    out = out.join(targets, "key").withColumn("copies", copies)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
