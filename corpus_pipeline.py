"""A training corpus from raw documents: quality, near duplicates, personal data, mix, tokens.

Each stage works on all that its predecessor kept and returns the columns of its
input, but for the last, which returns tokens. Stages move texts at most once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm import bpe, mixing, ngram_join, pii, quality_model
from pressmill.llm.common import table
from pressmill.llm.queries import tokenizer
from pressmill.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality model, fitted on the labelled ones among them, does not reject."""
    model = quality_model.fit_quality(docs, table(spark, sf_dir, "labels"))
    # The other columns travel under numbers, so that none clashes with the score.
    more = {c: f"c{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    numbered = docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in more.items()])
    kept = quality_model.score_quality(numbered, model, *more.values()).where(F.col("score") >= quality_model.THRESHOLD)
    return kept.select(*[F.col(more.get(c, c)).alias(c) for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by n-gram similarity, the one with the smallest id.

    An id names one document: of several rows with it the one with the smallest text stays. Rows without an
    id can't be named, so they are never grouped and all stay.
    """
    grouped = ngram_join.ngram_join(docs)
    gone = materialize(spark, grouped.where("component_id <> doc_id").select("doc_id"), "near_copies")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = grouped.where("doc_id is not null and component_id = doc_id").groupBy("doc_id").count().where("count > 1")
    repeated = materialize(spark, repeated.select("doc_id"), "repeated_ids")
    if not repeated.take(1):
        return kept
    # Rows of repeated ids alone move, one for each id and task.
    first = F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("doc")
    several = kept.join(repeated, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("id")).agg(first).select("doc.*")
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).union(several.select(*docs.columns))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by labels; ``n_chars`` follows the new text."""
    return pii.mask_pii(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows of one id, or without an id, as often as any of them."""
    mixed = mixing.mix_sources(docs).groupBy(F.col("doc_id").alias("id")).agg(F.max("copies").cast("int").alias("copies"))
    mixed = materialize(spark, mixed.where(F.col("copies") > 0), "mixed")
    whole = docs.select(F.struct(*docs.columns).alias("doc"))
    taken = whole.join(mixed, F.col("doc.doc_id").eqNullSafe(F.col("id")))
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256`` for each row of the mix; the bytes decoded are those encoded."""
    coded = bpe.encode(docs, *tokenizer())
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("PII", mask_personal_data),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: No SQL fits a classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; what each keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
