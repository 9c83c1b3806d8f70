"""The registered queries of these operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm import bpe, chat_format, clustering, html_extract, mixing, near_vectors, ngram_join, pii, quality_model, quality_rules, resampling, substring_dedup, toxicity
from pressmill.llm.common import table
from pressmill.llm.labelled import held_out

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def tokenizer() -> tuple[str, str]:
    """Rank file and splitting pattern of the production tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def quality_rules_query(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "kept_words")


def quality_base_query(spark: SparkSession, folder: str) -> DataFrame:
    """The base measures of op1 alone, which SQL can state."""
    return quality_rules_query(spark, folder).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode(table(spark, folder, "documents"), *tokenizer())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _span_text(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def pii_query(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind_no"] == k)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind_no"] < pii.N_BASE)
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind.name}") for k, kind in enumerate(pii.KINDS[: pii.N_BASE])],
        F.sha2(_span_text(base), 256).alias("base_sha256"),
        _span_text(F.col("spans")).alias("spans"),
    )


def pii_base_query(spark: SparkSession, folder: str) -> DataFrame:
    """The base columns of op3 alone, which SQL can state."""
    return pii_query(spark, folder).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def ngram_join_query(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, folder, "documents"))


def substring_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def quality_model_query(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality_model.score_quality(docs, quality_model.fit_quality(docs, labels))
    return _scores(scored, quality_model.THRESHOLD)


def toxicity_query(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))
    return _scores(scored, toxicity.THRESHOLD)


def _scores(scored: DataFrame, threshold: float) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def mixing_query(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def mixing_targets_query(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes and targets of op7 alone, which SQL can state."""
    return mixing_query(spark, folder).select("doc_id", "size", "source_size", "target")


#: One more conversation than the table has.
EXTRA_CHAT = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def chat_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat_format.format_chats(rows.union(spark.createDataFrame(EXTRA_CHAT, rows.schema)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat_format.loss_text(F.col("formatted"), F.col("escaped"), F.col("loss"))
    return chats.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def near_vectors_query(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, folder, "embeddings"))


def resampling_query(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def html_extract_query(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, folder, "pages"))


def clustering_query(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality_rules_query,
    "op1_quality_base": quality_base_query,
    "op2_byte_bpe": bpe_query,
    "op3_pii": pii_query,
    "op3_pii_base": pii_base_query,
    "op4_ngram_join": ngram_join_query,
    "op5_substring_dedup": substring_dedup_query,
    "op6_quality_model": quality_model_query,
    "op7_mixing": mixing_query,
    "op7_mixing_targets": mixing_targets_query,
    "op8_toxicity": toxicity_query,
    "op9_chat_format": chat_query,
    "op10_near_vectors": near_vectors_query,
    "op11_resampling": resampling_query,
    "op12_html_extract": html_extract_query,
    "op13_clustering": clustering_query,
}
