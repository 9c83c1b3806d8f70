"""Records or items to a vector table, as one batch job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions.language import ALLOWED
from pressmill.functions.text import trim_space
from pressmill.operators.chunking import MAX_TOKENS, OVERLAP_TOKENS, chunk_items
from pressmill.operators.dedup import dedup_by_url
from pressmill.operators.embedding import DIMENSION, embed
from pressmill.operators.language import allow_languages, detect_language
from pressmill.operators.normalize import normalize_fields, normalize_items
from pressmill.operators.validate import DECODE_REASONS, SCHEMA_REASONS, accepted, decode_records, rejects
from pressmill.operators.vector_table import VectorTable, latest_per_chunk
from pressmill.session import materialize, work_dir

VERSION = ("fetched_at",)  # orders the versions of one url
MAX_REPEATED = 200_000  # urls with several versions whose hashes are broadcast
ITEM_ID = "item_id"  # tells apart items of one url and fetch time; later records win ties


def with_item_id(items: DataFrame) -> DataFrame:
    """An id per item: a hash of all its fields, so a retried task, a replayed
    batch and a stream (where positions are not at hand) give the same ids.
    Two records that differ in any field are two items; byte-equal ones are one."""
    return items if ITEM_ID in items.columns else items.withColumn(ITEM_ID, F.xxhash64(*items.columns))


def newest_first(columns: list[str]) -> list:
    """Order of versions: fetch time, then the item read last."""
    keys = [*VERSION, *([ITEM_ID] if ITEM_ID in columns else [])]
    return [F.col(c).desc_nulls_last() for c in keys]


@dataclass(frozen=True)
class IngestOptions:
    """What an ingest job does between reading and writing.

    The defaults are the plain job: normalize, chunk, embed, upsert. Batch
    dedup and the language step are off unless asked for. ``drop_failed``
    leaves out items the embedder fails on instead of failing the job; where
    it is not set, streams leave them out and batch jobs fail.
    """

    max_tokens: int = MAX_TOKENS
    overlap_tokens: int = OVERLAP_TOKENS
    provider: str = "hash"
    dim: int = DIMENSION
    dedup: bool = False
    detect: bool = False
    languages: tuple[str, ...] | None = None
    replace_url: bool = False
    embed_partitions: int | None = None
    drop_failed: bool | None = None
    #: Texts a provider gets at once; None: whole Arrow batches.
    batch_size: int | None = None


def refine_items(items: DataFrame, options: IngestOptions) -> DataFrame:
    """Normalize, then the optional dedup and language steps.

    Dedup runs after the url trim, so it compares the urls that are stored. A
    stored language is filtered first, where the scan can skip rows, unless
    dedup has to see the other versions.
    """
    if options.languages and not options.detect and not options.dedup:
        return normalize_items(items.where(F.col("language").isin(list(options.languages))))
    out = normalize_items(items)
    if options.dedup:
        out = dedup_by_url(out)
    return language_step(out, options)


def language_step(items: DataFrame, options: IngestOptions) -> DataFrame:
    """Detect the language and keep the allowed ones, as far as asked for."""
    if options.detect:
        text = F.coalesce("content", "summary", "title")
        items = detect_language(items.withColumn("_text", text), "_text").drop("_text")
    if options.detect or options.languages:
        items = allow_languages(items, list(options.languages or ALLOWED))
    return items


def chunked_items(items: DataFrame, options: IngestOptions) -> DataFrame:
    """Items to chunk rows that still carry their fetch time."""
    refined = with_item_id(refine_items(items, options))
    return chunk_items(refined, options.max_tokens, options.overlap_tokens, carry=(*VERSION, ITEM_ID))


def embedded_items(items: DataFrame, options: IngestOptions) -> DataFrame:
    """Items to embedded chunk rows."""
    return embed_chunks(chunked_items(items, options), options)


def embed_chunks(chunks: DataFrame, options: IngestOptions) -> DataFrame:
    return embed(chunks, "chunk_text", options.provider, options.dim, options.embed_partitions, bool(options.drop_failed), options.batch_size)


def latest_chunks(items: DataFrame, options: IngestOptions) -> DataFrame:
    """Chunk rows of items, the last version of each chunk id.

    A url that comes once has one version of each chunk, so its rows stay where
    they are cut. Only urls that come again, or are null, have their chunks
    ranked by a shuffle; urls are told apart by 64-bit hashes, and a once-only
    url whose hash is taken for a repeated one is merely ranked as well. Where
    most items or too many urls repeat, all chunks are ranked.
    """
    spark = items.sparkSession
    url = trim_space(F.col("url"))
    seen = items.select(F.xxhash64(url).alias("_url"), url.isNull().cast("int").alias("_none")).groupBy("_url")
    seen = seen.agg(F.count("*").alias("n"), F.max("_none").alias("none"))
    seen = materialize(spark, seen.select("_url", "n", ((F.col("n") > 1) | (F.col("none") > 0)).alias("again")), "urls")
    again = F.when(F.col("again"), F.col("n"))
    urls, repeated, total = seen.agg(F.count(again), F.coalesce(F.sum(again), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not urls:
        return chunked_items(items, options)

    def ranked(some: DataFrame) -> DataFrame:
        chunks = chunked_items(some, options)
        return latest_per_chunk(chunks, newest_first(chunks.columns))

    if urls > MAX_REPEATED or 2 * repeated > total:
        return ranked(items)
    several = F.broadcast(seen.where("again").select("_url"))
    part = lambda how: items.withColumn("_url", F.xxhash64(url)).join(several, "_url", how).drop("_url")
    return chunked_items(part("left_anti"), options).unionByName(ranked(part("left_semi")))


def store_chunks(chunks: DataFrame, table: VectorTable, options: IngestOptions, latest: bool = False, **batch) -> int:
    """Embed and upsert. Superseded versions are dropped first, while a row is
    still text: no vector is computed or shuffled for them. ``latest`` says
    that none are among the chunks."""
    latest = chunks if latest else latest_per_chunk(chunks, newest_first(chunks.columns))
    rows = embed_chunks(latest, options)
    return table.upsert(
        rows,
        order_by=(*VERSION, *([ITEM_ID] if ITEM_ID in chunks.columns else [])),
        unique=True,
        replace_url=options.replace_url,
        drop_failed=bool(options.drop_failed),
        **batch,
    )


def ingest_items(items: DataFrame, table: VectorTable, options: IngestOptions = IngestOptions(), **batch) -> int:
    """Run the whole job, then keep the table's deltas few; returns the chunks written.

    The items' urls are read first, so items that are dear to make should be stored ones.
    """
    table.ensure(options.dim)
    written = store_chunks(latest_chunks(items, options), table, options, latest=True, **batch)
    table.maintain()
    return written


def ingest_records(
    records: DataFrame,
    table: VectorTable,
    reject_path: str | None = None,
    options: IngestOptions = IngestOptions(),
    writer: str | None = None,
    batch_id: int | None = None,
) -> int:
    """As :func:`ingest_items`, from JSON records; refused ones go to a table.

    A job that may be retried names its ``writer`` and ``batch_id``: its rejects
    then have a folder of their own, which a retry writes again, and its rows
    are upserted once. Without them, rejects are appended.
    """
    decoded = decode_records(records)
    named = writer is not None and batch_id is not None
    if reject_path:
        accepted_rows, refused = split_outcomes(decoded)
        if named:
            refused.write.mode("overwrite").parquet(f"{reject_path}/writer={writer}/batch={batch_id}")
        else:
            refused.write.mode("append").parquet(reject_path)
    else:
        accepted_rows = materialize(records.sparkSession, accepted(decoded), "decoded")  # urls are looked at first
    return ingest_items(accepted_rows, table, options, writer=writer, batch_id=batch_id)


def split_outcomes(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted items and the dead-letter rows from one decode.

    One write, laid out by outcome, holds both; each is read back from its own
    folder (partition pruning), so the records are parsed once for two outputs.
    """
    spark = decoded.sparkSession
    path = work_dir(spark, "decoded")
    both = decoded.select(
        "*",
        F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("refused")).alias("_outcome"),
    )
    both = both.withColumn("value", F.when(F.col("_outcome") == "refused", F.col("value")))  # accepted rows need no raw text
    both.write.partitionBy("_outcome").parquet(path)
    back = spark.read.schema(both.schema).parquet(path)
    accepted_rows = back.where(F.col("_outcome") == "accepted").drop("_outcome", "reason", "value")
    refused_rows = rejects(back.where(F.col("_outcome") == "refused").drop("_outcome"))
    return accepted_rows, refused_rows


def record_outcomes(records: DataFrame) -> DataFrame:
    """Each record with the stage that dropped it, or ``ingested``."""
    decoded = normalize_fields(decode_records(records))
    reason = F.col("reason")
    stage = (
        F.when(reason.isin(SCHEMA_REASONS), "schema_invalid")
        .when(reason.isin(DECODE_REASONS), "decode_failed")
        .when(reason == "normalize_failed", "normalize_failed")
        .when(F.coalesce("title", "summary", "content").isNull(), "normalized_dropped")
        .otherwise("ingested")
    )
    return decoded.withColumn("stage", stage)


def stage_counts(records: DataFrame) -> DataFrame:
    """How many records ended at each stage: ``stage, records``."""
    return record_outcomes(records).groupBy("stage").agg(F.count("*").alias("records"))
