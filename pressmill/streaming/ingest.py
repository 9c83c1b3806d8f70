"""Record streams to a vector table."""

from __future__ import annotations

from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from pressmill.operators.files import Files
from pressmill.operators.chunking import chunk_items, pick_text
from pressmill.operators.normalize import normalize_items
from pressmill.operators.records import ingest_summary, summary_json
from pressmill.operators.validate import DECODE_REASONS, SCHEMA_REASONS, accepted, decode_records, rejects
from pressmill.operators.vector_table import VectorTable
from pressmill.plans.ingest import ITEM_ID, VERSION, IngestOptions, language_step, store_chunks, with_item_id
from pressmill.streaming.dedup import TTL, dedup_stream


def decode_stream(records: DataFrame, name: str = "decode") -> DataFrame:
    """Decoded records; the counts per outcome are observed as ``name`` and
    show up in the query progress."""
    reason = F.col("reason")
    return decode_records(records).observe(
        name,
        F.count("*").alias("records"),
        F.count_if(reason.isNull()).alias("accepted"),
        F.count_if(reason.isin(SCHEMA_REASONS)).alias("schema_invalid"),
        F.count_if(reason.isin(DECODE_REASONS)).alias("decode_failed"),
        F.count_if(reason == "normalize_failed").alias("normalize_failed"),
    )


def _start(writer: DataStreamWriter, checkpoint: str, name: str | None, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if once else writer).start()


def write_chunks(
    chunks: DataFrame,
    table: VectorTable,
    checkpoint: str,
    options: IngestOptions,
    summaries: str | None = None,
    name: str | None = None,
    once: bool = False,
    failures: str | None = None,
    counters: str | None = None,
) -> StreamingQuery:
    """Embed and upsert a stream of chunks. A batch that is replayed after a
    failure finds its own commit and leaves the table alone.

    ``summaries`` names a folder for the ``{"url":…,"chunks":…}`` line of each
    processed item, told apart by its ``item_id`` where the chunks carry one
    (two records of one url and fetch time give two lines); ``failures`` one for
    ``url, reason`` of the items the embedder failed on. Both get a sub-folder
    per query and batch, which a replay writes again. ``counters`` names a
    folder for one row per batch: ``batch, chunks, items, written,
    embedding_failed, upsert_failed`` (a failed upsert writes its row, then
    fails the batch, which is retried from the checkpoint).
    """
    if options.drop_failed is None:
        options = replace(options, drop_failed=True)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # The query's own id: a fresh checkpoint at an old path numbers its batches anew.
        writer = Files(batch.sparkSession, checkpoint).load(f"{checkpoint.rstrip('/')}/metadata")["id"]
        folder = f"query={writer}/batch={batch_id}"
        if summaries or counters:
            batch = batch.persist(StorageLevel.DISK_ONLY)
        # A replayed batch upserts nothing; the counter row of its first run stands.
        counting = counters and table.snapshot()["writers"].get(writer, -1) < batch_id
        try:
            written = store_chunks(batch, table, options, writer=writer, batch_id=batch_id)
        except Exception:
            if counting:
                _count(batch, batch_id, -1, None, f"{counters}/{folder}")
            raise
        failed = table.last_failed(writer)
        if counting:
            _count(batch, batch_id, written, failed, f"{counters}/{folder}")
        if failures and failed is not None:
            reasons = failed.withColumn("reason", F.lit("embedding_failed"))
            reasons.write.mode("overwrite").parquet(f"{failures}/{folder}")
        if summaries:
            done = ingest_summary(batch, [*VERSION, *([ITEM_ID] if ITEM_ID in batch.columns else [])])
            done = done if failed is None else done.join(failed, "url", "left_anti")
            summary_json(done).write.mode("overwrite").text(f"{summaries}/{folder}")
        if summaries or counters:
            batch.unpersist()
        table.maintain()

    return _start(chunks.writeStream.foreachBatch(upsert), checkpoint, name, once)


def _count(batch: DataFrame, batch_id: int, written: int, failed: DataFrame | None, path: str) -> None:
    """One counter row of a batch; ``written`` below 0 marks a failed upsert."""
    item = [F.col("url"), *([F.col(ITEM_ID)] if ITEM_ID in batch.columns else [])]
    row = batch.agg(F.count("*").alias("chunks"), F.count_distinct(*item).alias("items")).select(
        F.lit(batch_id).cast("bigint").alias("batch"),
        "chunks",
        "items",
        F.lit(max(written, 0)).cast("bigint").alias("written"),
        F.lit(0 if failed is None else failed.count()).cast("bigint").alias("embedding_failed"),
        F.lit(1 if written < 0 else 0).cast("bigint").alias("upsert_failed"),
    )
    row.write.mode("overwrite").parquet(path)


def ingest_stream(
    records: DataFrame,
    table: VectorTable,
    checkpoint: str,
    options: IngestOptions = IngestOptions(),
    ttl: str | None = None,
    summaries: str | None = None,
    name: str | None = None,
    once: bool = False,
    failures: str | None = None,
    counters: str | None = None,
) -> StreamingQuery:
    """Decode, normalize, chunk, embed and upsert a stream of records.

    ``ttl`` adds url dedup with that time to live. The query progress counts
    records per outcome (``decode``), items left after cleaning
    (``normalize``), after dedup and language (``refine``), and chunks
    (``chunk``). :func:`reject_stream` stores the refused records.
    """
    table.ensure(options.dim)
    if options.dedup:
        raise ValueError("a stream is deduplicated with ttl, not with the batch option")
    items = normalize_items(accepted(decode_stream(records)))
    items = items.observe("normalize", F.count("*").alias("kept"))
    if ttl:
        items = dedup_stream(items, ttl)
    refined = language_step(items, options).observe(
        "refine", F.count("*").alias("kept"), F.count_if(pick_text().isNull()).alias("chunked_dropped")
    )
    refined = with_item_id(refined)
    chunks = chunk_items(refined, options.max_tokens, options.overlap_tokens, carry=(*VERSION, ITEM_ID))
    chunks = chunks.observe("chunk", F.count("*").alias("chunks"))
    return write_chunks(chunks, table, checkpoint, options, summaries, name, once, failures, counters)


def reject_stream(
    records: DataFrame, path: str, checkpoint: str, name: str | None = None, once: bool = False
) -> StreamingQuery:
    """Append refused records with their reason to the dead-letter table."""
    refused = rejects(decode_records(records))
    return _start(refused.writeStream.format("parquet").option("path", path), checkpoint, name, once)


def print_stream(records: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Show a stream on the console, for debugging."""
    return _start(records.writeStream.format("console"), checkpoint, None, once)


__all__ = [
    "TTL",
    "decode_stream",
    "ingest_stream",
    "print_stream",
    "reject_stream",
    "write_chunks",
]
