"""Feed payloads as a stream, joined with a source registry that is read anew for every batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pressmill.sources.feeds import parse_feeds


def feed_stream(
    payloads: DataFrame,
    registry_path: str,
    out: str,
    checkpoint: str,
    fetched_at: int,
    once: bool = False,
) -> StreamingQuery:
    """Parse a stream of ``(source_id, payload)`` into items appended below ``out``.

    The registry is a Parquet table at ``registry_path`` (``id, language, tags``):
    each batch reads it again, so a source added or changed between batches
    holds from the next batch on (a stream-static join that follows the table).
    A batch writes its own folder, which a replay writes again.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        registry = rows.sparkSession.read.parquet(registry_path)
        parse_feeds(rows, registry, fetched_at).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = payloads.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
