"""Raw record sources: one text value per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Batch form: JSON lines as ``value``."""
    return spark.read.text(path)


def stream_records(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """File stream of JSON lines as ``value``."""
    return spark.readStream.options(**options).text(path)


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str = "earliest",
    **options: str,
) -> DataFrame:
    """Topic stream, values as UTF-8 text, keys ignored.

    Needs the Kafka connector package on the session.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
    )
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    return reader.load().select(F.col("value").cast("string").alias("value"))
