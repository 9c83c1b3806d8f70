"""Views of stored tables as the records the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.schemas import ITEM


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core when a small input has fewer splits than the cluster.

    Text work is CPU-bound, and one small file is one task. At scale a scan has
    more splits than cores, the test fails and no shuffle is added.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def document_items(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, text, lang, source, …)`` as items, whole texts."""
    return documents.select(
        F.col("source").alias("source_id"),
        F.concat(F.lit("https://docs.example/"), F.col("doc_id")).alias("url"),
        F.concat(F.lit("Document  "), F.col("doc_id"), F.lit(" ")).alias("title"),
        F.lit(None).cast("string").alias("summary"),
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("author"),
        F.lit(None).cast("bigint").alias("published_at"),
        F.col("lang").alias("language"),
        F.array(F.lit("Doc"), F.upper("lang"), F.lit("doc")).alias("tags"),
        F.lit(0).cast("bigint").alias("fetched_at"),
    ).to(_nullable(ITEM))


def _nullable(schema):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
