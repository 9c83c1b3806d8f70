"""Fixed schemas of every record that crosses an operator boundary."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())

ITEM = T.StructType([
    T.StructField("source_id", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("published_at", T.LongType()),  # epoch seconds
    T.StructField("language", T.StringType()),
    T.StructField("tags", _STRINGS),
    T.StructField("fetched_at", T.LongType()),
])

ITEM_REQUIRED = ["source_id", "url"]

CHUNK = T.StructType([
    T.StructField("chunk_id", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("chunk_text", T.StringType(), False),
    T.StructField("chunk_index", T.IntegerType(), False),
    T.StructField("total_chunks", T.IntegerType(), False),
    T.StructField("language", T.StringType()),
    T.StructField("published_at", T.LongType()),
    T.StructField("source_id", T.StringType(), False),
    T.StructField("tags", _STRINGS),
])

EMBEDDED_CHUNK = T.StructType(CHUNK.fields + [T.StructField("embedding", T.ArrayType(T.FloatType()))])

SOURCE = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("schedule_cron", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("tags", _STRINGS),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
])

FEED_PAYLOAD = T.StructType([
    T.StructField("source_id", T.StringType(), False),
    T.StructField("payload", T.StringType()),
])
