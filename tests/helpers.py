"""Builders shared by the tests."""

from pressmill.schemas import ITEM
from pyspark.sql import types as T

OPEN_ITEM = T.StructType([T.StructField(f.name, f.dataType) for f in ITEM.fields])


def items(spark, *entries):
    base = dict.fromkeys(ITEM.fieldNames()) | {"source_id": "s", "url": "https://x.test/a", "tags": [], "fetched_at": 0}
    data = [tuple((base | e)[n] for n in ITEM.fieldNames()) for e in entries]
    return spark.createDataFrame(data, OPEN_ITEM)


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")
