import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """Rows of ``(doc_id, text[, source])`` as documents, with columns whose names clash with the operators' own."""

    def make(*rows):
        rows = [(*r, None)[:3] if len(r) == 2 else r for r in rows]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
        return df.withColumns({c: F.lit("x") for c in ("size", "kind", "n", "spans", "score", "component", "_t", "key", "ids")})

    return make
