"""The registry of sources: a small table joined to what they deliver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.schemas import SOURCE

SOURCE_TYPES = ("rss",)
_DEFAULTS = {"schedule_cron": "*/5 * * * *", "language": "en", "tags": [], "extra": {}}


def source_registry(spark: SparkSession, rows: list[dict], known: tuple[str, ...] = SOURCE_TYPES) -> DataFrame:
    """Registry from configuration entries; optional fields take defaults."""
    full = [{**_DEFAULTS, **row} for row in rows]
    data = [tuple(row[f.name] for f in SOURCE.fields) for row in full]
    return check_sources(spark.createDataFrame(data, SOURCE), known)


def read_sources(spark: SparkSession, path: str, known: tuple[str, ...] = SOURCE_TYPES) -> DataFrame:
    """Registry from a YAML file with a ``sources`` list (needs PyYAML)."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return source_registry(spark, yaml.safe_load(handle)["sources"], known)


def check_sources(sources: DataFrame, known: tuple[str, ...] = SOURCE_TYPES) -> DataFrame:
    """Raise on a source whose type nothing can parse."""
    unknown = sources.where(~F.col("type").isin(*known)).select("type").first()
    if unknown:
        raise ValueError(f"Unknown source type: {unknown['type']}")
    return sources
