"""Session helpers: defaults for a fresh session and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def build_session(app_name: str = "pressmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    A cluster sets its own master, memory and shuffle width; only what changes
    results (time zone) or plan quality (adaptive execution) is set here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Id lookups push their ids to the scan one by one, not as a range.
        "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _fallback_root() -> str:
    return tempfile.mkdtemp(prefix="pressmill-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared folder named by ``spark.checkpoint.dir``.

    Executors must be able to read it, so the cluster's setting wins; a local
    folder is made only where the setting is absent (single-machine tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _fallback_root()
    return f"{root.rstrip('/')}/pressmill/{name}-{uuid.uuid4().hex}"


def materialize(spark: SparkSession, df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives executor loss, and lets several
    consumers share one computation.
    """
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
