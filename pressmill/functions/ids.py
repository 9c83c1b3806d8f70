"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_id(url: Column, index: Column) -> Column:
    """UUID text of the first 32 hex digits of ``sha1(url#index)``.

    Depends on url and index only: a new version of a page overwrites the
    chunks of the old one.
    """
    digest = F.sha1(F.concat(url, F.lit("#"), index.cast("string")).cast("binary"))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(digest.isNotNull(), F.concat_ws("-", *parts))
