"""Joins against a keyed lookup that stay even when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
SALTS = 32


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` (reading at most ``max_rows + 1`` rows) against the bounds."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns]))).cast("bigint"))
    rows, total = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    row_id: list[str],
    how: str = "inner",
    broadcast: bool | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which holds at most one row per ``key``.

    A lookup measured small is broadcast and ``rows`` do not move. Otherwise
    both sides shuffle on ``(key, salt)``: the lookup is copied once per salt
    and a hot key is spread over that many tasks. The salt comes from
    ``row_id``, the columns that tell rows of one key apart, so a re-run task
    sends each row to the same place. The join is a merge join by hint: from a
    narrow file, Spark's own estimate, which leaves the copies out, would have
    the driver hold all of them.
    """
    if fits_broadcast(lookup) if broadcast is None else broadcast:
        return rows.join(F.broadcast(lookup), key, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*row_id), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [key, "_salt"], how).drop("_salt")
