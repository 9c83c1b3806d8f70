"""Stream dedup by url with a time to live."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

TTL = "72 hours"
#: Groups of urls, fixed for the life of a checkpoint. A group costs a call of the state function
#: per batch, a url only its row; a batch writes the times of the groups it touches.
GROUPS = 1024


def first_in_batch(rows: DataFrame, *key: str) -> DataFrame:
    """Drop repeats of a key inside each Arrow batch, before any shuffle.

    A map-side reduction for streams, where a rank is not allowed: a hot key
    then sends one row per Arrow batch to its state partition, not all rows.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = pa.array(range(batch.num_rows), pa.int64())
            keys = pa.table({**{k: batch.column(batch.schema.get_field_index(k)) for k in key}, "_at": at})
            first = keys.group_by(list(key)).aggregate([("_at", "min")]).column("_at_min").combine_chunks()
            yield batch.take(pc.take(first, pc.array_sort_indices(first)))

    return rows.mapInArrow(reduce, rows.schema)


def dedup_stream(items: DataFrame, ttl: str = TTL, event_time: str | None = None, groups: int = GROUPS) -> DataFrame:
    """Keep one item per url for ``ttl``: an item passes if none of its url passed in the ``ttl`` before it.

    The clock is the batch time, which a replayed batch keeps; no item can be
    late, so none but repeats are dropped. With ``event_time``, a column of
    epoch seconds, the time to live follows that column instead; rows may come
    in any order and none is late, but a row older than the last of its url
    that passed is a repeat, and one without a time has its batch's. State holds one time per url and goes when its
    time to live is over, by ``event_time`` when no row of the url came for
    ``ttl`` of the batch clock. Urls are dealt by hash into ``groups``, and the state
    function runs once for a group. A task holds one row for each url and time
    of a group's share of a micro-batch, so a hot url costs by its distinct times.
    """
    life = int(pd.Timedelta(ttl).total_seconds() * 1_000_000)
    timed = items.withColumn("_seen", F.current_timestamp())
    time = F.coalesce(F.timestamp_seconds(event_time), F.col("_seen")) if event_time else F.col("_seen")
    timed = timed.withColumns({"_micros": F.unix_micros(time), "_clock": F.unix_micros("_seen")})
    timed = first_in_batch(timed, "url", "_micros")
    # Numbers cross to pandas as text, where a null stays a null and a long stays whole.
    plain = [F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NumericType) else F.col(f.name) for f in items.schema]
    sent = timed.select(*plain, "_micros", "_clock", "_seen", F.pmod(F.xxhash64("url"), F.lit(groups)).alias("_group"))
    out = sent.drop("_micros", "_clock", "_seen", "_group").schema

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Of each url the last time that passed, and when its state goes (microseconds).
        known = _urls_of(state.get[0]) if state.exists else {}
        watermark, fresh, kept = state.getCurrentWatermarkMs(), set(), []
        if not state.hasTimedOut:
            rows = None
            for frame in frames:
                rows = frame if rows is None else pd.concat([rows, frame])
                rows = rows.drop_duplicates(["url", "_micros"])
            rows = rows.sort_values("_micros", kind="stable")
            for at, (url, t, clock) in enumerate(zip(rows["url"].tolist(), rows["_micros"].tolist(), rows["_clock"].tolist())):
                last, free = known.get(url, (None, 0))
                if last is None or t >= last + life:
                    kept.append(at)
                    last = t
                known[url] = last, (max(clock, free) if event_time else last + life)
                fresh.add(url)
        known = {url: v for url, v in known.items() if url in fresh or v[1] // 1000 >= watermark}
        if known:
            state.update((_blob_of(known),))
            state.setTimeoutTimestamp(max(min(free for _, free in known.values()) // 1000, watermark + 1))
        else:
            state.remove()
        if kept:
            yield rows.iloc[kept].drop(columns=["_micros", "_clock", "_seen", "_group"])

    # The watermark trails the batch clock, so no row is behind it, and only frees state: times alone decide
    # what passes. (A processing-time timeout would keep a run over all available rows from ending.)
    grouped = sent.withWatermark("_seen", ttl).groupBy("_group")
    unique = grouped.applyInPandasWithState(run, out, "urls binary", "append", GroupStateTimeout.EventTimeTimeout)
    return unique.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in items.schema])


def _blob_of(known: dict[str | None, tuple[int, int]]) -> bytes:
    """A group's urls with their times, as one Arrow stream."""
    last, free = (pa.array([v[i] for v in known.values()], pa.int64()) for i in (0, 1))
    batch = pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), last, free], names=["url", "last", "free"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _urls_of(blob: bytes) -> dict[str | None, tuple[int, int]]:
    columns = pa.ipc.open_stream(blob).read_all()
    return dict(zip(columns["url"].to_pylist(), zip(columns["last"].to_pylist(), columns["free"].to_pylist())))
