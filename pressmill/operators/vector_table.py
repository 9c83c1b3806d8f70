"""A keyed vector table on plain Parquet: upsert, replay guard, compaction.

An upsert appends one folder and never rewrites the table, so its cost follows
the batch. A snapshot file names the folders of the base and of the batches
since (the deltas); writing the next snapshot publishes a batch as a whole.
Reads take the newest row per id out of the deltas and the rest from the base.

Every folder is laid out by a bucket of the chunk id (``partitionBy``), and
the snapshot knows the rows of each delta per bucket. A read pairs base and
deltas bucket group by bucket group, each group holding at most
``BROADCAST_DELTA_ROWS`` delta rows, so the ids of a group are broadcast and
base rows, vectors and all, are filtered where they lie. The driver holds the
ids of all groups at once, so above ``BROADCAST_TOTAL_ROWS`` delta rows nothing is
broadcast and the columns that are read are joined by a shuffle.

A narrow url index (url, extent: one past the highest chunk index stored),
laid out by a bucket of the url, lets ``replace_url`` find the ids past a new
total from the batch's urls alone: it opens the index buckets of those urls
and never scans the vector table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from functools import reduce

from pressmill.functions.ids import chunk_id
from pressmill.operators.embedding import DIMENSION, require_dimension
from pressmill.operators.files import Files
from pressmill.operators.joins import fits_broadcast, lookup_join
from pressmill.schemas import EMBEDDED_CHUNK

MAX_DELTAS = 32
COMPACT_SHARE = 10  # compact once the deltas hold a tenth of the base
BROADCAST_DELTA_ROWS = 500_000
#: The groups' ids are all held by the driver at once, so this bounds them together; above it one shuffled join pairs base and deltas.
BROADCAST_TOTAL_ROWS = 500_000
#: Buckets of chunk ids and of urls in a new collection (``ensure`` takes others). Each
#: writing task makes one file per bucket, and one bucket's deltas must fit the
#: broadcast bound, so a collection expecting D delta rows at most wants
#: D / BROADCAST_DELTA_ROWS buckets or more.
BUCKETS = 8
URL_BUCKETS = 8

_ROW = T.StructType([T.StructField(f.name, f.dataType) for f in EMBEDDED_CHUNK.fields])
_STORED = T.StructType(_ROW.fields + [T.StructField("_seq", T.LongType()), T.StructField("_removed", T.BooleanType())])
_URLS = T.StructType([T.StructField("url", T.StringType()), T.StructField("extent", T.IntegerType()),
                      T.StructField("_seq", T.LongType()), T.StructField("_replace", T.BooleanType()), T.StructField("_ubucket", T.IntegerType())])
_EMPTY = {"seq": 0, "base": [], "base_rows": 0, "clustered": False, "deltas": [], "writers": {}, "last": None, "failed_urls": 0, "urls": []}


def latest_per_chunk(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The last version of each chunk id. Each task reduces its own versions
    before the shuffle (group limit), so hot ids do not pile up."""
    window = W.partitionBy("chunk_id").orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(window)).where(F.col("_nth") == 1).drop("_nth")


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _extents(records: DataFrame) -> DataFrame:
    """``url, extent`` from index records: the last replacing record, raised by later ones.

    A url has one record per batch since the last fold, so its list stays short.
    """
    ordered = F.array_sort(F.collect_list(F.struct("_seq", "_replace", "extent")))
    step = lambda acc, r: F.when(r["_replace"], r["extent"]).otherwise(F.greatest(acc, r["extent"]))
    return records.groupBy("url").agg(F.aggregate(ordered, F.lit(0), step).cast("int").alias("extent"))


class VectorTable:
    """Collection of embedded chunks, keyed by ``chunk_id``, cosine distance.

    One writer at a time: of two that race, the second fails on its snapshot.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._files = Files(spark, self.path)

    def ensure(self, dim: int = DIMENSION, buckets: int = BUCKETS, url_buckets: int = URL_BUCKETS) -> VectorTable:
        """Create the collection if missing; a different size is an error. Buckets are fixed at creation."""
        if "collection.json" not in self._files.names(self.path):
            layout = {"buckets": buckets, "url_buckets": url_buckets}
            self._files.create(f"{self.path}/collection.json", {"size": dim, "distance": "cosine", **layout})
        if self.dimension() != dim:
            raise ValueError(f"the collection holds vectors of {self.dimension()} elements, not {dim}")
        return self

    def dimension(self) -> int:
        return self._files.load(f"{self.path}/collection.json")["size"]

    def buckets(self) -> tuple[int, int]:
        """Buckets of chunk ids and of urls; a collection from before the layout has one of each."""
        meta = self._files.load(f"{self.path}/collection.json")
        return meta.get("buckets", 1), meta.get("url_buckets", 1)

    # -- snapshots ----------------------------------------------------------

    def snapshot(self) -> dict:
        names = self._files.names(f"{self.path}/snapshots")
        return self._files.load(f"{self.path}/snapshots/{names[-1]}") if names else _EMPTY

    def _publish(self, before: dict, **changes) -> None:
        after = {**before, **changes, "seq": before["seq"] + 1}
        self._files.create(f"{self.path}/snapshots/{after['seq']:012d}.json", after)

    def _write_plain(self, rows: DataFrame) -> dict:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return {"folder": folder, "rows": self.spark.read.schema(rows.schema).parquet(folder).count()}

    def _write(self, rows: DataFrame, clustered: bool = False) -> dict:
        """Stored rows in folders by bucket of the chunk id; the count of each bucket comes back (one row a bucket)."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        bucketed = rows.select(*_STORED.fieldNames()).withColumn("_bucket", _bucket(F.col("chunk_id"), self.buckets()[0]))
        if clustered:
            bucketed = bucketed.repartitionByRange("_bucket", "chunk_id").sortWithinPartitions("chunk_id")
        bucketed.write.partitionBy("_bucket").parquet(folder)
        counts = {str(r["_bucket"]): r["n"] for r in self._scan([folder]).groupBy("_bucket").agg(F.count("*").alias("n")).collect()}
        return {"folder": folder, "rows": sum(counts.values()), "buckets": counts}

    def _scan(self, folders: list[str]) -> DataFrame:
        schema = T.StructType(_STORED.fields + [T.StructField("_bucket", T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        # Each folder is a table of its own partitions, so each is read by itself.
        return reduce(lambda a, b: a.unionByName(b), [self.spark.read.schema(schema).parquet(f) for f in folders])

    # -- reads --------------------------------------------------------------

    def read(self) -> DataFrame:
        """The current rows, one per chunk id."""
        return self._current(self.snapshot()).select(*_ROW.fieldNames())

    def _newest(self, snapshot: dict) -> DataFrame:
        """Newest row per id of the deltas, removals included."""
        deltas = self._scan([d["folder"] for d in snapshot["deltas"]])
        one_version = len({d["seq"] for d in snapshot["deltas"]}) < 2
        return deltas if one_version else latest_per_chunk(deltas, [F.col("_seq").desc()])

    def _current(self, snapshot: dict) -> DataFrame:
        base = self._scan(snapshot["base"])
        if not snapshot["deltas"]:
            return base
        deltas = self._scan([d["folder"] for d in snapshot["deltas"]])
        versions = len({d["seq"] for d in snapshot["deltas"]}) > 1
        parts = []
        for group, fits in self._groups(snapshot, self.buckets()[0]):
            # The snapshot knows the rows of every bucket, so a broadcast needs
            # no guess; base and delta rows, vectors and all, stay where they lie.
            mine = (lambda df: df) if group is None else (lambda df, g=group: df.where(F.col("_bucket").isin(g)))
            delta = mine(deltas)
            ids = delta.groupBy("chunk_id").agg(F.max("_seq").alias("_seq")) if versions else delta.select("chunk_id", "_seq")
            # By its own estimate, from narrow files, Spark would broadcast far too many ids.
            ids = F.broadcast(ids) if fits else ids.hint("merge")
            newest = delta.join(ids, ["chunk_id", "_seq"], "left_semi") if versions else delta
            kept = newest.where(~F.col("_removed"))
            if snapshot["base"]:
                kept = mine(base).join(ids.select("chunk_id"), "chunk_id", "left_anti").unionByName(kept)
            parts.append(kept)
        return reduce(lambda a, b: a.unionByName(b), parts)

    @staticmethod
    def _groups(snapshot: dict, buckets: int) -> list[tuple[list[int] | None, bool]]:
        """All buckets dealt in order into groups of at most ``BROADCAST_DELTA_ROWS`` delta rows.

        One group (``None``: all buckets) while all deltas fit, or where they
        exceed ``BROADCAST_TOTAL_ROWS`` together and are joined by a shuffle. A
        bucket above the bound stands alone and is joined by a shuffle: more
        buckets at creation keep that away.
        """
        total = sum(d["rows"] for d in snapshot["deltas"])
        if total > BROADCAST_TOTAL_ROWS:
            return [(None, False)]
        if total <= BROADCAST_DELTA_ROWS or any("buckets" not in d for d in snapshot["deltas"]):
            return [(None, total <= BROADCAST_DELTA_ROWS)]
        counts = dict.fromkeys(range(buckets), 0)
        for d in snapshot["deltas"]:
            for b, n in d["buckets"].items():
                counts[int(b)] = counts.get(int(b), 0) + n
        groups, now, rows = [], [], 0
        for b in sorted(counts):
            if now and rows + counts[b] > BROADCAST_DELTA_ROWS:
                groups.append((now, rows <= BROADCAST_DELTA_ROWS))
                now, rows = [], 0
            now.append(b)
            rows += counts[b]
        return groups + [(now, rows <= BROADCAST_DELTA_ROWS)]

    @staticmethod
    def _delta_rows(snapshot: dict) -> int:
        return sum(d["rows"] for d in snapshot["deltas"])

    # -- writes -------------------------------------------------------------

    def upsert(
        self,
        rows: DataFrame,
        order_by: tuple[str, ...] = (),
        unique: bool = False,
        replace_url: bool = False,
        drop_failed: bool = False,
        writer: str | None = None,
        batch_id: int | None = None,
    ) -> int:
        """Insert or overwrite by chunk id; returns the rows written.

        ``order_by`` columns say which of several versions in one batch is the
        last; ``unique`` says there is one version already. ``replace_url``
        also removes a url's chunks beyond its new total; without it a shorter
        new version leaves the old tail in place. A row without a vector fails
        the batch; with ``drop_failed`` all rows of its url are left out and
        the url is counted. ``writer`` and ``batch_id`` make a replayed batch a
        no-op.
        """
        before = self.snapshot()
        guarded = writer is not None and batch_id is not None
        if guarded and before["writers"].get(writer, -1) >= batch_id:
            return 0
        seq = before["seq"] + 1
        newest_first = [F.col(c).desc_nulls_last() for c in order_by] or [F.col("total_chunks").desc(), F.col("chunk_text")]
        latest = rows if unique else latest_per_chunk(rows, newest_first)
        latest = require_dimension(latest, self.dimension(), nullable=drop_failed)
        added, failed, totals = [], 0, None
        urls = self._url_folders(before)
        if replace_url:
            latest, stale, totals = self._replaced(latest, order_by, urls)
            added.append(self._write(self._stored(stale, seq, removed=True)))
        stored = self._write(self._stored(latest, seq, removed=False))
        refused = None
        if drop_failed:
            stored, refused = self._without_failed(stored)
            failed = refused["rows"] if refused else 0
        added.append(stored)
        writers = {**before["writers"], writer: batch_id} if guarded else before["writers"]
        if not before["base"] and not before["deltas"]:
            # A first load has one row per id already: it is a base.
            change = {"base": [stored["folder"]], "base_rows": stored["rows"]}
        else:
            change = {"deltas": before["deltas"] + [{**a, "seq": seq} for a in added if a["rows"]]}
        failed += before["failed_urls"]
        change["urls"] = urls + [self._index_batch(stored["folder"], totals, seq)]
        if guarded:
            change["failed"] = {**before.get("failed", {}), writer: refused and refused["folder"]}
        self._publish(before, writers=writers, last=stored["folder"], failed_urls=failed, **change)
        return stored["rows"]

    def _without_failed(self, stored: dict) -> tuple[dict, dict | None]:
        """The folder without the urls that have a row lacking its vector, and
        a folder of these urls. The usual case, no such row, costs one scan of
        the vector column."""
        rows = self._scan([stored["folder"]])
        failed = rows.where(F.col("embedding").isNull()).select("url").distinct()
        if failed.isEmpty():
            return stored, None
        refused = self._write_plain(failed)
        failed = self.spark.read.schema(failed.schema).parquet(refused["folder"])
        marked = lookup_join(rows, failed.withColumn("_failed", F.lit(True)), "url", ["chunk_id"], how="left")
        return self._write(marked.where(F.col("_failed").isNull()).select(*_STORED.fieldNames())), refused

    def last_failed(self, writer: str) -> DataFrame | None:
        """The urls that ``writer``'s last batch left out, None where it left out none."""
        folder = self.snapshot().get("failed", {}).get(writer)
        return self.spark.read.schema("url string").parquet(folder) if folder else None

    def last_batch(self) -> DataFrame:
        """The rows of the last upsert."""
        last = self.snapshot()["last"]
        return self._scan([last] if last else []).select(*_ROW.fieldNames())

    def _replaced(self, latest: DataFrame, order_by: tuple[str, ...], urls: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The batch without rows past each url's last total, the stored ids
        past it, and the totals. The batch is written out once, as it is used
        three times.

        Stored ids past a total come from the url index: chunk ids are made
        from url and index (``chunk_id``), so ``[total, extent)`` names them.
        Only the index buckets of the batch's urls are opened.
        """
        staged = latest.select(*dict.fromkeys([*_ROW.fieldNames(), *order_by]))
        batch = self.spark.read.schema(staged.schema).parquet(self._write_plain(staged)["folder"])
        version = F.struct(*[F.col(c) for c in (*order_by, "total_chunks")])
        totals = self.spark.read.schema("url string, _total int").parquet(
            self._write_plain(batch.groupBy("url").agg(F.max_by("total_chunks", version).cast("int").alias("_total")))["folder"]
        )
        small = fits_broadcast(totals)
        past = F.col("chunk_index") >= F.col("_total")
        kept = lookup_join(batch, totals, "url", ["chunk_id"], broadcast=small).where(~past)
        mine = [r[0] for r in totals.select(_bucket(F.col("url"), self.buckets()[1])).distinct().collect()]  # at most url_buckets rows
        index = self._scan_urls(urls).where(F.col("_ubucket").isin(mine))
        index = index.join(F.broadcast(totals.select("url")) if small else totals.select("url").hint("merge"), "url", "left_semi")
        extents = lookup_join(_extents(index), totals, "url", ["url"], broadcast=small).where(F.col("extent") > F.col("_total"))
        place = F.explode(F.sequence(F.col("_total"), F.col("extent") - 1))
        stale = extents.select("url", place.alias("chunk_index")).select(chunk_id(F.col("url"), F.col("chunk_index")).alias("chunk_id"))
        return kept, stale, totals

    # -- url index ------------------------------------------------------------

    def _scan_urls(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], _URLS)
        return reduce(lambda a, b: a.unionByName(b), [self.spark.read.schema(_URLS).parquet(f) for f in folders])

    def _write_urls(self, records: DataFrame) -> str:
        folder = f"{self.path}/urls/{uuid.uuid4().hex}"
        cols = [c for c in _URLS.fieldNames() if c != "_ubucket"]
        records.select(*cols).withColumn("_ubucket", _bucket(F.col("url"), self.buckets()[1])).write.partitionBy("_ubucket").parquet(folder)
        return folder

    def _url_folders(self, snapshot: dict) -> list[str]:
        """The snapshot's index folders; a table from before the index gets one, from one scan, once."""
        if "urls" in snapshot:
            return list(snapshot["urls"])
        rows = self._current(snapshot).where(F.col("url").isNotNull())
        first = rows.groupBy("url").agg((F.max("chunk_index") + 1).cast("int").alias("extent"))
        return [self._write_urls(first.withColumns({"_seq": F.lit(snapshot["seq"]).cast("bigint"), "_replace": F.lit(True)}))]

    def _index_batch(self, folder: str, totals: DataFrame | None, seq: int) -> str:
        """One index record per url of a batch: its new extent, or, replacing, its total."""
        if totals is not None:
            records = totals.select("url", F.col("_total").alias("extent"), F.lit(True).alias("_replace"))
        else:
            rows = self._scan([folder]).where(F.col("url").isNotNull())
            records = rows.groupBy("url").agg((F.max("chunk_index") + 1).cast("int").alias("extent")).withColumn("_replace", F.lit(False))
        return self._write_urls(records.where(F.col("url").isNotNull()).withColumn("_seq", F.lit(seq).cast("bigint")))

    def fold_urls(self) -> None:
        """Fold the index records into one per url."""
        before = self.snapshot()
        urls = self._url_folders(before)
        if len(urls) > 1:
            now = _extents(self._scan_urls(urls)).withColumns({"_seq": F.lit(before["seq"]).cast("bigint"), "_replace": F.lit(True)})
            self._publish(before, urls=[self._write_urls(now)])

    @staticmethod
    def _stored(rows: DataFrame, seq: int, removed: bool) -> DataFrame:
        present = set(rows.columns)
        return rows.select(
            *[
                F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
                for f in _ROW.fields
            ],
            F.lit(seq).cast("bigint").alias("_seq"),
            F.lit(removed).alias("_removed"),
        )

    # -- upkeep -------------------------------------------------------------

    def merge(self) -> None:
        """Fold the deltas into one, leaving the base alone."""
        before = self.snapshot()
        if len(before["deltas"]) > 1:
            merged = self._write(self._newest(before))
            self._publish(before, deltas=[{**merged, "seq": before["seq"]}])

    def compact(self) -> None:
        """Fold the deltas into a new base, laid out by chunk id so that a
        lookup of few ids opens few files. Old folders stay for open readers."""
        before = self.snapshot()
        if before["deltas"] or not before["clustered"]:
            base = self._write(self._current(before), clustered=True)
            self._publish(before, base=[base["folder"]], base_rows=base["rows"], clustered=True, deltas=[])

    def maintain(self) -> None:
        """Keep the number of deltas low. The base is rewritten only when the
        deltas have grown to a fair share of it."""
        now = self.snapshot()
        if len(now.get("urls", [])) >= MAX_DELTAS:
            self.fold_urls()
            now = self.snapshot()
        if len(now["deltas"]) >= MAX_DELTAS:
            if self._delta_rows(now) * COMPACT_SHARE >= now["base_rows"]:
                self.compact()
            else:
                self.merge()
