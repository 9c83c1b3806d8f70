"""Exact Jaccard self-join on word n-grams by PartEnum signatures, and its components.

Sets of one size band, or of neighbouring bands, that reach the similarity
differ in at most k features. The features are dealt by hash into more than k
parts, so at least one part is the same in both: a set's signatures are the
hashes of its parts. (Each signature is one part of the enumeration; with k + 1
or more parts, subsets larger than one part are not needed for completeness.)
Bands grow by the inverse of the similarity, so a set signs for its own band and
for the next.

Empty parts say nothing and are left out. That is safe for a set with more than
k non-empty parts, since at most k of them differ from a partner's. Frequent
features are left out as well, which no partner's count of differences can
exceed. A set with too few parts left signs with each of its rare features too;
if those are no more than k, with the parts of all its features; and if these are
no more than k, with each feature. So every link shares a signature. Sets that
share no rare feature differ in all of theirs, so of two linked ones one is
light: it has at most k / 2 of them. Pairs without a light set are left out
where all features sign.

Signatures many sets share are not expanded into pairs: each set meets a pivot,
and only sets that stay in different components meet further pivots, more in each
round, until all light ones were met. Pairs whose sizes, rare features and counts
of frequent features in cells already differ too much are not verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pressmill.llm import packed
from pressmill.llm.common import lower_ascii, mix, slices, split_words, texts, windows, word_hashes
from pressmill.llm.components import components
from pressmill.session import materialize

WIDTH = 5
NUM, DEN = 3, 4  # similarity as a fraction
SPREAD = 1.6  # parts for each difference
HOT_DOCS = 48  # documents from which a feature is frequent
HOT_LIST = 100_000  # frequent features at most; any choice of them keeps the join exact
LOCAL_GROUP, GROUP = 64, 64  # sets from which a signature's group meets pivots only, in a chunk and in a bucket
PIVOTS = 16  # in the first round after the star
TILE, TILE_SALTS = 256, 8  # members, and pivots, of a group that meet in one call; tasks that a group's tiles go to
OWN, BIG, LIGHT, FULL, SINGLE = 1, 2, 4, 8, 16  # flags of an entry
_ODD = np.uint64(0x9E3779B97F4A7C15)
ENOUGH = 1 << 30  # shared entries of a pair that need not be counted


def shingle_sets(batch: pa.RecordBatch, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray]]:
    """For each row with words its number and the sorted hashes of its distinct shingles."""
    flat, rows = split_words(lower_ascii(batch.column("text")))
    hashes = word_hashes(flat)
    grams = windows(hashes, width)
    found, first = np.unique(rows, return_index=True)
    for row, a, b in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(rows)]):
        own = np.sort(grams[a : b - width + 1]) if b - a >= width else windows(hashes[a:b], b - a)
        yield row, own[np.concatenate([[True], own[1:] != own[:-1]])]


def set_id(features: np.ndarray) -> int:
    """A 64-bit id of a set: equal for equal sets."""
    total = np.array([features.sum(), mix(features).sum(), len(features)], np.uint64)
    return int(windows(total, 3)[0].astype(np.int64))


def _bands() -> np.ndarray:
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, ends[-1] * DEN // NUM))
    return np.array(ends)


#: Largest size of each band; a partner of a set in one band lies in it or in one next to it.
BANDS = _bands()


def band_of(size: int) -> int:
    return int(np.searchsorted(BANDS, size, "left"))


def differences(band: int) -> int:
    """Most features in which two linked sets of sizes up to the band's end differ."""
    return int((DEN - NUM) * 2 * int(BANDS[band]) // (DEN + NUM))


def _parts(features: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the parts that hold features, and a hash of what each holds."""
    part = ((features >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
    # Sums of 40-bit numbers are whole in a double for up to 8,192 features of a part, and the same in any case
    # for equal parts, as the features are sorted.
    total = np.bincount(part, (features & np.uint64((1 << 40) - 1)).astype(np.float64), n)
    used = np.flatnonzero(np.bincount(part, minlength=n))
    return used, total[used].astype(np.uint64)


def signatures(features: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[int, int, int, int]]:
    """Hashes and flags of one set's entries, its band, how many entries a partner of its own and of the next band shares at least,
    and how many of its features are rare.

    That number is negative where the set relies on single features, which only a partner that does so too has signed with.
    """
    size = len(features)
    rare = features
    if len(hot):
        at = np.searchsorted(hot, features)
        rare = features[hot[np.minimum(at, len(hot) - 1)] != features]
    own = band_of(size)
    keys, flags, shared = [], [], [0, 0]

    def sign(hashes: np.ndarray, flag: int) -> None:
        keys.append(mix(hashes))
        flags.append(np.full(len(hashes), flag, np.uint8))

    for band in (own, own + 1):
        k = differences(band)
        if not k:
            continue  # only equal sets are linked, and those are one set here
        n, mine = int(SPREAD * k) + 4, OWN if band == own else 0
        seed = np.array([0, 1, 2, 3], np.uint64) + np.uint64(4 * band)
        used, total = _parts(rare, n)
        sign(total * _ODD + (used.astype(np.uint64) << np.uint64(20)) + seed[0], mine | LIGHT)
        need = len(used) - k
        if need <= 0:
            need = -max(0, len(rare) - k)
            sign(rare ^ mix(seed[2:3]), mine | LIGHT | SINGLE)
            if len(rare) <= k:
                light = LIGHT if 2 * len(rare) <= k else 0
                used, total = _parts(features, n)
                sign(total * _ODD + (used.astype(np.uint64) << np.uint64(20)) + seed[1], mine | light | FULL)
                if len(used) <= k:
                    sign(features ^ mix(seed[3:4]), mine | light | FULL | SINGLE)
        shared[band - own] = need
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8), (own, 0, 0, len(rare))
    return np.concatenate(keys), np.concatenate(flags), (own, *shared, len(rare))


_SPARE_BITS = 15


def _spare(keys: np.ndarray, flags: np.ndarray, band: int) -> tuple[int, int]:
    """Of each kind of entries of a set (parts or single features, of rare or all features) how many it can do without, for
    its own and for the next band, packed.

    A set and a partner that sign alike share all but as many entries of a kind as they differ in features. So if they share one,
    they share one that is not among the last of either in any order of all keys: those beyond the differences and one more.
    """
    ordered = np.sort(keys)
    twice = int((ordered[1:] == ordered[:-1]).sum())  # keys that fell together count once
    count = np.bincount(flags & (OWN | FULL | SINGLE), minlength=OWN + FULL + SINGLE + 1)
    packed_ = []
    for mine, k in ((OWN, differences(band)), (0, differences(band + 1))):
        spare = [max(0, min(int(count[mine | kind]) - twice - k - 1, (1 << _SPARE_BITS) - 1)) for kind in (0, FULL, SINGLE, FULL | SINGLE)]
        packed_.append(sum(x << _SPARE_BITS * i for i, x in enumerate(spare)))
    return packed_[0], packed_[1]


def _star(keys: np.ndarray, owners: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the entries of large groups, sorted by key: each one's pivot, and whether the two make a pair that counts.

    A group's pivot is a light own entry if there is one; families of like sets have few different pivots.
    """
    start, size = packed.groups(keys)
    first = np.uint64(3) - np.minimum(flags & OWN, 1).astype(np.uint64) - (flags & LIGHT > 0).astype(np.uint64) * np.uint64(2)
    rank = mix(owners.astype(np.uint64) ^ (keys & np.uint64(7))) >> np.uint64(2) | first << np.uint64(62)
    least = np.repeat(np.minimum.reduceat(rank, start), size)
    place = np.where(rank == least, np.arange(len(keys)), len(keys))
    at = np.repeat(np.minimum.reduceat(place, start), size)
    return at, _counts(flags, flags[at])


def _counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of entries count: one must be of its own band, and one light."""
    either = a | b
    return (either & OWN > 0) & (either & LIGHT > 0)


_FOUND = ["kind", "a", "b", "key"]
_FOUND_SCHEMA = "kind int, a bigint, b bigint, key bigint"


def _rows(kind: int, a: np.ndarray, b: np.ndarray, key: np.ndarray) -> pa.Table:
    arrays = [np.full(len(a), kind, np.int32), a.astype(np.int64), b.astype(np.int64), key.astype(np.int64)]
    return pa.table(dict(zip(_FOUND, arrays)))


def _counted(a: np.ndarray, b: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair of different sets once, smaller id first, with the sum of its times."""
    a, b, times = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b], times[a != b]
    order = np.lexsort((b, a))
    a, b, times = a[order], b[order], times[order]
    if not len(a):
        return a, b, times
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[start], b[start], np.add.reduceat(times, start)


def _bucket_pairs(group: pa.Table, width: int) -> pa.Table:
    """Candidate pairs of one bucket with the number of entries they share (kind 0), and members of groups that meet pivots only (kind 1)."""
    keys, owners, flags = packed.unpack(group, width)
    start, size = packed.groups(keys)
    some = np.repeat(size > 1, size) | (flags & BIG > 0)
    keys, owners, flags = keys[some], owners[some], flags[some]
    if not len(keys):
        return _rows(0, *[np.zeros(0)] * 3)
    start, size = packed.groups(keys)
    most = np.maximum.reduceat(flags & BIG, start)
    big = np.repeat((size > GROUP) | (most > 0), size)
    pairs_a, pairs_b, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if big.any():
        k, o, f = keys[big], owners[big], flags[big]
        at, counts = _star(k, o, f)
        pairs_a.append(o[counts])
        pairs_b.append(o[at[counts]])
        times.append(np.full(int(counts.sum()), ENOUGH))
    k, o, f = keys[~big], owners[~big], flags[~big]
    for d in range(1, GROUP):
        same = k[d:] == k[:-d]
        if not same.any():
            break
        meet = same & _counts(f[d:], f[:-d])
        pairs_a.append(o[d:][meet])
        pairs_b.append(o[:-d][meet])
        times.append(np.ones(int(meet.sum()), np.int64))
    pairs = _counted(np.concatenate(pairs_a), np.concatenate(pairs_b), np.concatenate(times))
    return pa.concat_tables([_rows(0, *pairs), _rows(1, owners[big], flags[big], keys[big])])


def _cells(features: np.ndarray, hot: np.ndarray) -> list[int]:
    """How many frequent features fall in each of 32 cells, up to 255, as four numbers of eight bytes."""
    if not len(hot):
        return [0] * 4
    own = features[hot[np.minimum(np.searchsorted(hot, features), len(hot) - 1)] == features]
    count = np.bincount((own >> np.uint64(59)).astype(np.int64), minlength=32)
    return np.minimum(count, 255).astype(np.uint8).view(np.int64).tolist()


def _apart(a: str, b: str) -> str:
    """At least so many frequent features differ in two sets: the sum over cells of the differences of their counts."""
    cell = lambda side, w, i: f"(shiftrightunsigned({side}cells{w}, {8 * i}) & 255)"
    return "(" + " + ".join(f"abs({cell(a, w, i)} - {cell(b, w, i)})" for w in range(4) for i in range(8)) + ")"


def _near(a: str, b: str, more: str = "0") -> str:
    """What linked sets fulfil: sizes in proportion, and differences of no more than a seventh of both sizes."""
    sizes = f"{DEN} * least({a}n, {b}n) >= {NUM} * greatest({a}n, {b}n)"
    return f"{sizes} and {DEN + NUM} * ({more} + {_apart(a, b)}) <= {DEN - NUM} * ({a}n + {b}n)"


def _entries(hot: np.ndarray, width: int, facts: dict[int, tuple[int, ...]], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in slices(batches):
        ids = batch.column("doc_id")
        for row, features in shingle_sets(batch):
            if not ids[row].is_valid:
                continue
            keys, flags, (band, own, after, rare) = signatures(features, hot)
            if len(keys):
                sid, keys = set_id(features), packed.key_of(keys, width)
                facts[sid] = (band << 32 | own + (1 << 31), after, rare, len(features), *_cells(features, hot), *_spare(keys, flags, band))
                yield keys, np.full(len(keys), sid, np.int64), flags


def _combine(keys: np.ndarray, owners: np.ndarray, flags: np.ndarray) -> tuple[tuple[np.ndarray, ...], ...]:
    """A chunk's entries once each; of a group many of its sets share, one pivot goes on and the others meet it.

    Returns the entries that go on, the members of such groups, and their pairs with the pivots.
    """
    order = np.lexsort((owners, keys))
    keys, owners, flags = keys[order], owners[order], flags[order]
    once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
    keys, owners, flags = keys[once], owners[once], flags[once]
    start, size = packed.groups(keys)
    big = np.repeat(size > LOCAL_GROUP, size)
    if not big.any():
        return (keys, owners, flags), (keys[:0], owners[:0], flags[:0]), (owners[:0], owners[:0])
    k, o, f = keys[big], owners[big], flags[big]
    at, counts = _star(k, o, f)
    go, marked = ~big, flags.copy()
    chosen = np.flatnonzero(big)[np.unique(at)]
    go[chosen] = True
    marked[chosen] |= BIG
    return (keys[go], owners[go], marked[go]), (k, o, f), (o[counts], o[at[counts]])


def profile(docs: DataFrame, hot_docs: int = HOT_DOCS) -> DataFrame:
    """``doc_id, n, sid`` for each row, and rows ``feature, seen`` for features frequent in a chunk of documents."""
    rows = texts(docs)
    total = max(1, docs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        n_docs = n_features = 0

        def frequent() -> pa.RecordBatch:
            feature, count = np.unique(np.concatenate(held), return_counts=True)
            often = count >= max(3, hot_docs * n_docs / total / 4)
            f, c = feature[often].astype(np.int64), count[often].astype(np.int64)
            none = pa.nulls(len(f), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, pa.array(f), pa.array(c)], names=names)

        names = ["doc_id", "n", "sid", "feature", "seen"]
        for batch in slices(batches):
            n, sid = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for row, features in shingle_sets(batch):
                n[row], sid[row] = len(features), set_id(features)
                if sid[row] not in seen:
                    seen.add(int(sid[row]))
                    held.append(features)
                    n_features += len(features)
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(sid, mask=n == 0), none, none], names=names)
            n_docs += batch.num_rows
            if n_features >= packed.CHUNK:
                yield frequent()
                held, n_docs, n_features = [], 0, 0
                seen.clear()
        if held:
            yield frequent()

    return rows.mapInArrow(run, "doc_id bigint, n bigint, sid bigint, feature bigint, seen bigint")


def candidates(docs: DataFrame, hot: np.ndarray, entries: int) -> DataFrame:
    """``kind, a, b, key``: pairs of set ids with the entries they share (0), members of large groups by key (1), and of
    each set its band and the entries a partner of that band shares at least (``b``) or of the next one (``key``) (2),
    its rare features (``b``) and size (``key``) (3), the cells of its frequent features (4, 5), and the entries it can spare (6)."""
    shared, buckets = docs.sparkSession.sparkContext.broadcast(hot), packed.bucket_count(entries)
    width = packed.key_width(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts: dict[int, tuple[int, ...]] = {}
        for chunk in packed.chunks(_entries(shared.value, width, facts, batches)):
            sids, (packed_band, after, rare, size, *cells) = np.array(list(facts), np.int64), np.array(list(facts.values()), np.int64).T
            facts.clear()
            yield _tagged(_blob(buckets, 2, sids, packed_band, after), 1)
            yield _tagged(_blob(buckets, 3, sids, rare, size), 1)
            yield _tagged(_blob(buckets, 4, sids, cells[0], cells[1]), 1)
            yield _tagged(_blob(buckets, 5, sids, cells[2], cells[3]), 1)
            yield _tagged(_blob(buckets, 6, sids, cells[4], cells[5]), 1)
            go, (key, owner, flag), (a, b) = _combine(*chunk)
            yield _tagged(packed.pack(*go, buckets, width), 0)
            if len(key):
                # Members and their pivots travel as entries of their own, to any bucket.
                yield _tagged(_blob(buckets, 0, *_counted(a, b, np.full(len(a), ENOUGH))), 1)
                yield _tagged(_blob(buckets, 1, owner, flag, key), 1)

    def each(group: pa.Table) -> pa.Table:
        plain = np.asarray(group.column("tag")) == 0
        out = [_bucket_pairs(group.filter(pa.array(plain)), width)] if plain.any() else []
        for tag, kind, blob in zip(*(group.column(c).to_pylist() for c in ("tag", "n", "block"))):
            if tag:
                out.append(_rows(kind, *np.frombuffer(blob, np.int64).reshape(3, -1)))
        return pa.concat_tables(out)

    sent = texts(docs).mapInArrow(run, f"tag int, {packed.SCHEMA}")
    return sent.groupBy("bucket").applyInArrow(each, _FOUND_SCHEMA)


def _tagged(batch: pa.RecordBatch, tag: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, tag, np.int32)), *batch.columns], names=["tag", *batch.schema.names])


def _blob(buckets: int, kind: int, a: np.ndarray, b: np.ndarray, key: np.ndarray, size: int = 50_000) -> pa.RecordBatch:
    blocks = [np.stack([x[i : i + size].astype(np.int64) for x in (a, b, key)]).tobytes() for i in range(0, len(a), size)]
    to = [int(x) for x in mix(np.arange(len(blocks), dtype=np.uint64) + key[:1].sum().astype(np.uint64)) % np.uint64(buckets)]
    columns = [pa.array(to, pa.int32()), pa.array([kind] * len(to), pa.int32()), pa.array([0] * len(to), pa.int32()), pa.array(blocks, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "n", "owners", "block"])


def _facts(found: DataFrame) -> DataFrame:
    """``sid, band, own, after, rare, n, cells0 .. cells3, spare, spare_next`` of each set."""
    of = lambda kind, column: F.max(F.when(F.col("kind") == kind, F.col(column)))
    names = {"packed": (2, "b"), "after": (2, "key"), "rare": (3, "b"), "n": (3, "key"), "cells0": (4, "b"), "cells1": (4, "key"), "cells2": (5, "b"), "cells3": (5, "key"), "spare": (6, "b"), "spare_next": (6, "key")}
    facts = found.where("kind >= 2").groupBy(F.col("a").alias("sid")).agg(*[of(*v).alias(k) for k, v in names.items()])
    band, own = F.shiftright("packed", 32), F.col("packed") % (1 << 32) - (1 << 31)
    return facts.withColumn("band", band).withColumn("own", own).drop("packed")


def _needed(big: DataFrame) -> DataFrame:
    """The members of large groups without the entries a set can do without, those in its largest groups.

    Any two sets that share an entry still share one (see ``_spare``), as all drop the last in one order of the keys;
    entries outside large groups come first in it.
    """
    sized = big.join(big.groupBy("key").agg(F.count("*").alias("members")), "key")
    kind = "(if(full > 0, 1, 0) + if(single > 0, 2, 0))"
    spare = F.expr(f"shiftright(if(own > 0, spare, spare_next), {_SPARE_BITS} * {kind}) & {(1 << _SPARE_BITS) - 1}")
    last = W.partitionBy("sid", "own", "full", "single").orderBy(F.desc("members"), "key")
    return sized.withColumn("place", F.row_number().over(last)).where(F.col("place") > spare).select(*big.columns)


def _promising(found: DataFrame, big: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs that share as many entries as linked sets must: the non-empty parts of either, less the most they differ in.

    Entries in large groups are not counted by pairs, so as many as either set has there, of the band the two meet in, may
    be missing.
    """
    in_band = lambda own: F.count_if((F.col("full") == 0) & ((F.col("own") > 0) == own))
    missing = big.groupBy("sid").agg(in_band(True).alias("missing"), in_band(False).alias("missing_next"))
    facts = facts.drop("spare", "spare_next").join(missing, "sid", "left").fillna(0, ["missing", "missing_next"])
    side = lambda s: facts.select(*[F.col(c).alias(s if c == "sid" else f"{s}_{c}") for c in facts.columns])
    pairs = found.where("kind = 0").groupBy("a", "b").agg(F.sum("key").alias("times")).join(side("a"), "a").join(side("b"), "b")
    of = lambda s, o, own, after: F.when(F.col(f"{s}_band") >= F.col(f"{o}_band"), F.col(f"{s}_{own}")).otherwise(F.col(f"{s}_{after}"))
    a, b = of("a", "b", "own", "after"), of("b", "a", "own", "after")
    least_shared = F.when((a <= 0) & (b <= 0), -F.least(a, b)).otherwise(F.greatest(a, b))
    enough = F.col("times") + F.least(of("a", "b", "missing", "missing_next"), of("b", "a", "missing", "missing_next")) >= least_shared
    return pairs.where(enough).where(_near("a_", "b_")).select("a", "b")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``sid, features`` for the wanted ``sid, rep``: the sets of their texts, as sorted 48-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            want = batch.column("sid").to_pylist()
            found: dict[int, bytes] = {}
            for row, features in shingle_sets(batch):
                if set_id(features) == want[row]:
                    found[want[row]] = packed._planes(np.unique(packed.key_of(features)), 6)
            sids = pa.array(list(found), pa.int64())
            yield pa.RecordBatch.from_arrays([sids, pa.array(list(found.values()), pa.binary())], names=["sid", "features"])

    rows = texts(docs).join(wanted.select(F.col("rep").alias("doc_id"), "sid"), "doc_id")
    return rows.select("sid", "text").mapInArrow(run, "sid bigint, features binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of ``pairs`` whose sets reach the similarity."""

    def values(blob: bytes) -> np.ndarray:
        raw = np.frombuffer(blob, np.uint8).reshape(6, -1).T
        out = np.zeros((len(raw), 8), np.uint8)
        out[:, :6] = raw
        return out.view(np.uint64).ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, x = [], None, None
            for fa, fb in zip(batch.column("fa"), batch.column("fb")):
                fa = fa.as_py()
                if fa is not last and fa != last:
                    last, x = fa, values(fa)
                y = values(fb.as_py())
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(DEN * both >= NUM * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])

    fa, fb = (sets.select(F.col("sid").alias(s), F.col("features").alias(f"f{s}")) for s in "ab")
    return pairs.join(fb, "b").join(fa, "a").select("a", "b", "fa", "fb").mapInArrow(run, "a bigint, b bigint")


def _stars(pairs: DataFrame) -> DataFrame:
    """Of all candidate pairs, those of a set with the smallest of its partners: one a set at most."""
    both = pairs.union(pairs.select("b", "a"))
    return both.groupBy("a").agg(F.min("b").alias("b")).where("b < a").select(F.col("b").alias("a"), F.col("a").alias("b"))


def _apart_still(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components; further links inside one change nothing."""
    placed = pairs
    for side in "ab":
        place = joined.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
        placed = placed.join(place, side, "left").withColumn(f"_{side}", F.coalesce(f"_{side}", side))
    return placed.where("_a <> _b").select("a", "b")


def _grown(joined: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links, which join whole components: one edge for each two of them, and one for each set."""
    part = lambda side: joined.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
    ends = links.join(part("a"), "a", "left").join(part("b"), "b", "left")
    ends = ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).distinct()
    return components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(ends))


def _chosen(pivots: int) -> Column:
    """Whether a group's member is among the first ``pivots`` or so of its light sets, in the order of a hash of the set."""
    if not pivots:
        return F.lit(False)
    rank = F.pmod(F.xxhash64("sid"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.col("light") > 0) & (rank < F.least(F.lit(1.0), F.lit(float(pivots)) / F.col("lights")))


def _unmet(placed: DataFrame, pivots: int) -> DataFrame:
    """The members a group still needs: pivots have met all others, and where all light sets were pivots nothing is left to meet."""
    return placed.where((F.col("lights") > pivots) & ~_chosen(pivots))


_MEMBER = ["sid", "part", "own", "full", "rare", "n", "cells0", "cells1", "cells2", "cells3"]


def _met(members: DataFrame, pivot: DataFrame, pivots: int) -> DataFrame:
    """``a, b``: members and pivots of a group that lie in different components and may be linked (see ``_near``).

    A group's members, and its pivots, are packed into tiles of ``TILE`` or so, a row each, and each tile of members meets
    each of pivots in numpy, where a pair costs a few nanoseconds and most never become rows. A large group's tiles are
    dealt to several tasks.
    """
    tiles = lambda count: F.ceil(count / TILE).cast("int")
    place = lambda salt, n: F.pmod(F.xxhash64("sid", F.lit(salt)), n).cast("int").alias("tile")
    salts = F.least(tiles(F.col("members")), F.lit(TILE_SALTS)).alias("salts")
    rows = members.select("key", salts, F.lit(0).alias("side"), place(1, tiles(F.col("members"))), *_MEMBER)
    rows = rows.union(pivot.select("key", salts, F.lit(1).alias("side"), place(2, tiles(F.least("lights", F.lit(pivots)))), *_MEMBER))
    packed_ = rows.groupBy("key", "side", "tile").applyInArrow(_tile, "key bigint, salts int, side int, tile int, block binary")
    packed_ = materialize(members.sparkSession, packed_, "ngram")
    mine = packed_.where("side = 0").select("key", F.pmod("tile", "salts").alias("salt"), F.col("block").alias("m"))
    theirs = packed_.where("side = 1").select("key", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"), F.col("block").alias("p"))
    return mine.join(theirs, ["key", "salt"]).select("m", "p").mapInArrow(_tiles_met, "a bigint, b bigint").distinct()


def _tile(group: pa.Table) -> pa.Table:
    block = np.stack([group.column(c).to_numpy().astype(np.int64) for c in _MEMBER]).tobytes()
    return group.slice(0, 1).select(["key", "salts", "side", "tile"]).append_column("block", pa.array([block], pa.binary()))


def _tiles_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blocks in zip(batch.column("m"), batch.column("p")):
            a, b = _tile_pairs(*(np.frombuffer(x.as_py(), np.int64).reshape(len(_MEMBER), -1) for x in blocks))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _tile_pairs(members: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m, p = dict(zip(_MEMBER, members)), dict(zip(_MEMBER, pivots))
    cells = [np.ascontiguousarray(x[-4:].T).view(np.uint8).astype(np.int16) for x in (members, pivots)]
    # Sets that share no rare feature differ in all of them; those that do share one meet by it.
    apart = np.where(m["full"][:, None] > 0, m["rare"][:, None] + p["rare"], 0)
    small, large = np.minimum(m["n"][:, None], p["n"]), np.maximum(m["n"][:, None], p["n"])
    room = (DEN - NUM) * (m["n"][:, None] + p["n"]) - (DEN + NUM) * apart
    meet = (m["part"][:, None] != p["part"]) & (m["own"][:, None] + p["own"] > 0) & (DEN * small >= NUM * large) & (room >= 0)
    if meet.any():
        differ = np.zeros(meet.shape, np.int16)
        for c in range(cells[0].shape[1]):
            differ += np.abs(cells[0][:, c, None] - cells[1][:, c])
        meet &= (DEN + NUM) * differ.astype(np.int64) <= room
    a, b = np.nonzero(meet)
    a, b = m["sid"][a], p["sid"][b]
    return np.minimum(a, b), np.maximum(a, b)


def ngram_join(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are lower-cased in A-Z; a document's set holds its distinct shingles of
    five words, or its whole sequence if that is shorter. Documents link at a
    Jaccard similarity of three quarters; ``component_id`` is the smallest id
    reachable. Rows without words or text are empty and stay alone, as do rows
    without an id (their component is null). Repeated rows are equal sets and
    link. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = materialize(spark, profile(docs), "ngram")
    seen = rows.where("feature is not null").groupBy("feature").agg(F.sum("seen").alias("seen"))
    hot = seen.where(F.col("seen") >= HOT_DOCS / 2).orderBy(F.desc("seen"), "feature").limit(HOT_LIST)
    hot = np.sort(np.asarray(hot.select("feature").toArrow()["feature"]).astype(np.int64).view(np.uint64))
    known = rows.where("feature is null")
    alike = known.where("doc_id is not null and sid is not null")
    classes = materialize(spark, alike.groupBy("sid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "ngram")
    entries = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = materialize(spark, candidates(docs, hot, entries), "ngram")

    flag = F.col("b").cast("int")
    big = found.where("kind = 1").select(F.col("a").alias("sid"), "key", flag.bitwiseAND(OWN).alias("own"), flag.bitwiseAND(LIGHT).alias("light"), flag.bitwiseAND(FULL).alias("full"), flag.bitwiseAND(SINGLE).alias("single"))
    big = big.groupBy("sid", "key").agg(*[F.max(c).alias(c) for c in ("own", "light", "full", "single")])
    facts = materialize(spark, _facts(found), "ngram")
    big = materialize(spark, big.join(facts.drop("own", "after", "band"), "sid"), "ngram")
    pairs = materialize(spark, _promising(found, big, facts), "ngram")
    big = materialize(spark, _needed(big).drop("single", "spare", "spare_next"), "ngram")
    ends = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).union(big.select("sid")).distinct()
    sets = materialize(spark, _sets(docs, classes.join(ends, "sid").select("sid", "rep")), "ngram")
    # A family of like sets has very many pairs, and a star of it joins most of it: the others are verified only where
    # their ends are still apart.
    stars = materialize(spark, _stars(pairs), "ngram")
    joined = materialize(spark, components(_verified(stars, sets)), "ngram")
    rest = materialize(spark, _apart_still(pairs.join(stars, ["a", "b"], "left_anti"), joined), "ngram")
    joined = materialize(spark, _grown(joined, _verified(rest, sets)), "ngram")

    # Groups that met one pivot each: light sets still apart from others meet all of them, some in each round.
    counts = big.groupBy("key").agg(F.sum((F.col("light") > 0).cast("int")).alias("lights"), F.max("own").alias("any"), F.count("*").alias("members"))
    big = materialize(spark, big.join(counts.where("lights > 0 and any > 0").drop("any"), "key"), "ngram")
    done, pivots = 0, PIVOTS
    while True:
        placed = big.join(joined, big.sid == joined.node, "left").select(*big.columns, F.coalesce("component", "sid").alias("part"))
        # Members are dealt out by set: a key may have very many, and each meets all pivots of its key.
        placed = materialize(spark, placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "sid"), "ngram")
        open_ = placed.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.max("lights").alias("most"))
        open_ = materialize(spark, open_.where("p <> q").select("key", "most"), "ngram")
        most = open_.agg(F.coalesce(F.max("most"), F.lit(0))).first()[0]
        if not most:
            break
        # Only pivots are looked up among the open groups: the members stay one row each, whatever the rounds.
        pivot = placed.where(_chosen(pivots) & ~_chosen(done)).join(open_.select("key"), "key").select(*placed.columns)
        more = _met(placed, pivot, pivots)
        more = materialize(spark, more.join(pairs, ["a", "b"], "left_anti"), "ngram")
        if more.take(1):
            joined = materialize(spark, _grown(joined, _verified(more, sets)), "ngram")
            pairs = pairs.union(more)
        if pivots >= most:
            break
        big, done, pivots = _unmet(placed, pivots).select(*big.columns), pivots, pivots * 16

    parts = classes.join(joined, classes.sid == joined.node, "left").select("sid", "rep", F.coalesce("component", "sid").alias("part"))
    first = parts.groupBy("part").agg(F.min("rep").alias("component_id"))
    of = materialize(spark, parts.join(first, "part").select("sid", "component_id"), "ngram")
    own = F.when(known.doc_id.isNotNull(), F.coalesce(F.col("component_id"), known.doc_id))
    return known.join(of, "sid", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
