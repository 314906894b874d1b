"""Exact dedup against immutable snapshots, screened by binary-fuse filters.

1. Every text is reduced to a digest (SHA-256 of the text without white space).
2. Each snapshot is immutable, so its filters are built once: the distinct
   digests are dealt into buckets of about ``BUCKET`` by their leading bits, and
   each bucket gets a static 3-wise binary-fuse filter (Graf and Lemire,
   "Binary Fuse Filters", 2022) with 8-bit fingerprints.
3. Incoming digests are first grouped among themselves (duplicates inside the
   new batch) and the distinct ones screened bucket by bucket. A miss is
   certainly new; only positives join the snapshot's exact buckets.
4. Digests that hold more than one row are checked byte by byte: only texts with such a
   digest are read off the rows, and grouped by the text itself (copies collapse before the
   shuffle). Texts that differ under one digest are told apart by the text.

``write_snapshot`` stores a snapshot once: its filters, and its distinct texts with their
digests as exact buckets. ``dedup_batch`` screens a new batch against any number of stored
snapshots. ``exact_dedup`` does both for one table, part of which plays the snapshot.

A group of copies collapses in each task before any shuffle; the join that gives
every row its group is one that Spark may split where a digest is hot.

Defined cases: a null text is an empty one, and all empty texts are equal; of
equal texts the one with most code points stays, then the smallest doc_id (null
last); any doc_id of a long is fine; rows that repeat the winner's doc_id in its group count
as that document and stay; a digest's text in two snapshots counts in both; an empty table, or an empty snapshot, is fine; only ``doc_id`` and
``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtally.llm.common import SPACES, materialise, ship

BUCKET = 50_000
SEEDS = 64
SENT_DIGESTS = 200_000  # digests that may be sent to every task, under 20 MB


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


# ------------------------------------------------------------ the filter


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over seeded keys."""
    h = keys + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """(segment length, number of start segments) for ``n`` distinct keys."""
    if n <= 1:
        return 4, 1
    length = min(1 << 18, 1 << int(math.floor(math.log(n) / math.log(3.33) + 2.25)))
    slots = int(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n)))
    return length, max(1, -(-slots // length) - 2)


def _slots(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    """The three slots of each hash, in three consecutive segments."""
    first = ((h >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    mask, step = np.uint64(length - 1), np.uint64(length)
    return np.stack([first, (first + step) ^ ((h >> np.uint64(18)) & mask), (first + step + step) ^ (h & mask)])


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(40))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) of distinct uint64 keys."""
    length, segments = _shape(len(keys))
    for seed in range(SEEDS):
        h = _mix(keys, seed)
        at = _slots(h, length, segments)
        size = (segments + 2) * length
        degree = np.bincount(at.ravel(), minlength=size).tolist()
        held = [0] * size  # xor of the keys (by number) in each slot
        rows = at.T.tolist()
        for k, row in enumerate(rows):
            for s in row:
                held[s] ^= k
        queue, order = [s for s in range(size) if degree[s] == 1], []
        while queue:
            s = queue.pop()
            if degree[s] != 1:
                continue
            k = held[s]
            order.append((k, s))
            for x in rows[k]:
                degree[x] -= 1
                held[x] ^= k
                if degree[x] == 1:
                    queue.append(x)
        if len(order) < len(keys):
            segments += 1  # not peelable: another seed, a little more room
            continue
        prints, cells = _prints(h).tolist(), [0] * size
        for k, s in reversed(order):
            a, b, c = rows[k]
            cells[s] = prints[k] ^ cells[a] ^ cells[b] ^ cells[c] ^ cells[s]
        return seed, length, segments, bytes(cells)
    raise ValueError("keys of a binary-fuse filter must be distinct")


def might_contain(keys: np.ndarray, seed: int, length: int, segments: int, cells: bytes) -> np.ndarray:
    h = _mix(keys, seed)
    a, b, c = _slots(h, length, segments)
    f = np.frombuffer(cells, np.uint8)
    return _prints(h) == (f[a] ^ f[b] ^ f[c])


def _keys(digests: pd.Series) -> np.ndarray:
    return np.array([int.from_bytes(d[-8:], "little") for d in digests], np.uint64)


def snapshot_filters(distinct: DataFrame, buckets: int) -> DataFrame:
    """Filters of a snapshot's distinct digests: bucket, seed, length, segments, cells."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(_keys(group["digest"]))
        return pd.DataFrame([(group["bucket"].iat[0], *build_filter(keys))], columns=["bucket", "seed", "length", "segments", "cells"])

    return (distinct.select("digest", bucket_of(F.col("digest"), buckets).alias("bucket")).groupBy("bucket")
            .applyInPandas(build, "bucket int, seed int, length int, segments int, cells binary"))


def bucket_of(digest: Column, buckets: int) -> Column:
    lead = F.conv(F.hex(F.substring(digest, 1, 6)), 16, 10).cast("long")
    return F.coalesce((lead % buckets).cast("int"), F.lit(0))


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The incoming distinct digests that a filter cannot rule out."""

    def probe(group: pd.DataFrame, built: pd.DataFrame) -> pd.DataFrame:
        if group.empty or built.empty:
            return group[["digest"]].iloc[:0]
        f = built.iloc[0]
        return group.loc[might_contain(_keys(group["digest"]), int(f.seed), int(f.length), int(f.segments), f.cells), ["digest"]]

    dealt = incoming.select("digest", bucket_of(F.col("digest"), buckets).alias("bucket"))
    return dealt.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, "digest binary")


# ------------------------------------------------------------ the operator


def _best(rows: Column, doc_id: Column) -> Column:
    """The row that stays has the smallest of these: most code points, then smallest id, null ids last."""
    return F.struct((-rows).alias("minus_length"), F.isnull(doc_id).alias("unknown"), doc_id.alias("doc_id"))


def _counted() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.min(_best(F.col("length"), F.col("doc_id"))).alias("best")]


def _summed() -> list[Column]:
    return [F.sum("n").alias("n"), F.min("best").alias("best")]


def _rows(docs: DataFrame, digest, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(normalised(F.col("text"))).alias("digest"),
                       F.coalesce(F.length("text"), F.lit(0)).alias("length"), *more)


def _texts(docs: DataFrame, digest, of: DataFrame) -> DataFrame:
    """doc_id, length, digest, bytes of the rows whose digest is in ``of`` (distinct digests)."""
    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).alias("length"),
                      normalised(F.col("text")).alias("bytes"))
    # few digests go to the rows, so that texts without one are never shuffled; many meet them by digest
    wanted = F.broadcast(of) if of.count() <= SENT_DIGESTS else of
    return own.withColumn("digest", digest(F.col("bytes"))).join(wanted, "digest", "left_semi")


def exact_dedup(docs: DataFrame, in_snapshot: Column, digest=sha256) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    ``in_snapshot``: which rows are the stored snapshot; the others are the new
    batch. ``digest``: from the normalised text to bytes, at least 8 of them.
    """
    ship(docs.sparkSession)
    rows = materialise(_rows(docs, digest, F.coalesce(in_snapshot, F.lit(False)).alias("stored")))
    grouped = materialise(rows.groupBy("digest", "stored").agg(*_counted()))
    stored, incoming = grouped.filter("stored").drop("stored"), grouped.filter("NOT stored").drop("stored")

    buckets = max(1, math.ceil(stored.count() / BUCKET))
    filters = materialise(snapshot_filters(stored.select("digest"), buckets))
    positive = screen(incoming.select("digest"), filters, buckets)
    met = materialise(incoming.join(positive, "digest").join(
        stored.select("digest", F.col("n").alias("stored_n"), F.col("best").alias("stored_best")), "digest"))

    # one row per digest: met ones with both sides, then what is only stored or only new
    groups = met.select("digest", (F.col("n") + F.col("stored_n")).alias("n"), F.least("best", "stored_best").alias("best"))
    for side in (stored, incoming):
        groups = groups.unionByName(side.join(met.select("digest"), "digest", "left_anti"))

    shared = materialise(groups.filter("n > 1").select("digest"))
    exact = _texts(docs, digest, shared).groupBy("digest", "bytes").agg(*_counted())
    return _resolved(docs, rows, groups, exact, digest)


def write_snapshot(docs: DataFrame, folder: str, digest=sha256) -> None:
    """Stores an immutable snapshot: its exact buckets (bucket, digest, bytes, n, best) and the filter of each."""
    spark = docs.sparkSession
    ship(spark)
    own = _rows(docs, digest, normalised(F.col("text")).alias("bytes"))
    distinct = materialise(own.groupBy("digest", "bytes").agg(*_counted()))
    buckets = max(1, math.ceil(distinct.count() / BUCKET))
    bucket = bucket_of(F.col("digest"), buckets)
    distinct.withColumn("bucket", bucket).repartition("bucket").write.parquet(f"{folder}/texts")
    filters = snapshot_filters(distinct.select("digest").distinct(), buckets)
    filters.withColumn("buckets", F.lit(buckets)).write.parquet(f"{folder}/filters")


def dedup_batch(batch: DataFrame, snapshots: list[str], digest=sha256) -> DataFrame:
    """One row per row of ``batch``: doc_id, keep_id, group_size, kept, digest, with the stored copies counted in.

    ``snapshots``: folders of ``write_snapshot``. Their filters are read, never built again.
    """
    spark = batch.sparkSession
    ship(spark)
    rows = materialise(_rows(batch, digest))
    mine = materialise(rows.groupBy("digest").agg(*_counted()))
    stored = None
    for folder in snapshots:
        filters = spark.read.parquet(f"{folder}/filters")
        first = filters.select("buckets").first()
        positive = screen(mine.select("digest"), filters, first.buckets if first else 1)
        met = spark.read.parquet(f"{folder}/texts").select("digest", "bytes", "n", "best").join(positive, "digest", "left_semi")
        stored = met if stored is None else stored.unionByName(met)
    exact = _texts(batch, digest, materialise(mine.filter("n > 1").select("digest"))).groupBy("digest", "bytes").agg(*_counted())
    if stored is None:
        return _resolved(batch, rows, mine, exact, digest)
    stored = materialise(stored)
    met = stored.groupBy("digest").agg(F.sum("n").alias("stored_n"), F.min("best").alias("stored_best"))
    groups = materialise(mine.join(met, "digest", "left").select(
        "digest", (F.col("n") + F.coalesce("stored_n", F.lit(0))).alias("n"), F.least("best", "stored_best").alias("best"), F.col("stored_n").isNotNull().alias("met")))
    shared = groups.filter("n > 1 OR met").select("digest")
    exact = _texts(batch, digest, shared).groupBy("digest", "bytes").agg(*_counted())
    exact = exact.unionByName(stored).groupBy("digest", "bytes").agg(*_summed())
    return _resolved(batch, rows, groups.drop("met"), exact, digest)


def _resolved(docs: DataFrame, rows: DataFrame, groups: DataFrame, exact: DataFrame, digest) -> DataFrame:
    """The answer by digest, but by text for digests under which ``exact`` (of all shared digests) has several texts."""
    collided = exact.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest")
    collided = materialise(collided)
    out = _answer(rows, groups, ["digest"])
    if collided.isEmpty():
        return out
    own = _texts(docs, digest, collided)
    apart = _answer(own, exact.join(collided, "digest", "left_semi"), ["digest", "bytes"])
    return out.join(collided, "digest", "left_anti").select(apart.columns).unionByName(apart)


def _answer(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    keep = F.col("best.doc_id")
    return rows.join(groups.select(*keys, F.col("n").alias("group_size"), keep.alias("keep_id")), keys).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
