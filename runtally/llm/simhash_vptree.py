"""SimHash near-dedup with vantage-point trees.

1. *Fingerprints.* A-Z lowered, words are runs of anything but space and \\t..\\r,
   shingles are ``width`` words joined by a space (a shorter text is one shingle).
   Each shingle is hashed by XXH64; a bit of the fingerprint is set if it is set
   in over half of the hashes, repeats included. No words: fingerprint zero.
2. *Tree.* Distinct fingerprints are cut into shards of about ``LEAF``. Each node
   takes one of its fingerprints as vantage point; the counts of the 65 possible
   distances give the radius whose larger side is smallest. A bounded sample
   shapes the first tree, every fingerprint is placed in it, and leaves that came
   out too large are cut on by their own counts. Triangle
   bound: if |a, b| <= r then their distances to the vantage point differ by at
   most r. So the near side holds distances up to the radius, the far side those
   from radius - r + 1 on; the overlap is stored in both, and every linked pair
   meets in at least one leaf. Branches that no linked pair can join are pruned.
3. *Exact pairs.* Each leaf compares its fingerprints exactly, block by block, and
   returns one link per linked fingerprint (to the smallest of its cluster), never
   all pairs of a cluster.
4. *Components* of the links by repeated contraction to the smallest neighbour.

Identical fingerprints collapse before the tree, so copies cost nothing. Nothing
but counts reaches the driver. Random fingerprints overlap in about a fifth of a
node per level at distance 2, so work grows as about the power 1.5 of the distinct
fingerprints, which is what this index gives.

Defined cases: a null text is an empty one; rows without words share fingerprint
zero and are linked like others; rows that repeat a doc_id are rows like others,
linked by their own texts; a null doc_id never names a component unless nothing
else does (then null); an empty table gives an empty result; only ``doc_id`` and
``text`` are read. ``kept_rows`` leaves exactly one row of each component, also
where doc_ids repeat or are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from runtally.llm.common import materialise, number_rows, ship

LEAF = 8192  # fingerprints of a leaf, about
SENT_IDS = 500_000  # ids that may be sent to every task, under 20 MB
SAMPLE = 1 << 14  # fingerprints that shape the first tree
LEAST_SAMPLE = 64  # of them in a node that is still cut
BLOCK = 1 << 21  # pairs compared at once
SEED = 42
CHUNK = 1 << 16  # hashes counted at once


def fingerprint(text: bytes, width: int) -> int:
    """The SimHash of a UTF-8 text, as a signed 64-bit integer."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    n = len(words)
    if n == 0:
        return 0
    if n <= width:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        h, seed = xxhash.xxh64_intdigest, SEED
        hashes = [h(line[a:b], seed) for a, b in zip(starts[:n - width + 1].tolist(), ends[width - 1:].tolist())]
    h = np.array(hashes, "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), CHUNK):
        bits = np.unpackbits(h[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    out = np.packbits(2 * ones > len(h), bitorder="little").view("<i8")
    return int(out[0])


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, fp (signed 64 bits)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.large_binary())
            fps = [fingerprint(t.as_py() or b"", width) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        task, "doc_id long, fp long")


# ------------------------------------------------------------ the tree


def grow(sample: np.ndarray, total: int, reach: int, leaf: int) -> list[tuple[int, int, int, int]]:
    """A tree for ``total`` fingerprints from a sample: (vantage point, radius, near node, far node), leaves as ~number.

    Node 0 is the root; a branch ends where its share of ``total`` fits a leaf.
    """
    nodes: list = []
    leaves = 0

    def branch(inside: np.ndarray) -> int:
        nonlocal leaves
        cut = None
        if len(inside) * total > leaf * len(sample) and len(inside) >= LEAST_SAMPLE:
            d = np.bitwise_count(inside.view(np.uint64) ^ inside.view(np.uint64)[0]).astype(np.int64)
            near = np.cumsum(np.bincount(d, minlength=65))
            far = len(d) - np.concatenate((np.zeros(reach), near[:65 - reach]))  # distances from radius - reach + 1 on
            worse = np.maximum(near, far)
            cut = int(np.argmin(worse)) if worse.min() < len(d) else None
        if cut is None:
            leaves += 1
            return ~(leaves - 1)
        at = len(nodes)
        nodes.append(None)
        nodes[at] = (int(inside[0]), cut, branch(inside[d <= cut]), branch(inside[d >= cut - reach + 1]))
        return at

    branch(sample)
    return nodes


def place(fps: np.ndarray, nodes: list[tuple[int, int, int, int]], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, place in ``fps``): every leaf that each fingerprint belongs to."""
    if not nodes:
        return np.zeros(len(fps), np.int64), np.arange(len(fps))
    found, todo = [], [(0, np.arange(len(fps)))]
    while todo:
        node, at = todo.pop()
        if node < 0:
            found.append((np.full(len(at), ~node), at))
            continue
        point, radius, near, far = nodes[node]
        d = np.bitwise_count(fps[at].view(np.uint64) ^ np.array(point, np.int64).view(np.uint64))
        todo += [(near, at[d <= radius]), (far, at[d >= radius - reach + 1])]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _planted(fps: DataFrame, reach: int, leaf: int) -> DataFrame:
    """(node, fp) by one tree, grown from at most ``SAMPLE`` fingerprints (those with the smallest hash)."""
    total = fps.count()
    nodes = []
    if total > leaf:
        some = fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
        nodes = grow(np.array([r.fp for r in some], np.int64), total, reach, leaf)
    tree = fps.sparkSession.sparkContext.broadcast(nodes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column("fp").to_numpy()
            node, at = place(own, tree.value, reach)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(own[at])], ["node", "fp"])

    return fps.select("fp").mapInArrow(task, "node long, fp long")


def _leaves(fps: DataFrame, reach: int, leaf: int) -> DataFrame:
    """(node, fp): every pair of fingerprints within ``reach`` bits shares a node.

    Nodes of the first tree that still hold over ``4 * leaf`` fingerprints (large
    tables, or dense ones) are cut on, a level a round, by the same rule. Where no cut
    separates anything, a node's fingerprints are dealt into blocks of about ``leaf``, and
    every pair of blocks is a node of its own: all pairs meet, each in a task of bounded size.
    """
    rows = materialise(_planted(fps, reach, leaf))
    ready = None
    for level in range(1, 64):
        # one row per node; the vantage point is the fingerprint with the smallest hash at this level
        nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min_by("fp", F.xxhash64("fp", F.lit(level))).alias("point"))
        large = materialise(nodes.filter(F.col("n") > 4 * leaf))
        if large.isEmpty():
            break
        known = rows.join(large, "node").withColumn("d", F.bit_count(F.col("fp").bitwiseXOR(F.col("point"))))
        hist = known.groupBy("node", "n", "point", "d").agg(F.count(F.lit(1)).alias("c"))
        by = Window.partitionBy("node").orderBy("d")  # 65 rows a node at most
        hist = (hist.withColumn("near", F.sum("c").over(by.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("far", F.col("n") - F.coalesce(F.sum("c").over(by.rangeBetween(Window.unboundedPreceding, -reach)), F.lit(0))))
        cuts = hist.withColumn("worse", F.greatest("near", "far")).groupBy("node", "n", "point").agg(
            F.min_by("d", F.struct("worse", "d")).alias("radius"), F.min("worse").alias("worse"))
        cuts = materialise(cuts.filter("worse < n").select("node", "point", "radius"))
        done = rows.join(large.select("node"), "node", "left_anti")  # small enough
        whole = large.join(cuts.select("node"), "node", "left_anti")  # no cut helps
        done = done.unionByName(_block_pairs(rows, whole, leaf))
        ready = done if ready is None else ready.unionByName(done)
        if cuts.isEmpty():
            return ready
        d = F.bit_count(F.col("fp").bitwiseXOR(F.col("point")))
        sides = F.array_compact(F.array(
            F.when(d <= F.col("radius"), F.lit(0)), F.when(d >= F.col("radius") - reach + 1, F.lit(1))))
        rows = rows.join(cuts, "node").select(F.explode(sides).alias("side"), "node", "fp")
        rows = materialise(rows.select(F.xxhash64("node", "side", F.lit(level)).alias("node"), "fp"))
    return rows if ready is None else rows.unionByName(ready)


def _block_pairs(rows: DataFrame, whole: DataFrame, leaf: int) -> DataFrame:
    """(node, fp) of the nodes in ``whole`` (node, n): a node for each pair of blocks, a block with itself included."""
    blocks = F.ceil(F.col("n") / leaf).cast("int")
    dealt = rows.join(whole.select("node", blocks.alias("blocks")), "node").withColumn("own", F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks")).cast("int"))
    met = dealt.select("node", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return met.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"), F.lit("pair")).alias("node"), "fp")


def leaf_links(fps: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """(fp, smallest fp of its cluster) for every fingerprint linked inside a leaf."""
    n = len(fps)
    u = fps.view(np.uint64)
    root = np.arange(n)  # flat: always the smallest member's place
    step = max(1, BLOCK // max(1, n))
    for at in range(0, n, step):
        close = np.bitwise_count(u[at:at + step, None] ^ u[None, :]) <= reach
        for k in np.flatnonzero(close.sum(axis=1) > 1):
            roots = np.unique(root[close[k]])
            if len(roots) > 1:
                root[np.isin(root, roots[1:])] = roots[0]
    linked = np.flatnonzero(root != np.arange(n))
    return list(zip(fps[linked].tolist(), fps[root[linked]].tolist()))


def _links(leaves: DataFrame, reach: int) -> DataFrame:
    def task(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(leaf_links(np.sort(group["fp"].to_numpy(np.int64)), reach), columns=["a", "b"], dtype="int64")

    return leaves.groupBy("node").applyInPandas(task, "a long, b long")


# ------------------------------------------------------------ components


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id; root is the smallest id of its component.

    Each round maps every id to its smallest neighbour and contracts the links;
    the minima are combined before the shuffle, so hubs cost no more than others.
    """
    links = materialise(links.filter("a <> b").distinct())
    found = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                            .select("id", F.least("id", "m").alias("to")))
        if found is None:
            found = least.select("id", F.col("to").alias("root"))
        else:
            known = found.join(least.select(F.col("id").alias("root"), "to"), "root", "left")
            found = known.select("id", F.coalesce("to", "root").alias("root"))
        found = materialise(found)
        left = least.select(F.col("id").alias("a"), F.col("to").alias("ta"))
        right = least.select(F.col("id").alias("b"), F.col("to").alias("tb"))
        links = links.join(left, "a").join(right, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        links = materialise(links.filter("a <> b").distinct())
    return found if found is not None else links.select(F.col("a").alias("id"), F.col("b").alias("root"))


# ------------------------------------------------------------ the operator


def simhash_groups(docs: DataFrame, width: int, reach: int, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed 64 bits), component_id."""
    ship(docs.sparkSession)
    rows = materialise(fingerprints(docs, width))
    fps = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = _links(_leaves(fps, reach, leaf), reach)
    roots = components(links)
    named = fps.join(roots.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialise(named)
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(names, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def kept_rows(docs: DataFrame, width: int, reach: int) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the smallest doc_id.

    Where doc_ids repeat or are null they don't name rows: then rows are numbered
    by doc_id (null last), text and the other columns, and these numbers do.
    """
    unclear = docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        groups = simhash_groups(docs, width, reach)
        goes = materialise(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("__goes")))
        # few ids go to the documents; many meet them by id
        goes = F.broadcast(goes) if goes.count() <= SENT_IDS else goes
        return docs.join(goes, docs["doc_id"] == goes["__goes"], "left_anti")
    row = F.struct(*(docs[f"`{c}`"] for c in docs.columns))
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("*", F.isnull("id").alias("unknown"), F.to_json("row").alias("rest"))
    rows = materialise(number_rows(rows, [], ["unknown", "id", "text", "rest"], "place").select("row", "text", "place"))
    groups = simhash_groups(rows.select(F.col("place").alias("doc_id"), "text"), width, reach)
    stays = groups.select(F.col("component_id").alias("stays")).distinct()
    return rows.join(stays, F.col("place") == F.col("stays"), "left_semi").select("row.*")
