"""Sharding by a k-d tree over metadata dimensions, balanced by bytes.

Each row is a point: its metadata columns (``METADATA``, those that the table has;
a value's place is a hash of it, a null's is 0) and a few numbers in [0, 1) that are functions of
its text (see ``dimensions``; callers may pass others). Rows with equal texts may differ in
their metadata: all of them take the smallest place that any of them has. A tree node that still
holds several shards is split along its widest dimension (as a share of the whole table's range;
of ties, as at the root, the widest on its own scale) at the weighted median: the bytes of
its rows are summed by the leading ``BITS`` of the dimension's key, the bucket in
which the budget ends is found by a running sum, and only that bucket is summed
again by the next ``BITS``, until it holds under ``TOLERANCE`` of the node or is
one point.

The low bits of a key come from a hash of the text. So rows with equal texts are
one point and stay together, unless the point alone is heavier than
``TOLERANCE`` of its node: then its rows are divided by a hash of their id, which
keeps the sizes near equal when a third of all rows are copies of one text.

Per node only sums of at most ``2**BITS`` buckets are shuffled, combined before
the shuffle; the driver sees one row per tree node (their number is the number
of shards, a parameter). Places inside the shards come from counts per task. Texts whose rows
differ in metadata are sent to the rows up to ``SENT`` of them. Beyond that only those with more
than a ``HOT``-th of all rows are sent (fewer than ``HOT``), and rows meet the others by a join on
the text's hash, where no key is hot.

Defined cases: a null text has no bytes (size 1); ties lie in one point; repeated
rows are points like others; a null doc_id is numbered first; an empty table
gives an empty result; a table without one of the ``METADATA`` columns has a dimension less; only
these, ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from runtally.llm.common import materialise, number_rows

BITS = 15
KEY_BITS = 60
LEAD = 24  # key bits that come from the dimension, the others from the text's hash
TOLERANCE = 0.002
UNITS = 1 << 30
METADATA = ("source", "lang")
SENT = 200_000
HOT = 1000


def dimensions(text: Column) -> dict[str, Column]:
    """Length in characters (on a log scale), bytes per character."""
    size, chars = F.octet_length(text), F.length(text)
    return {
        "chars": F.log2(chars + 1.0) / 32,
        "width": F.when(chars > 0, (size / chars - 1) / 4).otherwise(F.lit(0.0)),
    }


@dataclass
class Cut:
    """Where a node is divided; ``budget`` and ``top`` follow the search for the key."""

    node: int
    dim: int
    left: int  # shards on the left
    total: int
    budget: float  # bytes still to go left
    top: int = 0  # leading bits of the key, as far as found
    key: int = -1  # the last key that goes left
    part: int = UNITS  # of the rows at that key, those whose id hash lies below go left


def _tail(text_hash: Column) -> Column:
    """The low bits of all keys of a row."""
    return F.shiftrightunsigned(text_hash, 64 - (KEY_BITS - LEAD))


def _point(make) -> list[Column]:
    """doc_id, size, text_crc32, unit, keys of a row, by its text alone."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tail = _tail(F.xxhash64(text))
    keys = [F.shiftleft(F.floor(F.least(F.greatest(d, F.lit(0.0)), F.lit(1 - 1e-9)) * (1 << LEAD)), KEY_BITS - LEAD).bitwiseOR(tail)
            for d in make(text).values()]
    return [
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(UNITS)).alias("unit"), F.array(*keys).alias("keys")]


def _metadata(docs: DataFrame) -> list[Column]:
    """text_hash, and the places of the metadata values of a row."""
    places = [F.when(docs[f"`{c}`"].isNull(), F.lit(0).cast("long")).otherwise(F.shiftrightunsigned(F.xxhash64(docs[f"`{c}`"].cast("string")), 64 - LEAD))
              for c in METADATA if c in docs.columns]
    return [F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"), F.array(*places).cast("array<bigint>").alias("places")]


@dataclass
class Agreed:
    """Places of the texts whose rows differ in metadata: ``of`` (the text's hash), ``agreed``."""

    sent: DataFrame  # of a checked size
    others: DataFrame | None  # none of them hot

    def keys_of(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the keys of their agreed metadata before the others."""
        rows = rows.join(F.broadcast(self.sent), F.col("text_hash") == F.col("of"), "left").withColumn("agreed_sent", F.col("agreed")).drop("of", "agreed")
        agreed = F.col("agreed_sent")
        if self.others is not None:
            # rows that have their places are dealt by their unit and meet nothing
            rows = rows.withColumn("deal", F.when(F.col("agreed_sent").isNull(), F.lit(-1).cast("long")).otherwise(F.col("unit")))
            others = self.others.withColumn("dealt", F.lit(-1).cast("long"))
            rows = rows.join(others, (F.col("text_hash") == F.col("of")) & (F.col("deal") == F.col("dealt")), "left")
            agreed = F.coalesce(agreed, F.col("agreed"))
        tail = _tail(F.col("text_hash"))
        lead = F.transform(F.coalesce(agreed, F.col("places")), lambda p: F.shiftleft(p, KEY_BITS - LEAD).bitwiseOR(tail))
        rows = rows.withColumn("keys", F.concat(lead, F.col("keys")))
        return rows.drop("text_hash", "places", "agreed_sent", "deal", "of", "dealt", "agreed")


def _agree(facts: DataFrame, dims: int) -> Agreed:
    """``facts``: rows with text_hash and ``dims`` places."""
    low = [F.min(F.col("places")[d]).alias(f"lo{d}") for d in range(dims)]
    high = [F.max(F.col("places")[d]).alias(f"hi{d}") for d in range(dims)]
    differs = F.lit(False)
    for d in range(dims):
        differs = differs | (F.col(f"lo{d}") < F.col(f"hi{d}"))
    texts = facts.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n"), *low, *high).filter(differs)
    texts = materialise(texts.select(F.col("text_hash").alias("of"), "n", F.array(*(f"lo{d}" for d in range(dims))).cast("array<bigint>").alias("agreed")))
    if texts.count() <= SENT:
        return Agreed(texts.drop("n"), None)
    hot = F.col("n") > facts.count() / HOT
    return Agreed(texts.filter(hot).drop("n"), texts.filter(~hot).drop("n"))


def _points(docs: DataFrame, make) -> tuple[DataFrame, int, Agreed]:
    """The rows as points, the number of their dimensions, and how copies agree."""
    facts = materialise(docs.select(*_point(make), *_metadata(docs)))
    dims = sum(c in docs.columns for c in METADATA)
    agreed = _agree(facts, dims)
    return materialise(agreed.keys_of(facts)), dims + len(make(F.lit(""))), agreed


def _cuts(rows: DataFrame, nodes: dict[int, int], dims: int, ranges: list[int]) -> list[Cut]:
    """Where the nodes that hold several shards are cut; ``nodes``: shards of each.

    ``ranges``: how far each dimension reaches in the whole table; filled at the root.
    """
    spark = rows.sparkSession
    stats = rows.filter(F.col("node").isin([n for n, s in nodes.items() if s > 1])).groupBy("node").agg(
        F.sum("size").alias("bytes"), *(F.min(F.col("keys")[d]).alias(f"lo{d}") for d in range(dims)),
        *(F.max(F.col("keys")[d]).alias(f"hi{d}") for d in range(dims))).collect()
    cuts = []
    for r in stats:
        reach = [r[f"hi{d}"] - r[f"lo{d}"] for d in range(dims)]
        ranges[:] = ranges or [max(1, x) for x in reach]
        wide = max(range(dims), key=lambda d: (reach[d] / ranges[d], reach[d], -d))
        shards = nodes[r["node"]]
        cuts.append(Cut(r["node"], wide, shards // 2, r["bytes"], r["bytes"] * (shards // 2) / shards))
    # refine the bucket in which each node's budget ends
    done: list[Cut] = []
    for depth in range(1, KEY_BITS // BITS + 1):
        if not cuts:
            break
        shift = KEY_BITS - BITS * depth
        at = _rows(spark, [(c.node, c.dim, c.budget, c.top) for c in cuts], "node int, dim int, budget double, top long")
        key = F.element_at("keys", F.col("dim") + 1)
        inside = rows.join(F.broadcast(at), "node")  # one row per tree node
        if depth > 1:
            inside = inside.filter(F.shiftright(key, shift + BITS) == F.col("top"))
        sums = inside.groupBy("node", "budget", F.shiftright(key, shift).alias("bucket")).agg(F.sum("size").alias("bytes"))
        w = Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("passed", F.coalesce(F.sum("bytes").over(w), F.lit(0)))
        edge = sums.filter((F.col("passed") <= F.col("budget")) & (F.col("passed") + F.col("bytes") > F.col("budget")))
        found = {e["node"]: e for e in edge.collect()}
        for c in cuts:
            e = found[c.node]
            c.budget, c.top, inner = c.budget - e["passed"], e["bucket"], e["bytes"]
            if inner <= TOLERANCE * c.total or shift == 0:
                # the bucket goes to the nearer side as a whole, or, if a single point is heavier, in parts
                c.key = (c.top + 1 << shift) - 1
                if inner > TOLERANCE * c.total:
                    c.part = int(UNITS * c.budget / inner)
                elif 2 * c.budget < inner:
                    c.key = (c.top << shift) - 1
                done.append(c)
        cuts = [c for c in cuts if c not in done]
    return done


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows from the driver, as a local relation."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [c.split()[1].replace("long", "bigint") for c in schema.split(", ")]
    values = ", ".join("(" + ", ".join(f"CAST({v!r} AS {k})" for v, k in zip(r, kinds)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def fit_tree(points: DataFrame, dims: int, shards: int) -> list[list[tuple]]:
    """The tree, level by level: (node, dim, key, part, node on the right) of each cut.

    A node bears the number of its first shard.
    """
    rows = points.withColumn("node", F.lit(0))
    nodes, ranges, levels = {0: shards}, [], []
    while any(n > 1 for n in nodes.values()):
        cuts = _cuts(rows, nodes, dims, ranges)
        if not cuts:  # no rows
            break
        levels.append([(c.node, c.dim, c.key, c.part, c.node + c.left) for c in cuts])
        rows = _descend(rows, levels[-1], len(levels))
        for c in cuts:
            nodes[c.node + c.left], nodes[c.node] = nodes[c.node] - c.left, c.left
    return levels


def _descend(rows: DataFrame, level: list[tuple], depth: int) -> DataFrame:
    at = _rows(rows.sparkSession, [(n, *rest) for n, *rest in level], "of int, dim int, cut long, part long, right int")
    key = F.element_at("keys", F.col("dim") + 1)
    unit = F.pmod(F.xxhash64("unit", F.lit(depth)), F.lit(UNITS))  # another hash a level: the parts of a point stay uniform
    goes_right = (key > F.col("cut")) | ((key == F.col("cut")) & (unit >= F.col("part")))
    return rows.join(F.broadcast(at), F.col("node") == F.col("of"), "left").select(  # one row per tree node
        *(c for c in rows.columns if c != "node"), F.when(goes_right, F.col("right")).otherwise(F.col("node")).alias("node"))


def assign(points: DataFrame, levels: list[list[tuple]]) -> DataFrame:
    """``points`` with their ``node``, the number of the shard."""
    rows = points.withColumn("node", F.lit(0))
    for depth, level in enumerate(levels, 1):
        rows = _descend(rows, level, depth)
    return rows


def _shards_for(points: DataFrame, target_bytes: int) -> int:
    return max(1, math.ceil((points.agg(F.sum("size")).first()[0] or 0) / target_bytes))


def kd_shards(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None, make=dimensions) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    The tree is split until its leaves reach ``target_bytes`` (or there are ``shards`` leaves).
    """
    points, dims, _ = _points(docs, make)
    levels = fit_tree(points, dims, shards or _shards_for(points, target_bytes))
    placed = assign(points, levels).select("doc_id", "size", "text_crc32", "unit", F.col("node").alias("shard"))
    return number_rows(placed, ["shard"], ["doc_id", "unit"], "slot").drop("unit")


def sharded_rows(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None, make=dimensions) -> DataFrame:
    """The rows of ``docs`` with all their columns and, last, their ``shard``; an old column of that name makes way."""
    points, dims, agreed = _points(docs, make)
    levels = fit_tree(points, dims, shards or _shards_for(points, target_bytes))
    whole = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), *_point(make), *_metadata(docs))
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() != "shard"]
    return assign(agreed.keys_of(whole), levels).select(*kept, F.col("node").alias("shard"))
