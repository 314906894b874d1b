"""Mixing sources to target weights by nested hash thresholds.

Sizes are counts of words. Every source gets a target: sources in code-point
order (null last) weigh ``WEIGHTS`` in turn and share ``SHARE`` times all words;
a target stops at ``REPEATS`` times its source's words, and what is above is
shared again by weight until no target is above its stop.

A source is taken whole as often as its target holds it; the rest of the target
is one more copy of the rows whose hash lies below the source's threshold. The
threshold comes from histograms: words are summed by source and by the leading
``BITS`` of the hash, running sums find the bucket in which the budget ends, and
only that bucket is summed again by the next ``BITS``; what is left of it is
decided hash by hash. Nothing is sorted but the few rows of the last bucket, and
a larger budget always takes a superset of the rows.

One row per source is the only thing that passes one task (the sharing of the
targets). Hash buckets spread a hot source over ``2**BITS`` groups; Spark may
split the joins that bring a source's threshold to its rows.

Defined cases: null texts have no words, take nothing and stay in the table; a
source without words has target 0; rows that repeat a doc_id share its hash and
are taken alike; a null doc_id hashes like the empty string; an empty table
gives an empty result; only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from runtally.llm.common import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BITS = 12
HASH_BITS = 60
SENT_SOURCES = 100_000  # sources whose thresholds may be sent to every task, under 20 MB
PARTS = 32


def words(text: Column) -> Column:
    """Number of runs of anything but space and \\t..\\r."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long")


def row_hash(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id's decimal text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target from (source, source_size): one row per source."""
    by_code_point = [F.col("source").isNull(), F.col("source").cast("binary")]
    place = F.row_number().over(Window.orderBy(*by_code_point)) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    t = sizes.withColumn("weight", weight).withColumn("stop", F.lit(float(REPEATS)) * F.col("source_size"))
    # sources by how soon they stop: the first ones stop, the others share what is left
    by = Window.orderBy(F.col("stop") / F.col("weight"), *by_code_point)
    everything = Window.partitionBy()
    t = t.withColumn("at", F.row_number().over(by))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(SHARE) * F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    t = t.withColumn("level", left / weights)
    open_at = F.min(F.when(F.col("level") <= F.col("stop") / F.col("weight"), F.col("at"))).over(everything)
    t = t.withColumn("open_at", open_at)
    level = F.max(F.when(F.col("at") == F.col("open_at"), F.col("level"))).over(everything)
    return t.withColumn("level", level).select(
        "source", "source_size",
        F.when(F.col("open_at").isNull() | (F.col("at") < F.col("open_at")), F.col("stop"))
        .otherwise(F.col("level") * F.col("weight")).alias("target"))


def _boundary(buckets: DataFrame) -> DataFrame:
    """Per source the bucket in which ``need`` ends, and the words before it.

    ``buckets``: source, need, bucket, words (``2**BITS`` rows a source at most).
    A source whose budget reaches past its last bucket has no row.
    """
    w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    b = buckets.withColumn("passed", F.coalesce(F.sum("words").over(w), F.lit(0)))
    b = b.filter((F.col("passed") <= F.col("need")) & (F.col("passed") + F.col("words") > F.col("need")))
    return b.select("source", F.col("bucket").alias("edge"), (F.col("need") - F.col("passed")).alias("left"))


def _edge(rows: DataFrame, plan: DataFrame, bucket: Column) -> DataFrame:
    sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    needs = plan.select(F.col("source").alias("s"), "need")
    return _boundary(sums.join(needs, sums["source"].eqNullSafe(needs["s"])).drop("s"))


def sized_rows(docs: DataFrame) -> DataFrame:
    return materialise(docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"),
        row_hash(F.col("doc_id")).alias("hash")))


def thresholds(rows: DataFrame) -> DataFrame:
    """s (source), source_size, target, copies, upto: a row is taken ``copies`` times, once more if its hash is at most ``upto``."""
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("copies", F.least(whole, F.lit(REPEATS)))
    plan = materialise(plan.withColumn("need", F.col("target") - F.col("copies") * F.col("source_size")))

    # the threshold of each source, ``low`` the part already decided, ``left`` the words still to take there
    sized = rows.filter("size > 0")
    threshold = plan.select("source", "need", F.lit(0).cast("long").alias("low"))
    for depth in (1, 2):
        shift = HASH_BITS - BITS * depth
        inside = sized
        if depth > 1:
            found = threshold.select(F.col("source").alias("s"), F.shiftright("low", shift + BITS).alias("top"))
            inside = sized.join(found, sized["source"].eqNullSafe(found["s"])
                                & (F.shiftright(sized["hash"], shift + BITS) == found["top"])).drop("s", "top")
        edge = _edge(inside, threshold, F.shiftright("hash", shift))
        threshold = materialise(edge.select("source", F.col("left").alias("need"), F.shiftleft("edge", shift).alias("low")))
    # hash by hash in the last bucket: taken while that brings the sum nearer to the budget
    top = threshold.select(F.col("source").alias("s"), "need", F.shiftright("low", shift).alias("top"))
    last = (sized.join(top, sized["source"].eqNullSafe(top["s"]) & (F.shiftright(sized["hash"], shift) == top["top"]))
            .groupBy("source", "need", "hash").agg(F.sum("size").alias("words")))
    w = Window.partitionBy("source").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("passed", F.coalesce(F.sum("words").over(w), F.lit(0)))
    last = last.groupBy("source").agg(F.max(F.when(2 * F.col("passed") + F.col("words") <= 2 * F.col("need"), F.col("hash"))).alias("upto"))

    cut = threshold.select("source", "low").join(last.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    cut = cut.select(F.col("source").alias("s"), F.coalesce("upto", F.col("low") - 1).alias("upto"))
    full = plan.join(cut, plan["source"].eqNullSafe(cut["s"]), "left").select(
        F.col("source").alias("s"), "source_size", "target", "copies",
        F.coalesce("upto", F.when(F.col("need") > 0, F.lit((1 << HASH_BITS) - 1)).otherwise(F.lit(-1))).alias("upto"))
    return materialise(full)


def _with_plan(rows: DataFrame, of: Column, full: DataFrame, row_hash_: Column) -> DataFrame:
    """Rows with the plan of their source. Few sources go to the rows; many meet them by source, whose rows are
    dealt over ``PARTS`` so that no source's rows need one task."""
    if full.count() <= SENT_SOURCES:
        return rows.join(F.broadcast(full), of.eqNullSafe(full["s"]))
    dealt = full.select("*", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("__part"))
    return rows.join(dealt, of.eqNullSafe(dealt["s"]) & (F.pmod(row_hash_, F.lit(PARTS)).cast("int") == dealt["__part"])).drop("__part")


def mix(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken."""
    rows = sized_rows(docs)
    full = thresholds(rows)
    taken = F.col("size") * (F.col("copies") + (F.col("hash") <= F.col("upto")).cast("long"))
    return _with_plan(rows, rows["source"], full, rows["hash"]).select(
        "doc_id", "source", "size", "source_size", "target", F.least(taken, REPEATS * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns."""
    full = thresholds(sized_rows(docs)).select("s", "copies", "upto")
    whole = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
                        F.col("source").cast("string").alias("of"), row_hash(F.col("doc_id")).alias("hash"))
    times = F.least(F.col("copies") + (F.col("hash") <= F.col("upto")).cast("long"), F.lit(REPEATS)).cast("int")
    taken = _with_plan(whole, whole["of"], full, whole["hash"]).select("row", F.explode(F.array_repeat(F.lit(0), times)))
    return taken.select("row.*")


def mix_sql(table: str = "documents") -> str:
    """The same result as DuckDB SQL: running sums by hash instead of histograms."""
    weight = " ".join(f"WHEN {k} THEN {float(w)}" for k, w in enumerate(WEIGHTS))
    return f"""
WITH r AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {HASH_BITS // 4}))::BIGINT AS hash FROM {table}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % {len(WEIGHTS)} {weight} END::DOUBLE AS weight,
    {float(REPEATS)}::DOUBLE * source_size AS stop FROM s),
o AS (SELECT *, row_number() OVER b AS pos, ({SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(stop) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lvl
    FROM w WINDOW b AS (ORDER BY stop / weight, source IS NULL, encode(source))),
f AS (SELECT *, min(CASE WHEN lvl <= stop / weight THEN pos END) OVER () AS open_at FROM o),
t AS (SELECT source, source_size, CASE WHEN open_at IS NULL OR pos < open_at THEN stop
    ELSE max(CASE WHEN pos = open_at THEN lvl END) OVER () * weight END AS target FROM f),
p AS (SELECT *, least(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END, {REPEATS})::BIGINT AS copies FROM t),
h AS (SELECT source, hash, sum(size) AS words FROM r WHERE size > 0 GROUP BY source, hash),
q AS (SELECT source, hash, words, coalesce(sum(words) OVER (PARTITION BY source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed FROM h),
k AS (SELECT q.source, q.hash, 2 * passed + words <= 2 * (p.target - p.copies * p.source_size) AS more FROM q JOIN p ON q.source IS NOT DISTINCT FROM p.source)
SELECT r.doc_id, r.source, r.size, p.source_size, p.target, least(r.size * (p.copies + coalesce(k.more, false)::BIGINT), {REPEATS} * r.size)::BIGINT AS taken
FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source LEFT JOIN k ON r.source IS NOT DISTINCT FROM k.source AND r.hash = k.hash"""
