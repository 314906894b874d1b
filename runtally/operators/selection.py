"""Exact order statistics of groups of any size, without bringing a group together.

``median`` and ``percentile`` keep every value of a group in one task. Here the value of a
wanted rank is found by narrowing. Each round reads two values around the rank off a
mergeable quantile histogram of the values still in question, counts exactly what lies below, at,
between and above them, and either has met the rank or goes on strictly between them (or on
the side where the rank lies, if the histogram was off). Both steps are partial aggregates,
so a group that holds a third of all rows costs each task its own share. Every round takes
at least the two values away, and leaves about 1/500 of a group: five rounds do for 10^12 values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtally.sources import shared

STEPS = 1000  # of the histogram's shares
ACCURACY = 10_000  # of its ranks: 1/10000 of the values


def exact_median(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """One row per group: its keys and the exact, interpolating median of ``value``.

    NULL and NaN values are skipped; a group without any gets NULL; NULL keys form groups of
    their own. The state between rounds, one row a group, is written to the shared folder:
    its size is known, so the planner broadcasts it where it is small, and run-time
    skew handling splits the join where it is not.
    """
    spark = df.sparkSession
    folder, round_ = shared.scratch_folder(spark, "selection"), 0

    def kept(state: DataFrame) -> DataFrame:
        nonlocal round_
        round_ += 1
        state.write.parquet(f"{folder}/{round_}")
        return spark.read.schema(state.schema).parquet(f"{folder}/{round_}")

    names = [f"_key{k}" for k in range(len(group))]
    rows = df.select(*[F.col(g).alias(k) for g, k in zip(group, names)], F.col(value).cast("double").alias("_v"))
    sound = F.col("_v").isNotNull() & ~F.isnan("_v")
    values = rows.filter(sound)
    counts = rows.groupBy(*names).agg(F.count_if(sound).alias("_all"))
    none = F.lit(None).cast("double")
    state = kept(counts.select(*names, "_all", F.col("_all").alias("_n"), F.floor((F.col("_all") - 1) / 2).alias("_rank"),
                               none.alias("_lo"), none.alias("_hi"), none.alias("_found")))
    while not state.filter(_open()).isEmpty():
        state = kept(_narrowed(values, state, names))
    # of an even count, the next value up is the other middle one
    v, found = F.col("_v"), F.col("_found")
    upper = _with_state(values, state, names, F.lit(True)).groupBy(*names).agg(
        F.count_if(v <= found).alias("_upto"), F.min(F.when(v > found, v)).alias("_next"))
    s = _with_state(state, upper, names, F.lit(True), "left")
    second = F.when(F.col("_upto") > F.floor(F.col("_all") / 2), found).otherwise(F.col("_next"))
    return s.select(*[F.col(k).alias(g) for g, k in zip(group, names)], (0.5 * found + 0.5 * second).alias(out))


def _open() -> Column:
    """Groups whose rank is not met yet."""
    return (F.col("_all") > 0) & F.col("_found").isNull()


def _with_state(left: DataFrame, right: DataFrame, names: list[str], cond: Column, how: str = "inner") -> DataFrame:
    """Join on the group keys, NULL keys matching."""
    right = right.withColumnsRenamed({k: f"{k}_r" for k in names})
    for k in names:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{k}_r"))
    return left.join(right, cond, how).drop(*[f"{k}_r" for k in names])


def _in_question(values: DataFrame, state: DataFrame, names: list[str]) -> DataFrame:
    """Values strictly between the bounds of their group (NULL: no bound), with the group's state."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    return _with_state(values, state.filter(_open()), names, (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi)))


def _narrowed(values: DataFrame, state: DataFrame, names: list[str]) -> DataFrame:
    """One round for all groups that are open."""
    v, p, q, n, rank = (F.col(c) for c in ("_v", "_p", "_q", "_n", "_rank"))
    shares = [k / STEPS for k in range(STEPS + 1)]
    histogram = _in_question(values, state, names).groupBy(*names).agg(F.percentile_approx("_v", shares, ACCURACY).alias("_grid"))

    def at(step: Column) -> Column:
        return F.get("_grid", F.greatest(F.lit(0), F.least(F.lit(STEPS), step)).cast("int"))

    share = rank / F.greatest(n, F.lit(1)) * STEPS
    bounds = _with_state(state, histogram, names, F.lit(True), "left").withColumns(
        {"_p": at(F.floor(share) - 1), "_q": at(F.ceil(share) + 1)}).drop("_grid")
    counts = _in_question(values, bounds, names).groupBy(*names).agg(
        F.count_if(v < p).alias("_below"), F.count_if(v == p).alias("_at_p"),
        F.count_if((v > p) & (v < q)).alias("_mid"), F.count_if((v == q) & (q > p)).alias("_at_q"))
    s = _with_state(bounds, counts, names, F.lit(True), "left")
    # ranks at which p, the values between, q, and the values above q begin
    at_p = F.col("_below")
    mid = at_p + F.col("_at_p")
    at_q = mid + F.col("_mid")
    above = at_q + F.col("_at_q")

    def by_place(below: Column, between: Column, beyond: Column, old: Column) -> Column:
        return F.when(~_open(), old).when(rank < at_p, below).when(rank < mid, old).when(rank < at_q, between).when(
            rank < above, old).otherwise(beyond)

    lo, hi = F.col("_lo"), F.col("_hi")
    met = F.when((rank >= at_p) & (rank < mid), p).when((rank >= at_q) & (rank < above), q)
    return s.select(*names, "_all", by_place(at_p, F.col("_mid"), n - above, n).alias("_n"), by_place(rank, rank - mid, rank - above, rank).alias("_rank"),
                    by_place(lo, p, q, lo).alias("_lo"), by_place(p, q, hi, hi).alias("_hi"), F.coalesce("_found", met).alias("_found"))
