"""Joins, unions, membership tests, statistics and reshapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union ALL by column name; missing columns become NULL when allowed."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out


# A member meets the rows of its key in so many parts, so that no key's rows need one task.
SPREAD = 8


def filter_member_or(df: DataFrame, members: DataFrame, key: str, other: Column, spread_by: str | None = None) -> DataFrame:
    """Rows whose ``key`` is among ``members[key]`` OR for which ``other`` holds: an EXISTS inside a disjunction.

    The subquery becomes an existence join, which never multiplies rows and needs no
    distinct members; NULL keys match NULL members, like the source's ``%in%``. A small
    member side is broadcast by the planner or at run time. Else both sides are shuffled on the key
    and the key's part: ``spread_by`` (a column or struct that differs between the rows of a key)
    deals them over ``SPREAD`` parts and members go to each, as run-time skew handling
    does not split existence joins.
    """
    member = members.select(F.col(key).alias("_member"))
    rows = df.withColumn("_member_key", F.col(key))
    match = F.col("_member").eqNullSafe(F.col("_member_key").outer())
    if spread_by is not None:
        member = member.distinct().select("_member", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_member_part"))
        rows = rows.withColumn("_part", F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int"))
        match = match & (F.col("_member_part") == F.col("_part").outer())
    return rows.filter(member.filter(match).exists() | other).select(*(F.col(f"`{c}`") for c in df.columns))


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table to every row (scalar subqueries).

    A filter on such a column is pushed down like one on a literal.
    """
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def median_min_max(df: DataFrame, group: Sequence[str], value: str, prefix: dict[str, str]) -> list[Column]:
    """Exact median (interpolating), min and max of ``value``; NULLs skipped.

    The exact median keeps every value of a group in one task: use it only
    on groups with a known bound (days of a year, years per calendar day).
    """
    v = F.col(value)
    fns = {"median": F.median(v), "min": F.min(v), "max": F.max(v)}
    return [fns[k].alias(n) for k, n in prefix.items()]


def pivot_values(long: DataFrame, key: str, name_col: str, value_col: str, names: dict[str, str]) -> DataFrame:
    """Long (key, name, value) -> one column per listed name.

    Pivot values are given explicitly, so Spark needs no extra job to find
    them; duplicates per (key, name) resolve to ``max`` (deterministic).
    """
    wide = long.groupBy(key).pivot(name_col, list(names)).agg(F.max(value_col))
    return wide.select(key, *[F.col(f"`{k}`").alias(v) for k, v in names.items()])


def evaluated_once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with a column that is costly to compute, evaluated once a row.

    A filter on a projected column is pushed below the projection with the expression in its
    place, once for each mention; it stays above a generator. ``explode`` of one value keeps every row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
