"""Window operators: group totals, running totals, shares, fill-down.

These run on already-aggregated daily tables (at most species x years x
366 rows, whatever the detection volume), so a window partition is small
by construction. Running totals and fill-down over groups without a bound are in
``segmented``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordering(order: Sequence[Column | str]) -> list[Column]:
    out = []
    for o in order:
        c = F.col(o) if isinstance(o, str) else o
        out.append(c.asc_nulls_last() if isinstance(o, str) else c)
    return out


def running_window(partition: Sequence[str], order: Sequence[Column | str]):
    return (
        Window.partitionBy(*partition)
        .orderBy(*ordering(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def running_total(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], value: str, out: str,
    null_policy: str = "skip",
) -> DataFrame:
    """Cumulative sum of ``value`` in ``order`` within ``partition``.

    ``null_policy="propagate"`` makes every row at or after the first NULL
    NULL (R's ``cumsum``); the default skips NULLs like SQL ``sum``.
    """
    w = running_window(partition, order)
    total = F.sum(value).over(w)
    if null_policy == "propagate":
        seen_null = F.max(F.col(value).isNull().cast("int")).over(w)
        total = F.when(seen_null == 0, total)
    elif null_policy != "skip":
        raise ValueError(null_policy)
    return df.withColumn(out, total)


def group_total(df: DataFrame, partition: Sequence[str], value: str, out: str) -> DataFrame:
    """Group sum on every row (window form, for small groups)."""
    return df.withColumn(out, F.sum(value).over(Window.partitionBy(*partition)))


def share_of_total(df: DataFrame, part: str, total: str, out: str) -> DataFrame:
    """``part / total`` as double."""
    return df.withColumn(out, F.col(part).cast("double") / F.col(total).cast("double"))


def fill_down(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], columns: Sequence[str]
) -> DataFrame:
    """Last observation carried forward; leading NULLs stay NULL."""
    w = running_window(partition, order)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
