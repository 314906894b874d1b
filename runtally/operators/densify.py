"""Calendar densification: every day of a range for every group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def date_grid(keys_with_bounds: DataFrame, keys: Sequence[str], lo: str, hi: str, out: str) -> DataFrame:
    """One row per key and day in ``[lo, hi]``; empty when ``lo > hi``."""
    days = F.when(
        F.col(lo) <= F.col(hi), F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))
    )
    return keys_with_bounds.select(*keys, F.explode(days).alias(out))


def complete_dates_join(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    lo: Column,
    hi: Column,
) -> DataFrame:
    """``complete()`` as a full outer join of a per-group daily grid with the
    data, for groups of any size.

    ``lo``/``hi`` are aggregate expressions evaluated per group (e.g.
    ``F.min("min_dummy")``). Rows outside the grid survive (full, not left,
    join). Keys match NULL-safely so NULL groups are completed too. The grid
    and the data are both shuffled on ``keys + date``.
    """
    keys = list(keys)
    on_cols = keys + [date_col]
    g = {c: f"_grid_{c}" for c in on_cols}
    bounds = df.groupBy(*keys).agg(lo.alias("_lo"), hi.alias("_hi"))
    grid = date_grid(bounds, keys, "_lo", "_hi", date_col).select(*[F.col(c).alias(g[c]) for c in on_cols])
    cond = None
    for c in on_cols:
        eq = F.col(g[c]).eqNullSafe(F.col(c))
        cond = eq if cond is None else cond & eq
    joined = grid.join(df, cond, "full")
    merged = [F.coalesce(F.col(g[c]), F.col(c)).alias(c) for c in on_cols]
    rest = [F.col(c) for c in df.columns if c not in on_cols]
    return joined.select(*merged, *rest)


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns})


def complete_dates(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    lo: Column,
    hi: Column,
) -> DataFrame:
    """``complete()`` for bounded groups (one calendar of days per group):
    same rows as ``complete_dates_join`` without its shuffles.

    Within a partitioning by ``keys`` (a window, so one exchange unless the
    input is already partitioned that way) the group's bounds are window
    aggregates; the group's first row also emits the day grid (``sequence``
    exploded, keys passed through so the partitioning survives); grid days
    that a data row already covers are dropped, which is what the full outer
    join yields (every data row once, in or out of the grid; every uncovered
    grid day once; NULL keys group together). A following window over the
    same keys needs no exchange. Each group's rows meet in one task, so use
    it only where groups are bounded (days of a year).
    """
    keys = list(keys)
    group = Window.partitionBy(*keys)
    rest = [c for c in df.columns if c not in keys]
    d = df.withColumns({
        "_lo": lo.over(group),
        "_hi": hi.over(group),
        "_rn": F.row_number().over(group.orderBy(F.col(date_col).asc_nulls_last())),
    })
    types = {f.name: f.dataType for f in df.schema.fields}

    def row(is_data: bool, day=None) -> Column:
        fields = [
            (day if c == date_col and day is not None else F.col(c) if is_data else F.lit(None).cast(types[c])).alias(c)
            for c in rest
        ]
        return F.struct(*fields, F.lit(is_data).alias("_is_data"))

    days = F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 DAY"))
    grid = F.transform(days, lambda day: row(False, day))
    emit = F.when((F.col("_rn") == 1) & (F.col("_lo") <= F.col("_hi")), F.concat(F.array(row(True)), grid)).otherwise(
        F.array(row(True))
    )
    rows = d.select(*keys, F.explode(emit).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest + ["_is_data"]])
    covered = F.max(F.col("_is_data").cast("int")).over(Window.partitionBy(*keys, date_col))
    out = rows.withColumn("_covered", covered).filter(F.col("_is_data") | (F.col("_covered") == 0))
    return out.select(*keys, *rest)
