"""Order-sensitive per-key values and rows, reduced before the shuffle.

Report order matters to the source workflow ("first", "last", "latest row,
ties to the first"). Spark DataFrames are unordered, so every function here
takes an explicit ordinal. The single values are ``min_by``/``max_by``
aggregates with a map-side partial aggregation; the whole row of a key is a
``row_number() = 1``, which Spark limits to one row a key in each input task
(WindowGroupLimit). Either way a key holding a third of the rows is reduced
before the shuffle instead of being funnelled whole into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtally.functions.columns import col


def first_by(x: Column | str, ordinal: Column | str) -> Column:
    """Value on the row with the smallest ordinal (NULL values are kept)."""
    return F.min_by(col(x), col(ordinal))


def first_by_where(x: Column | str, ordinal: Column | str, cond: Column) -> Column:
    """``first_by`` restricted to rows where ``cond`` is true; none -> NULL."""
    return F.min_by(F.when(cond, col(x)), F.when(cond, col(ordinal)))


def last_by_where(x: Column | str, ordinal: Column | str, cond: Column) -> Column:
    """Value on the row with the largest ordinal among rows where ``cond``."""
    return F.max_by(F.when(cond, col(x)), F.when(cond, col(ordinal)))


def _descending(c: Column, dtype: T.DataType) -> Column:
    """A sort order on ``c``, largest first, NULL last (NaN counts as smallest)."""
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return c.desc_nulls_last()
    if isinstance(dtype, T.NumericType):
        return (-c).asc_nulls_last()
    raise TypeError(f"cannot order descending on {dtype.simpleString()}")


def _flat(df: DataFrame, c: Column | str) -> list[Column]:
    """A struct ordinal as its leaf fields (flat keys compare faster)."""
    if isinstance(c, str):
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.StructType):
            out = []
            for f in dtype.fields:
                out += _flat_field(f"{c}.{f.name}", f.dataType)
            return out
        return [F.col(c)]
    return [c]


def _flat_field(path: str, dtype: T.DataType) -> list[Column]:
    if isinstance(dtype, T.StructType):
        out = []
        for f in dtype.fields:
            out += _flat_field(f"{path}.{f.name}", f.dataType)
        return out
    return [F.col(path)]


def top1_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    ordinal: Column | str,
    payload: Sequence[str] | None = None,
    descending: bool = True,
) -> DataFrame:
    """One row per key: the row with the max (or min) ``order_col``; ties go
    to the smallest ordinal; keys whose ``order_col`` is all NULL give no row.

    Runs as a row number over the flat sort key ``(order, ordinal...)``: each
    input task keeps one row a key before the shuffle. The key is evaluated once
    a row: NULL orders sort last and are dropped at the end (a filter below would
    be pushed into the scan and repeat the clock parse).
    """
    keys = list(keys)
    payload = [c for c in (payload or df.columns) if c not in keys]
    dtype = df.schema[order_col].dataType
    o = F.col(order_col)
    best = Window.partitionBy(*keys).orderBy(_descending(o, dtype) if descending else o.asc_nulls_last(), *_flat(df, ordinal))
    return df.withColumn("_place", F.row_number().over(best)).filter((F.col("_place") == 1) & o.isNotNull()).select(*keys, *payload)
