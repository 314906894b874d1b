"""Running totals and fill-down for groups of any size: segmented prefix sums.

A window brings a group to one task. Here rows are range-partitioned by group and order
together, so a group that holds any share of the rows is cut into segments of about
equal size. Each segment runs its own window; the segments' sums and last values (one row a
group and segment) get their prefix over the segments before, which is added back. The
segment of a row is written to the shared folder with it, so a lost executor can't
change it between the two uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runtally.operators.running import ordering
from runtally.sources import shared

_SEGMENT = "_segment"


def _segmented(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``df`` with the number of each row's range segment; numbers rise with group and order."""
    ranged = df.repartitionByRange(*partition, *ordering(order)).withColumn(_SEGMENT, F.spark_partition_id())
    folder = f"{shared.scratch_folder(df.sparkSession, 'segments')}/rows"
    ranged.write.parquet(folder)
    return df.sparkSession.read.schema(ranged.schema).parquet(folder)


def _with_segments(rows: DataFrame, segments: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Rows with what is known of their segment, NULL groups matching; one row a group and segment on the right."""
    keys = [*partition, _SEGMENT]
    right = segments.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return rows.join(right, same).drop(*[f"_of_{k}" for k in keys])


def running_total_segmented(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], value: str, out: str, null_policy: str = "skip"
) -> DataFrame:
    """``running.running_total`` for groups without a bound; ``order`` must tell the rows of a group apart."""
    if null_policy not in ("skip", "propagate"):
        raise ValueError(null_policy)
    rows = _segmented(df, partition, order)
    here = Window.partitionBy(*partition, _SEGMENT).orderBy(*ordering(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*partition).orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*partition, _SEGMENT).agg(F.sum(value).alias("_sum"), F.max(F.col(value).isNull()).alias("_hole"))
    sums = sums.select(*partition, _SEGMENT, F.sum("_sum").over(before).alias("_base"),
                       F.coalesce(F.max("_hole").over(before), F.lit(False)).alias("_holed"))
    rows = rows.withColumns({"_here": F.sum(value).over(here), "_hole_here": F.max(F.col(value).isNull()).over(here)})
    # NULL only while no value was seen, as a window over the whole group gives
    total = F.when(F.col("_base").isNull(), F.col("_here")).otherwise(F.col("_base") + F.coalesce("_here", F.lit(0)))
    if null_policy == "propagate":
        total = F.when(~F.col("_holed") & ~F.col("_hole_here"), total)
    return _with_segments(rows, sums, partition).select(*[F.col(f"`{c}`") for c in df.columns if c != out], total.alias(out))


def fill_down_segmented(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], columns: Sequence[str]
) -> DataFrame:
    """``running.fill_down`` for groups without a bound; ``order`` must tell the rows of a group apart."""
    rows = _segmented(df, partition, order)
    here = Window.partitionBy(*partition, _SEGMENT).orderBy(*ordering(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*partition).orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({c: F.last(c, ignorenulls=True).over(here) for c in columns})
    # the filled value of a segment's last row is what it hands on; a segment's rows are told apart by their order
    place = F.struct(*[x for o in order for x in _place(o)])
    ends = rows.groupBy(*partition, _SEGMENT).agg(*[F.max_by(c, place).alias(f"_end_{c}") for c in columns])
    ends = ends.select(*partition, _SEGMENT, *[F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_end_{c}") for c in columns])
    joined = _with_segments(rows, ends, partition)
    return joined.select(*[F.coalesce(c, f"_end_{c}").alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def _place(o: Column | str) -> list[Column]:
    """Sort keys whose rising order is that of ``ordering``: names come NULLs last, columns as they compare."""
    if isinstance(o, str):
        return [F.col(o).isNull(), F.col(o)]
    return [o]
