"""Landed daily river values for one gauge (SRC3).

Values may land long (date, site_no, parameter_cd, value) or wide
(date, X_00010_00003, X_00060_00003). The gauge and the date range are plain
filters, so they reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtally import config as C
from runtally.operators.relational import pivot_values

WIDE_COLUMNS = {
    f"X_{C.PARAM_TEMPERATURE}_00003": "mean_temp",
    f"X_{C.PARAM_DISCHARGE}_00003": "mean_discharge",
}
HISTORY_START = dt.date(1990, 1, 1)


def read_long(spark: SparkSession, path: str, site: str | None, end: dt.date, start: dt.date = HISTORY_START) -> DataFrame:
    df = spark.read.parquet(path)
    cond = (F.col("date") >= F.lit(start)) & (F.col("date") <= F.lit(end))
    if site is not None:
        cond = cond & (F.col("site_no") == site)
    df = df.filter(cond & F.col("parameter_cd").isin(C.PARAM_TEMPERATURE, C.PARAM_DISCHARGE))
    return pivot_values(df, "date", "parameter_cd", "value",
                        {C.PARAM_TEMPERATURE: "mean_temp", C.PARAM_DISCHARGE: "mean_discharge"})


def from_wide(df: DataFrame) -> DataFrame:
    """Rename the agency's wide columns and make ``date`` a DATE."""
    return df.select(F.to_date("Date").alias("date"),
                     *[F.col(k).cast("double").alias(v) for k, v in WIDE_COLUMNS.items()])


def read_wide(spark: SparkSession, path: str, end: dt.date, start: dt.date = HISTORY_START) -> DataFrame:
    """Landed wide values (``Date`` and the agency's value columns) of a date range."""
    days = F.to_date("Date")
    return from_wide(spark.read.parquet(path).filter((days >= F.lit(start)) & (days <= F.lit(end))))
