"""Helpers shared by the operators: tables, reliable cuts of lineage, numbering."""

from __future__ import annotations

import functools
import operator
import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

# The characters that count as white space in every operator: space and \t..\r.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A row's place inside its task is kept in the low 33 bits of monotonically_increasing_id().
IN_TASK = (1 << 33) - 1


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver found it (for the code of the tasks)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a scratch folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="runtally-shared-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def drop_folder(spark: SparkSession, folder: str, at_end: bool = False) -> None:
    """Deletes a folder of this run, at once or when the session's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if at_end:
        store.mkdirs(path)
        store.deleteOnExit(path)
    else:
        store.delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder: later steps survive a lost executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def number_rows(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Adds ``out``: each row's place, from 0 without gaps, among the rows of its ``keys``.

    Rows are range-partitioned by keys and order together, so one key may hold
    any share of the rows; each task counts its own rows and the places start
    at the sum of the tasks before. No window ever runs over the rows.
    """
    cols = df.columns
    r = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    r = materialise(r.withColumn("__task", F.spark_partition_id()))
    r = r.withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit(IN_TASK)))
    runs = r.groupBy(*keys, "__task").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__from"))
    before = Window.partitionBy(*keys).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__from"))
    of = {k: f"__of{i}" for i, k in enumerate([*keys, "__task"])}
    runs = runs.select(*(F.col(k).alias(c) for k, c in of.items()), "__base")
    on = functools.reduce(operator.and_, (F.col(k).eqNullSafe(F.col(c)) for k, c in of.items()))
    return r.join(runs, on).select(*cols, (F.col("__at") + F.col("__base")).alias(out))
