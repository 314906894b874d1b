"""Parquet marts: the datasets one job writes and the next reads (SNK1, SRC4).

Writing a mart and reading it back is also how the batch jobs cut lineage:
the data lives in shared storage, so a lost executor costs a re-read, not a
recomputation of everything upstream.

Commit protocol. A mart is a folder of versions and a pointer file. A write
goes to a fresh version; only when all of it is there the pointer is replaced, in
one step. A job that dies at any point leaves the old mart readable. The version
before the current one is kept for readers that opened it, older ones are deleted.

Three layouts:

- plain or partitioned (``write_mart``): one version is the whole dataset;
- by year (``write_years``): each partition value points to the version that wrote
  it last, so a run replaces the years it holds, all at once, and leaves the others;
- by fish (``write_by_key``): bucketed and sorted by a key, so aggregates and joins on
  that key need no exchange. A bucket is read by one task, so the layout is used only
  where no key has more than ``KEY_ROWS`` rows; else the mart is plain and the reader's
  plan shuffles with partial aggregation.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtally.sources import shared

# Mart name -> partition columns (species-partitioned marts let a species
# predicate prune files at the scan).
PARTITIONING: dict[str, tuple[str, ...]] = {
    "individuals": (),
    "daily": ("species",),
    "daily_completed": ("species",),
    "alldaily": ("species",),
    "run_stats": ("species",),
    "sfc_flow": (),
}
POINTER = "_CURRENT"
KEY_ROWS = 5_000_000
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def mart_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _pointer(spark: SparkSession, root: str, name: str) -> dict | None:
    return shared.read_json(spark, f"{mart_path(root, name)}/{POINTER}")


def _commit(spark: SparkSession, root: str, name: str, pointer: dict) -> None:
    """Makes ``pointer`` the current one and deletes the versions that neither it nor its predecessor names."""
    old = _pointer(spark, root, name) or {"versions": [], "kept": []}
    pointer["kept"] = [v for v in old["versions"] if v not in pointer["versions"]]
    shared.replace_json(spark, f"{mart_path(root, name)}/{POINTER}", pointer)
    for v in set(old["versions"] + old["kept"]) - set(pointer["versions"] + pointer["kept"]):
        shared.delete(spark, f"{mart_path(root, name)}/{v}")


def _fresh() -> str:
    return f"version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _written(spark: SparkSession, root: str, name: str, write) -> str:
    """A fresh version, made by ``write(path)``; what a failed write leaves is deleted."""
    version = _fresh()
    path = f"{mart_path(root, name)}/{version}"
    try:
        write(path)
    except BaseException:
        shared.delete(spark, path)
        raise
    return version


def write_mart(df: DataFrame, root: str, name: str, partition_by: Sequence[str] | None = None) -> str:
    """Replaces the named dataset as a whole, like the source workflow's serialise-to-file."""
    spark = df.sparkSession
    parts = tuple(partition_by) if partition_by is not None else PARTITIONING.get(name, ())
    w = df.write.partitionBy(*parts) if parts else df.write
    version = _written(spark, root, name, w.parquet)
    _commit(spark, root, name, {"versions": [version], "schema": df.schema.json()})
    return mart_path(root, name)


def write_years(df: DataFrame, root: str, name: str, by: str) -> str:
    """Replaces the partitions of ``by`` that ``df`` holds; all others stay as they are."""
    spark = df.sparkSession
    version = _written(spark, root, name, df.write.partitionBy(by).parquet)
    years = [f for f in shared.list_folders(spark, f"{mart_path(root, name)}/{version}") if f.startswith(f"{by}=")]
    old = _pointer(spark, root, name) or {}
    held = old.get("partitions", {}) | {y: version for y in years}
    _commit(spark, root, name, {"versions": sorted({version, *held.values()}), "schema": df.schema.json(), "partitions": held})
    return mart_path(root, name)


def write_by_key(df: DataFrame, root: str, name: str, key: str, buckets: int, key_rows: int = KEY_ROWS) -> str:
    """Replaces the named dataset, bucketed and sorted by ``key`` if no key has more than ``key_rows`` rows.

    NULL keys form a key of their own.
    """
    spark = df.sparkSession
    version = _written(spark, root, name, df.write.parquet)
    plain = f"{mart_path(root, name)}/{version}"
    rows = spark.read.schema(df.schema).parquet(plain)
    most = rows.groupBy(key).count().agg(F.max("count").alias("n")).first().n
    if most is not None and most > key_rows:
        _commit(spark, root, name, {"versions": [version], "schema": df.schema.json()})
        return mart_path(root, name)

    def write(path: str) -> None:
        table = f"runtally_{uuid.uuid4().hex}"
        made = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path)
        try:
            made.saveAsTable(table)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {table}")

    bucketed = _written(spark, root, name, write)
    _commit(spark, root, name, {"versions": [bucketed], "schema": df.schema.json(), "key": key, "buckets": buckets})
    shared.delete(spark, plain)
    return mart_path(root, name)


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The committed state of a mart; a DataFrame keeps the version it was made from."""
    at = _pointer(spark, root, name)
    if at is None:
        raise FileNotFoundError(f"no committed mart {mart_path(root, name)}")
    base, schema = mart_path(root, name), T.StructType.fromJson(json.loads(at["schema"]))
    if "partitions" in at:
        paths = [f"{base}/{v}/{part}" for part, v in sorted(at["partitions"].items())]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("version")
    path = f"{base}/{at['versions'][0]}"
    if "key" not in at:
        return spark.read.schema(schema).parquet(path)
    table, key = f"runtally_{at['versions'][0].split('=')[1].replace('-', '_')}", at["key"]
    ddl = spark.createDataFrame([], schema)._jdf.schema().toDDL()
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {int(at['buckets'])} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def partition_values(spark: SparkSession, root: str, name: str) -> list[str]:
    """Values that a mart by year holds, as text; NULL is left out."""
    at = _pointer(spark, root, name) or {}
    return sorted(v for v in (unquote(p.split("=", 1)[1]) for p in at.get("partitions", {})) if v != _NO_VALUE)
