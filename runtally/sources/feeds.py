"""Landed report files (delimited text) -> raw feed DataFrames.

Each feed has an explicit schema (no inference) and a header -> raw-name
map. Raw names are shared by all feeds so one canonicalisation serves them
all. Report row order matters to "first"/"last" semantics, so every row gets
an ``ordinal``: (rank of the path in the caller's list, file, byte offset of the
split, position within the split). Files stay splittable; the ordinal
orders rows across splits of the same file. All files of a report are one scan:
the rank of a row's file is read off its path.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtally.sources.shared import list_files, list_folders, named_paths


# Raw column names used by the canonicalisation step.
RAW_COLUMNS = (
    "tag", "species_name", "rear_type", "run_name", "site", "release_site",
    "obs_time", "release_date", "mark_life_stage", "mark_length",
)

# Report headers of each feed -> raw names, in file column order.
LIVE_DETECTIONS = {
    "Tag": "tag",
    "Species Name": "species_name",
    "Rear Type Code": "rear_type",
    "Site": "site",
    "Release Site": "release_site",
    "Obs Time": "obs_time",
    "Release Date": "release_date",
    "Mark Life Stage": "mark_life_stage",
    "Mark Length": "mark_length",
}
LIVE_DOWNSTREAM = {
    "Tag": "tag",
    "Site": "site",
    "Release Site": "release_site",
    "Obs Time": "obs_time",
}
COMPLETED_DETECTIONS = {
    "Tag Code": "tag",
    "Species Name": "species_name",
    "Rear Type Code": "rear_type",
    "Run Name": "run_name",
    "Site Name": "site",
    "Release Site Name": "release_site",
    "Obs Time Value": "obs_time",
    "Release Date MMDDYYYY": "release_date",
    "Mark Life Stage Value": "mark_life_stage",
    "Mark Length mm": "mark_length",
}
COMPLETED_DOWNSTREAM = {
    "Tag Code": "tag",
    "Site Name": "site",
    "Obs Time Value": "obs_time",
}
FEEDS = {
    "live_detections": LIVE_DETECTIONS,
    "live_downstream": LIVE_DOWNSTREAM,
    "completed_detections": COMPLETED_DETECTIONS,
    "completed_downstream": COMPLETED_DOWNSTREAM,
}
_NUMERIC = {"mark_length"}
# Rows that one task sorts and writes when a report is landed (about 180 MB of sort memory).
PART_ROWS = 1_000_000


def feed_schema(headers: dict[str, str]) -> T.StructType:
    return T.StructType([
        T.StructField(h, T.DoubleType() if raw in _NUMERIC else T.StringType(), True)
        for h, raw in headers.items()
    ])


def read_report(
    spark: SparkSession,
    paths: Sequence[str] | str,
    feed: str,
    encoding: str | None = None,
    line_sep: str | None = None,
) -> DataFrame:
    """Read one report feed from one or more landed files (union ALL in the
    given path order, one scan). UTF-16LE reports need ``encoding="UTF-16LE"`` and
    ``line_sep="\\r\\n"``; a byte-order mark, if present, is dropped. Columns a
    feed lacks are NULL, so every feed can go to every job."""
    headers = FEEDS[feed]
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(feed_schema(headers)).option("header", True).option("mode", "PERMISSIVE")
    if encoding:
        reader = reader.option("encoding", encoding)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    ordinal = F.struct(
        _file_rank(spark, paths).alias("file_rank"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = reader.csv(paths)
    return standardise(rows.select(*[F.col(f"`{h}`").alias(r) for h, r in headers.items()], ordinal.alias("ordinal")))


def _one_slash(uri: str) -> str:
    return re.sub(r"^(\w+):/+", r"\1:/", uri)


def _file_rank(spark: SparkSession, paths: Sequence[str]) -> Column:
    """Place of the row's file in ``paths`` (files, folders or globs); a file that several stand for has the first place."""
    if len(paths) == 1:
        return F.lit(0)
    here, rank = F.regexp_replace(F.col("_metadata.file_path"), r"^(\w+):/+", "$1:/"), F.lit(None).cast("int")
    for place in range(len(paths) - 1, -1, -1):
        for path, is_folder in named_paths(spark, paths[place]):
            uri = _one_slash(spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toASCIIString())
            rank = F.when(here.startswith(uri + "/") if is_folder else here == uri, place).otherwise(rank)
    return rank


def standardise(raw: DataFrame) -> DataFrame:
    """Add any raw column a feed lacks as NULL string, in the shared order."""
    have = set(raw.columns)
    cols = [F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS]
    if "mark_length" not in have:
        cols[RAW_COLUMNS.index("mark_length")] = F.lit(None).cast("double").alias("mark_length")
    return raw.select(*cols, "ordinal")


def land_report(
    raw: DataFrame, folder: str, feed: str, files: int, encoding: str = "UTF-8", line_sep: str = "\n",
    part_rows: int | None = None,
) -> list[str]:
    """Writes a raw feed as a landed report of at most ``files`` files, in report order; returns their paths in that order.

    A file of more than about ``part_rows`` (else ``PART_ROWS``) rows is landed as a folder of parts of that size, in order by name,
    so no task sorts or writes more; ``read_report`` gives the rows of a folder the rank of its path.
    """
    headers = FEEDS[feed]
    parts = -(-raw.count() // (files * (part_rows or PART_ROWS)))
    if parts <= 1:
        rows = raw.repartitionByRange(files, "ordinal").sortWithinPartitions("ordinal")
    else:
        # range n of the report is part n % parts of file n // parts; zeros keep the folders in order by name
        place = F.lpad(F.floor(F.spark_partition_id() / parts).cast("string"), 5, "0")
        rows = raw.repartitionByRange(files * parts, "ordinal").withColumn("file", place).sortWithinPartitions("file", "ordinal")
    rows = rows.select(*[F.col(r).alias(h) for h, r in headers.items()], *(["file"] if parts > 1 else []))
    out = rows.write.partitionBy("file") if parts > 1 else rows.write
    out.option("header", True).option("encoding", encoding).option("lineSep", line_sep).csv(folder)
    if parts <= 1:
        return list_files(raw.sparkSession, folder)
    return [f"{folder}/{name}" for name in list_folders(raw.sparkSession, folder) if name.startswith("file=")]
