"""Folders and small files that driver and executors share, through Hadoop's file systems."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """(file system, path) of ``path`` on whatever store it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; it is deleted when the session's JVM ends.

    Only a local session without that setting gets a machine-local one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="runtally-")
    folder = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, p = _at(spark, folder)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return folder


def named_paths(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(qualified path, is it a folder) of what ``path`` (a file, a folder or a glob) stands for, by name."""
    fs, p = _at(spark, path)
    return sorted((s.getPath().toString(), s.isDirectory()) for s in fs.globStatus(p) or [])


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Qualified paths of the files in a folder, by name; marker files left out."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isFile() and s.getPath().getName()[0] not in "_.")


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A small JSON file; None where there is none."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def replace_json(spark: SparkSession, path: str, value: dict) -> None:
    """Puts ``value`` in the place of a small JSON file in one step: readers see the old one or the new one."""
    jvm = spark._jvm
    fs, p = _at(spark, path)
    _, made = _at(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(made, True)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(made), fs.makeQualified(p), how)
