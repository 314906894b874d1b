"""Local sessions for tests and benchmarks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Let HotSpot JIT-compile whole-stage-codegen methods above 8 KB: the
# canonicalisation stage (parse + derive + filter) generates one of ~9 KB,
# which the JVM would otherwise run interpreted. Recommended on clusters too.
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"

# Settings the pipelines rely on; safe to apply to an existing session.
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "runtally") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RUNTALLY_DRIVER_MEMORY", "8g"))
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
        # many distinct plans share stage shapes: keep more compiled classes
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for k, v in SQL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
