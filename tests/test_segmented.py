"""Segmented running totals and fill-down against the window forms."""

import pytest
from pyspark.sql import functions as F

from runtally.operators.running import fill_down, running_total
from runtally.operators.segmented import fill_down_segmented, running_total_segmented


@pytest.fixture(scope="module", autouse=True)
def many_segments(spark):
    """Small partitions stay apart, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def df(spark):
    """One group holds half of the rows; NULL keys, orders and values, leading NULLs, an all-NULL group."""
    n = F.col("id")
    base = spark.range(6000).repartition(7).select(
        F.when(n % 2 == 0, "hot").when(n % 97 == 1, None).when(n % 89 == 1, "void").otherwise(F.concat(F.lit("g"), n % 40)).alias("g"),
        F.when(n % 11 == 0, None).otherwise((n * 7919) % 500).alias("t"), n.alias("k"), (n % 13).alias("v0"), F.lit("x").alias("_base"))
    return base.withColumn("v", F.when((F.col("g") != "void") & (F.col("v0") != 5), F.col("v0")))


def rows(d):
    return sorted((tuple(r) for r in d.collect()), key=str)


@pytest.mark.parametrize("policy", ["skip", "propagate"])
@pytest.mark.parametrize("keys", [["g"], []])
def test_running_total(df, policy, keys):
    cols = ["g", "t", "k", "v", "total"]
    want = running_total(df, keys, ["t", "k"], "v", "total", policy).select(*cols)
    plain = df.drop("_base")
    assert rows(running_total_segmented(plain, keys, ["t", "k"], "v", "total", policy).select(*cols)) == rows(want)
    assert running_total_segmented(plain.limit(0), keys, ["t", "k"], "v", "total", policy).count() == 0


def test_fill_down(df):
    want = fill_down(df, ["g"], ["t", "k"], ["v"]).select("g", "t", "k", "v")
    assert rows(fill_down_segmented(df, ["g"], ["t", "k"], ["v"]).select("g", "t", "k", "v")) == rows(want)


def test_a_hot_group_is_cut_into_segments(spark, df):
    from runtally.operators.segmented import _SEGMENT, _segmented

    seg = _segmented(df, ["g"], ["t", "k"]).groupBy(_SEGMENT).count().collect()
    sizes = [r["count"] for r in seg]
    assert len(sizes) >= 6 and max(sizes) < 6000 / 2 / 2
