"""EXISTS inside OR: existence join, NULL keys, hot keys, plan."""

import pytest
from pyspark.sql import functions as F

from runtally import registry
from runtally.operators import relational
from runtally.operators.relational import filter_member_or

ROWS = "pit_id string, ordinal long, stage string"


def brute(rows, members):
    return sorted(((k, o, s) for k, o, s in rows if k in members or s == "Adult"), key=str)


def got(df, *extra):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("spread_by", [None, "ordinal"])
@pytest.mark.parametrize("members", [[], ["a"], [None], ["a", "a", None, "zzz"]])
def test_null_tags_and_repeated_members(spark, spread_by, members):
    rows = [(None, 1, "x"), ("a", 2, None), ("a", 2, None), ("b", 3, "Adult"), ("c", 4, None), (None, 5, "Adult")]
    df, m = spark.createDataFrame(rows, ROWS), spark.createDataFrame([(x,) for x in members], "pit_id string")
    assert got(filter_member_or(df, m, "pit_id", F.col("stage") == "Adult", spread_by)) == brute(rows, set(members))


def test_members_from_the_same_table(spark):
    rows = [("a", 1, "Juvenile"), ("a", 2, "x"), ("b", 3, "x"), (None, 4, "x")]
    df = spark.createDataFrame(rows, ROWS)
    out = filter_member_or(df, df.filter("stage = 'Juvenile'"), "pit_id", F.lit(False), "ordinal")
    assert got(out) == [("a", 1, "Juvenile"), ("a", 2, "x")]



def test_hot_fish_is_dealt_over_parts(spark):
    """One fish holds half of the rows: its rows reach the join in SPREAD parts of near equal size."""
    n = 20_000
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 500)).alias("pit_id"),
                               F.col("id").alias("ordinal"), F.when(F.col("id") < 0, "Adult").alias("stage"))
    members = spark.createDataFrame([("hot",), ("f1",), ("f3",)], "pit_id string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = filter_member_or(df, members, "pit_id", F.col("stage") == "Adult", "ordinal")
        assert "ExistenceJoin" in out._jdf.queryExecution().executedPlan().toString()
        parts = [r["count"] for r in out.filter("pit_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(parts) == n // 2 and max(parts) <= 3 * n / 2 / relational.SPREAD
        assert out.count() == n // 2 + n // 250
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("name", ["semi_or_exists", "population_live"])
def test_queries_plan_an_existence_join(spark, sf_dir, name):
    plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ExistenceJoin" in plan and "LeftOuter" not in plan
