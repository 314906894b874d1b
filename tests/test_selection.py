"""Exact medians by narrowing against the middle of a sorted list."""

import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from runtally.operators import selection
from runtally.operators.selection import exact_median


def brute(rows):
    groups = {}
    for g, v in rows:
        groups.setdefault(g, [])
        if v is not None and v == v:
            groups[g].append(v)
    return {g: statistics.median(vs) if vs else None for g, vs in groups.items()}


def got(df):
    return {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v double").repartition(5).selectExpr("*", "1 AS _v", "2 AS _n")


def test_small_groups_nulls_and_ties(spark):
    rows = [("a", 1.0), ("a", 4.0), ("a", 2.0), ("b", None), ("c", 5.0), (None, 7.0), (None, 9.0), ("d", float("nan")), ("d", 3.0),
            ("e", 1.0), ("e", 1.0), ("e", 1.0), ("e", 9.0), ("f", -0.5), ("f", 1e300), ("h", 2.0), ("h", 2.0), ("h", 8.0), ("h", 8.0)]
    assert got(frame(spark, rows)) == brute(rows)
    assert got(frame(spark, rows).limit(0)) == {}


@pytest.mark.parametrize("grid", [None, 20])
def test_large_groups_of_all_shapes(spark, monkeypatch, grid):
    if grid:  # a coarse, inexact histogram needs more rounds, the result is the same
        monkeypatch.setattr(selection, "STEPS", grid)
        monkeypatch.setattr(selection, "ACCURACY", 40)
    rng = np.random.default_rng(1)
    shapes = {"normal": rng.standard_normal(5001), "even": rng.random(4000), "ties": rng.integers(0, 3, 3000).astype(float),
              "half": np.r_[np.zeros(1500), rng.random(1500)], "spread": 10.0 ** rng.uniform(-300, 300, 3000), "one": np.full(2000, 7.0),
              "two": np.r_[np.full(1000, 1.0), np.full(1000, 2.0)], "skew": rng.lognormal(0, 5, 2501)}
    rows = [(g, float(v)) for g, vs in shapes.items() for v in vs]
    assert got(frame(spark, rows)) == brute(rows)


def test_infinities_and_no_keys(spark):
    rows = [("a", float("-inf"))] * 3 + [("a", 1.0)] * 2
    assert got(frame(spark, rows)) == {"a": float("-inf")}
    df = spark.range(1, 20_001).selectExpr("cast(id % 9973 AS double) AS v")
    assert exact_median(df, [], "v", "m").first().m == statistics.median([k % 9973 for k in range(1, 20_001)])


def test_values_are_never_shuffled(spark, sf_dir, monkeypatch):
    """Each round's jobs aggregate in the tasks that read the values and join a broadcast state."""
    df = spark.range(50_000).select((F.col("id") % 3).cast("string").alias("g"), F.rand(3).alias("v"))
    plans = []
    plain = selection._narrowed

    def seen(values, state, names):
        out = plain(values, state, names)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(selection, "_narrowed", seen)
    assert exact_median(df, ["g"], "v", "m").count() == 3
    assert plans and all("partial_percentile_approx" in p and "partial_count" in p and "Window" not in p for p in plans)
    for p in plans:
        lines = p.splitlines()
        assert p.count("BroadcastHashJoin") >= 2  # values with the state
        for k, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:  # of one row a group and task, or of the state
                assert any("partial_" in x or "selection-" in x for x in lines[k + 1:k + 4]), lines[k:k + 4]
