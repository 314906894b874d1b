"""Ordinal quality and k-d shards against brute force."""

import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from runtally.llm import kd_shards, ordinal_quality, queries


def test_gradient_against_finite_differences():
    rng = np.random.default_rng(3)
    n, k = 40, 7
    at, cols = (x.astype(np.int64) for x in (np.repeat(np.arange(n), 3), rng.integers(0, k, 3 * n)))
    grades = rng.integers(0, ordinal_quality.GRADES, n)
    for _ in range(5):
        par = rng.normal(size=k + 2) * 0.7
        loss, grad = ordinal_quality.loss_and_gradient(par, at, cols, grades)
        for j in range(len(par)):
            step = np.zeros_like(par)
            step[j] = 1e-6
            up, down = (ordinal_quality.loss_and_gradient(par + s * step, at, cols, grades)[0] for s in (1, -1))
            assert abs((up - down) / 2e-6 - grad[j]) < 1e-6


def test_loss_is_that_of_a_plain_loop():
    rng = np.random.default_rng(4)
    rows = [sorted(set(rng.integers(0, 5, 3).tolist())) for _ in range(12)]
    grades, par = rng.integers(0, 3, 12), rng.normal(size=7)
    thresholds = [par[5], par[5] + math.exp(par[6])]
    total = 0.0
    for feats, g in zip(rows, grades):
        score = sum(par[f] for f in feats)
        tails = [1.0, *(1 / (1 + math.exp(-(score - t))) for t in thresholds), 0.0]
        total -= math.log(tails[g] - tails[g + 1])
    at = np.repeat(np.arange(12), [len(r) for r in rows])
    loss, _ = ordinal_quality.loss_and_gradient(par, at, np.concatenate(rows), grades)
    # infinite thresholds are clipped at 30, which is worth some 1e-12
    assert abs(loss - total / 12 - ordinal_quality.RIDGE / 2 * np.sum(par[:5] ** 2)) < 1e-9


def test_scores_against_a_plain_loop(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    model = ordinal_quality.train(docs, queries.table(spark, sf_dir, "labels"))
    want = {}
    for r in docs.collect():
        score = sum(model.weights[f] for f in set(ordinal_quality.features(r.text)))
        clean, good = (1 / (1 + math.exp(-(score - t))) for t in model.thresholds)
        want[r.doc_id] = (clean, good, clean + good, good >= ordinal_quality.KEEP_GOOD and clean >= ordinal_quality.KEEP_CLEAN)
    assert model.thresholds[0] < model.thresholds[1]
    for r in ordinal_quality.score(docs, model).collect():
        assert np.allclose((r.p_clean, r.p_good, r.expected_grade), want[r.doc_id][:3], atol=1e-12) and r.kept == want[r.doc_id][3]


@pytest.mark.parametrize("shards", [2, 5, 8])
def test_tree_against_brute_force_on_the_points(spark, sf_dir, shards):
    """Every cut: the widest dimension of its node, at the weighted median as near as the points allow, and rows go to their side."""
    points = queries.table(spark, sf_dir, "documents").select(*kd_shards._point(kd_shards.dimensions))
    dims = len(kd_shards.dimensions(F.lit("")))
    levels = kd_shards.fit_tree(points, dims, shards)
    rows = points.collect()
    keys, size = np.array([r["keys"] for r in rows]), np.array([r["size"] for r in rows])
    node, left_of = np.zeros(len(rows), int), {0: shards}
    root = keys.max(axis=0) - keys.min(axis=0)
    for depth, level in enumerate(levels, 1):
        assert sorted(n for n, s in left_of.items() if s > 1) == sorted(c[0] for c in level)
        for n, dim, key, part, right in level:
            here = np.flatnonzero(node == n)
            share = (keys[here].max(axis=0) - keys[here].min(axis=0)) / np.maximum(root, 1)
            assert share[dim] == share.max()
            total, budget = size[here].sum(), size[here].sum() * (left_of[n] // 2) / left_of[n]
            # the nearest to the budget that any cut between keys can come
            order = np.argsort(keys[here, dim], kind="stable")
            k, passed = keys[here, dim][order], np.cumsum(size[here][order])
            ends = passed[np.flatnonzero(np.concatenate((k[1:] != k[:-1], [True])))]
            best = np.abs(np.concatenate(([0], ends)) - budget).min()
            goes_left = keys[here, dim] <= key
            if part == kd_shards.UNITS:
                assert abs(size[here][goes_left].sum() - budget) <= best + kd_shards.TOLERANCE * total
                node[here[~goes_left]] = right
            else:  # one point heavier than the tolerance is divided by a hash of the id
                at = keys[here, dim] == key
                unit = spark.createDataFrame([(rows[i].unit,) for i in here], "unit long").select(
                    F.pmod(F.xxhash64("unit", F.lit(depth)), F.lit(kd_shards.UNITS)).alias("u")).collect()
                over = np.array([u.u >= part for u in unit])
                node[here[(keys[here, dim] > key) | (at & over)]] = right
            left_of[right] = left_of[n] - left_of[n] // 2
            left_of[n] = left_of[n] // 2
    assert set(left_of.values()) == {1}
    got = sorted((r.doc_id, r.node) for r in kd_shards.assign(points, levels).select("doc_id", "node").collect())
    assert got == sorted((r.doc_id, int(n)) for r, n in zip(rows, node))
    assert all(abs(size[node == s].sum() - size.sum() / shards) < 0.1 * size.sum() / shards for s in range(shards))


@pytest.mark.parametrize("sent", [200_000, 0])
def test_metadata_dimensions_and_copies_that_differ_in_them(spark, sf_dir, sent, monkeypatch):
    """Keys of source and language by a plain loop: the smallest place of a text's rows; equal texts are one point."""
    monkeypatch.setattr(kd_shards, "SENT", sent)
    monkeypatch.setattr(kd_shards, "HOT", 400)
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    hot = spark.range(10**6, 10**6 + 60).selectExpr("id AS doc_id", "'one text' AS text", "IF(id % 2 = 0, 'en', NULL) AS lang", "concat('s', id % 7) AS source")
    docs = docs.union(hot)
    points, dims, _ = kd_shards._points(docs, kd_shards.dimensions)
    assert dims == 4
    names = [r[0] for r in docs.selectExpr("explode(array(source, lang))").distinct().collect()]
    place = {n: 0 if n is None else (xxhash.xxh64_intdigest(n.encode(), 42) >> 40) for n in names}
    low = {}
    rows = docs.collect()
    for r in rows:
        old = low.get(r.text or "", (1 << 24, 1 << 24))
        low[r.text or ""] = (min(old[0], place[r.source]), min(old[1], place[r.lang]))
    got = {r.doc_id: r["keys"] for r in points.collect()}
    assert len(got) == len(rows)
    tails = 60 - kd_shards.LEAD
    for r in rows:
        assert (got[r.doc_id][0] >> tails, got[r.doc_id][1] >> tails) == low[r.text or ""]
        assert len({k & ((1 << tails) - 1) for k in got[r.doc_id]}) == 1
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text or "", set()).add(tuple(got[r.doc_id]))
    assert all(len(k) == 1 for k in by_text.values())


def test_tree_with_metadata_cuts_along_it(spark, sf_dir):
    """The root is cut along the dimension that is widest on its own scale, and the nodes still come out near equal."""
    docs = queries.table(spark, sf_dir, "documents")
    points, dims, _ = kd_shards._points(docs, kd_shards.dimensions)
    levels = kd_shards.fit_tree(points, dims, 8)
    rows = points.collect()
    keys, largest = np.array([r["keys"] for r in rows]), max(r["size"] for r in rows)
    assert levels[0][0][1] == int(np.argmax(keys.max(axis=0) - keys.min(axis=0))) and levels[0][0][1] in (0, 1)
    sizes = [r["b"] for r in kd_shards.assign(points, levels).groupBy("node").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= largest
    bare = docs.select("doc_id", "text")
    assert kd_shards._points(bare, kd_shards.dimensions)[1] == 2 and kd_shards.kd_shards(bare, shards=8).count() == docs.count()
