"""Whitening against a dense eigendecomposition, and the solver on hard spectra."""

import numpy as np
import pytest

from runtally.llm import queries, whitening


def brute(rows, wanted=16):
    """(vec_id, deviation, whitened row) per kept row, n, explained; by forming the covariance."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    c = ((n * fit - s) / n).astype(float)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:wanted], u[:, ::-1][:, :wanted]
    dev = [int(sum(k * k for k in r)) for r in (n * x - s)]
    return [i for i, _ in kept], dev, ((n * x - s) / n).astype(float) @ u, e, e / (c * c).sum() * n, n


def check(spark, df, tol=1e-9):
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    ids, dev, proj, e, share, n = brute(rows)
    got = whitening.whiten(df).collect()
    k = len(e)
    assert len(got) == len(ids) * k and {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    sure = e > len(rows[0][1] or [1]) * np.finfo(float).eps * e[0]
    for j in range(k):
        mine = by[j + 1]
        assert sorted((r.vec_id, r.deviation) for r in mine) == sorted(zip(ids, dev))
        if not sure[j]:
            assert all(r.whitened is None for r in mine)
            continue
        want = sorted(zip(ids, proj[:, j] / np.sqrt(e[j])))
        have = sorted((r.vec_id, r.whitened) for r in mine)
        sign = np.sign(sum(a[1] * b[1] for a, b in zip(have, want)))
        assert max(abs(a[1] - sign * b[1]) for a, b in zip(have, want)) < tol
        assert all(abs(r.explained - share[j]) <= 1e-10 * share[j] for r in mine)
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1


def test_query_against_brute_force(spark, sf_dir):
    df = queries.table(spark, sf_dir, "embeddings")
    check(spark, df)
    assert queries.QUERIES["op13_whitening"](spark, sf_dir).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "1 AS n", "2 AS y", "3 AS component", "4 AS label", "5 AS v", "6 AS at")


def test_bad_rows_repeats_and_few_dimensions(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(c) for c in rng.standard_normal(5) * [9, 5, 3, 2, 1]]) for k in range(60)]
    rows += [(k, rows[0][1]) for k in range(100, 160)] + [(3, rows[3][1])]  # a vector in half of the rows, a repeated row
    bad = [(200, None), (201, [1.0, None, 2.0, 3.0, 4.0]), (202, [float("nan")] * 5), (203, [float("inf")] + [0.0] * 4), (204, [])]
    check(spark, frame(spark, rows + bad))
    got = whitening.whiten(frame(spark, rows + bad + [(300, [1.0, 2.0])]))
    assert {r.vec_id for r in got.collect()} == {k for k, _ in rows}


def test_dimensions_without_variance(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [float(a), float(b), 1.5, float(a)]) for k, (a, b) in enumerate(rng.standard_normal((40, 2)) * 4)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert [r.whitened is None for r in sorted(got, key=lambda r: (r.vec_id, r.component))[:4]] == [False, False, True, True]
    one = whitening.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 for r in one)
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_entries_beyond_64_bits_of_products(spark):
    rows = [(1, [1e17, 0.0]), (2, [-1e17, 1.0]), (3, [5e16, 2.0]), (4, [0.0, 3.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 8 and all(r.deviation is None for r in got if r.vec_id < 3)
    assert max(r.identity_error for r in got) < 1e-4


@pytest.mark.parametrize("d,spectrum", [
    (1, lambda d: np.ones(1)), (5, lambda d: np.arange(d, 0, -1.0)), (64, lambda d: np.linspace(1, 1.02, d)),
    (200, lambda d: 0.9 ** np.arange(d)), (250, lambda d: np.sort(np.random.default_rng(2).random(d))[::-1]),
    (40, lambda d: np.repeat(np.arange(10, 0, -1.0), 4)), (20, lambda d: np.where(np.arange(d) < 3, 1.0, 0.0)), (8, lambda d: np.zeros(d)),
])
def test_solver_reaches_double_precision(d, spectrum):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    want = np.sort(spectrum(d))[::-1]
    v = (q * want) @ q.T
    v = (v + v.T) / 2
    e, u = whitening.components(lambda t: v @ t, d)
    top = max(want[0], 1e-300)
    assert np.abs(e - want[:len(e)]).max() <= 1e-13 * top and len(e) == min(16, d)
    assert np.linalg.norm(v @ u - u * e, axis=0).max() <= 1e-13 * top
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13


def test_sums_of_many_tasks_are_reduced_in_spark(spark, monkeypatch):
    df = spark.range(1000).selectExpr("array(id, id * id % 17) AS y").repartition(23)
    monkeypatch.setattr(whitening, "REDUCE", 4)
    got = whitening._total(df, 2, lambda y: y.sum(axis=0))
    assert got.tolist() == [sum(range(1000)), sum(k * k % 17 for k in range(1000))]
