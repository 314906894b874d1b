"""Embedding whitening: leading components by a block Jacobi-Davidson method.

Entries are put on a grid (``floor(GRID * c)``), so counts and sums are exact, and every
vector is fitted once (the distinct grid vectors, written to the shared folder). Their
covariance V is never formed. What the method needs of it are products with a block of
vectors: each task centres its rows exactly, (n*x - S) / n, multiplies them twice and
returns one d x k matrix; these are added up in the order of the tasks. A product costs one
pass over the fit list, whatever its size, and the driver holds d x (a few dozen) numbers.

Outer loop: Rayleigh-Ritz on a search space that is orthogonal to the locked vectors; the
leading Ritz pairs whose residuals ||V u - e u|| have reached double precision
(``LOCK`` * eps * largest e) are locked from the top; for the next ones the projected correction equation

    (I - P) (V - e I) (I - P) t = -r,    P the projector on locked vectors and u,

is solved roughly by MINRES, all of the block at once, one product a step. The solutions
join the search space, which restarts from its best Ritz vectors when it is full. Pairs are
numbered by falling e only after all are locked.

Defined cases: rows whose vector is null or holds a null, NaN or infinity are dropped; of
vectors of several lengths the commonest length is whitened (of ties the longest), others are
not returned, nor are vectors without entries; entries beyond the long range are clamped by
the cast; fewer than ``components`` dimensions give fewer components; a component without
variance (``e`` not above d * eps * largest e) has null ``whitened``, with no variance at
all also null ``explained``; a ``deviation`` beyond a long is null; repeated rows and repeated
vectors are all returned but fitted once; an empty table gives an empty result; only
``vec_id`` and ``embedding`` are read, other columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtally.llm.common import materialise, ship

GRID = 64
SHIFT = 1_000_000  # what the grid's origin is called
COMPONENTS = 16
GUARD = 4  # vectors of the block beyond those still wanted, against missed neighbours
SPACE = 10  # size of the search space in blocks, before it restarts
MINRES_STEPS = 3
LOCK = 64  # residuals count as zero at so many eps of the largest eigenvalue
OUTER = 200
REDUCE = 256  # results of so many tasks are added in one task before they reach the driver
ROWS = 4096  # rows of one dense block inside a task


def on_grid(vectors: DataFrame) -> DataFrame:
    """vec_id, y: the kept rows, y = floor(GRID * entry) per dimension."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).filter("v IS NOT NULL")
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = v.filter(F.coalesce(sound, F.lit(False))).filter(F.size("v") > 0)
    return v.select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(GRID))).cast("long")).alias("y"))


def _dense(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """Blocks of at most ROWS grid vectors as int64 matrices."""
    for b in batches:
        y = b.column("y")
        for at in range(0, b.num_rows, ROWS):
            part = y.slice(at, ROWS)
            yield part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(part), d)


@dataclass
class FitList:
    """The distinct grid vectors, read again for each pass, and their exact count and sums."""

    rows: DataFrame  # y
    d: int
    n: int
    sums: np.ndarray  # of y: int64, or Python integers where n*y may leave the 64 bits

    def passed(self, fn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over all dense blocks of ``fn(centred block)``."""
        centred = _centring(self.n, self.sums)
        return _total(self.rows, self.d, lambda y: fn(centred(y)))

    def product(self, t: np.ndarray) -> np.ndarray:
        """V t for a block of vectors t (d x k)."""
        return self.passed(lambda x: x.T @ (x @ t)) / self.n


def _centring(n: int, sums: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """(n*y - S) / n: the difference is exact, so only the division rounds."""
    return lambda y: ((n * y.astype(sums.dtype) - sums) / n).astype(np.float64)


def _total(rows: DataFrame, d: int, fn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``fn`` over the dense blocks of all rows, in the order of the tasks."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for y in _dense(batches, d):
            part = fn(y)
            total = part if total is None else total + part
        if total is not None:
            yield packed(TaskContext.get().partitionId(), total)

    def packed(k: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([total.dtype.str]), pa.array([list(total.shape)], pa.list_(pa.int32())),
             pa.array([total.tobytes()], pa.binary())], ["task", "kind", "shape", "sums"])

    def added(rows) -> np.ndarray | None:
        total = None
        for _, kind, shape, raw in sorted(rows, key=lambda r: r[0]):
            part = np.frombuffer(raw, kind).reshape(tuple(shape))
            total = part if total is None else total + part
        return total

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(r["task"], r["kind"], r["shape"], r["sums"]) for b in batches for r in b.to_pylist()]
        groups: dict[int, list] = {}
        for r in got:
            groups.setdefault(r[0] // REDUCE, []).append(r)
        for g, members in groups.items():
            yield packed(g, added(members))

    schema = "task int, kind string, shape array<int>, sums binary"
    parts = rows.select("y").mapInArrow(task, schema)
    tasks = rows.rdd.getNumPartitions()
    while tasks > REDUCE:
        tasks = -(-tasks // REDUCE)
        parts = parts.repartition(tasks, F.floor(F.col("task") / REDUCE)).mapInArrow(reduce, schema)
    return added([tuple(r) for r in parts.collect()])


def fit_list(grid: DataFrame) -> FitList | None:
    """The distinct vectors of the commonest length; None without any."""
    lengths = grid.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return None
    rows = materialise(grid.select("y").filter(F.size("y") == lengths.d).distinct())
    all_of = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max("y")).alias("high"), F.min(F.array_min("y")).alias("low")).first()
    if max(abs(all_of.high), abs(all_of.low)) * all_of.n < 1 << 61:
        sums = _total(rows, lengths.d, lambda y: y.sum(axis=0))
    else:
        exact = rows.select(F.posexplode("y")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(19,0)")).alias("s")).orderBy("pos")
        sums = np.array([int(r.s) for r in exact.collect()], dtype=object)
    return FitList(rows, lengths.d, all_of.n, sums)


def _orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal basis of the columns of t without their parts in the given orthonormal blocks; columns that vanish are left out."""
    t = t / np.maximum(np.linalg.norm(t, axis=0), np.finfo(float).tiny)
    for _ in range(2):  # twice is enough
        for q in against:
            t = t - q @ (q.T @ t)
    kept: list[np.ndarray] = []
    for c in t.T:
        before = np.linalg.norm(c)
        for _ in range(2):
            for q in (*against, *([np.stack(kept, 1)] if kept else [])):
                c = c - q @ (q.T @ c)
        if np.linalg.norm(c) > 1e-8 * max(before, 1e-8):
            kept.append(c / np.linalg.norm(c))
    return np.stack(kept, 1) if kept else np.zeros((t.shape[0], 0))


def _corrections(product, locked: np.ndarray, u: np.ndarray, e: np.ndarray, r: np.ndarray, steps: int) -> np.ndarray:
    """MINRES on the projected correction equations of all columns at once; one product a step.

    Each column is its own Lanczos process with Givens rotations; a column whose recursion has ended stays as it is.
    """
    def project(z: np.ndarray) -> np.ndarray:
        z = z - locked @ (locked.T @ z)
        return z - u * np.sum(u * z, axis=0)

    def apply(z: np.ndarray) -> np.ndarray:
        z = project(z)
        return project(product(z) - z * e)

    b = project(-r)
    k = b.shape[1]
    beta = np.linalg.norm(b, axis=0)
    safe = lambda x: np.where(x > 0, x, 1.0)
    alive = beta > 0
    x, v, v_old = np.zeros_like(b), b / safe(beta), np.zeros_like(b)
    w, w_old = np.zeros_like(b), np.zeros_like(b)
    c, c_old, s, s_old = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    eta, beta_k, start = beta.copy(), np.zeros(k), beta.copy()
    for _ in range(steps):
        av = apply(v)
        alpha = np.sum(v * av, axis=0)
        nxt = project(av - alpha * v - beta_k * v_old)
        beta_next = np.linalg.norm(nxt, axis=0)
        r1 = c * alpha - c_old * s * beta_k
        r2 = s * alpha + c_old * c * beta_k
        r3 = s_old * beta_k
        rho = np.hypot(r1, beta_next)
        alive &= rho > 1e-14 * np.maximum(np.abs(e), 1e-300)
        c_new, s_new = np.where(alive, r1 / safe(rho), 1.0), np.where(alive, beta_next / safe(rho), 0.0)
        w_new = (v - r3 * w_old - r2 * w) / safe(rho)
        x = x + np.where(alive, c_new * eta, 0.0) * w_new
        eta = -s_new * eta
        alive &= (np.abs(eta) > 1e-3 * start) & (beta_next > 1e-14 * np.abs(e))
        if not alive.any():
            break
        v_old, v = v, nxt / safe(beta_next)
        w_old, w, c_old, c, s_old, s, beta_k = w, w_new, c, c_new, s, s_new, beta_next
    return project(x)


def components(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the symmetric operator ``product``."""
    wanted = min(wanted, d)
    block = min(d, wanted + GUARD)
    rng = np.random.default_rng(0)
    locked, found = np.zeros((d, 0)), []
    q = _orthonormal(rng.standard_normal((d, block)))
    aq = product(q)
    for _ in range(OUTER):
        h = q.T @ aq
        e, s = np.linalg.eigh((h + h.T) / 2)
        e, s = e[::-1], s[:, ::-1]
        u, au = q @ s, aq @ s
        u_norm = np.linalg.norm(u, axis=0)
        u, au = u / u_norm, au / u_norm
        r = au - u * e
        r = r - locked @ (locked.T @ r)
        size = max([abs(x) for x in (*found, *e)], default=0.0)
        small = np.linalg.norm(r, axis=0) <= LOCK * np.finfo(float).eps * size
        done = 0
        while done < len(e) and small[done] and len(found) + done < wanted:
            done += 1
        locked = np.concatenate([locked, _orthonormal(u[:, :done], locked)], axis=1)
        found += list(e[:done])
        if len(found) >= wanted:
            order = np.argsort(-np.array(found), kind="stable")
            return np.array(found)[order], locked[:, order]
        u, au, e, r = u[:, done:], au[:, done:], e[done:], r[:, done:]
        block = min(wanted - len(found) + GUARD, d - len(found))
        q, aq = u, au
        if q.shape[1] + block > SPACE * block and q.shape[1] < d - len(found):
            q = _orthonormal(q[:, :2 * block], locked)
            aq = product(q)  # taken anew, so no rounding piles up
        todo = min(block, u.shape[1])
        if q.shape[1] < d - locked.shape[1]:
            t = _corrections(product, locked, u[:, :todo], e[:todo], r[:, :todo], MINRES_STEPS)
            more = _orthonormal(t, locked, q)
            if more.shape[1] == 0:  # corrections inside the space: fresh directions
                more = _orthonormal(rng.standard_normal((d, min(block, d - locked.shape[1] - q.shape[1]))), locked, q)
            q, aq = np.concatenate([q, more], axis=1), np.concatenate([aq, product(more)], axis=1)
        else:  # the space is all that is left: its products once more, exactly
            q = _orthonormal(q, locked)
            aq = product(q)
    raise RuntimeError("the components did not reach double precision")


@dataclass
class Whitening:
    fit: FitList
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # d x k
    explained: np.ndarray
    identity_error: float | None

    @property
    def scaled(self) -> np.ndarray:
        """Directions over sqrt(e); not a number where a component has no variance."""
        known = has_variance(self.values, self.fit.d)
        return np.where(known, self.vectors / np.sqrt(np.where(known, self.values, 1.0)), np.nan)


def has_variance(values: np.ndarray, d: int) -> np.ndarray:
    return values > d * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)


def train(grid: DataFrame, wanted: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``grid`` (see ``on_grid``)."""
    ship(grid.sparkSession)
    fit = fit_list(grid)
    if fit is None:
        return None
    values, vectors = components(fit.product, fit.d, wanted)
    trace = float(fit.passed(lambda x: np.array([np.sum(x * x)]))[0]) / fit.n
    w = Whitening(fit, values, vectors, values / trace if trace > 0 else np.full(len(values), np.nan), None)
    known = has_variance(values, fit.d)
    if known.any():
        to = w.scaled[:, known]
        mean = fit.passed(lambda x: (x @ to).sum(axis=0)) / fit.n

        def squares(x: np.ndarray) -> np.ndarray:
            z = x @ to - mean
            return z.T @ z

        w.identity_error = float(np.abs(fit.passed(squares) / fit.n - np.eye(int(known.sum()))).max())
    return w


def _deviations(y: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums of squares of n*y - S per row; None beyond a long."""
    diff = n * y.astype(sums.dtype) - sums
    top = int(np.abs(diff).max(initial=0))
    if diff.dtype != object and top * top * y.shape[1] < 1 << 63:
        return (diff * diff).sum(axis=1).tolist()
    exact = [sum(c * c for c in row) for row in diff.tolist()]
    return [c if c < 1 << 63 else None for c in exact]


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """One row per kept row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows are only read and multiplied by the d x k directions; nothing is shuffled.
    """
    grid = on_grid(vectors)
    w = train(grid, wanted)
    schema = "vec_id long, n long, deviation long, whitened array<double>"
    grid = grid.select(F.col("vec_id").cast("long").alias("vec_id"), "y")
    if w is None:
        rows = grid.limit(0).select("vec_id", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
                                    F.array().cast("array<double>").alias("whitened"))
        explained, error = [], None
    else:
        d, n, sums, to = w.fit.d, w.fit.n, w.fit.sums, w.scaled
        explained, error = [None if np.isnan(x) else float(x) for x in w.explained], w.identity_error
        centred = _centring(n, sums)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, ROWS):
                    part = b.slice(at, ROWS)
                    y = next(_dense([part], d))
                    z = centred(y) @ to
                    flat = pa.array(z.ravel(), from_pandas=True)  # not a number is null
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), flat)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id"), pa.array(np.full(len(z), n, np.int64)), pa.array(_deviations(y, n, sums), pa.int64()), lists],
                        ["vec_id", "n", "deviation", "whitened"])

        rows = grid.filter(F.size("y") == d).mapInArrow(task, schema)
    share = F.array(*(F.lit(x).cast("double") for x in explained)) if explained else F.array().cast("array<double>")
    rows = rows.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                       F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
