"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are 0 (toxic), 1 (poor) and 2 (good). One vector of weights over hashed
text features is shared by all grades and ordered thresholds cut its score:
P(grade >= k) = sigmoid(score - threshold_k). That gives every document its tail
probabilities and its expected grade; documents are kept by the tail probability
of the top grade and by that of not being toxic.

Features of a whole text, as sets (a feature is there or not): its lower-cased
words, their first ``PREFIX`` characters, and which of ``STEPS_OF_SHARE`` are
reached by the shares of words in upper case, with doubled marks, without letters,
with digits, with other characters, equal to the word before, or seen before. All
are hashed to ``2**HASH_BITS`` columns.

The model is fitted on at most ``FIT_ROWS`` labelled documents, those with the
smallest hash of doc_id (a documented bound; the limit is a parameter). Columns
are first screened on them: a column stays if it is in ``MIN_DOCS`` of them and
its documents' grades differ from the rest by ``MIN_Z`` standard errors. Scoring
reads every document once and shuffles nothing; the model it sends along has a
fixed size.

Defined cases: a null or empty text has no word features and is scored by the
thresholds alone; labels without a document, or with a null in quality or toxic,
are not used for fitting; a document labelled with two grades is fitted with each,
equal labels count once; of a repeated doc_id the smallest text is fitted; without
labels of two grades at least nothing is learned and everything is kept; repeated
rows get equal scores; an empty table gives an empty result; only ``doc_id`` and
``text`` of the documents are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtally.llm.common import materialise, ship

HASH_BITS = 18
FIT_ROWS = 8000
PREFIX = 4
MIN_DOCS = 3
MIN_Z = 4.0
RIDGE = 1e-3
STEPS = 400
GRADES = 3
KEEP_GOOD = 0.5  # least P(grade >= 2) of a document that stays
KEEP_CLEAN = 0.5  # least P(grade >= 1)
STEPS_OF_SHARE = (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
DOUBLED = re.compile(r"([^\w\s])\1$")


def grade(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good."""
    return F.when(toxic > 0, F.lit(0)).when(quality > 0, F.lit(2)).otherwise(F.lit(1))


def _shapes(word: str) -> str:
    """Shapes of one word: upper case, doubled marks at its end, no letter or digit, digits, anything but letters."""
    if word.isalpha():
        return "U" if len(word) > 1 and word.isupper() else ""
    upper = "U" if len(word) > 1 and word.isupper() else ""
    plain = "N" if not any(c.isalnum() for c in word) else "D" if any(c.isdigit() for c in word) else ""
    return upper + plain + ("M" if DOUBLED.search(word) else "") + ("X" if not word.rstrip(".,").isalpha() else "")


def features(text: str | None) -> list[int]:
    """Hashed columns of a text, ascending."""
    words = (text or "").split()
    lower = [w.lower() for w in words]
    found = {f"w{w}" for w in lower} | {f"p{w[:PREFIX]}" for w in lower}
    if words:
        shares: Counter = Counter()
        counts = Counter(words)
        for w, n in counts.items():
            for s in _shapes(w):
                shares[s] += n
        shares["R"] = sum(a == b for a, b in zip(lower, lower[1:]))
        shares["E"] = len(words) - len(counts)
        found |= {f"s{s}{t}" for s, n in shares.items() for t in STEPS_OF_SHARE if n >= t * len(words)}
    h, mask = xxhash.xxh32_intdigest, (1 << HASH_BITS) - 1
    return sorted({h(f) & mask for f in found})


@dataclass
class Model:
    weights: np.ndarray  # one per hashed column, most of them 0
    thresholds: np.ndarray  # ascending, one per step between grades

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., a column each."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))


def loss_and_gradient(par: np.ndarray, at: np.ndarray, cols: np.ndarray, grades: np.ndarray) -> tuple[float, np.ndarray]:
    """Penalised mean negative log-likelihood and its gradient.

    ``par``: weights, first threshold, log gaps between thresholds; row ``at[i]`` has feature ``cols[i]``.
    """
    n, k = len(grades), len(par) - (GRADES - 1)
    gaps = np.exp(par[k + 1:])
    th = np.concatenate([[-np.inf], par[k] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
    score = np.bincount(at, par[cols], n) if len(cols) else np.zeros(n)
    # P(grade = g) = S(th[g+1] - score) - S(th[g] - score)
    up, lo = (1 / (1 + np.exp(-np.clip(th[grades + d] - score, -30, 30))) for d in (1, 0))
    p = np.maximum(up - lo, 1e-12)
    du, dl = up * (1 - up) / p, lo * (1 - lo) / p
    ds = (du - dl) / n
    grad = np.zeros_like(par)
    if len(cols):
        grad[:k] = np.bincount(cols, ds[at], k) + RIDGE * par[:k]
    dth = [(np.sum(dl[grades == g + 1]) - np.sum(du[grades == g])) / n for g in range(GRADES - 1)]
    grad[k] = sum(dth)
    grad[k + 1:] = [sum(dth[j + 1:]) * gaps[j] for j in range(len(gaps))]
    return float(-np.log(p).mean() + RIDGE / 2 * np.sum(par[:k] ** 2)), grad


def fit(rows: list, grades: np.ndarray) -> Model | None:
    """Maximum penalised likelihood of the cumulative-link model; ``rows``: hashed columns of each document."""
    weights = np.zeros(1 << HASH_BITS)
    n = len(rows)
    if len(np.unique(grades)) < 2:
        return None
    cols = np.concatenate([np.asarray(r, np.int32) for r in rows])
    at = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    # screening: mean grade of a column's documents against the overall mean
    docs = np.bincount(cols, minlength=len(weights))
    mean, spread = grades.mean(), grades.std()
    z = (np.bincount(cols, grades[at], len(weights)) - docs * mean) / (spread * np.sqrt(np.maximum(docs, 1)))
    kept = np.flatnonzero((docs >= MIN_DOCS) & (np.abs(z) >= MIN_Z))
    number = np.full(len(weights), -1)
    number[kept] = np.arange(len(kept))
    inside = number[cols] >= 0
    at, cols = at[inside].astype(np.int64), number[cols[inside]]
    # thresholds as a first one and log gaps keep their order; Adam on the mean log-likelihood
    share = np.array([np.mean(grades >= k) for k in range(1, GRADES)]).clip(1e-3, 1 - 1e-3)
    cuts = np.log((1 - share) / share)
    par = np.concatenate([np.zeros(len(kept)), [cuts[0]], np.log(np.maximum(np.diff(cuts), 0.05))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    k = len(kept)
    for step in range(1, STEPS + 1):
        _, grad = loss_and_gradient(par, at, cols, grades)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        par -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights[kept] = par[:k]
    return Model(weights, par[k] + np.concatenate([[0.0], np.cumsum(np.exp(par[k + 1:]))]))


def _featured(rows: DataFrame) -> DataFrame:
    """grade, cols: columns of each text as packed 32-bit integers, which keeps the driver's share small."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [np.array(features(t.as_py()), "<i4").tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("grade"), pa.array(cols, pa.binary())], ["grade", "cols"])

    return rows.select("grade", "text").mapInArrow(task, "grade int, cols binary")


def train(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> Model | None:
    """The model, from at most ``limit`` labelled documents."""
    ship(docs.sparkSession)
    rated = labels.select(F.col("doc_id").alias("rated"), grade(F.col("quality"), F.col("toxic")).alias("grade"),
                          (F.col("quality") + F.col("toxic")).alias("known")).filter("known IS NOT NULL AND rated IS NOT NULL")
    chosen = rated.select("rated", "grade").distinct().orderBy(F.xxhash64("rated"), "rated", "grade").limit(limit)
    chosen = materialise(chosen)
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("rated"))  # at most ``limit`` rows
    rows = rows.groupBy("rated", "grade").agg(F.min("text").alias("text"))  # of a repeated doc_id one text
    got = sorted((bytes(r.cols), r.grade) for r in _featured(rows).collect())
    return fit([np.frombuffer(c, "<i4") for c, _ in got], np.array([g for _, g in got], np.int64)) if got else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, p_clean, p_good, expected_grade, kept."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, p_clean double, p_good double"
    if model is None:
        out = rows.select("doc_id", F.lit(1.0).alias("p_clean"), F.lit(1.0).alias("p_good"))
    else:
        out = rows.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), schema)
    return out.select("*", (F.col("p_clean") + F.col("p_good")).alias("expected_grade"),
                      stays(F.col("p_clean"), F.col("p_good")).alias("kept"))


def stays(p_clean, p_good):
    """The decision, of columns or of arrays."""
    return (p_good >= KEEP_GOOD) & (p_clean >= KEEP_CLEAN)


def kept_rows(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; nothing is joined."""
    if model is None:
        return docs
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = tails_of([t.as_py() for t in b.column("text").cast(pa.string())], sent.value)
                yield b.filter(pa.array(stays(p[:, 0], p[:, 1])))

    return docs.mapInArrow(task, docs.schema)


def tails_of(texts: list[str | None], model: Model) -> np.ndarray:
    sums = np.array([model.weights[features(t)].sum() for t in texts])
    return model.tails(sums)


def _scorer(model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = tails_of([t.as_py() for t in b.column("text")], model.value)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p[:, 0]), pa.array(p[:, 1])], ["doc_id", "p_clean", "p_good"])

    return task
