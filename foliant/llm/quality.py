"""Operator 3: ordinal cumulative-link regression on graded ratings.

P(grade > j | text) = sigmoid(w . x - t_j), with one weight vector w over hashed byte trigrams
(square-root counts of unit length) and ordered thresholds t_0 < t_1 < ... . The fit uses a
bounded sample: at most ``sample`` rated documents of each grade, the first by a hash of their
id; the rest of the work covers all documents. Sampling by grade shifts the thresholds, which
are set anew from the grades' shares among all ratings.

Defined results: null or empty text has no features and gets the thresholds' own
probabilities. Null ratings and ratings of unknown documents are left out. With fewer than two
grades every probability of exceeding is 0 and the expected grade the only grade (or 0).
Repeated rows are rows of their own. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.grams import gram_counts


def features(text: bytes | None, bits: int) -> np.ndarray:
    x = np.sqrt(gram_counts(text, bits).astype(np.float32))
    return x / max(float(np.sqrt(x @ x)), 1e-9)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class CumulativeLink:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade > grades[j]) for each row and j but the last."""
        return _sigmoid((x @ self.weights)[:, None] - self.thresholds)

    def expected(self, tails: np.ndarray) -> np.ndarray:
        return self.grades[0] + tails @ np.diff(np.asarray(self.grades, float))


def fit(x: np.ndarray, grade: np.ndarray, shares: dict[int, float], steps: int = 300, rate: float = 0.5, ridge: float = 1e-5) -> CumulativeLink:
    """Gradient ascent (Adam) on the likelihood of the grades, each weighted by its share."""
    grades = sorted(shares)
    k = len(grades) - 1
    if k < 1:
        return CumulativeLink(grades or [0], np.zeros(x.shape[1], np.float32), np.zeros(0))
    level = np.searchsorted(grades, grade)
    weight = np.array([shares[g] for g in grades])[level] / np.bincount(level, minlength=k + 1)[level]
    above = np.cumsum([shares[g] for g in grades[::-1]])[::-1][1:]
    # thresholds as a first value and positive steps, so they stay ordered
    start = -np.log(above / (1 - above).clip(1e-9))
    p = np.concatenate([np.zeros(x.shape[1]), start[:1], np.log(np.diff(start).clip(1e-3))])
    m, v, d = np.zeros_like(p), np.zeros_like(p), x.shape[1]
    for i in range(1, steps + 1):
        t = np.cumsum(np.concatenate([p[d : d + 1], np.exp(p[d + 1 :])]))
        z = x @ p[:d].astype(np.float32)
        s = _sigmoid(z[:, None] - t)
        upper, lower = np.hstack([np.ones((len(z), 1)), s]), np.hstack([s, np.zeros((len(z), 1))])
        row = np.arange(len(z))
        a, b = upper[row, level], lower[row, level]
        prob = (a - b).clip(1e-9)
        da, db = a * (1 - a) / prob * weight, b * (1 - b) / prob * weight
        g = np.zeros_like(p)
        g[:d] = x.T @ (da - db).astype(np.float32) - ridge * p[:d]
        gt = np.zeros(k)
        np.add.at(gt, level[level > 0] - 1, -da[level > 0])
        np.add.at(gt, level[level < k], db[level < k])
        g[d] = gt.sum()
        g[d + 1 :] = np.cumsum(gt[::-1])[::-1][1:] * np.exp(p[d + 1 :])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p += rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
    return CumulativeLink(grades, p[:d].astype(np.float32), np.cumsum(np.concatenate([p[d : d + 1], np.exp(p[d + 1 :])])))


def _feature_rows(bits: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                rows = [features(t, bits).astype(np.float16).tobytes() for t in batch.column(1).slice(at, 512).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 512).cast(pa.int64()), pa.array(rows, pa.binary())], schema=schema)

    return run


def _scored(model: CumulativeLink, bits: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                x = np.stack([features(t, bits) for t in batch.column(1).slice(at, 512).to_pylist()])
                tails = model.tails(x)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 512).cast(pa.int64()), pa.array(model.expected(tails).astype(float)), pa.array(tails.astype(float).tolist(), pa.list_(pa.float64()))], schema=schema)

    return run


def train(docs: DataFrame, ratings: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "quality", bits: int = 11, sample: int = 3000, rows_in_all: int = 12_000, most_grades: int = 256) -> CumulativeLink:
    """Fit on at most ``sample`` rated documents a grade and ``rows_in_all`` in all (4 KB each on
    the driver). Every grade takes part; more than ``most_grades`` raise ValueError. Null ids,
    null grades and ratings without a document are left out; of ratings of one document the
    last drawn counts; with fewer than two grades all documents get the one."""
    rated = ratings.select(F.col(id_col).cast("long").alias("id"), F.col(grade_col).cast("int").alias("grade")).dropna()
    counts = {r["grade"]: r["n"] for r in rated.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).orderBy("grade").limit(most_grades + 1).collect()}
    if len(counts) > most_grades:
        raise ValueError(f"more than {most_grades} grades")
    total = sum(counts.values())
    sample = max(1, min(sample, rows_in_all // max(1, len(counts))))
    drawn = [(r["id"], g) for g in counts for r in rated.where(F.col("grade") == g).orderBy(F.xxhash64("id"), "id").limit(sample).collect()]
    grade = dict(drawn)
    if len(counts) < 2:
        return fit(np.zeros((0, 1 << bits), np.float32), np.zeros(0, int), dict.fromkeys(counts, 1.0))
    spark = docs.sparkSession
    ids = spark.createDataFrame([(i,) for i in grade], "id long")  # at most sample rows a grade
    schema = pa.schema([("id", pa.int64()), ("x", pa.binary())])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).join(F.broadcast(ids), "id", "left_semi")
    rows = rows.mapInArrow(_feature_rows(bits, schema), "id long, x binary").collect()
    if not rows:
        return fit(np.zeros((0, 1 << bits), np.float32), np.zeros(0, int), {g: 1.0 for g in list(counts)[:1]})
    x = np.stack([np.frombuffer(r.x, np.float16) for r in rows]).astype(np.float32)
    y = np.array([grade[r.id] for r in rows])
    seen = {g: counts[g] / total for g in sorted(set(y.tolist()))}
    return fit(x, y, {g: s / sum(seen.values()) for g, s in seen.items()})


def rate_documents(docs: DataFrame, model: CumulativeLink, *, id_col: str = "doc_id", text_col: str = "text", bits: int = 11) -> DataFrame:
    """doc_id, expected_grade and tails, the probabilities of exceeding each grade but the last."""
    schema = pa.schema([("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("tails", pa.list_(pa.float64()))])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(_scored(model, bits, schema), "doc_id long, expected_grade double, tails array<double>")
