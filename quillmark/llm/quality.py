"""Operator 9: quality scores by Bradley-Terry pairwise ranking.

Pairs of a text marked good and a text marked bad are preferences; the log loss on the difference of
their features gives the weights of a linear score. The decision threshold is a quantile of the
training scores (the share of bad texts); ``score`` is the logistic of the distance to it, so 0.5
lies at the threshold.

Only features of the whole text enter a score: counts of its bytes, words and lines, its words and its runs of three
bytes, both hashed. The fit reads at most ``max_rows`` labelled texts (those with the smallest id hashes), about 600 bytes
of features each, and at most ``MAX_PAIRS`` preferences; everything else covers all rows.

Defined results: null and empty texts have zero features and a score like any other; equal texts
have equal scores; several labels of one id are averaged, null labels left out; of several texts of one id the fit reads one; without labels of both kinds the
score is 0.5 for every text; a null id is never held out; other columns aren't looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features

#: Most labelled texts that a fit reads, and preference pairs that it draws from them.
MAX_ROWS, MAX_PAIRS = 20_000, 50_000
#: Ridge of the counts, and of the many hashed inputs, each of which tells little; chosen by folds of the rows to learn from.
RIDGE = np.where(np.arange(len(features.NAMES)) < len(features.COUNTS), 1e-3, 1e-2)
#: Pairs whose differences are held at once.
PAIRS_AT_ONCE = 8192


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    width: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip((z - self.threshold) / self.width, -40, 40)))


def held_out(id_col: str):
    """crc32 of the id as text leaves the remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def drawn_pairs(good: np.ndarray, max_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the better and the worse text of each preference: all pairs if there are at most ``max_pairs``."""
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if len(better) * len(worse) <= max_pairs:
        return np.repeat(better, len(worse)), np.tile(worse, len(better))
    rng = np.random.default_rng(0)
    return rng.choice(better, max_pairs), rng.choice(worse, max_pairs)


def fit_pairs(x: np.ndarray, good: np.ndarray, max_pairs: int = MAX_PAIRS, ridge: float | np.ndarray = 1e-3, steps: int = 30) -> Ranker:
    """Newton steps on the mean log loss of sigmoid(weights . (better - worse)) with a ridge, one for all inputs or one for each."""
    d = x.shape[1] if x.ndim == 2 else len(features.NAMES)
    if not len(x) or good.all() or not good.any():
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 1.0)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    better, worse = drawn_pairs(good, max_pairs)
    w = np.zeros(d)
    for _ in range(steps):
        slope, curve = -ridge * w, np.diag(np.broadcast_to(ridge, d).astype(float))
        for a in range(0, len(better), PAIRS_AT_ONCE):
            diff = z[better[a : a + PAIRS_AT_ONCE]] - z[worse[a : a + PAIRS_AT_ONCE]]
            p = 1 / (1 + np.exp(-np.clip(diff @ w, -40, 40)))
            slope += diff.T @ (1 - p) / len(better)
            curve += (diff * (p * (1 - p))[:, None]).T @ diff / len(better)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    s = z @ w
    threshold = float(np.quantile(s, ((~good).sum() - 0.5) / max(1, len(s) - 1), method="linear"))
    return Ranker(mean, scale, w, threshold, max(float(s.std()) / 4, 1e-9))


def _feature_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for b in batches:
            x = [features.of_text(t).astype("<f4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(x, pa.binary())], [id_col, "x"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, x binary")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> Ranker:
    """Learn from the rows that aren't held out; ``max_rows`` bounds what comes to the driver."""
    marked = labels.select(id_col, F.col(label_col).cast("double").alias("y")).where(F.col(id_col).isNotNull() & F.col("y").isNotNull() & ~held_out(id_col))
    marked = marked.groupBy(id_col).agg((F.avg("y") >= 0.5).alias("y")).orderBy(F.xxhash64(id_col), id_col).limit(max_rows)
    y = {r[0]: r[1] for r in marked.collect()}
    if not y:
        return fit_pairs(np.zeros((0, len(features.NAMES))), np.zeros(0, bool))
    ids = docs.sparkSession.createDataFrame([(i,) for i in sorted(y)], f"`{id_col}` {dict(labels.dtypes)[id_col]}")
    # at most max_rows ids, so the broadcast is bounded, and one row for each of them comes back
    rows = _feature_rows(docs.join(F.broadcast(ids), id_col, "left_semi"), id_col, text_col).groupBy(id_col).agg(F.min("x").alias("x")).orderBy(id_col).collect()
    x = np.frombuffer(b"".join(r["x"] for r in rows), "<f4").astype(float).reshape(len(rows), len(features.NAMES))
    return fit_pairs(x, np.array([y[r[id_col]] for r in rows], bool), ridge=RIDGE)


def score(docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text", score_col: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and its score."""

    @F.pandas_udf("double")
    def of(texts):
        import pandas as pd

        x = np.array([features.of_text(t) for t in texts]).reshape(len(texts), len(features.NAMES))
        return pd.Series(ranker.scores(x))

    return docs.withColumn(score_col, of(F.col(text_col)))


def classify(docs: DataFrame, labels: DataFrame, **names: str) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    id_col, text_col = names.get("id_col", "doc_id"), names.get("text_col", "text")
    ranker = fit(docs, labels, **names)
    scored = score(docs.select(id_col, text_col), ranker, id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
