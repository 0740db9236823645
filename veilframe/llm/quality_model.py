"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.labelled import ROWS_PER_CLASS, as_texts, calibrate, fit_on_sample, score_documents
from veilframe.llm.shared import documents
from veilframe.llm.words import Texts, Words

BUCKETS = 1 << 20
SMOOTHING = 1.0
#: The most weight of a training row with one n-gram; a row of n has it divided by the root of n, so long texts don't outvote short ones.
PENALTY = 1.0
#: Log-count ratios are divided by this, so that a text's few hundred of them have a margin near 1 and the descent converges in EPOCHS.
RATIO_SCALE = 8.0
EPOCHS = 30


def features(texts: Texts, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text's words and word pairs, and where each text's begin."""
    w = Words(texts, lower=False)
    pairs, at2 = w.ngrams(2)
    row = np.concatenate([np.repeat(np.arange(len(texts)), np.diff(w.at)), np.repeat(np.arange(len(texts)), np.diff(at2))])
    bucket = np.concatenate([w.hash, pairs]) & np.uint64(buckets - 1)
    both = np.unique(row.astype(np.uint64) * np.uint64(buckets) + bucket)
    return (both & np.uint64(buckets - 1)).astype(np.int64), np.searchsorted(both, np.arange(len(texts) + 1).astype(np.uint64) * np.uint64(buckets))


def dual_descent(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, penalty: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the penalised hinge loss, one dual variable at a time.

    Row i has the values of its buckets; y is -1 or 1; penalty bounds row i's variable. The bias
    is the weight of a constant 1.
    """
    w, bias = np.zeros(len(values)), 0.0
    alpha = np.zeros(len(rows))
    norm = np.array([1.0 + np.dot(values[r], values[r]) for r in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            v = values[r]
            slope = y[i] * (w[r] @ v + bias) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), penalty[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * v
                bias += step
                moved = max(moved, abs(new - alpha[i]) / penalty[i])
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    line: np.ndarray

    @classmethod
    def fit(cls, texts: list[str], y: np.ndarray, weight: np.ndarray, buckets: int = BUCKETS) -> QualityModel:
        """Every fourth text calibrates; the others are fitted."""
        rows = []
        for _, _, group in as_texts(texts):
            f, at = features(group, buckets)
            rows += np.split(f, at[1:-1])
        aside = np.arange(len(y)) % 4 == 3
        own = [r for r, a in zip(rows, aside, strict=True) if not a]
        sign = np.where(y[~aside] == 1, 1.0, -1.0)
        seen = [np.bincount(np.concatenate([r for r, s in zip(own, sign, strict=True) if s == c] or [np.zeros(0, np.int64)]), minlength=buckets) + SMOOTHING for c in (-1, 1)]
        ratio = np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum())
        scale = np.array([1 / np.sqrt(max(1, len(r))) for r in own])
        w, bias = dual_descent(own, ratio / RATIO_SCALE, sign, PENALTY * scale) if own else (np.zeros(buckets), 0.0)
        model = cls((w * ratio / RATIO_SCALE).astype(np.float32), bias, np.zeros(2))
        x = np.array([model.margin(r) for r, a in zip(rows, aside, strict=True) if a])
        if len(x):
            model.line = calibrate(x[:, None], y[aside], weight[aside])
        return model

    def margin(self, row: np.ndarray) -> float:
        return float(self.weights[row].sum(dtype=float) + self.bias)

    def score(self, texts: Texts) -> np.ndarray:
        f, at = features(texts, len(self.weights))
        total = np.concatenate([[0], np.cumsum(self.weights[f], dtype=float)])
        x = (total[at[1:]] - total[at[:-1]] + self.bias) * self.line[0] + self.line[1]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_quality(docs: DataFrame, labels: DataFrame, *, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """doc_id, held_out and score in 0 to 1 of every row of docs; higher is likelier good.

    docs has doc_id and text, labels has doc_id and quality. Only the text is scored. The model is
    learnt from at most rows_per_class labelled documents of each class outside the held-out fold
    (crc32 of the id mod 5 = 0); its weights are BUCKETS numbers whatever the data. Null and empty
    texts score by the bias alone; repeated rows score alike; without labels every score is 0.5.
    Other columns are not looked at; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit_on_sample(docs, labels, "quality", lambda *sample: vars(QualityModel.fit(*sample)), rows_per_class))
    return score_documents(docs, lambda texts: QualityModel(**held.value).score(texts))


def op10_quality(spark, sf_dir):
    """score_quality() of documents by labels, good from a score of 0.3."""
    scored = score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))
