"""What the two classifiers share: labelled rows to learn from, calibration, and scoring of whole tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm.shared import held_out, materialise, passing, small_batches
from veilframe.llm.words import GROUP_BYTES, Texts, groups, lean

#: At most so many labelled documents of each class are learnt from, and so many characters of each class.
ROWS_PER_CLASS = 4_000
CHARACTERS_PER_CLASS = 16 << 20


def fit_on_sample(docs: DataFrame, labels: DataFrame, label: str, fit: Callable[[list[str], np.ndarray, np.ndarray], Any], rows_per_class: int = ROWS_PER_CLASS, seed: int = 5, characters: int = CHARACTERS_PER_CLASS) -> Any:
    """What fit makes of the texts, 0/1 labels and weights of a seeded sample of the labelled rows outside the held-out fold.

    One executor fits, as the sample is bounded in rows and characters, and its result must be plain arrays,
    which are pickled. The weights restore the classes' shares among all labelled rows. Null labels and null
    ids are left out; of repeated label rows the largest label counts, of repeated documents the
    least text.
    """
    with passing():
        return _fitted(docs, labels, label, fit, rows_per_class, seed, characters)


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and label, the largest of each id, outside the held-out fold; null labels and null ids are left out."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max(label).cast("long").alias("label"))


def _fitted(docs, labels, label, fit, rows_per_class, seed, characters):
    known = known_labels(labels, label)
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    drawn = None
    for c in (0, 1):
        part = known.filter(F.col("label") == c).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(rows_per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    # at most 2 * rows_per_class ids, each with one text
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    sample = materialise(sample.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "sample")
    long, room, spent = [], {0: characters, 1: characters}, {0: 0, 1: 0}
    for r in sample.select("doc_id", "label", F.char_length("text").alias("n"), F.xxhash64(F.lit(seed), "doc_id").alias("place")).orderBy("place", "doc_id").collect():
        if spent[r.label] + r.n > room[r.label]:
            long.append(r.doc_id)
        else:
            spent[r.label] += r.n
    if long:
        sample = sample.join(F.broadcast(docs.sparkSession.createDataFrame([(x,) for x in long], sample.select("doc_id").schema)), "doc_id", "left_anti")
    sample = sample.select("doc_id", "text", "label")

    def fitted(texts: list[str], y: np.ndarray) -> bytes:
        share = np.array([counts.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)])
        weight = share[y] if len(y) else np.zeros(0)
        return pickle.dumps(fit(texts, y, weight / max(weight.sum(), 1e-9) * len(y)))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        if rows:
            rows.sort(key=lambda r: (r[0], r[1]))
            model = fitted([r[1] for r in rows], np.array([r[2] for r in rows], np.int64))
            rows.clear()
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    made = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0].model if made else fitted([], np.zeros(0, np.int64)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression of y on the columns of x and a constant, by Newton steps."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    x = np.column_stack([x / scale, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * np.r_[b[:-1], 0]
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(np.full(len(b), ridge))
        step = np.linalg.solve(curve, slope)
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return b / np.r_[scale, 1.0]


def as_texts(texts: list[str]) -> Iterator[tuple[int, int, Texts]]:
    return groups(pa.array(texts, pa.large_string()))


def score_documents(docs: DataFrame, score: Callable[[Texts], np.ndarray]) -> DataFrame:
    """doc_id, held_out and score of every row; score is run over groups of whole texts on the executors."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [score(texts) for _, _, texts in groups(b.column(2), GROUP_BYTES)]
            scores = pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), scores], ["doc_id", "held_out", "score"])

    small_batches(docs.sparkSession)
    given = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = T.StructType([f for f in given.schema if f.name != "text"]).add("score", "double")
    return given.mapInArrow(run, schema)
