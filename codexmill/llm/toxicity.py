"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of single words, pairs of neighbours and pairs with one word between, and
of words' beginnings (so that inflected and compound forms have something in common), hashed to
2^BITS places. Learning sees one row after another; every place has its own rate, and L1
leaves few weights, which are what is broadcast. Scores are calibrated: a line through the margins of
rows that the model which scored them hadn't seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.common import bounded_sample, fold_of, text_hash
from codexmill.llm.textkit import ALNUM, Hasher, U, mix

BITS = 20
#: Bytes of a word that make its beginning.
STEM = 6


def _features(words: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and places of each kind of feature; words: whole words' and beginnings' hashes."""
    words, stems = words
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    shift = U(64 - BITS)
    yield row, (words >> shift).astype(np.int64)
    yield row, (mix(stems + U(0x5851F42D4C957F2D)) >> shift).astype(np.int64)
    for gap, salt in ((1, U(0x9FB21C651E98DF25)), (2, U(0xC2B2AE3D27D4EB4F))):
        if len(words) > gap:
            same = row[:-gap] == row[gap:]
            yield row[:-gap][same], (mix(words[:-gap] * salt + words[gap:]) >> shift).astype(np.int64)[same]


class Ftrl:
    """Per-coordinate FTRL-proximal; weights follow from z and n."""

    def __init__(self, places: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 5.0, l2: float = 1.0):
        self.z, self.n = np.zeros(places + 1), np.zeros(places + 1)
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.l1, self.l1_bias = l1, 0.0

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(len(z), self.l1)
        l1[-1] = 0.0  # the last is the bias
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, y: float) -> None:
        """at: places that are present, then the bias place."""
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make logistic(slope * margin + offset) a probability, by damped Newton steps; slope 1 and 0 where there is nothing to learn."""
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    margin = np.clip(margin, -30, 30)
    x, at = np.stack([margin, np.ones(len(y))], 1), np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + 0.5 * (v[0] - 1) ** 2 + 0.05 * v[1] ** 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ at)))
        slope = x.T @ (p - y) + np.array([at[0] - 1, 0.1 * at[1]])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag([1.0, 0.1]), slope)
        rate = 1.0
        while rate > 1e-6 and loss(at - rate * step) > loss(at):
            rate /= 2
        at = at - rate * step
        if np.abs(rate * step).max() < 1e-7:
            break
    return max(float(at[0]), 0.0), float(at[1])


def fit(rows: list[tuple[np.ndarray, float]], epochs: int = 3, folds: int = 5, enough: int = 2000) -> tuple[np.ndarray, float, float]:
    """Weights by place (the bias last), slope and offset, from rows of places and label.

    Margins for the calibration come from models without the fold that they score, one fold after
    another until enough rows are scored.
    """
    def weights(chosen: list[tuple[np.ndarray, float]]) -> np.ndarray:
        model = Ftrl(1 << BITS)
        for _ in range(epochs):
            for at, y in chosen:
                model.learn(at, y)
        return model.weights(slice(None))

    margins, labels = [], []
    for k in range(folds):
        if len(margins) >= enough or len(rows) < 2 * folds:
            break
        w = weights([r for i, r in enumerate(rows) if i % folds != k])
        margins += [w[at].sum() for at, _ in rows[k::folds]]
        labels += [y for _, y in rows[k::folds]]
    return weights(rows), *calibrate(np.array(margins, float), np.array(labels, float))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = 24_000, features: int = 60_000_000) -> tuple[np.ndarray, np.ndarray, float, float, float]:
    """Places, weights, bias, and the calibration's slope and offset, from at most bound labelled documents and so many features of them.

    The sample is bounded, so one task learns from it in a fixed order; a lost executor repeats it. A
    doc_id with several labels counts by their mean, one with several texts by that of the least hash;
    null labels and ids are left out.
    """
    chosen = bounded_sample(labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y")), F.col("doc_id"), bound)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("y").alias("y"), F.min_by("text", text_hash()).alias("text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(ALNUM, lower=True, prefix=STEM)
        for b in batches:
            for lo, hi, words, starts in hasher.rows(b.column("text")):
                keys = np.unique(np.concatenate([r * (1 << BITS) + p for r, p in _features(words, starts)] or [np.zeros(0, np.int64)]))
                ends = np.searchsorted(keys, np.arange(hi - lo + 1) * (1 << BITS))
                places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys & ((1 << BITS) - 1), pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("y").slice(lo, hi - lo), places], ["doc_id", "y", "places"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = [], 0
        for b in batches:
            flat, ends = b.column("places").flatten().to_numpy().astype(np.int32), np.cumsum([0, *b.column("places").value_lengths().fill_null(0).to_pylist()])
            for i, j, y in zip(ends[:-1], ends[1:], b.column("y").to_pylist(), strict=True):
                if held < features:
                    seen.append((np.append(flat[i:j], np.int32(1 << BITS)), y))
                    held += j - i
        w, slope, offset = fit(seen)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1, -2], pa.int32()), pa.array([*w[at], slope, offset], pa.float64())], ["place", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(featurise, f"doc_id {kind}, y int, places array<int>").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").drop("doc_id").mapInArrow(learn, "place int, weight double").collect()
    by = {r[0]: r[1] for r in found}
    slope, offset, bias = by.pop(-1, 1.0), by.pop(-2, 0.0), by.pop(1 << BITS, 0.0)
    return np.array(list(by), np.int64), np.array(list(by.values()), np.float32), bias, slope, offset


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float, float, float]) -> DataFrame:
    """doc_id and score (0 to 1) of every row of docs; a null or empty text has the bias's score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights, bias, slope, offset = shared.value
        table = np.zeros(1 << BITS, np.float32)
        table[places] = weights
        hasher = Hasher(ALNUM, lower=True, prefix=STEM)
        for b in batches:
            for lo, hi, words, starts in hasher.rows(b.column("text")):
                keys = [np.zeros(0, np.int64)]
                for row, at in _features(words, starts):
                    hit = table[at] != 0
                    keys.append(row[hit] * (1 << BITS) + at[hit])
                keys = np.unique(np.concatenate(keys))
                total = slope * (bias + np.bincount(keys >> BITS, table[keys & ((1 << BITS) - 1)], hi - lo)) + offset
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op10_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from labels outside fold 2 of 4; scores every document, one row for each row of documents.

    Null and empty texts have the score of a text without features; very long texts are read whole, in
    pieces; repeated rows come out as often as they go in; without labels all scores are one half;
    columns besides doc_id and text are not read. An empty table gives an empty one.
    """
    fold = fold_of("doc_id", 4)
    model = train(docs, labels.where(fold != 2).select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
