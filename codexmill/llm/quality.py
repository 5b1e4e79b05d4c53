"""Quality classifier: a sparse rule ensemble over text statistics.

Boosted shallow trees over statistics are taken apart into their paths, each a conjunction of
thresholds; a lasso logistic regression keeps and weighs few of them; those become Spark column
expressions, so that scoring is one projection without Python. Statistics are native expressions over
whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.llm.common import bounded_sample, fold_of, text_hash

STATISTICS = ["chars", "words", "word_chars", "upper", "symbols", "digits", "loud", "distinct_words", "repeated_lines", "short_words"]


def statistics(text: Column) -> Column:
    """A struct of doubles; a null text counts as empty, a share of nothing is 0."""
    t = F.coalesce(text, F.lit(""))
    chars = F.length(t)
    words = F.split(F.trim(t), r"[\x20\x09-\x0D]+")
    n_words = F.size(words)
    lines = F.split(t, r"\n")

    def share(n: Column, of: Column) -> Column:
        return F.coalesce(n.cast("double") / F.nullif(of.cast("double"), F.lit(0.0)), F.lit(0.0))

    def count(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern))

    found = {
        "chars": chars.cast("double"),
        "words": n_words.cast("double"),
        "word_chars": share(chars, n_words),
        "upper": share(count(r"\p{Lu}"), chars),
        "symbols": share(count(r"[%&#$*@^~|<>=+{}\[\]\\/_]"), chars),
        "digits": share(count(r"[0-9]"), chars),
        "loud": share(count(r"[!?]"), n_words),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "repeated_lines": F.lit(1.0) - share(F.size(F.array_distinct(lines)), F.size(lines)),
        "short_words": share(count(r"(?U)\b\p{L}{1,3}\b"), n_words),
    }
    return F.struct(*[found[k].alias(k) for k in STATISTICS])


@dataclass(frozen=True)
class Rules:
    """score = logistic(bias + sum of the weights of rules that hold); a rule: (statistic, above?, threshold)..."""

    rules: list[tuple[tuple[int, bool, float], ...]]
    weights: list[float]
    bias: float

    def score(self, stats: Column) -> Column:
        total = F.lit(float(self.bias))
        for rule, w in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for k, above, at in rule:
                holds = holds & ((stats[STATISTICS[k]] > at) if above else (stats[STATISTICS[k]] <= at))
            total = total + F.when(holds, F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, above, at in rule:
        out &= (x[:, k] > at) == above
    return out


def _grow(x: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, path: tuple, depth: int, found: list, fit: np.ndarray) -> None:
    """One tree by Newton gains; found gets every path, fit the leaves' steps."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, None)
    if depth and len(rows) >= 20:
        for k in range(x.shape[1]):
            at = np.searchsorted(cuts[k], x[rows, k], side="left")  # x <= cuts[i]: at <= i
            gl = np.cumsum(np.bincount(at, grad[rows], len(cuts[k]) + 1))[:-1]
            hl = np.cumsum(np.bincount(at, hess[rows], len(cuts[k]) + 1))[:-1]
            nl = np.cumsum(np.bincount(at, minlength=len(cuts[k]) + 1))[:-1]
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(nl < 5) | (len(rows) - nl < 5)] = 0
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), (k, float(cuts[k][int(gain.argmax())])))
    if best[1] is None:
        fit[rows] += -g / (h + 1)
        return
    k, at = best[1]
    for above in (False, True):
        step = (*path, (k, above, at))
        found.append(step)
        _grow(x, cuts, grad, hess, rows[(x[rows, k] > at) == above], step, depth - 1, found, fit)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, lasso: float = 2e-3, steps: int = 400) -> Rules:
    """Rules from statistics x and labels y (0 or 1); with one class only, its smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return Rules([], [], bias)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.01, 0.99, 64))) for k in range(x.shape[1])]
    margin, paths = np.full(len(y), bias), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        _grow(x, cuts, p - y, p * (1 - p), np.arange(len(y)), (), depth, paths, step)
        margin += rate * step
    kept: dict[bytes, tuple] = {}
    for rule in sorted(set(paths), key=lambda r: (len(r), r)):
        hit = _holds(rule, x)
        if 5 <= hit.sum() <= len(y) - 5:
            kept.setdefault(np.packbits(hit).tobytes(), rule)
    rules = list(kept.values())
    if not rules:
        return Rules([], [], bias)
    m = np.stack([_holds(r, x) for r in rules], 1).astype(np.float64)
    mean, scale = m.mean(0), m.std(0)
    m = (m - mean) / scale
    w, v, b, t = np.zeros(len(rules)), np.zeros(len(rules)), bias, 1.0
    rate = 1 / (0.25 * np.linalg.norm(m, 2) ** 2 / len(y) + 1e-9)
    for _ in range(steps):  # accelerated proximal gradient
        r = 1 / (1 + np.exp(-(b + m @ v))) - y
        b -= rate * r.mean()
        new = v - rate * (m.T @ r) / len(y)
        new = np.sign(new) * np.maximum(0, np.abs(new) - rate * lasso)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / after * (new - w), new, after
    on = np.flatnonzero(w)
    return Rules([rules[i] for i in on], [float(w[i] / scale[i]) for i in on], float(b - (w * mean / scale).sum()))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = 20_000) -> Rules:
    """Learns from at most bound labelled documents; only their statistics reach the driver.

    A doc_id with several labels counts by their mean, one with several texts by that of the least
    hash; null labels and ids are left out.
    """
    chosen = bounded_sample(labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y")), F.col("doc_id"), bound)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", text_hash().alias("th"), statistics(F.col("text")).alias("s"))
    rows = rows.groupBy("doc_id").agg(F.first("y").alias("y"), F.min_by("s", "th").alias("s")).select("doc_id", "y", "s.*").collect()
    rows.sort(key=lambda r: tuple(r))
    return fit(np.array([[r[k] for k in STATISTICS] for r in rows]).reshape(len(rows), len(STATISTICS)), np.array([r["y"] for r in rows], float))


def op7_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from labels outside fold 0 of 5; scores every document, one row for each row of documents.

    Null and empty texts have the statistics of an empty text; very long texts are read whole; repeated
    rows come out as often as they go in; without labels all scores are one half; columns besides doc_id
    and text are not read. An empty table gives an empty one.
    """
    fold = fold_of("doc_id", 5)
    rules = train(docs, labels.where(fold != 0).select("doc_id", "quality"))
    scored = docs.select("doc_id", statistics(F.col("text")).alias("s"))
    return scored.select("doc_id", (fold == 0).alias("held_out"), rules.score(F.col("s")).alias("score")).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
