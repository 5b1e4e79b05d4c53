"""Language identification by word-first backoff.

A word that the model knows scores by its log frequency in each language; an unseen word backs off
to character n-grams, longest first, until a length has known n-grams. A text scores the mean of its
words. Whole texts are read; the model's size is bounded by parameters, so its broadcast is too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.common import cut, fold_of

WORD = re.compile(r"[^\W\d_]+")
GAP = re.compile(r"[\W\d_]")
#: Characters of a text whose words are scored at a time; a word that goes on beyond them counts there.
PIECE = 1 << 20
#: A word over so many characters isn't kept in a scorer's cache.
LONG_WORD = 100
#: Log10 probability of what a language never showed, in words and in n-grams.
PENALTY = -7.0
#: Most entries of a model, and most cells of its tables (entries times languages; 4 bytes each).
ENTRIES, CELLS = 1_500_000, 48_000_000


@dataclass(frozen=True)
class Model:
    langs: list[str]
    words: dict[str, int]  # word -> row of word_logs
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    lengths: tuple[int, ...]  # longest first


def _grams(word: str, n: int) -> Iterator[str]:
    padded = f"\x02{word}\x03"
    return (padded[i : i + n] for i in range(len(padded) - n + 1))


def share(langs: int, kinds: int) -> int:
    """How many entries of each kind (words, n-grams of a length) a language may have, so that the model keeps to ENTRIES and CELLS."""
    return max(1, min(ENTRIES, CELLS // max(langs, 1)) // (max(langs, 1) * kinds))


def train(docs: DataFrame, per_lang: int = 3000, max_words: int = 30_000, max_grams: int = 20_000, lengths: tuple[int, ...] = (5, 4, 3, 2, 1), max_langs: int = 500) -> Model:
    """Learns from rows with text and lang.

    Bounds: about per_lang documents a language (those with the smallest hash of doc_id, the share
    follows from each language's count), the max_words commonest words and max_grams n-grams of each
    length a language, or fewer of both where there are so many languages that the model would go
    beyond ENTRIES or CELLS. More than max_langs languages is an error, not a silent cut.
    """
    rows = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(max_langs + 1).collect()}
    if len(counts) > max_langs:
        raise ValueError(f"more than {max_langs} languages; raise max_langs or clean the lang column")
    langs = sorted(counts)
    if not langs:
        return Model([], {}, np.zeros((0, 0), np.float32), {}, np.zeros((0, 0), np.float32), lengths)
    most = share(len(langs), 1 + len(lengths))
    max_words, max_grams = min(max_words, most), min(max_grams, most)
    rate = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, per_lang / counts[k]))])
    rows = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < rate[F.col("lang")] * float(1 << 30))
    # The texts are read once; the counts of their words several times.
    words = cut(rows.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("w")).groupBy("lang", "w").agg(F.count("*").alias("n")))
    # The commonest words by a count threshold: as large as the bound lets it be, found from the counts' histogram.
    hist = words.groupBy("lang", F.least("n", F.lit(100_000)).alias("n")).agg(F.count("*").alias("k"), F.sum("n").alias("t")).collect()
    floor = {}
    for lang in langs:
        left, least = max_words, 100_001
        for n, k in sorted(((r["n"], r["k"]) for r in hist if r["lang"] == lang), reverse=True):
            if k > left:
                break
            left, least = left - k, n
        floor[lang] = least
    least = F.create_map(*[F.lit(x) for k in langs for x in (k, floor[k])])
    tables = {lang: {} for lang in langs}
    for r in words.where((F.col("n") >= least[F.col("lang")]) & (F.length("w") <= LONG_WORD)).toLocalIterator():
        tables[r["lang"]][r["w"]] = r["n"]
    totals = {lang: sum(r["t"] for r in hist if r["lang"] == lang) for lang in langs}
    grams: dict[str, dict[int, dict[str, int]]] = {}
    for lang in langs:
        grams[lang] = {}
        for n in lengths:
            found: dict[str, int] = {}
            for w, k in tables[lang].items():
                for g in _grams(w, n):
                    found[g] = found.get(g, 0) + k
            grams[lang][n] = dict(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:max_grams])

    def logs(by_lang: list[dict[str, int]], total: list[float]) -> tuple[dict[str, int], np.ndarray]:
        index = {k: i for i, k in enumerate(sorted(set().union(*by_lang)))}
        out = np.full((len(index), len(by_lang)), PENALTY, np.float32)
        for j, (own, t) in enumerate(zip(by_lang, total, strict=True)):
            for k, n in own.items():
                out[index[k], j] = max(PENALTY, math.log10(n / t))
        return index, out

    known, word_logs = logs([tables[x] for x in langs], [totals.get(x, 1) for x in langs])
    gram_index: dict[str, int] = {}
    parts = []
    for n in lengths:
        own, m = logs([grams[x][n] for x in langs], [max(1, sum(grams[x][n].values())) for x in langs])
        start = len(gram_index)
        gram_index.update({k: start + i for k, i in own.items()})
        parts.append(m)
    return Model(langs, known, word_logs, gram_index, np.concatenate(parts) if parts else np.zeros((0, len(langs)), np.float32), lengths)


class Scorer:
    """One worker's scorer; unseen words are kept in a cache of bounded size."""

    def __init__(self, model: Model, cache: int = 200_000):
        self.m, self.limit = model, cache
        self.index = dict(model.words)
        self.rows = np.zeros((len(model.words) + cache + 1, len(model.langs)), np.float32)
        self.rows[: len(model.words)] = model.word_logs
        self.used = self.base = len(model.words)

    def back_off(self, word: str) -> np.ndarray:
        get = self.m.grams.get
        for n in self.m.lengths:
            total, k, found = np.zeros(len(self.m.langs), np.float64), 0, (i for g in _grams(word, n) if (i := get(g)) is not None)
            while some := list(islice(found, 1 << 16)):  # a word may be as long as a text
                total += self.m.gram_logs[some].sum(0, dtype=np.float64)
                k += len(some)
            if k:
                return (total / k).astype(np.float32)
        return np.full(len(self.m.langs), PENALTY, np.float32)

    def score(self, text: str | None) -> tuple[str, float]:
        total, n = np.zeros(len(self.m.langs)), 0
        low, letters, at = (text or "").lower(), False, 0
        while at < len(low):
            end = at + PIECE
            if end < len(low):  # to the end of the word that the piece would cut
                end = gap.start() if (gap := GAP.search(low, end)) else len(low)
            words = WORD.findall(low, at, end)
            at = end
            if not words:
                continue
            letters = letters or any(c.isalpha() for w in words for c in w)
            if not self.m.langs:
                continue
            ids = list(map(self.index.get, words))
            if None in ids:
                for k, i in enumerate(ids):
                    if i is None:
                        ids[k] = self.learn(words[k], total)
            ids = [i for i in ids if i is not None]
            total += self.rows[ids].sum(0, dtype=np.float64)
            n += len(words)
        if not letters or not n:
            return "und", 0.0
        mean = total / n
        p = np.exp((mean - mean.max()) * math.log(10) * min(n, 20))
        best = int(np.argmax(p))
        return self.m.langs[best], float(p[best] / p.sum())

    def learn(self, word: str, total: np.ndarray) -> int | None:
        i = self.index.get(word)
        if i is not None:
            return i
        if self.used - self.base >= self.limit or len(word) > LONG_WORD:
            total += self.back_off(word)  # not kept: as good, only slower
            return None
        i = self.used
        self.rows[i] = self.back_off(word)
        self.index[word] = i
        self.used += 1
        return i


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs' columns doc_id and text's prediction: lang_pred, score (0 to 1).

    `und` and 0.0 for a null text, one without letters, or an empty model. Repeated rows and ids come
    out as often as they go in; columns besides doc_id and text are not read.
    """
    parts = (model.langs, model.words, model.word_logs, model.grams, model.gram_logs, model.lengths)
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # plain values: executors needn't know the class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value))
        for b in batches:
            if scorer.used - scorer.base >= scorer.limit:
                scorer = Scorer(Model(*shared.value))
            got = [scorer.score(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def op3_language_id(docs: DataFrame) -> DataFrame:
    """Learns from the rows outside fold 0 of 5 (crc32 of doc_id) that have text and lang; predicts every row.

    `und` and 0.0 for null and empty texts, texts without letters, and where nothing could be learnt;
    very long texts are read whole, words across pieces too; languages that tie go by name; repeated rows
    come out as often as they go in; columns besides doc_id, text and lang are not read. An empty table
    gives an empty one.
    """
    fold = fold_of("doc_id", 5)
    model = train(docs.where(fold != 0))
    return identify(docs, model).select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")
