"""The set join, repeated passages and decontamination against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from codexmill.llm import decontam, graph, jaccard, substring
from tests.llm import brute
from tests.llm.conftest import WORDS, prose


def near_copies(n, edits, seed, length=150):
    r = random.Random(seed)
    base = prose(seed, length).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("seed,edits,length", [(1, 3, 150), (2, 8, 150), (3, 4, 60), (4, 1, 12)])
def test_jaccard_is_brute_force(spark, seed, edits, length):
    texts = near_copies(120, edits, seed, length) + [prose(1000 + i, 80) for i in range(60)]
    passage = prose(77, 60)
    texts += [f"{prose(2000 + i, 20)} {passage} {prose(3000 + i, 20)}" for i in range(60)] + [passage] * 5 + [passage.upper()]
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    got = [tuple(r) for r in jaccard.op5_ngram_jaccard(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(brute.jaccard(rows))


def test_sets_that_share_an_id_are_told_apart(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 11, 5, 50, 3), (2, 12, 5, 50, 3), (3, 13, 6, 50, 3), (4, 14, 6, 51, 3), (5, 15, 7, 50, 3), (6, 16, 7, 50, 4)], "doc_id long, th long, sid long, again long, n long")
    assert {r["sid"]: r["several"] for r in jaccard.distinct_sets(rows).collect()} == {5: False, 6: True, 7: True}
    tried, real = [], jaccard.shingles

    def colliding(docs, width, percent, slack, keep, salt=0):
        tried.append(salt)
        out = real(docs, width, percent, slack, keep, salt)
        return out.withColumn("sid", F.when(F.col("n") > 0, F.lit(1)).otherwise(F.col("sid"))) if salt == 0 else out

    monkeypatch.setattr(jaccard, "shingles", colliding)
    texts = [(1, prose(1, 30)), (2, prose(2, 30)), (3, prose(1, 30))]
    assert sorted(r["component_id"] for r in jaccard.op5_ngram_jaccard(frame(spark, texts)).collect()) == [1, 1, 2] and tried[:2] == [0, 1]


def test_jaccard_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = [tuple(r) for r in jaccard.op5_ngram_jaccard(odd).collect()]
    assert sorted(got, key=repr) == sorted(brute.jaccard(rows), key=repr)
    assert jaccard.op5_ngram_jaccard(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (201, 200)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(50)} == {100} and got[201] == 200
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_repeats_are_brute_force(spark, monkeypatch, hot):
    if hot:  # every anchor has too many segments, and whatever occurs three times is common
        monkeypatch.setattr(substring, "SEGMENTS", 1)
        monkeypatch.setattr(substring, "COMMON", 3)
    r = random.Random(5)
    passages = [prose(500 + i, 40 + 7 * i) for i in range(8)]
    texts = [f"{prose(i, 30)} {passages[r.randrange(8)]} {prose(50 + i, 10)}" for i in range(60)] + near_copies(20, 2, 9, 90)
    texts += [passages[0][: len(passages[0]) // 2], "ab " * 200, "ab ab " * 20, prose(999, 34), prose(999, 34), prose(998, 35), prose(998, 35), "", None]
    rows = list(enumerate(texts))
    got = {x["doc_id"]: x for x in substring.op6_substring_dedup(frame(spark, rows)).collect()}
    for (i, _), (n, gone, kept) in zip(rows, brute.repeats(texts), strict=True):
        assert (got[i]["n_words"], got[i]["n_removed"]) == (n, gone)
        assert got[i]["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_common_segments_are_bounded_and_told_by_both_hashes(spark, monkeypatch):
    known = np.array([[3, 5, 9], [30, 50, 90]])
    assert substring._among_segments(np.array([30, 31, 90, 50]), np.array([3, 3, 9, 9]), known).tolist() == [True, False, True, False]
    monkeypatch.setattr(substring, "COMMON", 2)
    passages = [prose(500 + i, 60) for i in range(6)]
    texts = [f"{prose(i, 10)} {passages[i % 6]}" for i in range(48)]
    want = brute.repeats(texts)
    for bound in (200_000, 20, 0):
        monkeypatch.setattr(substring, "BROADCAST_ANCHORS", bound)
        got = {x["doc_id"]: x["n_removed"] for x in substring.op6_substring_dedup(frame(spark, list(enumerate(texts)))).collect()}
        assert [got[i] for i in range(48)] == [gone for _, gone, _ in want]


def test_repeats_odd_rows(odd, empty):
    rows = odd.select("doc_id", "text").collect()
    expected = [(r["doc_id"], n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest()) for r, (n, gone, kept) in zip(rows, brute.repeats([r["text"] for r in rows]), strict=True)]
    assert sorted((tuple(r) for r in substring.op6_substring_dedup(odd).collect()), key=repr) == sorted(expected, key=repr)
    assert substring.op6_substring_dedup(empty).count() == 0


def test_clean_text_keeps_layout(spark):
    p = prose(3, 40)
    rows = [(1, f"first line\n\n{p}\nlast  line"), (2, f"{p} end"), (3, "no\n repeat")]
    got = {r["rest"]["doc_id"]: r["clean"] for r in substring.remove_repeated(frame(spark, rows)).collect()}
    assert got == {1: "first line\nlast  line", 2: "end", 3: "no\n repeat"}


ITEMS = [(1, prose(11, 30)), (2, prose(12, 8)), (3, "short item here"), (4, prose(11, 30)), (5, None), (6, "  "), (7, "Élan vital of THE people in two small towns"), (8, "zz")]


def test_leaks_are_brute_force(spark, odd):
    r = random.Random(2)
    texts = [f"{prose(100 + i, 20)}, {' '.join(ITEMS[r.randrange(2)][1].split()[:r.randint(5, 30)])}. {prose(200 + i, 9)}" for i in range(50)]
    texts += ["a Short-item HERE!", "élan vital of the people in two small towns", "Élan Vital of the people in two small towns.", "zz", None, "", prose(12, 8).upper()]
    rows = list(enumerate(texts))
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {x["doc_id"]: x for x in decontam.op8_decontamination(frame(spark, rows), benchmark).collect()}
    for (i, _), (n, hit, found) in zip(rows, brute.leaks(texts, ITEMS), strict=True):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["contaminated"]) == (n, hit, len(found), len(found) >= 2), i
        assert got[i]["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_leaks_odd_rows(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, prose(1, 20)), (2, "one two")], "item_id long, text string")
    rows = odd.select("doc_id", "text").collect()
    items = [(1, prose(1, 20)), (2, "one two")]
    expected = [(r["doc_id"], n, hit, len(found)) for r, (n, hit, found) in zip(rows, brute.leaks([r["text"] for r in rows], items), strict=True)]
    assert sorted((tuple(r)[:4] for r in decontam.op8_decontamination(odd, benchmark).collect()), key=repr) == sorted(expected, key=repr)
    assert decontam.op8_decontamination(empty, benchmark).count() == 0
    none = decontam.op8_decontamination(odd, benchmark.limit(0))
    assert none.agg(F.sum("n_hit"), F.count("*")).first() == (0, len(rows))


def test_leak_cleaning(spark):
    item = prose(11, 10)
    docs = spark.createDataFrame([(1, f"Start, {item}! end.", 0, "x"), (2, "clean  text.", 12, "y"), (3, f"{item} and {prose(12, 9)}", 1, "z"), (4, None, None, None)], "doc_id long, text string, n_chars int, th string")
    benchmark = spark.createDataFrame([(1, item), (2, prose(12, 9))], "item_id long, text string")
    out = decontam.clean(docs, benchmark)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert set(got) == {1, 2, 4} and got[2]["text"] == "clean  text." and got[1]["text"] == "Start! end." and got[1]["n_chars"] == 11 and got[4]["text"] is None


def test_words_list():
    assert len(set(WORDS)) == len(WORDS)
