import hashlib
import random

import pytest
from pyspark.sql import functions as F

from codexmill.llm import fingerprint
from codexmill.llm.fingerprint import Walk, edit_distance, likeness
from tests.llm.conftest import prose


def test_edit_distance():
    r = random.Random(3)
    for _ in range(200):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 12))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        assert edit_distance(a, b) == row[-1]
        assert [min(edit_distance(a, b, m), m + 1) for m in range(13)] == [min(row[-1], m + 1) for m in range(13)]
        assert fingerprint.alike(a, b, 0.8) == (5 * row[-1] <= max(len(a), len(b)))


@pytest.mark.parametrize("n", [40, 400, 4000])
def test_likeness_follows_edits(n):
    walk, r = Walk(), random.Random(n)
    a, other = prose(n, n), prose(n + 1, n)
    few = list(a)  # k edits may put as much as some k * k steps out of step: few of them, whatever the length
    for _ in range(2):
        few[r.randrange(len(few))] = "#"
    few = "".join(few[1:])
    fa, fb, fo = walk.fingerprint(a), walk.fingerprint(few), walk.fingerprint(other)
    assert likeness(fa, fa) == 1.0 and likeness(fa, fb) > 0.5 > likeness(fa, fo)
    assert likeness("", "") == 1.0 and likeness(fa, "") == 0.0


def test_walk_goes_on_from_a_prefix(monkeypatch):
    import numpy as np

    text = prose(9, 300)
    whole = Walk().fingerprint(text)
    monkeypatch.setattr(fingerprint, "BLOCK", 100)
    walk, codes = Walk(), np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at, first = walk.go(codes[:777], codes[:0], 0)
    assert walk.finish(np.concatenate([first, walk.go(codes[777:], codes[:777], at)[1]])) == whole == walk.fingerprint(text)


def check(rows, got):
    """rows in order of doc_id; got by op4."""
    for k, (i, text) in enumerate(rows):
        t, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        h = len(t) // 2
        edited = t[: len(t) - h] + after[:h]
        r = got[k]
        assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (i, len(t), hashlib.sha256(edited.encode()).hexdigest())
        walk = Walk()
        assert r["fingerprint"] == walk.fingerprint(t) and r["edited_fingerprint"] == walk.fingerprint(edited)
        assert r["near_edited"] == likeness(walk.fingerprint(t), walk.fingerprint(edited)) and r["near_next"] == likeness(walk.fingerprint(t), walk.fingerprint(after))


@pytest.mark.parametrize("n", [1, 2, 40])
def test_next_documents(spark, n):
    rows = [(i * 7 - 30, None if i == 3 else prose(i, i * 3) + "é" * (i % 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(rows, sorted(fingerprint.op4_fingerprints(df).collect(), key=lambda r: r["doc_id"]))


def test_odd_rows(odd, empty):
    got = fingerprint.op4_fingerprints(odd).collect()
    assert sorted(r["n_chars"] for r in got) == sorted(len(r["text"] or "") for r in odd.collect())
    assert fingerprint.op4_fingerprints(empty).count() == 0


def test_near_classes(spark):
    base = prose(1, 80)
    rows = [(5, base), (2, base), (9, base[:200] + "##" + base[202:]), (7, prose(2, 80)), (3, ""), (4, None), (8, prose(3, 5))]
    got = {r["doc_id"]: r["class_id"] for r in fingerprint.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {5: 2, 2: 2, 9: 2, 7: 7, 3: 3, 4: 3, 8: 8}


def test_near_classes_recall(spark):
    """Near copies with edits of words: of the pairs of edit similarity 0.8 or more, those that one class has."""
    r = random.Random(8)
    texts = []
    for base in range(8):
        words = prose(100 + base, 60).split()
        for _ in range(16):
            w = list(words)
            for _ in range(r.randint(0, 7)):
                w[r.randrange(len(w))] = f"new{r.randrange(10**4)}"
            texts.append(" ".join(w))
    got = {x["doc_id"]: x["class_id"] for x in fingerprint.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    near = [(i, j) for i in range(len(texts)) for j in range(i) if fingerprint.alike(texts[i], texts[j], 0.8)]
    assert len(near) > 150
    assert sum(got[i] == got[j] for i, j in near) / len(near) >= 0.9
    assert all(got[i] // 16 == i // 16 for i in got)  # nothing far is linked


def test_alike_is_the_edit_similarity():
    r = random.Random(5)
    for k in range(60):
        a = prose(k, r.randint(8, 60))
        w = a.split()
        for _ in range(r.randint(0, len(w) // 2)):
            w[r.randrange(len(w))] = r.choice(("new", "x", "longer word"))
        for b in (" ".join(w), prose(k + 500, len(w)), a[len(a) // 5 :], a + "!" * (len(a) // 4)):
            for least in (0.5, 0.8, 0.9):
                assert fingerprint.alike(a, b, least) == (edit_distance(a, b) <= int((1 - least) * max(len(a), len(b)) + 1e-9))


def test_near_classes_odd_rows(odd, empty):
    rows = odd.select("doc_id", "text").collect()
    got = fingerprint.near_classes(odd).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted((r["doc_id"] for r in rows), key=repr)
    by = {r["doc_id"]: r["class_id"] for r in got}
    assert by[1] == by[2] == 1 and by[4] == 4 and by[7] == 7 and by[8] == 8
    assert fingerprint.near_classes(empty).count() == 0


def test_many_rows_without_id(spark):
    """A null id that fills most runs is split by the texts' hashes."""
    rows = [(None, prose(i, 12)) for i in range(300)] + [(i, prose(1000 + i, 12)) for i in range(60)] + [(77, "same")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    runs = fingerprint._in_order(df.withColumn("th", fingerprint.text_hash())).collect()
    own = [x for x in runs if not x["tail"]]
    sizes = [sum(x["run"] == k for x in own) for k in {x["run"] for x in own}]
    assert len(own) == len(rows) and max(sizes) <= 0.6 * len(rows) and len(runs) <= len(rows) + 12
    texts = [x["text"] for x in sorted(own, key=lambda x: (x["doc_id"] is not None, x["doc_id"], x["th"]) if x["doc_id"] is not None else (False, 0, x["th"]))]
    got = fingerprint.op4_fingerprints(df).collect()
    pairs = sorted(hashlib.sha256((t[: len(t) - len(t) // 2] + a[: len(t) // 2]).encode()).hexdigest() for t, a in zip(texts, texts[1:] + texts[:1], strict=True))
    assert sorted(x["edited_sha256"] for x in got) == pairs


def test_walks_together_are_walks_alone(monkeypatch):
    sides = [(seed, backward) for seed in (0, 1) for backward in (False, True)]
    texts = [prose(i, i) for i in range(40)] + ["", "a", "\U0001f600b" * 30, "é" * 500]
    walks = fingerprint.Walks(sides)
    for bound in (1 << 23, 3000):
        monkeypatch.setattr(fingerprint, "TOGETHER", bound)
        for text, own in zip(texts, walks.hashes(texts), strict=True):
            assert [walk.finish(walk.letters[(h >> fingerprint.U(58)).astype(int)]) for (walk, _), h in zip(walks.sides, own, strict=True)] == [walk.fingerprint(text, backward) for walk, backward in walks.sides]


def test_near_lists_hold_no_texts_by_length_alone(spark):
    """Texts of about one length that have nothing in common share hardly a list, however many: their fingerprints' padding is no band."""
    rows = [(i, "".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=300 + i % 40))) for i in range(400)]
    kinds = fingerprint.bands(spark.createDataFrame(rows, "doc_id long, text string"), 4, [(0, False), (0, True)]).select(F.col("th").alias("kind"), "n_chars", "bands")
    assert kinds.where("size(bands) > 20").count() == 400 and fingerprint._lists(kinds, 0.8).count() <= 20
