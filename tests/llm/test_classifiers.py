"""Held-out accuracy of what is learnt, and odd rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from codexmill.llm import langid, licences, quality, toxicity
from codexmill.llm.langid import Model, Scorer
from tests.llm.conftest import prose

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{D}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{D}/labels.parquet")


def test_language_held_out(docs):
    got = langid.op3_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.98 and all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(spark, odd, empty):
    got = langid.op3_language_id(odd).collect()
    assert len(got) == odd.count()
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for r in got:
        if r["doc_id"] in (4, 5):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None and any(c.isalpha() for c in texts[r["doc_id"]] or ""):
            assert r["lang_pred"] in ("en", "fr")
    assert langid.op3_language_id(empty).count() == 0
    blind = spark.createDataFrame([(1, "12 34", "en"), (2, "abc", None)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.op3_language_id(blind.where("doc_id = 1")).collect()} == {"und"}


def test_back_off_and_full_cache(docs):
    model = langid.train(docs.where("doc_id < 200"))
    small, large = Scorer(model, cache=3), Scorer(model)
    for text in ("Xyzthing einkeitung unbekannteswort " * 3, "éelle aiment quiquoi"):
        a, b = small.score(text), large.score(text)
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-6
    assert Scorer(Model(["a"], {}, large.rows[:0, :1], {}, large.rows[:0, :1], (2, 1))).score("word") == ("a", 1.0)
    assert Scorer(Model([], {}, large.rows[:0, :0], {}, large.rows[:0, :0], (2, 1))).score("word")[0] == "und"


def test_pieces_do_not_change_a_score(docs, monkeypatch):
    model = langid.train(docs.where("doc_id < 200"))
    texts = [" ".join(prose(i, 40) for i in range(3)) + " 12 éelle aiment", "x" * 500 + " the and of", "12 " * 300, "ab1cd_ef " * 50]
    whole = [Scorer(model).score(t) for t in texts]
    for size in (1, 7, 64):
        monkeypatch.setattr(langid, "PIECE", size)
        for t, (lang, p) in zip(texts, whole, strict=True):
            got = Scorer(model).score(t)
            assert got[0] == lang and abs(got[1] - p) < 1e-5


def brute_language(model, text):
    """The same by its definition, word by word."""
    import math

    words = langid.WORD.findall((text or "").lower())
    if not any(c.isalpha() for w in words for c in w):
        return "und", 0.0
    sums = [0.0] * len(model.langs)
    for w in words:
        if w in model.words:
            logs = model.word_logs[model.words[w]]
        else:
            logs = [langid.PENALTY] * len(model.langs)
            for n in model.lengths:
                padded = f"\x02{w}\x03"
                rows = [model.grams[g] for g in (padded[i : i + n] for i in range(len(padded) - n + 1)) if g in model.grams]
                if rows:
                    logs = [sum(float(model.gram_logs[r][j]) for r in rows) / len(rows) for j in range(len(model.langs))]
                    break
        sums = [a + float(b) for a, b in zip(sums, logs, strict=True)]
    mean = [x / len(words) for x in sums]
    p = [10 ** ((x - max(mean)) * min(len(words), 20)) for x in mean]
    return model.langs[mean.index(max(mean))], max(p) / sum(p)


def test_language_is_brute_force(docs, odd):
    model = langid.train(docs.where("doc_id < 300"))
    for df in (docs.where("doc_id % 9 = 0"), odd):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        got = sorted((tuple(r) for r in langid.identify(df, model).collect()), key=repr)
        want = sorted(((i, *brute_language(model, t)) for i, t in rows), key=repr)
        assert [r[:2] for r in got] == [r[:2] for r in want] and all(abs(a[2] - b[2]) < 1e-4 for a, b in zip(got, want, strict=True))


def test_model_size_is_bounded(docs, monkeypatch):
    assert langid.share(4, 6) >= 30_000 and all(langid.share(n, 6) * 6 * n <= langid.ENTRIES and langid.share(n, 6) * 6 * n * n <= langid.CELLS for n in (1, 4, 50, 500))
    monkeypatch.setattr(langid, "ENTRIES", 600)
    model = langid.train(docs)
    assert 0 < len(model.words) + len(model.grams) <= 600


def test_too_many_languages_is_an_error(docs):
    with pytest.raises(ValueError):
        langid.train(docs, max_langs=2)


def f1(rows, label):
    held = [r for r in rows if r["held_out"] and r[label] is not None]
    hit = sum(r["predicted"] == 1 and r[label] == 1 for r in held)
    return 2 * hit / max(1, sum(r["predicted"] == 1 for r in held) + sum(r[label] == 1 for r in held)), held


def test_quality_held_out(docs, labels):
    rows = quality.op7_quality(docs, labels).join(labels, "doc_id").collect()
    score, held = f1(rows, "quality")
    assert score >= 0.95 and sum(r["predicted"] != r["quality"] for r in held) / len(held) <= 0.05


def test_quality_rules_are_what_is_scored(spark, docs, labels):
    rules = quality.train(docs, labels)
    rows = docs.limit(50).select(quality.statistics(F.col("text")).alias("s")).select("s", rules.score(F.col("s")).alias("score")).collect()
    import math

    for r in rows:
        z = rules.bias + sum(w for rule, w in zip(rules.rules, rules.weights, strict=True) if all((r["s"][k] > at) == above for k, above, at in rule))
        assert abs(1 / (1 + math.exp(-z)) - r["score"]) < 1e-9


def test_toxicity_held_out(docs, labels):
    rows = toxicity.op10_toxicity(docs, labels).join(labels, "doc_id").collect()
    score, held = f1(rows, "toxic")
    clean = [r for r in held if r["toxic"] == 0]
    assert score >= 0.7  # some 300 rows to learn from
    assert sum(r["predicted"] for r in clean) / len(clean) <= 0.05
    toxic = [r["score"] for r in held if r["toxic"] == 1]
    assert sum(toxic) / len(toxic) > 2 * sum(r["score"] for r in clean) / len(clean)


def test_toxicity_held_out_with_more_labels(spark):
    tables = [spark.read.parquet(f"{D.replace('0.01', '0.1')}/{t}.parquet") for t in ("documents", "labels")]
    rows = toxicity.op10_toxicity(*tables).join(tables[1], "doc_id").collect()
    score, held = f1(rows, "toxic")
    toxic, clean = ([r["predicted"] for r in held if r["toxic"] == y] for y in (1, 0))
    assert sum(toxic) / len(toxic) >= 0.88 and sum(clean) / len(clean) <= 0.012 and score >= 0.9


def test_toxicity_calibration():
    import numpy as np

    r = np.random.default_rng(1)
    margin = r.normal(0, 3, 4000)
    y = (r.random(4000) < 1 / (1 + np.exp(-(0.5 * margin - 1)))).astype(float)
    slope, offset = toxicity.calibrate(margin, y)
    assert abs(slope - 0.5) < 0.06 and abs(offset + 1) < 0.15
    assert toxicity.calibrate(margin, np.ones(4000)) == (1.0, 0.0)
    assert toxicity.calibrate(np.where(y > 0, 1e9, -1e9), y)[0] > 0  # parted without error


def test_one_id_in_many_rows_is_learnt_from_once(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    once = spark.createDataFrame([(i, f"{prose(i, 20)} {'bad deed' if i % 2 else ''}") for i in range(60)], "doc_id long, text string")
    many = once.union(spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("zz other "), F.col("id").cast("string"))))
    assert toxicity.train(many, labels, bound=60)[2] is not None
    assert quality.train(many, labels, bound=60).bias == quality.train(many.repartition(3), labels, bound=60).bias


def test_toxicity_learns_pairs_and_skips(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(1500):
        w = [r.choice(words) for _ in range(30)]
        y = i % 3 == 0
        if y:
            k = r.randrange(27)
            w[k], w[k + (2 if i % 2 else 1)] = "bad", "deed"
        elif i % 3 == 1:
            w[3], w[20] = "bad", "deed"
        rows.append((i, " ".join(w), int(y)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.op10_toxicity(df, df.select("doc_id", "toxic")).join(df.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert sum(x["predicted"] == x["toxic"] for x in got) / len(got) >= 0.95


@pytest.mark.parametrize("op", [quality.op7_quality, toxicity.op10_toxicity])
def test_scores_of_odd_rows(spark, odd, empty, op):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (3, None, None), (None, 1, 1), (7, 1, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    got = op(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert op(empty, labels).count() == 0
    assert op(odd, labels.limit(0)).count() == odd.count()


def test_licences(spark, odd, empty, docs):
    notices = [(i, f"some words\n{t}\nmore", f) for i, (f, t) in enumerate((f, t) for f, ts in licences.NOTICES.items() for t in ts)]
    other = [(1000, "He lost his driving license in court.", None), (1001, "plain words only", None), (1002, None, None), (1003, "", None), (1004, "Released under the MIT License.\nLicensed under CC BY 4.0.", None)]
    rows = spark.createDataFrame([(i, t) for i, t, _ in notices + other], "doc_id long, text string").unionByName(docs.select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 5000))
    got = {r["doc_id"]: r for r in licences.op9_licence_scan(rows).collect()}
    right = sum(got[i]["licence"] == f for i, _, f in notices)
    assert right / len(notices) >= 0.9
    assert not got[1000]["confirmed"] and got[1000]["licence"] == "unknown"
    assert got[1001]["licence"] == got[1002]["licence"] == got[1003]["licence"] == "none"
    assert got[1004]["families"] == "CC-BY,MIT" and got[1004]["n_paragraphs"] == 2
    assert all(0 <= r["probability"] <= 1 for r in got.values()) and len(got) == rows.count()
    assert licences.op9_licence_scan(odd).count() == odd.count()
    assert licences.op9_licence_scan(empty).count() == 0


def scanned(spark, docs, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(docs.select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 5000))
    got = {r["doc_id"]: r for r in licences.op9_licence_scan(rows).where("doc_id < 5000").collect()}
    return [got[i] for i in range(len(texts))]


def test_licence_lines_that_are_parts_of_a_notice(spark, docs):
    lines = ["All rights reserved.", "ALL RIGHTS RESERVED", "Copyright 2019 Jane Roe. All rights reserved.", "plain words\nAll rights reserved.\nmore words"]
    assert [r["licence"] for r in scanned(spark, docs, lines)] == ["Proprietary"] * 4
    assert not any(r["confirmed"] for r in scanned(spark, docs, ["She reserved a table with permission of all.", "The rights to the copy of it", "All copyright."]))


def test_licence_notices_wrapped(spark, docs):
    import textwrap

    known = [(f, t) for f, ts in licences.NOTICES.items() for t in ts if len(t) > 150]
    shapes = [(width, mark) for width in (40, 72, 80) for mark in ("", "// ", " * ")]
    wrap = lambda t, width, mark: "Some words before\n" + "\n".join(mark + x for x in textwrap.wrap(t, width)) + "\nand after"
    got = scanned(spark, docs, [wrap(t, *s) for _, t in known for s in shapes])
    want = [f for f, _ in known for _ in shapes]
    assert [(f, r["licence"]) for f, r in zip(want, got, strict=True) if r["licence"] != f] == []
    assert all(r["families"] == f for f, r in zip(want, got, strict=True))


def test_licence_lines_without_an_english_cue(spark, docs):
    known = {
        "Available under CC-BY-SA-4.0.": "CC-BY-SA", "Released under Apache-2.0.": "Apache-2.0", "Distributed under BSD-3-Clause.": "BSD", "Licensed under CC-BY-4.0.": "CC-BY",
        "Veröffentlicht unter der MIT-Lizenz.": "MIT", "Dieser Text steht unter der CC-BY-NC-Lizenz.": "CC-BY-NC", "Ce texte est publié sous licence MIT.": "MIT",
        "Este texto se distribuye bajo la licencia GPLv3.": "GPL-3.0", "Made available under GPL-2.0-or-later.": "GPL-2.0", "Released under MIT.": "MIT",
    }
    got = [r["licence"] for r in scanned(spark, docs, list(known))]
    assert dict(zip(known, got, strict=True)) == known
    none = ["Er kam mit der Bahn unter der Brücke.", "The film was released in May.", "Publié à Paris.", "Apache helicopters were available."]
    assert not any(r["confirmed"] for r in scanned(spark, docs, none))
    assert {r["licence"] for r in scanned(spark, docs, none)} == {"none"}


#: Wordings and names that the operator doesn't learn from.
WORDINGS = [
    "You may use this under the terms of the {} license.", "This project uses the {} license", "The software is {} licensed.", "Code is released as {}", "{} (see LICENSE)",
    "Der Quelltext ist unter {} lizenziert.", "Alle Inhalte stehen unter {}.", "Le texte est distribué selon les termes de la licence {}.", "Este programa está bajo la licencia {}.",
    "Copyright 2021 Jane Roe, licensed under {}", "Use of these pages is subject to {}.", "Source available under {} at our site", "Licensing: {} for all modules",
    "This document (c) 2015 the authors, {} license", "Dual licensed; this part: {}", "Das Programm wird unter {} veröffentlicht.", "Sauf mention contraire, contenu sous {}.",
    "Salvo indicación contraria, bajo {}.", "Unless noted otherwise, text is under {}.", "Released to everyone under the {} license, no warranty.",
]
KNOWN = {"MIT": "MIT", "Apache-2.0": "Apache-2.0", "BSD": "BSD-2-Clause", "GPL-3.0": "GPLv3", "GPL-2.0": "GPL-2.0", "CC-BY-SA": "CC-BY-SA-4.0", "CC0": "CC0", "MPL-2.0": "MPL-2.0", "ISC": "ISC", "LGPL": "LGPL-2.1"}


def test_licence_wordings_that_were_not_learnt(spark, docs):
    texts = [(w.format(n), f) for w in WORDINGS for f, n in KNOWN.items() if w not in licences.FORMS]
    got = scanned(spark, docs, [t for t, _ in texts])
    right = sum(r["licence"] == f for (_, f), r in zip(texts, got, strict=True))
    assert right / len(texts) >= 0.9
    wrong = [(t, r["licence"]) for (t, f), r in zip(texts, got, strict=True) if r["licence"] not in (f, "unknown", "none")]
    assert len(wrong) / len(texts) <= 0.01


def test_short_statements_of_licences(spark, docs):
    known = {"Released under the Apache 2.0 terms.": "Apache-2.0", "Code: Apache-2.0": "Apache-2.0", "Distributed under BSD-3-Clause": "BSD", "Released under MIT": "MIT", "Dieses Werk steht unter der MIT-Lizenz.": "MIT", "SPDX: BSD-3-Clause": "BSD"}
    assert dict(zip(known, [r["licence"] for r in scanned(spark, docs, list(known))], strict=True)) == known
    none = ["ER KAM MIT DER BAHN UNTER DER BRÜCKE.", "Er kam mit der Bahn.", "Version 2.0 of the plan was released under pressure.", "An ISO standard and a public mission.", "Two clauses of the bill were available to all."]
    assert not any(r["confirmed"] for r in scanned(spark, docs, none))


def test_licence_odd_rows(spark, odd):
    rows = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(20, "Released under the MIT License."), (20, "Released under the MIT License."), (20, "plain")], "doc_id long, text string"))
    got = [(r["doc_id"], r["licence"], r["n_paragraphs"]) for r in licences.op9_licence_scan(rows).collect()]
    assert sorted((x for x in got if x[0] == 20), key=repr) == [(20, "MIT", 1), (20, "MIT", 1), (20, "none", 0)]
    assert all(x[1:] == ("none", 0) for x in got if x[0] != 20) and len(got) == rows.count()
