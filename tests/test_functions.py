"""Functions on small rows, held against Python's own re where it says the same."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from codexmill.functions import classify, encoding, extract, markup
from codexmill.functions import text as tx
from codexmill.plans.pipeline import analyse, clean_step, finish
from codexmill.sources.schemas import ENTRY


def one(spark, f, *values):
    schema = ", ".join(f"c{i} string" for i in range(len(values)))
    r = spark.createDataFrame([values], schema).select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]
    return r.asDict() if hasattr(r, "asDict") else r


TEXTS = [
    "", None, "#REDIRECT [[Angst]]", "#REDIRECT[[Angst]]", "[[Category:Fiction / Volumes (German)|Angst]]", "===Volumes===\n'''A Title'''\n<lst type=bracket>\nFischer Verlag, Frankfurt am Main, 1970\n432 p.\n</lst>",
    "'''T''' Translated by Jean Example, Paris 1946", "[[X|y]] [[Category:C]] [[Z]]", "1815, 1942, 2019, 2001; 1799; 2031", "Zhozef Fushe [Joseph Fouché]", "x y \r z", "Müller, übersetzt", "a ''b'' c\n\n d",
]


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("pattern,ignore", [(extract.YEAR, False), (r"\b(translation|translated by|übersetzt)\b", True), (r"'''(.*?)'''", False), (r"\[\[(.*?)\]\]", False), (r"(\w+)\s", False)])
def test_patterns_are_pythons(spark, text, pattern, ignore):
    flags = re.IGNORECASE if ignore else 0
    expected = [m if isinstance(m, str) else m[0] for m in re.findall(pattern, text or "", flags)]
    got = one(spark, lambda c: tx.every(F.coalesce(c, F.lit("")), pattern, 1, ignore), text)
    assert got == expected
    assert one(spark, lambda c: tx.matches(c, pattern, ignore), text) == bool(text and re.search(pattern, text, flags))


@pytest.mark.parametrize(
    "text,expected",
    [("#REDIRECT [[Angst]]", "Redirect"), ("[[Category:X]]", "Category"), ("12 p.", "Bibliography Entry"), ("An Essay", "Essay"), ("an essay", "Unknown"), ("Übersetzung", "Translation"), ("Lyrik", "Poetry"), ("A Letter", "Correspondence"), ("", "Unknown"), (None, "Unknown")],
)
def test_types(spark, text, expected):
    assert one(spark, classify.identify_content_type, text) == expected


@pytest.mark.parametrize("text,expected", [("[[Category:X]] essay", "Category"), ("Volumes", "Bibliography Entry"), ("ESSAY", "Essay"), ("es ist übersetzt", "Translation"), ("Rezension", "Review"), ("ein Brief", "Correspondence"), ("the Movie", "Film/Media"), ("Biographie", "Biography"), ("none", "Other"), (None, None)])
def test_classes(spark, text, expected):
    assert one(spark, classify.classify_content, text) == expected


@pytest.mark.parametrize("broken,repaired", [("Ã¤ Ã¶ Ã¼ ÃŸ", "ä ö ü ß"), ("Ã¡ Ã© Ã³ Ãº Ã±", "á é ó ú ñ"), ("Ä€ Ä« Å« á¹£ á¸¥", "Ā ī ū ṣ ḥ"), ("wÃ¤re", "wäre"), ("Ärger Ñandú 日本", "Ärger Ñandú 日本"), ("a &amp;lt; b&nbsp;c &#8211;", "a &lt; b c –"), ("x\u0001​﻿y", "xy"), (None, None)])
def test_encoding(spark, broken, repaired):
    assert one(spark, encoding.fix_encoding_deep, broken) == repaired


def test_encoding_compat(spark):
    assert one(spark, lambda c: encoding.fix_encoding(c, compat=True), "Ärger Ñandú") == "črger Нandú"


@pytest.mark.parametrize("broken,repaired", [("wÃ¤re", "wäre"), ("â€œAâ€™", "“A’"), ("KongreÃŸes", "Kongreßes"), ("Ñandú", "Ñandú"), ("日本 Ã¤", "日本 Ã¤"), ("plain", "plain")])
def test_bytes(spark, broken, repaired):
    assert one(spark, encoding.fix_bytes, broken) == repaired


def test_nfc_and_titles(spark):
    assert one(spark, encoding.nfc, "ä") == "ä"
    assert one(spark, encoding.nfc, None) is None
    assert one(spark, encoding.decode_hex_title, "0x466f7563686ec3a9") == "Fouchné"
    assert one(spark, encoding.decode_hex_title, "0xzz") is None


@pytest.mark.parametrize("text,plain", [("[[X|y]] [[Category:C]] [[Z]]", "y Z"), ("[[Z]] mid [[X|y]] end", "Z mid y end"), ("'''b''' ''i''", "b i"), ("<lst type=x>a\nb</lst>", "a b"), ("say \\\"x\\\" it\\'s", "say \"x\" it's"), (None, ""), ("", "")])
def test_markup(spark, text, plain):
    assert one(spark, markup.remove_wiki_markup, text) == plain


def test_markup_compat(spark):
    assert one(spark, lambda c: markup.remove_wiki_markup(c, compat=True), "[[Z]] mid [[X|y]] end") == "y end"


@pytest.mark.parametrize("year,period", [("1799", 0), ("1880", 0), ("1881", 1), ("1942", 1), ("1943", 2), ("1980", 2), ("1981", 3), ("2000", 3), ("2001", 4), ("x", None), (None, None)])
def test_periods(spark, year, period):
    assert one(spark, extract.time_period, year) == ("" if period is None else extract.PERIODS[period])


def test_fields(spark):
    text = TEXTS[5]
    got = spark.createDataFrame([(text,)], "c string").select(*[v.alias(k) for k, v in extract.biblio_info(F.col("c")).items()]).first()
    assert (got["year"], got["location"], got["page_count"]) == ("1970", "Frankfurt", "432")
    assert one(spark, extract.content_title, text) == "A Title"
    assert one(spark, extract.content_title, "\n  first \n second") == "first"
    assert one(spark, extract.titles, TEXTS[9]) == {"title": "Zhozef Fushe", "original": "Joseph Fouché"}
    assert one(spark, extract.titles, "Contents\n1. A [X]. Tr\n2. B [Y]") == {"title": "1. A * 2. B", "original": "X * Y"}
    assert one(spark, extract.original_title, "T [O] more [P]", "T") == "O"
    assert one(spark, extract.page_count, "in all 12 pages") == "12"
    assert one(spark, extract.catalog_numbers, "12,34") == {"catalog_number_1": "12", "catalog_number_2": "34"}
    assert one(spark, extract.detect_language, "German edition") == "German"
    assert one(spark, lambda c: extract.detect_language(c, compat=True), "German edition") == "edition"
    assert one(spark, extract.detect_language, "x [[Category:A (French)]]") == "French"
    assert one(spark, extract.publisher_location, 'Moskva: "Raduga", 1990') == {"publisher": "Raduga", "location": "Moskva"}
    assert one(spark, extract.scored_year, "printed 1950 [1933]") == {"year": "1933", "confidence": 0.8}
    assert one(spark, extract.scored_publisher, "Verlag: Insel") == {"publisher": "Insel", "confidence": 0.9}
    assert one(spark, extract.iso_by_indicators, "herausgegeben, translated, Verlag") == "de" and one(spark, extract.iso_by_indicators, None) is None
    assert one(spark, lambda c: extract.language_from_categories(markup.categories(c)), "[[Category:Z (Hindi)]]") == "Hindi"


def test_content_items(spark):
    text = "Contents\n1. Angst [Fear]. Translated by Jo Doe, pp. 3-9\n2. Amok\n\nmore"
    got = spark.createDataFrame([(text,)], "c string").select(extract.content_items(F.col("c")).alias("x")).first()["x"]
    assert [tuple(r) for r in got] == [("Angst", "Fear", "Jo Doe", "3-9"), ("Amok", "", "", "")]
    assert one(spark, extract.content_items, None) == []


def test_helpers(spark):
    assert one(spark, lambda c: tx.count_literal(c, "),("), "a),(b),(c") == 2
    assert one(spark, lambda c: tx.find(c, "b"), "abc") == 1
    assert one(spark, lambda c: tx.mysql_substring(c, F.lit(0), 2), "abc") == ""
    assert one(spark, tx.leading_int, " 12a") == 12
    assert one(spark, tx.strip, "  x\n") == "x"
    assert one(spark, tx.shorten_label, "a" * 30 + "/b/" + "c" * 20) == "a" * 30 + "/.../" + "c" * 20


def test_pipeline_on_empty_and_odd_entries(spark):
    rows = [(1, "Angst", "1,2", t, "utf-8", 1) for t in TEXTS]
    out = finish(clean_step(analyse(spark.createDataFrame(rows, ENTRY))))
    got = out.collect()
    assert len(got) == len(TEXTS) and out.columns[:4] == ["page_id", "text_id", "catalog_number_1", "catalog_number_2"]
    assert all(v is not None for r in got for v in r)
    assert finish(clean_step(analyse(spark.createDataFrame([], ENTRY)))).count() == 0


def test_pipeline_computes_no_column_that_the_final_table_has_not(spark):
    out = finish(clean_step(analyse(spark.createDataFrame([(1, "Angst", "1,2", "x", "utf-8", 1)], ENTRY))))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [c for c in ("content_title", "title_match", "content_type", "redirect_target", "blob_id") if f"{c}#" in plan and f"AS {c}#" in plan]


def test_texts_below_u0300_pass_the_nfc_gate_by_one_comparison(spark):
    assert encoding.UNSTABLE.startswith("[\\u0300-\\x{10FFFF}&&[")
    points = [i for i in range(0x80, 0x11000) if not 0xD800 <= i < 0xE000]
    gated = {ord(r["c"]) for r in spark.createDataFrame([(chr(i),) for i in points], "c string").where(F.col("c").rlike(encoding.UNSTABLE)).collect()}
    assert {i for i in points if unicodedata.normalize("NFC", chr(i)) != chr(i)} <= gated and min(gated) == 0x300
    assert {ord(x) for x in "̈ᅡᆨक़"} <= gated and not {ord(x) for x in "äéß€“д"} & gated


@pytest.mark.parametrize("runs", [500, 1])
def test_nfc_sends_runs_instead_of_texts(spark, monkeypatch, runs):
    monkeypatch.setattr(encoding, "RUNS", runs)
    marks = ["a", "A", " ", "o", "\u0308", "\u0323", "\u0344", "\u0958", "\u1100", "\u1161", "\u11a8", "\uac00", "\u212b", "\U0001d15e", "\u09c7", "\u09be"]
    r = random.Random(4)
    texts = ["".join(r.choices(marks, k=r.randint(0, 30))) for _ in range(400)] + ["plain", "", None, "a\u0308\u0323 a\u0308 \u0308"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string").select("i", encoding.nfc(F.col("c")).alias("n"))
    assert {x["i"]: x["n"] for x in df.collect()} == {i: t if t is None else unicodedata.normalize("NFC", t) for i, t in enumerate(texts)}
    assert "_composed(CASE WHEN" in df._jdf.queryExecution().optimizedPlan().toString()
