"""Repair of texts whose UTF-8 bytes were read as Latin-1 or cp1252, entities, control characters, NFC."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from codexmill.functions.text import let

# cp1252's glyphs for the bytes 80-9F that it defines, and those bytes' code points.
CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
C1 = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
# Pairs of broken and repaired text by group, in the order in which they apply. A `\xad` is
# a soft hyphen, the last byte of what it repairs.
CYRILLIC = [("Ä\xad", "ĭ"), ("iā\xad", "iĭ"), ("eā\xadn", "eĭn"), ("shteā\xad", "shteĭ"), ("skiā\xad", "skiĭ")]
INDIC = [("viá¸", "viḍ"), ("á¸am", "ḍam"), ("á¹‡a", "ṇa"), ("á¹£", "ṣ"), ("á¸¥", "ḥ"), ("á¹\xad", "ṭ"), ("á¹ƒ", "ṃ")]
ARABIC = [("Ä€", "Ā"), ("Ä«", "ī"), ("Å«", "ū")]
ARABIC_WORDS = [("DÄr", "Dār"), ("MadÄ", "Madā"), ("ThaqÄfah", "Thaqāfah"), ("BaghdÄd", "Baghdād"), ("ÄshiqÄt", "Āshiqāt"), ("\"'Ālam", "'Ālam"), ("waÊ¾l", "wa'l")]
GERMAN = [("Ã¤", "ä"), ("Ã¶", "ö"), ("Ã¼", "ü"), ("ÃŸ", "ß"), ("Ã„", "Ä"), ("Ã–", "Ö"), ("Ãœ", "Ü")]
SPANISH = [("Ã¡", "á"), ("Ã©", "é"), ("Ã\xad", "í"), ("Ã³", "ó"), ("Ãº", "ú"), ("Ã±", "ñ")]
FRENCH = [("Ã£", "ã"), ("Ãµ", "õ"), ("Ã¢", "â"), ("Ãª", "ê"), ("Ã®", "î"), ("Ã´", "ô"), ("Ã»", "û"), ("Ã§", "ç")]
MORE_FRENCH = [("Ã¨", "è"), ("Ã²", "ò"), ("Ã¹", "ù"), ("Ã€", "À"), ("ÃŠ", "Ê"), ("Ãˆ", "È"), ("Ã‰", "É"), ("Â°", "°")]
EASTERN = [("Å¡", "š"), ("Å½", "Ž"), ("Å¾", "ž"), ("Å™", "ř"), ("Å„", "ń"), ("Å‚", "ł")]
LIGATURES = [("Ã¦", "æ"), ("Å¸", "ÿ")]
QUOTES = [("â€™", "'"), ("â€œ", '"'), ("â€\x9d", '"'), ("â€“", "–"), ("â€”", "—"), ("â€¦", "…")]
TWICE = [("Ã£Â£", "ã"), ("Ã£Â¢", "â")]
ESCAPED = [("\\'Ālam", "'Ālam"), ("fī \\'l", "fī 'l")]
TABLE: list[tuple[str, str]] = [*CYRILLIC, *INDIC, *ARABIC, *ARABIC_WORDS, *TWICE, *GERMAN, *SPANISH, *FRENCH, *MORE_FRENCH, *EASTERN, *LIGATURES, *QUOTES]
# What applies in compat mode only, as it damages texts that are right: patterns where a
# letter before or after matters, and pairs.
HINDI = [("Bhč", "Bhā"), ("č(?=[a-zA-Z])", "ā"), ("Mč", "Mā"), ("(?<=[a-zA-Z])č", "ā"), ("upanyčso", "upanyāso"), ("rūpčntar", "rūpāntar"), ("istuvčrt", "istuvārt")]
GERMAN_WORDS = [("w re ", "wäre "), ("kongre ", "kongre"), ("gre es", "greßes")]
BARE = [("Ä", "č")]
CYRILLIC_BARE = [("Ð", "И"), ("Ñ", "Н"), ('Å"', "œ")]
QUOTES_BARE = [("â€™", "'"), ("â€œ", '"'), ("â€", '"')]
# Entities and what they stand for; &amp; comes last, so that nothing is decoded twice.
ENTITIES: list[tuple[str, str]] = [
    ("&nbsp;", " "), ("&mdash;", "—"), ("&ndash;", "–"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&#8211;", "–"), ("&#8212;", "—"), ("&#8216;", "‘"), ("&#8217;", "’"), ("&#8220;", "“"), ("&#8221;", "”"),
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
]
#: What a byte from 80 to BF looks like when read as cp1252 or Latin-1.
AFTER = f"[\\x80-\\xBF{CP1252}]"
#: A byte pair of broken UTF-8, which marks a text as suspicious: a lead byte's glyph and what may follow it.
SUSPICIOUS = f"[\\u00C2-\\u00F4]{AFTER}"
#: Texts without any of these stay as they are: suspicious pairs, the table's other beginnings, entities, escaped and doubled quotes, controls.
TRIGGER = SUSPICIOUS + "|[ÄāáÊ&]|\\\\[\"']|\"\"|\"'|[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F\\u200B-\\u200D\\u2060\\uFEFF]"
# The nine markers that are counted.
MARKERS = ["Ã¤", "Ã¶", "Ã¼", "Ãœ", "ÃŸ", "Ã©", "Ã¨", "Ã²", "Ã¹"]


def fix_table(c: Column, pairs: list[tuple[str, str]] = TABLE) -> Column:
    """Literal substitutions, in order."""
    for broken, repaired in pairs:
        c = F.replace(c, F.lit(broken), F.lit(repaired))
    return c


def decode_entities(c: Column) -> Column:
    return fix_table(c, ENTITIES)


def fix_bytes(c: Column) -> Column:
    """The text whose UTF-8 bytes were read as cp1252, if c can be that; else c. Texts that are right stay."""

    def again(back: Column) -> Column:
        able = back.rlike(r"^[\x00-\xFF]*\z") & back.rlike(r"[\x80-\xFF]")
        return F.try_validate_utf8(F.when(able, F.encode(back, "ISO-8859-1")).cast("string"))

    return F.coalesce(let(F.translate(c, CP1252, C1), again), c)


def fix_words(c: Column) -> Column:
    """fix_bytes() of each word by itself, for texts that are broken in part."""
    return F.array_join(F.transform(F.split(c, " "), fix_bytes), " ")


def remove_controls(c: Column) -> Column:
    """Without control characters (but tab and line ends), zero-width characters and byte order marks."""
    return F.regexp_replace(c, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F​‌‍⁠﻿]", "")


def fix_quotes(c: Column) -> Column:
    """Without backslashes before double quotes; doubled double quotes become one."""
    return F.replace(F.regexp_replace(fix_table(c, ESCAPED), r'\\+"', '"'), F.lit('""'), F.lit('"'))


def _compat(c: Column) -> Column:
    """The rules as they once were, in their order; most not after a backslash, bare letters and all."""

    def guarded(c: Column, pairs: list[tuple[str, str]], literal: bool = True) -> Column:
        for broken, repaired in pairs:
            pattern = rf"\Q{broken}\E" if literal else broken
            c = F.regexp_replace(c, rf"(?<!\\){pattern}", repaired)
        return c

    t = guarded(guarded(guarded(c, CYRILLIC), INDIC), HINDI, literal=False)
    for group in (ARABIC, ARABIC_WORDS, GERMAN, GERMAN_WORDS, SPANISH, FRENCH, EASTERN[:3], BARE, EASTERN[3:], CYRILLIC_BARE, LIGATURES):
        t = guarded(t, group)
    t = guarded(decode_entities(t), QUOTES_BARE)
    return fix_quotes(guarded(remove_controls(fix_table(t, ESCAPED)), TWICE))


def fix_encoding(c: Column, compat: bool = False) -> Column:
    """Table, entities, quotes, controls; null stays null, and texts without any trigger are not looked at twice.

    compat applies all rules as they once were, also those that damage texts that are right; only the
    single quotes' entities, which once inserted other text, are decoded. NFC is a step of its own: normal().
    """
    if compat:
        return _compat(c)
    return F.when(c.rlike(TRIGGER), remove_controls(fix_quotes(decode_entities(fix_table(c))))).otherwise(c)


def fix_encoding_deep(c: Column, compat: bool = False) -> Column:
    """fix_encoding(), then by bytes where the result is still suspicious, then the table again."""
    again = lambda once: fix_encoding(fix_words(once), compat)
    whole = let(fix_encoding(c, compat), lambda once: F.when(once.rlike(SUSPICIOUS), again(once)).otherwise(once))
    return whole if compat else F.when(c.rlike(TRIGGER), whole).otherwise(c)


def _unstable() -> str:
    """A class of the characters that NFC changes by themselves or in company, from Unicode's data.

    All are U+0300 or above; that is asked first, as the class itself is a chain of many spans.
    """
    changed = [i for i in range(0x300, 0x110000) if not 0xAC00 <= i < 0xE000 and unicodedata.normalize("NFC", chr(i)) != chr(i)]
    jamo, newer = [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)], [*range(0x898, 0x8A0), 0xC3C, *range(0x1AC1, 0x1B00)]  # marks that Java 17 doesn't know yet
    marks = [i for i in range(0x10000, 0x110000) if unicodedata.category(chr(i))[0] == "M"]

    def spans(points: Iterable[int]) -> str:
        found: list[list[int]] = []
        for i in sorted(set(points)):
            if found and i == found[-1][1] + 1:
                found[-1][1] = i
            else:
                found.append([i, i])
        return "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in found)

    above = spans([*marks, *[i for i in changed if i > 0xFFFF]])
    return f"[\\u0300-\\x{{10FFFF}}&&[\\p{{M}}{spans([*[i for i in changed if i <= 0xFFFF], *jamo, *newer])}[\\x{{10000}}-\\x{{10FFFF}}&&[{above}]]]]"


UNSTABLE = _unstable()


#: What NFC may change: such characters with the one before them. Texts with more than RUNS different ones are changed as a whole.
RUN, RUNS = f"(?s)(?:(?!{UNSTABLE}).)?{UNSTABLE}+", 500


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def _composed(runs: pd.Series) -> pd.Series:
    """Pairs of a run and its NFC where they differ, long runs first, so that none is changed within another."""

    def of(parts: Iterable[str]) -> list[list[str]]:
        both = [[x, unicodedata.normalize("NFC", x)] for x in sorted(parts, key=len, reverse=True)]
        return [pair for pair in both if pair[0] != pair[1]]

    return runs.map(lambda parts: None if parts is None else of(parts))


def nfc(c: Column) -> Column:
    """Unicode NFC; Spark has no function for it. Only a text's different runs of what it can change leave the JVM."""
    runs = F.array_distinct(F.regexp_extract_all(c, F.lit(RUN), F.lit(0)))
    pairs = _composed(F.when(c.rlike(UNSTABLE), F.when(F.size(runs) <= RUNS, runs).otherwise(F.array(c))))
    return F.coalesce(F.aggregate(pairs, c, lambda t, pair: F.replace(t, pair[0], pair[1])), c)


def normal(c: Column) -> Column:
    """nfc(), as a step of the pipeline."""
    return nfc(c)


def decode_hex_title(c: Column) -> Column:
    """A title given as 0x-prefixed hexadecimal UTF-8; null if it isn't hexadecimal, and invalid bytes become U+FFFD."""
    return F.make_valid_utf8(F.unhex(F.regexp_replace(c, "^0x", "")).cast("string"))


def decode_latin1(c: Column) -> Column:
    """Bytes read as cp1252, as MySQL's latin1 is."""
    return F.translate(F.decode(c, "ISO-8859-1"), C1, CP1252)
