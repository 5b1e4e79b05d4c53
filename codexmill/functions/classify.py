"""What kind of entry a text is, and which features it has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codexmill.functions.text import cases, has, matches, starts

# Word tests of the two classifiers and of the features.
TRANSLATION = r"\b(translation|translated by|übersetzt)\b"
CLASSES = [
    ("Essay", r"\b(essay|essays)\b"),
    ("Translation", TRANSLATION),
    ("Review", r"\b(review|reviews|reviewed by|rezension)\b"),
    ("Correspondence", r"\b(letter|correspondence|brief)\b"),
    ("Film/Media", r"\b(film|movie|adaptation)\b"),
    ("Biography", r"\b(biography|biographie|biografie)\b"),
]
BIBLIOGRAPHY = ["<lst type=bracket", r"'''.*?'''", r"\b(Volumes?|Band|Tome)\b", r"\b(Published|Veröffentlicht|Erschienen)\b", r"\d+\s*p\."]
TYPES = [
    ("Essay", r"\b(Essay|Essays|Aufsatz|Aufsätze)\b"),
    ("Translation", r"\b(Translation|Translated|Übersetzt|Translated by|Translator|Übersetzung)\b"),
    ("Poetry", r"\b(Poem|Gedicht|Poetry|Poesie|Lyrik)\b"),
    ("Correspondence", r"\b(Letter|Brief|Correspondence|Korrespondenz)\b"),
]
CONFIDENCE = {"Redirect": 0.99, "Category": 0.95, "Bibliography Entry": 0.9, "Essay": 0.8, "Translation": 0.8, "Poetry": 0.75, "Correspondence": 0.75, "Unknown": 0.0}

# Nine types by a pattern each, in order, with the confidence that a match gives.
RULES = [
    ("Redirect", r"^#REDIRECT \[\[(.*?)\]\]", 1.0),
    ("Category", r"\[\[Category:(.*?)(?:\|.*?)?\]\]", 1.0),
    ("Essay", r"\b(essay|essays|aufsatz|aufsätze)\b", 0.85),
    ("Translation", r"\b(translation|translated by|übersetzt)\b", 0.9),
    ("Biography", r"\b(biography|biographie|life of)\b", 0.8),
    ("Collection", r"\b(collection|sammlung|collected works)\b", 0.75),
    ("Review", r"\b(review|reviewed|critique|rezension)\b", 0.9),
    ("Correspondence", r"\b(letter|brief|correspondence)\b", 0.85),
    ("Film/Media", r"\b(film|movie|adaptation|recording)\b", 0.85),
]


def content_patterns(c: Column) -> dict[str, Column]:
    """Ten features; false for null."""
    return {
        "has_title_markup": matches(c, r"'''.*?'''"),
        "has_volumes": has(c, "Volumes"),
        "has_year": matches(c, r"\b(1[8-9]\d{2}|20[0-2]\d)\b"),
        "has_publisher": matches(c, "(?:Verlag|Publisher|Press)", True),
        "has_location": matches(c, "(?:Wien|Berlin|Frankfurt|Leipzig|London|New York)"),
        "has_list": has(c, "<lst"),
        "has_html": matches(c, r"<\w+[^>]*>"),
        "has_category": has(c, "[[Category:"),
        "has_translation": matches(c, TRANSLATION, True),
        "has_review": matches(c, r"\b(review|reviewed|rezension)\b", True),
    }


def classify_content(c: Column) -> Column:
    """One of nine classes, the first that fits; null for null."""
    found = cases((has(c, "[[Category:"), "Category"), (has(c, "Volumes") | has(c, "<lst type=bracket>"), "Bibliography Entry"), *[(matches(c, p, True), k) for k, p in CLASSES], otherwise="Other")
    return F.when(c.isNotNull(), found)


def identify_content_type(c: Column) -> Column:
    """One of eight types, case-sensitive; Unknown for null."""
    return cases((starts(c, "#REDIRECT"), "Redirect"), (has(c, "[[Category:"), "Category"), *[(matches(c, p), "Bibliography Entry") for p in BIBLIOGRAPHY], *[(matches(c, p), k) for k, p in TYPES], otherwise="Unknown")


def type_confidence(kind: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for k in CONFIDENCE.items() for x in k])[kind], F.lit(0.0))


def rule_type(c: Column) -> Column:
    """A struct of kind and confidence: the first of nine rules that the text meets, in any case; Unknown and 0 without, and for null."""
    one = lambda kind, sure: F.struct(F.lit(kind).alias("kind"), F.lit(float(sure)).alias("confidence"))
    return F.coalesce(*[F.when(matches(c, p, True), one(kind, sure)) for kind, p, sure in RULES], one("Unknown", 0.0))
