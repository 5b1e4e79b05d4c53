"""Bibliographic fields from an entry's text: all native expressions, null where nothing is found."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codexmill.functions.markup import remove_wiki_markup
from codexmill.functions.text import every, first, first_of, has, matches, replace, starts, strip, votes

# Patterns and word lists of the extractors.
YEAR = r"\b(1[8-9]\d{2}|20[0-2]\d)\b"
CITIES = ["Wien", "Berlin", "Frankfurt", "Leipzig", "London", "New York", "Paris", "Zürich", "Hamburg", "München", "Salzburg"]
MORE_CITIES = [*CITIES, "Stockholm", "Amsterdam", "Bern", "Genf", "Rome", "Madrid", "Barcelona", "Milano", "Torino", "Moskva", "Moskau", "Moscow", "Praha", "Prag", "Prague", "Budapest", "Tokyo", "Warszawa", "Warsaw", "Buenos Aires", "Rio de Janeiro"]
PUBLISHER = [r"(?:Verlag|Publisher|Press):\s*(.*?)(?:\.|\n|$)", r"(?:published by|verlegt bei)\s*(.*?)(?:\.|\n|$)", r"\b(?:Verlag|Publishers?)\b[^\n.]*?([\w\s&]+)(?:,|\.|$)"]
PUBLISHER_WIDE = [r"(?:Verlag|Publisher|Press):\s*([\w\s&.,\-]+)", r"(?:published by|verlegt bei)\s*([\w\s&.,\-]+)", r"\b(?:Verlag|Publishers?)\b[^\n.]*?([\w\s&.,\-]+)(?:,|\.|$)", r"\b(?:Editions?|Edizioni)\b[^\n.]*?([\w\s&.,\-]+)(?:,|\.|$)"]
TRANSLATOR = [r"(?:Translated by|Übersetzt von|Translator|Translation by)[:\s]+([^,\n.]+)", r"(?:Traduction|Traduit par|Traduzione di|Traducción de)[:\s]+([^,\n.]+)"]
PAGES = [r"(\d+)(?:\s*)p\.", r"(\d+)(?:\s*)pages", r"(\d+)(?:\s*)Seiten"]
ORIGINAL = [r"(?:Original title|Originally published as)[:\s]+(.*?)(?:\.|$|\n)", r"(?:Originaltitel|Ursprünglicher Titel)[:\s]+(.*?)(?:\.|$|\n)", r"(?:Titre original|Título original)[:\s]+(.*?)(?:\.|$|\n)"]
LANGUAGE = r"(?:Language|Sprache):\s*(.*?)(?:\.|\n|$)"
LANGUAGE_WIDE = [r"(?:Language|Sprache|Langue|Idioma)[:\s]+(.*?)(?:\.|$|\n)", r"(?:in|auf|en|in the|translated into)\s+(German|English|French|Spanish|Italian|Russian|Chinese|Japanese|Arabic|Portuguese)\b"]
EIGHT = "German|English|French|Spanish|Italian|Russian|Arabic|Chinese"
EXPLICIT = [(rf"\b({EIGHT}) (edition|translation|version)\b", 1), (rf"\b(translated into|translated to|translation into) ({EIGHT})\b", 2), (r"\b(auf Deutsch|in English|en français|en español|in italiano|на русском|بالعربية|用中文)\b", 1)]
VOTES = {
    "German": [r"\b(German|Deutsch)\b", r"\b(Verlag|Band|herausgegeben)\b", r"\b(München|Berlin|Frankfurt|Leipzig|Wien)\b"],
    "English": [r"\b(English|translated into English)\b", r"\b(London|New York|Oxford|Cambridge)\b", r"\b(Publisher|Press)\b"],
    "French": [r"\b(French|Français|traduit en français)\b", r"\b(Paris|Éditions)\b", r"\b(traduction|traduit)\b"],
    "Spanish": [r"\b(Spanish|Español|traducido al español)\b", r"\b(Madrid|Barcelona|Buenos Aires)\b", r"\b(traducción|traducido)\b"],
    "Italian": [r"\b(Italian|Italiano|tradotto in italiano)\b", r"\b(Roma|Milano|Torino|Firenze)\b", r"\b(traduzione|tradotto)\b"],
    "Russian": [r"\b(Russian|русский|переведено на русский)\b", r"\b(Moscow|Moskva|Moskau)\b"],
    "Arabic": [r"\b(Arabic|العربية)\b", r"(تولستوي|زفايج)", r"\b(ترجمة|المترجم)\b"],
    "Chinese": [r"\b(Chinese|中文|汉语)\b", r"\b(北京|上海|台北)\b", r"(译者|翻译)"],
}
CATEGORY_LANGUAGE = rf"\[\[Category:.*?\(({EIGHT})\)\]\]"
LANGUAGES = ["Russian", "German", "English", "French", "Spanish", "Italian", "Portuguese", "Japanese", "Chinese", "Arabic", "Hindi", "Sanskrit", "Hebrew"]
ISO = {"German": "de", "English": "en", "French": "fr", "Spanish": "es", "Italian": "it", "Russian": "ru", "Portuguese": "pt", "Japanese": "ja", "Chinese": "zh", "Arabic": "ar", "Hindi": "hi", "Sanskrit": "sa", "Hebrew": "he"}
PLACES = {"Wien": "Vienna", "Zürich": "Zurich", "München": "Munich", "Köln": "Cologne", "Praha": "Prague", "Moskva": "Moscow"}
SCORED_YEARS = [(r"(?:published|erschienen|veröffentlicht).*?(\d{4})", 0.9), (r"\[(\d{4})\]", 0.8), (YEAR, 0.7)]
SCORED_PUBLISHERS = [(PUBLISHER_WIDE[0], 0.9), (PUBLISHER_WIDE[1], 0.9), (PUBLISHER_WIDE[2], 0.8)]
ISO_INDICATORS = {
    "de": ["verlag", "deutsche", "herausgegeben", "übersetzt"],
    "en": ["publisher", "english", "translated", "edited by"],
    "fr": ["édition", "française", "traduit", "publié"],
    "es": ["edición", "española", "traducido", "publicado"],
    "it": ["edizione", "italiana", "tradotto", "pubblicato"],
}
SENTENCE_END = r"(?<!\w)\.(?!\w)"
PERIODS = ["Pre-lifetime (before 1881)", "During Lifetime (1881-1942)", "Post-WWII (1943-1980)", "Late 20th Century (1981-2000)", "Contemporary (after 2000)"]
# Patterns of titles, lists of contents, publishers and places.
TITLE = r"'''(.*?)'''"
CONTENTS = r"Contents\s*\n(.*?)(?:\n\n|\z)"
CONTENTS_BELOW = r"Contents.*?\n(.*?)(?:\n\n|\z)"
PAIR = r"([^\[\n]+)\s*\[(.*?)(?:\.\s*Translated|\])"
BRACKETED = r"^([^\[]+)\s*\[(.*?)\]"
LEADING = r"^\s*\[(.*?)\]"
BRACKET = r"\[(.*?)\]"
SECTIONS = [r"[Cc]ontents\s*\n(.*?)(?:\n\n|\z)", r"(?:\n\n|\n)(\d+\.\s+.*?)(?:\n\n|\z)"]
NUMBERED = r"(?:\n|^)(\d+\.\s+.*?)(?=\n\d+\.|\z)"
LINED = r"(?:\n|^)([^.\n]+\s*\[.*?\].*?)(?=\n|$)"
ITEM_ENDS = r"\n\d+\.|\n-|\n\*|\n"
ITEM_PAGES = r"pp\.\s*(\(?\d+\)?-\d+|\d+)"
ITEM_TRANSLATORS = [r"(?:[Tt]ranslated by|[Tt]r\.)\s+(.*?)[.,]", r"(?:[Tt]ranslation by|[Tt]rans\.)\s+(.*?)[.,]"]
HOUSES = [r':\s+"([^"]+)"', r"(?:Izdatel'stvo|Publishing|Verlag|Éditions)\s+\"?([^\",.]+)\"?", r"(?:[A-Z][a-zA-Z\s]+:)?\s*([^,]+?)(?:,|\s+\d{4})"]
TOWNS = r"(?:^|\s)(Moscow|Moskva|Berlin|London|New York|Paris|Wien|Vienna|Frankfurt|Leipzig)\b"
BEFORE_COLON = r"([A-Z][a-zA-Z\s]+):"
PAGE_COUNTS = [r"(\d+)\s*(?:p\.|pages)", r"(\d+)/\(\d+\)p\.", r"(?:total|in all|altogether)\s+(\d+)\s*(?:p\.|pages)"]


def content_title(c: Column) -> Column:
    """Text between three quotes, else the first line that isn't blank, else empty."""
    lines = F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")
    return F.coalesce(first(c, TITLE), F.get(lines, F.lit(0)), F.lit(""))


def title_match(page_title: Column, title: Column) -> Column:
    """Whether one title contains the other, underscores read as spaces; false for null."""
    t = F.replace(page_title, F.lit("_"), F.lit(" "))
    return F.coalesce(F.contains(t, title) | F.contains(title, t), F.lit(False))


def biblio_info(c: Column) -> dict[str, Column]:
    """year, publisher, location, language, page_count: the first of each."""
    return {
        "year": first(c, YEAR),
        "publisher": strip(F.coalesce(*[first(c, p, ignore_case=True) for p in PUBLISHER])),
        "location": first(c, rf"\b({'|'.join(CITIES)})\b"),
        "language": strip(first(c, LANGUAGE, ignore_case=True)),
        "page_count": first(c, PAGES[0]),
    }


def bibliographic_data(c: Column, page_title: Column) -> dict[str, Column]:
    """title, year (up to three), publisher, location (all cities, as met), translator, page_count, original_title, language; '' where missing."""
    t = F.coalesce(c, F.lit(""))
    named = F.replace(page_title, F.lit("_"), F.lit(" "))
    line = strip(F.get(F.split(strip(t), "\n"), F.lit(0)))
    plain = ~starts(t, "#REDIRECT") & ~starts(t, "[[Category") & (F.length(line) > 3) & (F.length(line) < 100)

    def one(patterns: list[str]) -> Column:
        return F.coalesce(*[strip(first(t, p, ignore_case=True)) for p in patterns], F.lit(""))

    return {
        "title": first_of(first(t, TITLE), F.when(~starts(named, "#REDIRECT"), named), F.when(plain, line), F.lit(None).cast("string")),
        "year": F.array_join(F.slice(every(t, YEAR), 1, 3), ", "),
        "publisher": one(PUBLISHER_WIDE),
        "location": F.array_join(F.array_distinct(every(t, "|".join(rf"\b{x}\b" for x in MORE_CITIES), 0, ignore_case=True)), ", "),
        "translator": one(TRANSLATOR),
        "page_count": one(PAGES),
        "original_title": one(ORIGINAL),
        "language": one(LANGUAGE_WIDE),
    }


def detect_language(c: Column, compat: bool = False) -> Column:
    """A language by what the text says, by two of its words or more, by its category, else Unknown.

    compat takes the explicit patterns' second group, as it once was, whatever it holds.
    """
    said = [first(c, p, (2 if compat and g == 1 and p != EXPLICIT[2][0] else g), ignore_case=True) for p, g in EXPLICIT]
    voted = [F.when(votes(*[matches(c, p, True) for p in patterns]) >= 2, lang) for lang, patterns in VOTES.items()]
    return F.coalesce(*said, *voted, first(c, CATEGORY_LANGUAGE), F.lit("Unknown"))


def time_period(year: Column) -> Column:
    """One of five periods; empty without a year."""
    y = year.try_cast("double")
    return F.coalesce(F.when(y < 1881, PERIODS[0]).when(y <= 1942, PERIODS[1]).when(y <= 1980, PERIODS[2]).when(y <= 2000, PERIODS[3]).when(y > 2000, PERIODS[4]), F.lit(""))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("long")


def plain(c: Column, lines: bool = False, given: Column | None = None) -> Column:
    """given, or c without markup; lines: line ends stay. Callers with many extractors compute it once and hand it on."""
    return remove_wiki_markup(c, keep_lines=lines) if given is None else given


def titles(c: Column, compat: bool = False, flat: Column | None = None, lines: Column | None = None) -> Column:
    """A struct of title and original: from the first two items of a contents list, else `title [original]`, else the first sentence.

    Unless compat, the contents list is looked for before line ends are collapsed.
    """
    flat = plain(c, given=flat)
    lines = flat if compat else plain(c, True, lines)
    listed = first(lines, CONTENTS, ignore_case=True, dot_all=True)
    items = F.slice(F.arrays_zip(F.transform(every(listed, PAIR, 1), strip).alias("t"), F.transform(every(listed, PAIR, 2), strip).alias("o")), 1, 2)
    several = F.coalesce(F.size(every(listed, PAIR, 1)) >= 2, F.lit(False))
    joined = F.struct(F.array_join(F.transform(items, lambda x: x["t"]), " * ").alias("title"), F.array_join(F.transform(items, lambda x: x["o"]), " * ").alias("original"))
    bracketed = F.struct(strip(F.regexp_extract(flat, rf"(?dU){BRACKETED}", 1)).alias("title"), strip(F.regexp_extract(flat, rf"(?dU){BRACKETED}", 2)).alias("original"))
    below = every(first(lines, CONTENTS_BELOW, ignore_case=True, dot_all=True), r"([^\[\n]+)\s*\[")
    led = matches(flat, LEADING) & F.coalesce(F.size(below) >= 2, F.lit(False))
    under = F.struct(F.array_join(F.transform(F.slice(below, 1, 2), strip), " * ").alias("title"), F.coalesce(first(flat, LEADING), F.lit("")).alias("original"))
    only = F.struct(F.lit("").alias("title"), F.coalesce(first(flat, BRACKET), F.lit("")).alias("original"))
    sentence = F.struct(first_sentence(flat).alias("title"), F.lit("").alias("original"))
    return F.when(several, joined).when(matches(flat, BRACKETED), bracketed).when(led, under).when(matches(flat, BRACKET), only).otherwise(sentence)


def first_sentence(flat: Column) -> Column:
    """Up to the first full stop that isn't inside a word; all of it without one."""
    return strip(F.get(F.split(flat, f"(?dU){SENTENCE_END}", 2), F.lit(0)))


def short_title(c: Column) -> Column:
    """Over 100 characters: the first ten words and an ellipsis."""
    return F.when(F.length(c) > 100, F.concat(F.array_join(F.slice(F.split(strip(c), r"(?U)\s+"), 1, 10), " "), F.lit("..."))).otherwise(c)


def extract_title(redirect: Column, pair: Column, flat: Column) -> Column:
    """The title, the redirect's target, the original title, else the first sentence, shortened."""
    return first_of(pair["title"], F.when(redirect.isNotNull(), remove_wiki_markup(redirect)), pair["original"], short_title(first_sentence(flat)), F.lit(""))


def original_title(c: Column, title: Column | None = None, flat: Column | None = None) -> Column:
    """The bracket right after the title, if one is given, else the first bracket, without brackets left at its ends; '' without."""
    found = [without_brackets(first(c, BRACKET)), F.lit("")]
    if title is not None:
        flat = plain(c, given=flat)
        at = F.instr(flat, title)
        found.insert(0, first(strip(F.when((title != "") & (at > 0), F.substring(flat, at + F.length(title), F.length(flat)))), LEADING))
    return F.coalesce(*found)


def without_brackets(c: Column) -> Column:
    return F.regexp_replace(c, r"^\[|\]\z", "")


def catalog_numbers(text_id: Column) -> Column:
    parts = F.split(text_id.cast("string"), ",")
    two = F.size(parts) >= 2
    return F.struct(F.when(two, F.get(parts, F.lit(0))).otherwise("").alias("catalog_number_1"), F.when(two, F.get(parts, F.lit(1))).otherwise("").alias("catalog_number_2"))


def full_entry(c: Column, compat: bool = False, lines: Column | None = None) -> Column:
    """The first paragraph, else the first 250 characters."""
    t = plain(c) if compat else plain(c, True, lines)
    return strip(F.when(has(t, "\n\n"), F.substring_index(t, "\n\n", 1)).otherwise(F.substring(t, 1, 250)))


def content_items(c: Column, compat: bool = False, lines: Column | None = None) -> Column:
    """Array of (title, original_title, translator, pages): the items of an entry's list of contents.

    compat collapses line ends before the list is looked for, and deletes every number from titles with pages.
    """
    t = plain(c) if compat else plain(c, True, lines)
    numbered, rows = every(t, NUMBERED, dot_all=True), every(t, LINED)
    section = F.coalesce(
        *[first(t, p, dot_all=True) for p in SECTIONS],
        F.when(F.size(numbered) > 0, F.array_join(numbered, "\n")),
        F.when(F.size(rows) > 1, F.array_join(rows, "\n")),
    )
    items = F.filter(F.transform(F.split(section, ITEM_ENDS), strip), lambda x: x != "")

    def fields(x: Column) -> Column:
        pages, original = first(x, ITEM_PAGES), first(x, BRACKET)
        translator = F.coalesce(*[first(x, p) for p in ITEM_TRANSLATORS])
        title = F.when(original.isNotNull(), replace(x, r"\[.*?\]", "")).otherwise(x)
        title = F.when(translator.isNotNull(), replace(title, r"(?:[Tt]ranslated by|[Tt]r\.|[Tt]ranslation by|[Tt]rans\.)\s+.*?[.,]", "")).otherwise(title)
        title = F.when(pages.isNotNull(), replace(title, r"pp\.\s*\(?\d+\)?-\d+|\d+" if compat else r"pp\.\s*(?:\(?\d+\)?-\d+|\d+)", "")).otherwise(title)
        title = replace(replace(title, r"^\d+\.\s+", ""), r"[,.:;\s]+\z", "")
        return F.struct(strip(title).alias("title"), strip(F.coalesce(original, F.lit(""))).alias("original_title"), strip(F.coalesce(translator, F.lit(""))).alias("translator"), F.coalesce(pages, F.lit("")).alias("pages"))

    return F.coalesce(F.transform(items, fields), F.array().cast("array<struct<title: string, original_title: string, translator: string, pages: string>>"))


def publisher_location(c: Column, flat: Column | None = None) -> Column:
    """A struct of publisher (quoted, else after a keyword, else before the first comma or year) and location (before a colon, else a city)."""
    t = plain(c, given=flat)
    publisher = F.coalesce(*[first(t, p) for p in HOUSES], F.lit(""))
    location = F.coalesce(first(t, BEFORE_COLON), first(t, TOWNS, ignore_case=True), F.lit(""))
    return F.struct(strip(publisher).alias("publisher"), strip(location).alias("location"))


def language_from_categories(names: Column) -> Column:
    """The first language that the first category with any contains; '' without."""
    known = F.array(*[F.lit(x) for x in LANGUAGES])
    found = F.flatten(F.transform(names, lambda n: F.filter(known, lambda k: F.contains(n, k))))
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def page_count(c: Column, flat: Column | None = None) -> Column:
    t = plain(c, given=flat)
    return F.coalesce(*[first(t, p, ignore_case=i == 2) for i, p in enumerate(PAGE_COUNTS)], F.lit(""))


def primary_language(language: Column) -> Column:
    return F.coalesce(first(language, "^([A-Za-z]+)"), F.lit("Unknown"))


def normalise_place(location: Column) -> Column:
    """One spelling for places with several."""
    return F.coalesce(F.create_map(*[F.lit(x) for p in PLACES.items() for x in p])[location], location)


def iso_language(language: Column) -> Column:
    return F.create_map(*[F.lit(x) for p in ISO.items() for x in p])[language]


def _scored(c: Column, options: list[tuple[str, float]], name: str) -> Column:
    found = [strip(first(c, p, ignore_case=True)) for p, _ in options]
    return F.coalesce(*[F.when(f.isNotNull(), F.struct(f.alias(name), F.lit(s).alias("confidence"))) for f, (_, s) in zip(found, options, strict=True)])


def scored_year(c: Column) -> Column:
    """A struct of year and confidence, by the surest pattern that is found; null without a year."""
    return _scored(c, SCORED_YEARS, "year")


def scored_publisher(c: Column) -> Column:
    return _scored(c, SCORED_PUBLISHERS, "publisher")


def iso_by_indicators(c: Column) -> Column:
    """The language with the most indicator words in the text, ties by their order; null without any."""
    low = F.lower(c)
    scores = F.array(*[F.struct(votes(*[F.coalesce(low.contains(w), F.lit(False)) for w in words]).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("k")) for i, (k, words) in enumerate(ISO_INDICATORS.items())])
    best = F.array_max(scores)
    return F.when(best["n"] > 0, best["k"])
