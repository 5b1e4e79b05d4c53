"""Wiki markup: removal, categories, links, redirects, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codexmill.functions.text import every, first, replace, starts, strip

# Patterns of wiki markup.
CATEGORY = r"\[\[Category:(.*?)\]\]"
CATEGORY_KEYLESS = r"\[\[Category:(.*?)(?:\|.*?)?\]\]"
LINK = r"\[\[(?!Category:)(.*?)\]\]"
REDIRECT = r"#REDIRECT\s*\[\[(.*?)\]\]"
REDIRECT_STRICT = r"^#REDIRECT \[\[(.*?)\]\]"
URL = r"https?://\S+"
FEATURES = {
    "bold": r"'''.*?'''",
    "italic": r"''.*?''",
    "category": r"\[\[Category:.*?\]\]",
    "link": r"\[\[.*?\]\]",
    "header": r"={2,}.*?={2,}",
    "list": r"<lst.*?>",
    "html": r"<[^>]+>",
    "url": URL,
}


def remove_wiki_markup(c: Column, keep_lines: bool = False, compat: bool = False) -> Column:
    """Plain text; null becomes the empty text. compat keeps a piped link's rule as greedy as it once was."""
    return collapse(without_marks(c, compat), keep_lines)


def without_marks(c: Column, compat: bool = False) -> Column:
    """remove_wiki_markup() but for white space, which stays as it is."""
    t = F.coalesce(c, F.lit(""))
    t = replace(t, r"\[\[Category:.*?\]\]", "")
    t = replace(t, r"\{\{DEFAULTSORTKEY:.*?\}\}", "")
    t = replace(t, r"\[\[(.*?\|)?(.*?)\]\]" if compat else r"\[\[([^\]|]*\|)?([^\]]*)\]\]", "$2")
    t = replace(t, r"<lst.*?>(.*?)</lst>", "$1", dot_all=True)
    t = replace(t, r"'''(.*?)'''", "$1")
    t = replace(t, r"''(.*?)''", "$1")
    t = replace(t, "#REDIRECT ", "")
    return F.replace(F.replace(t, F.lit('\\"'), F.lit('"')), F.lit("\\'"), F.lit("'"))


def collapse(t: Column, keep_lines: bool = False) -> Column:
    """Runs of white space become one space, those at the ends go; keep_lines: line ends within stay."""
    return strip(replace(t, r"[^\S\n]+" if keep_lines else r"\s+", " "))


def clean_wiki_content(c: Column) -> Column:
    """Headings, links, quotes and tags go, their text stays."""
    t = replace(c, r"={2,}\s*(.*?)\s*={2,}", "$1")
    t = replace(t, r"\[\[([^\]|]*\|)?([^\]]*)\]\]", "$2")
    t = replace(t, r"'{2,}", "")
    return strip(replace(t, "<[^>]+>", ""))


def clean_markup(c: Column) -> Column:
    """Line breaks from <br>, the inside of <div> and <lst>, links' labels; other tags go."""
    t = replace(c, r"<br\s*/?>", "\n", ignore_case=True)
    t = replace(t, r"<(?:div|lst)[^>]*>(.*?)</(?:div|lst)>", "$1", dot_all=True)
    t = replace(t, r"\[\[([^\]|]*\|)?([^\]]*)\]\]", "$2")
    return strip(replace(t, "<[^>]+>", ""))


def strip_html(c: Column) -> Column:
    """Text of a page: tags become spaces, runs of white space one."""
    return strip(replace(replace(c, "<[^>]*>", " "), r"\s+", " "))


def categories(c: Column, keep_key: bool = True) -> Column:
    """Names of the categories; with their sort keys, or without."""
    return every(F.coalesce(c, F.lit("")), CATEGORY if keep_key else CATEGORY_KEYLESS)


def internal_links(c: Column) -> Column:
    return every(F.coalesce(c, F.lit("")), LINK)


def urls(c: Column) -> Column:
    return every(F.coalesce(c, F.lit("")), URL, 0)


def main_category(names: Column) -> Column:
    """The first category's first path segment; null without categories."""
    return strip(F.get(F.split(F.get(names, F.lit(0)), "/"), F.lit(0)))


def format_categories(names: Column) -> Column:
    return F.array_join(F.transform(names, lambda x: replace(strip(x), r"\s+", " ")), "; ")


def redirect_target(c: Column, strict: bool = True) -> Column:
    """Where a redirect leads; strict: the text begins with it, with one space."""
    return F.when(starts(c, "#REDIRECT"), first(c, REDIRECT_STRICT)) if strict else first(c, REDIRECT)
