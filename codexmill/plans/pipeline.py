"""From extracted entries to the final table; every step adds columns of the same row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.functions import classify, encoding, extract, markup
from codexmill.functions.text import first_of
from codexmill.operators import search
from codexmill.operators.relations import pick, settle
from codexmill.sources.schemas import FINAL


def analyse(entries: DataFrame) -> DataFrame:
    """Extracted entries with length, title, type and bibliographic fields."""
    c = F.col("content")
    out = entries.withColumns({"content_length": F.length(c), "content_title": extract.content_title(c)})
    return out.withColumns({"title_match": extract.title_match(F.col("page_title"), F.col("content_title")), "content_type": classify.classify_content(c), **extract.biblio_info(c)})


def clean_step(analysed: DataFrame) -> DataFrame:
    """Adds content_cleaned, with the dump's escapes undone, and redirect_target, the step between analysis and the final table."""
    c = F.col("content")
    return analysed.withColumns({"content_cleaned": F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\'"), F.lit("'")), "redirect_target": markup.redirect_target(c, strict=False)})


def finish(cleaned: DataFrame, compat: bool = False, columns: Sequence[str] = FINAL, filters: Mapping[str, object] | None = None) -> DataFrame:
    """The final table, columns as FINAL has them; '' for what is missing but in page_id.

    columns: those that are needed, the others are not computed. filters, as search() has them: of other
    rows nothing but the facets is computed. Steps are settled, as the optimizer would else copy the
    expressions of one into every use in the next; each computes a text once. What is still suspicious
    at the end is repaired once more.
    """
    c, want = F.col("content_cleaned"), set(columns)
    numbered = cleaned.where(F.col("text_id").contains(",")).limit(1).count() > 0 if want & {"catalog_number_1", "catalog_number_2"} else False
    # What settle() carries is computed for every row: only what the final table is made of goes in.
    sources = ["page_id", "text_id", "content_cleaned", "year", "language", *[x for x in ("publisher", "location", "page_count") if x in want]]
    df = settle(pick(cleaned, sources).withColumns({"year": F.col("year").try_cast("double"), "content_cleaned": encoding.normal(c)}))
    df = settle(df.withColumn("content_cleaned", encoding.fix_encoding_deep(c, compat)))
    df = settle(df.withColumn("_categories", markup.categories(c)))
    df = settle(df.withColumns({"main_category": F.coalesce(markup.main_category(F.col("_categories")), F.lit("")), "categories": markup.format_categories(F.col("_categories")), "time_period": extract.time_period(F.col("year")), "language": first_of(F.col("language"), extract.language_from_categories(F.col("_categories")), F.lit(""))}))
    for condition in search.meets(filters or {}):
        df = df.where(condition)
    if want <= {"page_id", "text_id", "year", "language", "categories", "main_category", "time_period"}:  # no plain text is needed
        df = df.withColumns({"_flat": F.lit(""), "_lines": F.lit(""), "_redirect": F.lit("")})
    else:
        df = settle(df.withColumns({"_redirect": markup.redirect_target(c), "_flat": markup.without_marks(c, compat), **({"_lines": markup.without_marks(c)} if compat else {})}))
        df = settle(df.withColumns({"_flat": markup.collapse(F.col("_flat")), "_lines": markup.collapse(F.col("_lines" if compat else "_flat"), keep_lines=True)}))
    flat, lines = F.col("_flat"), F.col("_lines")

    numbers = extract.catalog_numbers(F.col("text_id"))
    between = {
        "_titles": ({"title", "original_title"}, extract.titles(c, compat, flat, lines)),
        "_place": ({"publisher", "location"}, extract.publisher_location(c, flat)),
        "_items": ({x for x in FINAL if x.startswith("content_item")}, extract.content_items(c, compat, lines)),
    }
    if any(use & want for use, _ in between.values()):
        df = settle(df.withColumns({k: v for k, (use, v) in between.items() if use & want}))
    fields = {
        "catalog_number_1": lambda: numbers["catalog_number_1"],
        "catalog_number_2": lambda: numbers["catalog_number_2"],
        "title": lambda: extract.extract_title(F.col("_redirect"), F.col("_titles"), flat),
        "original_title": lambda: F.when((F.col("_titles.title") == "") & (F.col("_titles.original") == ""), extract.original_title(c)).otherwise(extract.without_brackets(F.col("_titles.original"))),
        "full_bibliographic_entry": lambda: extract.full_entry(c, compat, lines),
        "publisher": lambda: first_of(F.col("publisher"), F.col("_place.publisher")),
        "location": lambda: first_of(F.col("location"), F.col("_place.location")),
        "page_count": lambda: F.coalesce(F.col("page_count").cast("string"), extract.page_count(c, flat)),
        "clean_content": lambda: flat,
        **{f"content_item_{i}_{f}": (lambda i=i, f=f: F.get(F.col("_items"), F.lit(i - 1))[f]) for i in (1, 2, 3) for f in ("title", "original_title", "translator", "pages")},
    }
    df = df.withColumns({k: f() for k, f in fields.items() if k in want and (numbered or not k.startswith("catalog_number"))})
    df = settle(pick(df, [x for x in FINAL if x in want]))
    df = df.select([F.col(x) if x == "page_id" else F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in df.columns])
    again = lambda x: encoding.fix_encoding_deep(encoding.fix_encoding_deep(x, compat), compat)
    return df.withColumns({x: F.when(F.col(x).rlike(encoding.SUSPICIOUS), again(F.col(x))).otherwise(F.col(x)) for x in ("title", "original_title", "clean_content") if x in df.columns})
