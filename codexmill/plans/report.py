"""The statistics of a bibliography as one set of small tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.functions import classify, extract, markup
from codexmill.operators import profile
from codexmill.operators.relations import settle


def bibliography(entries: DataFrame) -> dict[str, DataFrame]:
    """Tables by name, from entries with content, content_type, year, location, language and page_count: types, redirects, encoding, categories, decades, periods, lifetime, places, languages, pages, links, duplicates."""
    c = F.col("content")
    rows = settle(entries.withColumns({"y": F.col("year").try_cast("double"), "pages": F.col("page_count").try_cast("double"), "kind": classify.identify_content_type(c), "main": F.coalesce(markup.main_category(markup.categories(c)), F.lit(""))}))
    return {
        "content_types": profile.shares(rows, "content_type"),
        "redirects": profile.value_counts(rows.where(F.col("kind") == "Redirect"), "content_type"),
        "encoding": profile.encoding_markers(rows, "content", "kind"),
        "main_categories": profile.value_counts(rows.where("main <> ''"), "main", 15),
        "decades": profile.decade_histogram(rows, "y"),
        "years": profile.describe(rows, F.col("y")),
        "periods": profile.period_histogram(rows, "y"),
        "lifetime": profile.lifetime_split(rows, "y"),
        "locations": profile.value_counts(rows, "location", 15),
        "languages": profile.value_counts(rows.select(extract.primary_language(F.col("language")).alias("language")), "language", 15).where("language <> 'Unknown'"),
        "pages": profile.number_stats(rows, "pages"),
        "page_bins": profile.page_bins(rows, "pages"),
        "links": profile.link_stats(rows, "content"),
        "decade_types": profile.shares(rows.where("y is not null").withColumn("decade", extract.decade(F.col("y"))), "content_type", ["decade"]),
        "period_categories": profile.top_in_groups(rows.where("y is not null").withColumn("period", extract.time_period(F.col("y"))), "period", "main"),
        "duplicates": profile.duplicated(rows, "content", "content").agg(F.count("*").alias("n")),
    }


def flat(tables: dict[str, DataFrame], counts: tuple[str, ...] = ("content_types", "redirects", "main_categories", "decades", "periods", "locations", "languages", "page_bins")) -> DataFrame:
    """section, label, n of the tables that count labels."""
    rows = [t.select(F.lit(k).alias("section"), F.col(next(c for c, kind in t.dtypes if kind == "string")).alias("label"), "n") for k, t in tables.items() if k in counts]
    return reduce(DataFrame.union, rows)
