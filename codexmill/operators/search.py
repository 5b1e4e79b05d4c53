"""Facets, keyword search, dashboard and routes over the final table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import parse_qsl, unquote

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexmill.functions.extract import PERIODS

SEARCHED = ("title", "original_title", "full_bibliographic_entry", "publisher", "location", "clean_content")
#: Facets and their columns.
FACETS = {"category": "main_category", "language": "language", "timePeriod": "time_period", "year": "year"}


def facet_values(df: DataFrame, facet: str) -> DataFrame:
    """A facet's distinct values, sorted: years as numbers, all else as text."""
    c = FACETS[facet]
    found = df.where(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).select(F.col(c).alias("value")).distinct()
    return found.orderBy(F.col("value").try_cast("double") if facet == "year" else "value")


def facet_counts(df: DataFrame, facets: tuple[str, ...] = ("category", "language", "timePeriod")) -> DataFrame:
    """facet, value, n of several facets, by grouping sets in one pass."""
    names = [FACETS[f] for f in facets]
    rows = df.select(*[F.col(c).cast("string").alias(c) for c in names]).groupingSets([[F.col(c)] for c in names], *[F.col(c) for c in names]).agg(F.count("*").alias("n"), F.grouping_id(*names).alias("g"))
    n = len(names)
    which = F.coalesce(*[F.when(F.col("g") == ((1 << n) - 1) ^ (1 << (n - 1 - i)), F.lit(f)) for i, f in enumerate(facets)])
    return rows.select(which.alias("facet"), F.coalesce(*names).alias("value"), "n").where("value is not null and value <> ''")


def search(df: DataFrame, query: str = "", **filters: object) -> DataFrame:
    """Rows whose searched fields contain the query in any case, and that meet all filters; without either, all rows.

    Filters compare typed: a year is a number however it is given.
    """
    found = df
    if query:
        hit = [F.coalesce(F.contains(F.lower(F.col(c)), F.lit(query.lower())), F.lit(False)) for c in SEARCHED if c in df.columns]
        found = found.where(reduce(lambda a, b: a | b, hit))
    for condition in meets(filters):
        found = found.where(condition)
    return found


def meets(filters: Mapping[str, object]) -> list[Column]:
    """A condition for each filter that has a value, by facet or column."""
    given = {FACETS.get(facet, facet): value for facet, value in filters.items() if value not in (None, "")}
    return [F.col(c).try_cast("double") == float(value) if c == "year" else F.col(c) == value for c, value in given.items()]


def page(df: DataFrame, order: str, number: int, size: int, descending: bool = False) -> DataFrame:
    """One page of a sorted listing; ties by page_id."""
    return df.orderBy(F.desc(order) if descending else F.col(order), "page_id").offset(number * size).limit(size)


def by_id(df: DataFrame, page_id: object) -> DataFrame:
    """The row of an id, compared as the column's type, so that the source can look it up."""
    return df.where(F.col("page_id") == F.lit(str(page_id)).try_cast(df.schema["page_id"].dataType)).limit(1)


def detail(df: DataFrame) -> DataFrame:
    """Fields for display: `Untitled` for a missing title, `-` for all else."""
    return df.select([F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("Untitled" if c == "title" else "-")).alias(c) for c in df.columns])


def dashboard(df: DataFrame) -> DataFrame:
    """part, label, n: totals, the year range, 12 categories, 10 languages, periods with rows; df is computed once."""
    names = ["main_category", "language", "time_period"]
    rows = df.select(*names, F.col("year").try_cast("double").alias("y")).groupingSets([[], *[[F.col(c)] for c in names]], *[F.col(c) for c in names])
    rows = rows.agg(F.count("*").cast("double").alias("n"), F.min("y").alias("a"), F.max("y").alias("b"), F.grouping_id(*names).alias("g"))
    label = F.coalesce(*names)
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc(F.coalesce(label, F.lit("")) != ""), F.desc("n"), label))
    rows = rows.select("n", "a", "b", "g", label.alias("label"), rank.alias("rank")).where("g = 7 or label <> ''")  # a few rows from here on
    entry = lambda part, label, n: F.struct(F.lit(part).alias("part"), label.alias("label"), n.alias("n"))
    totals = F.array(*[entry("total", F.lit(k), F.col(c)) for k, c in (("entries", "n"), ("first_year", "a"), ("last_year", "b"))])
    one = lambda part: F.array(entry(part, F.col("label"), F.col("n")))
    found = F.when(F.col("g") == 7, totals).when((F.col("g") == 3) & (F.col("rank") <= 12), one("category")).when((F.col("g") == 5) & (F.col("rank") <= 10), one("language")).when((F.col("g") == 6) & F.col("label").isin(PERIODS), one("period"))
    return rows.select(F.explode(found).alias("x")).select("x.part", "x.label", "x.n")


@dataclass
class Route:
    view: str = "dashboard"
    id: str | None = None
    query: str = ""
    filters: dict[str, str] = field(default_factory=dict)


VIEWS = ("dashboard", "list", "search", "detail", "category", "language", "period", "year")


def parse_route(fragment: str) -> Route:
    """`#view=list&filter=language:German&query=x`; `#view=<number>` and `#view=detail&id=<number>` both show an entry; unknown views show the dashboard."""
    given = dict(parse_qsl(fragment.lstrip("#"), keep_blank_values=True))
    view = given.get("view", "dashboard")
    if view.isdigit():
        return Route("detail", view)
    filters = {}
    for part in filter(None, given.get("filter", "").split(",")):
        k, _, v = part.partition(":")
        filters["timePeriod" if k == "period" else k] = unquote(v)
    return Route(view if view in VIEWS else "dashboard", given.get("id"), given.get("query", ""), filters)


def answer(df: DataFrame, route: Route) -> DataFrame:
    """What a route shows; an id that isn't there shows the dashboard."""
    if route.view == "detail":
        found = by_id(df, route.id)
        return detail(found) if found.limit(1).count() else dashboard(df)
    return dashboard(df) if route.view == "dashboard" else search(df, route.query, **route.filters)
