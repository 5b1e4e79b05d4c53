"""Profiles of a table: counts, shares, missing values, lengths, decades, duplicates, categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexmill.functions.classify import content_patterns
from codexmill.functions.encoding import MARKERS
from codexmill.functions.extract import PERIODS, YEAR, decade, time_period
from codexmill.functions.markup import CATEGORY_KEYLESS, FEATURES, categories, internal_links
from codexmill.functions.text import every, has, matches

#: Right ends of the page bins and their labels, in order.
PAGE_BINS = [(10, "1-10"), (50, "11-50"), (100, "51-100"), (200, "101-200"), (500, "201-500"), (1000, "501-1000"), (None, "1000+")]
LIFETIME = (1881, 1942)
# Indicators of five languages, and the variants by which works are mentioned.
INDICATORS = {
    "German": r"\b(German|Deutsch)\b",
    "English": r"\b(English|Englisch)\b",
    "French": r"\b(French|Français|Französisch)\b",
    "Spanish": r"\b(Spanish|Español|Spanisch)\b",
    "Italian": r"\b(Italian|Italiano|Italienisch)\b",
}
WORKS = {
    "Die Welt von Gestern": ["Die Welt von Gestern", "World of Yesterday", "Monde d'hier"],
    "Schachnovelle": ["Schachnovelle", "Chess Story", "Chess Novella", "Royal Game", "Jeu d'échecs"],
    "Brief einer Unbekannten": ["Brief einer Unbekannten", "Letter from an Unknown Woman", "Lettre d'une inconnue"],
    "Angst": ["Angst", "Fear", "Amok", "Peur"],
    "Amok": ["Amok", "Amok-Läufer", "Amok Runner"],
    "Brennendes Geheimnis": ["Brennendes Geheimnis", "Burning Secret"],
    "Sternstunden der Menschheit": ["Sternstunden der Menschheit", "Decisive Moments", "Moments étoilés"],
    "Marie Antoinette": ["Marie Antoinette", "María Antonieta", "Marie-Antoinette"],
    "Joseph Fouché": ["Joseph Fouché", "Fouche", "Fouché"],
    "Ungeduld des Herzens": ["Ungeduld des Herzens", "Beware of Pity", "Impatience du cœur"],
    "Verwirrung der Gefühle": ["Verwirrung der Gefühle", "Confusion of Feelings", "Confusion des sentiments"],
    "Der Kampf mit dem Dämon": ["Kampf mit dem Dämon", "Struggle with the Daemon"],
    "Drei Meister": ["Drei Meister", "Three Masters"],
    "Rausch der Verwandlung": ["Rausch der Verwandlung", "Post-Office Girl"],
    "Clarissa": ["Clarissa"],
    "Maria Stuart": ["Maria Stuart", "Mary Stuart", "Marie Stuart"],
    "Magellan": ["Magellan", "Magallanes", "Magellan: Der Mann und seine Tat"],
    "Erasmus von Rotterdam": ["Erasmus", "Erasmus von Rotterdam", "Érasme"],
}


def long_form(row: DataFrame, key: str, value: str) -> DataFrame:
    """One row of many columns as rows of key and value."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in row.columns)
    return row.select(F.expr(f"stack({len(row.columns)}, {pairs}) as ({key}, {value})"))


def value_counts(df: DataFrame, c: str, top: int | None = None) -> DataFrame:
    """Values with their counts; nulls are left out. top: the most frequent, ties by value."""
    found = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
    return found.orderBy(F.desc("n"), c).limit(top) if top else found


def shares(df: DataFrame, c: str, within: Sequence[str] = ()) -> DataFrame:
    """Counts of a column's values with their share in percent, of all rows or within groups.

    The window runs over counted groups, never over rows.
    """
    found = df.groupBy(*within, c).agg(F.count("*").alias("n"))
    return found.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*within)), 4))


def length_stats(df: DataFrame, c: str, by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Count, distinct values, and least, greatest, mean and median length; in one pass over the groups.

    Values are told apart by 96 bits of hashes, so that no text is shuffled. exact: the true median,
    which gathers a group's distinct lengths and their counts; else a sketch.
    """
    n = F.length(c)
    median = F.median(n) if exact else F.percentile_approx(n, 0.5, 10_000)
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.countDistinct(F.xxhash64(c), F.hash(c), F.nullif(F.isnotnull(c), F.lit(False))).alias("n_distinct"), F.min(n).cast("long").alias("min_len"), F.max(n).cast("long").alias("max_len"), F.round(F.avg(n), 4).alias("avg_len"), median.cast("double").alias("median_len")
    )


def describe(df: DataFrame, x: Column, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max of a number, over all or per group; quartiles are interpolated."""
    q = F.percentile(x, [0.25, 0.5, 0.75])
    out = df.groupBy(*by).agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).cast("double").alias("least"), q.alias("q"), F.max(x).cast("double").alias("greatest"))
    return out.select(*by, "count", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "least", *[F.get("q", F.lit(i)).alias(f"q{25 * i + 25}") for i in range(3)], "greatest")


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, n_null, n_empty, pct_null: one pass for all columns."""
    columns = list(columns or df.columns)
    texts = {c for c, t in df.dtypes if t == "string"}
    row = df.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("n_null"), (F.count_if(F.col(c) == "") if c in texts else F.lit(0).cast("long")).alias("n_empty"), F.count("*").alias("n")).alias(c) for c in columns])
    out = long_form(row, "column", "v")
    return out.select("column", "v.n_null", "v.n_empty", F.round(100.0 * F.col("v.n_null") / F.nullif(F.col("v.n"), F.lit(0)), 4).alias("pct_null"))


def high_missing(df: DataFrame, pct: float = 50.0) -> DataFrame:
    return missing_profile(df).where(F.col("pct_null") > pct).select("column", "pct_null")


def drop_empty_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """df without those of the columns that are null in every row."""
    columns = [c for c in (columns or df.columns) if c in df.columns]
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if not counts[c]])


def number_stats(df: DataFrame, c: str) -> DataFrame:
    x = F.col(c)
    return df.agg(F.count(x).alias("n"), F.min(x).cast("double").alias("least"), F.max(x).cast("double").alias("greatest"), F.round(F.avg(x), 4).alias("mean"), F.median(x).cast("double").alias("median"), (F.max(x) - F.min(x) + 1).cast("double").alias("span"))


def lifetime_split(df: DataFrame, year: str) -> DataFrame:
    y, (born, died) = F.col(year), LIFETIME
    row = df.agg(F.count_if(y.between(born, died)).alias("lifetime"), F.count_if(y > died).alias("posthumous"), F.count(y).alias("n"))
    return row.select("lifetime", "posthumous", *[F.round(100.0 * F.col(c) / F.nullif(F.col("n"), F.lit(0)), 4).alias(f"pct_{c}") for c in ("lifetime", "posthumous")])


def decade_histogram(df: DataFrame, year: str) -> DataFrame:
    """decade, n, n_years by decade."""
    return df.where(F.col(year).isNotNull()).groupBy(decade(F.col(year)).alias("decade")).agg(F.count("*").alias("n"), F.countDistinct(year).alias("n_years")).orderBy("decade").select(F.concat(F.col("decade").cast("string"), F.lit("s")).alias("decade"), "n", "n_years")


def period_histogram(df: DataFrame, year: str) -> DataFrame:
    """All five periods, those without rows too."""
    p = time_period(F.col(year))
    return long_form(df.agg(*[F.count_if(p == x).alias(x) for x in PERIODS]), "period", "n")


def page_bin(pages: Column) -> Column:
    """The bin, right-closed; null for null, 0 and less."""
    label = F.lit(None).cast("string")
    for end, name in reversed(PAGE_BINS):
        label = F.lit(name) if end is None else F.when(pages <= end, name).otherwise(label)
    return F.when(pages > 0, label)


def page_bins(df: DataFrame, pages: str) -> DataFrame:
    b = page_bin(F.col(pages))
    return long_form(df.agg(*[F.count_if(b == name).alias(name) for _, name in PAGE_BINS]), "bin", "n")


def cross_counts(df: DataFrame, row: Column, c: str, values: Sequence[str]) -> DataFrame:
    """Counts of rows by row and one column for each of values, 0 where there are none."""
    return df.groupBy(row.alias("row")).pivot(c, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def top_in_groups(df: DataFrame, group: str, c: str, k: int = 5) -> DataFrame:
    """The k most frequent values within each group, ties by value; the window is over counts."""
    n = df.groupBy(group, c).agg(F.count("*").alias("n"))
    return n.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), c)).cast("long")).where(F.col("rn") <= k)


def duplicated(df: DataFrame, c: str, key: str) -> DataFrame:
    """key of all rows whose c occurs more than once, nulls equal to each other.

    Groups are counted by 96 bits of hashes before rows meet them again, so no group and no text is gathered.
    """
    text = F.coalesce(F.col(c).cast("string"), F.lit("\x00null"))
    hashed = {"h": F.xxhash64(text), "g": F.hash(text)}
    often = df.groupBy(*[v.alias(k) for k, v in hashed.items()]).agg(F.count("*").alias("times")).where("times > 1")
    return df.select(key, *[v.alias(k) for k, v in hashed.items()]).join(often, ["h", "g"]).select(key, "times")


def list_counts(df: DataFrame, items: Column, name: str = "item") -> DataFrame:
    return df.select(F.explode(items).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def category_counts(df: DataFrame, c: str) -> DataFrame:
    return list_counts(df, every(F.col(c), CATEGORY_KEYLESS), "category")


def top_level(counts: DataFrame) -> DataFrame:
    """Counts of categories by their first path segment."""
    return counts.groupBy(F.trim(F.get(F.split("category", "/"), F.lit(0))).alias("branch")).agg(F.sum("n").alias("n"))


def category_tree(counts: DataFrame) -> DataFrame:
    """path, depth, parent, n (with all that is below), n_children: every prefix of every category's path."""
    parts = F.transform(F.split("category", "/"), lambda x: F.trim(x))
    paths = F.transform(F.sequence(F.lit(1), F.size("parts")), lambda i: F.array_join(F.slice(F.col("parts"), F.lit(1), i), " / "))
    rows = counts.select("n", parts.alias("parts")).select("n", F.posexplode(paths).alias("at", "path"))
    own = rows.groupBy("path", "at").agg(F.sum("n").alias("n"))
    own = own.select("path", (F.col("at") + 1).cast("long").alias("depth"), F.when(F.col("at") > 0, F.regexp_replace("path", " / [^/]*$", "")).alias("parent"), "n")
    children = own.where("parent is not null").groupBy(F.col("parent").alias("path")).agg(F.countDistinct("path").alias("n_children"))
    return own.join(children, "path", "left").select("path", "depth", "parent", "n", F.coalesce("n_children", F.lit(0)).alias("n_children"))


def pattern_summary(df: DataFrame, c: str) -> DataFrame:
    """feature, n, pct over the ten content features."""
    found = content_patterns(F.col(c))
    row = df.agg(*[F.struct(F.sum(v.cast("long")).alias("n"), F.round(100 * F.avg(v.cast("int")), 4).alias("pct")).alias(k) for k, v in found.items()])
    return long_form(row, "feature", "v").select("feature", "v.n", "v.pct")


def bibliography_patterns(df: DataFrame, c: str, kind: str, label: str = "Bibliography Entry") -> DataFrame:
    """pattern, n, pct over eight patterns, in the rows of one type; publisher to page_count are columns."""
    t = F.col(c)
    tests = {"has_volumes_header": has(t, "===Volumes==="), "has_triple_quotes": has(t, "'''"), "has_lst_tag": has(t, "<lst"), **{f"has_{x}": F.col(x).isNotNull() for x in ("publisher", "year", "location", "page_count")}, "is_redirect": F.coalesce(t.startswith("#REDIRECT"), F.lit(False))}
    row = df.where(F.col(kind) == label).agg(*[F.struct(F.count_if(v).alias("n"), F.round(100 * F.avg(v.cast("int")), 4).alias("pct")).alias(k) for k, v in tests.items()])
    return long_form(row, "pattern", "v").select("pattern", "v.n", "v.pct")


def true_rate(df: DataFrame, c: Column) -> DataFrame:
    return df.agg(F.round(100 * F.avg(c.cast("int")), 4).alias("pct"))


def all_equal(df: DataFrame, c: str) -> DataFrame:
    """Whether a column has one value only; nulls don't count."""
    return df.agg((F.countDistinct(c) == 1).alias("all_equal"))


def markup_by_type(df: DataFrame, c: str, kind: str) -> DataFrame:
    """Per type the number of rows with each kind of markup, all in one pass."""
    return df.groupBy(kind).agg(*[F.count_if(matches(F.col(c), p)).alias(k) for k, p in FEATURES.items()], F.count("*").alias("n"))


def encoding_markers(df: DataFrame, c: str, kind: str) -> DataFrame:
    """Per type: rows with each of nine markers (m1..m9), and with any trace."""
    return df.groupBy(kind).agg(*[F.count_if(has(F.col(c), m)).alias(f"m{i}") for i, m in enumerate(MARKERS, 1)], F.count_if(has(F.col(c), "Ã")).alias("affected"))


def language_indicators(df: DataFrame, c: str) -> DataFrame:
    return long_form(df.agg(*[F.count_if(matches(F.col(c), p, True)).alias(k) for k, p in INDICATORS.items()]), "language", "n")


def work_references(df: DataFrame, c: str, works: Mapping[str, Sequence[str]] = WORKS) -> DataFrame:
    """Mentions of works; a row counts once for each variant that it has."""
    import re

    sums = {w: sum((F.sum(matches(F.col(c), rf"\b{re.escape(v)}\b", True).cast("long")) for v in variants), F.lit(0)) for w, variants in works.items()}
    return long_form(df.agg(*[F.coalesce(s, F.lit(0)).cast("long").alias(k) for k, s in sums.items()]), "work", "n")


def timeline(df: DataFrame, c: str) -> DataFrame:
    """year, mentions, era (lifetime, posthumous or other) of all years named in texts, 1850 to 2025."""
    born, died = LIFETIME
    y = F.col("year")
    rows = df.select(F.explode(every(F.col(c), YEAR)).alias("year")).select(y.cast("long").alias("year")).where(y.between(1850, 2025))
    return rows.groupBy("year").agg(F.count("*").alias("mentions")).withColumn("era", F.when(y.between(born, died), "lifetime").when(y > died, "posthumous").otherwise("other"))


def link_stats(df: DataFrame, c: str) -> DataFrame:
    n = F.size(internal_links(F.col(c)))
    return df.agg(F.sum(n).cast("long").alias("total"), F.round(F.avg(n), 4).alias("mean"), F.max(n).cast("long").alias("most"), F.count_if(n > 0).alias("with_links"))


def category_coverage(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.count_if(F.size(categories(F.col(c))) > 0).alias("with_categories"))


def validate(df: DataFrame, suspicious: str = "[ÃÂ]") -> DataFrame:
    """column, n_null, n_empty, n_suspicious: the rows of each column without value, with an empty text, and with a text whose encoding looks broken; one pass for all."""
    texts = {c for c, t in df.dtypes if t == "string"}
    none = F.lit(0).cast("long")
    row = df.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("n_null"), (F.count_if(F.col(c) == "") if c in texts else none).alias("n_empty"), (F.count_if(F.col(c).rlike(suspicious)) if c in texts else none).alias("n_suspicious")).alias(c) for c in df.columns])
    return long_form(row, "column", "v").select("column", "v.*")


def compare(frames: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """part, label, n of each frame in a column of its own, same: the number of rows and the rows of each kind, side by side."""
    out = None
    for name, df in frames.items():
        rows = df.groupingSets([[], [F.col(kind)]], F.col(kind)).agg(F.count("*").alias(name), F.grouping_id(kind).alias("g"))
        one = rows.select(F.when(F.col("g") == 1, "rows").otherwise("kind").alias("part"), F.coalesce(F.when(F.col("g") == 1, "all").otherwise(F.col(kind)), F.lit("")).alias("label"), name)
        out = one if out is None else out.join(one, ["part", "label"], "full")
    counts = [F.coalesce(F.col(n), F.lit(0)) for n in frames]
    return out.select("part", "label", *[c.alias(n) for c, n in zip(counts, frames, strict=True)], (F.greatest(*counts) == F.least(*counts)).alias("same") if len(counts) > 1 else F.lit(True).alias("same"))
