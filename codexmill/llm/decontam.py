"""Benchmark decontamination by winnowing, in Spark expressions only.

Of every run of 4 consecutive 5-word hashes the least is a fingerprint, so any 8 words that a document
shares with an item give both a common fingerprint. Fingerprints are joined; only around such hits are
the 8-word windows themselves compared, word for word.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.llm.common import cut, small, text_hash

WINDOW = 8
GRAM = 5
RUN = WINDOW - GRAM + 1
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words where A-Z are as they were.
CASED_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def folded(text: str) -> Column:
    """A text with A-Z (and no other letter) lower-cased, in a form that keeps what differs different.

    The UTF-8 bytes are read as Latin-1 before lower(): ASCII is as usual, and of the other bytes only
    the leading ones of two-byte characters move, to values that stay apart from the rest by the
    number of bytes that follow. translate() would do the same a hundred times slower.
    """
    return F.lower(F.decode(F.coalesce(F.col(text), F.lit("")).cast("binary"), "ISO-8859-1"))


def words(text: str) -> Column:
    """Words of a text with A-Z lower-cased; a null text has none."""
    return F.array_remove(F.split(folded(text), WORDS.replace("[^", "[")), "")


def _hashes(df: DataFrame) -> DataFrame:
    """w (words) to g: the hashes of its 5-word grams (the last four entries are of fewer words)."""
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    grams = F.transform("h", lambda x, i: F.xxhash64(x, *[F.get(F.col("h"), i + j) for j in range(1, GRAM)]))
    return df.withColumn("g", grams).drop("h")


def _least() -> Column:
    """Of g: the least hash of each run, by the run's first place."""
    n = F.size("g") - (GRAM - 1)  # the last ones are not of GRAM words
    least = F.transform("g", lambda x, i: F.least(x, *[F.get(F.col("g"), i + j) for j in range(1, RUN)]))
    return F.slice(least, F.lit(1), F.greatest(n - (RUN - 1), F.lit(0)))


def _marks() -> Column:
    """Of m, what _least() gives: fp and at, for the first run of each stretch of runs that have the same hash, and again every RUN runs.

    So the windows of any hit begin at most RUN - 1 words after a mark with its hash.
    """
    first = lambda x, i: (i % RUN == 0) | (x != F.get(F.col("m"), i - 1))
    return F.filter(F.transform("m", lambda x, i: F.when(first(x, i), F.struct(x.alias("fp"), i.alias("at")))), lambda x: x.isNotNull())


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, k (words), window (words joined by one space), distinct; an item of fewer than 8 words is one window."""
    items = benchmark.select("item_id", words("text").alias("w")).where(F.size("w") > 0)
    k = F.least(F.size("w"), F.lit(WINDOW))
    starts = F.sequence(F.lit(1), F.size("w") - k + 1)
    return items.select("item_id", k.alias("k"), F.explode(F.transform(starts, lambda s: F.array_join(F.slice(F.col("w"), s, k), " "))).alias("window")).distinct()


def cells(found: DataFrame, *arrays: str) -> int:
    """Rows and entries of the arrays, which a broadcast of found would hold."""
    return sum(x or 0 for x in found.agg(F.count("*"), *[F.sum(F.size(c)) for c in arrays]).first())


def hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, th, start (word, from 1), k, window: every occurrence of an item's window in a document, once; and item_windows()."""
    windows = cut(item_windows(benchmark))
    distinct = windows.select("k", "window").distinct()
    n_windows, chars, short = distinct.agg(F.count("*"), F.sum(F.length("window")), F.collect_set(F.when(F.col("k") < WINDOW, F.col("k")))).first()
    keyed = docs.select("doc_id", text_hash().alias("th"), words("text").alias("w"))
    items = benchmark.select(words("text").alias("w"))
    prints = _hashes(items).select(F.explode(F.array_distinct(_least())).alias("fp")).distinct()

    # Marks of documents that some item has, too.
    marks = _hashes(keyed).select("doc_id", "th", _least().alias("m")).select("doc_id", "th", F.explode(_marks()).alias("x"))
    found = marks.select("doc_id", "th", "x.fp", "x.at").join(small(prints, n_windows), "fp")
    found = cut(found.groupBy("doc_id", "th").agg(F.collect_set("at").alias("marks")))
    near = found.select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"), "marks")
    theirs = docs.select("doc_id", text_hash().alias("th"), "text").join(small(near, cells(found, "marks")), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th"))).dropDuplicates(["doc_id", "th"])
    # After each: the windows that may hold it, compared as words.
    full = theirs.select("doc_id", "th", "marks", words("text").alias("w"))
    starts = F.array_distinct(F.flatten(F.transform("marks", lambda i: F.sequence(i + 1, i + RUN))))
    starts = F.filter(starts, lambda s: s + (WINDOW - 1) <= F.size("w"))
    full = full.select("doc_id", "th", F.explode(F.transform(starts, lambda s: F.struct(s.alias("start"), F.array_join(F.slice(F.col("w"), s, F.lit(WINDOW)), " ").alias("window")))).alias("x"))
    full = full.select("doc_id", "th", "x.start", F.lit(WINDOW).alias("k"), "x.window")
    for k in sorted(short or []):  # items too short to have a fingerprint: their one window against all runs of as many words
        own = keyed.dropDuplicates(["doc_id", "th"]).where(F.size("w") >= k)
        runs = own.select("doc_id", "th", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda s: F.array_join(F.slice(F.col("w"), s, F.lit(k)), " "))).alias("p", "window"))
        full = full.union(runs.select("doc_id", "th", (F.col("p") + 1).alias("start"), F.lit(k).alias("k"), "window"))
    return full.join(small(distinct, max(n_windows, (chars or 0) // 100), 300_000), ["k", "window"]), windows


def found_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """k_id, k_th (doc_id and text's hash), hit_words (places from 1), items (sorted strings) of the documents with hits."""
    found, windows = hits(docs, benchmark)
    found = cut(found.select("doc_id", "th", "start", "k", "window"))
    covered = found.groupBy("doc_id", "th").agg(F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("start"), F.col("start") + F.col("k") - 1)))).alias("hit_words"))
    items = found.select("doc_id", "th", "k", "window").distinct().join(windows, ["k", "window"]).groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return covered.alias("c").join(items.alias("i"), F.col("c.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("c.th") == F.col("i.th")), "left").select(F.col("c.doc_id").alias("k_id"), F.col("c.th").alias("k_th"), "hit_words", "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, least_items: int = 2) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items (sorted strings), contaminated.

    Equal rows have equal results; null texts have no words and no hits; an item without words occurs
    nowhere; items that are equal count each.
    """
    every = docs.select("doc_id", text_hash().alias("th"), F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), CASED_WORDS.replace("[^", "[")), "")).cast("long").alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return every.join(found_items(docs, benchmark), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("hit_words"), F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        (F.size(items) >= least_items).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, least_items: int = 2) -> DataFrame:
    """docs without the contaminated documents, and without the words that are hit in the others; all else as it was.

    Columns are docs' own; where text changes, n_chars (if there is one) follows.
    """
    found = cut(found_items(docs, benchmark))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), text_hash().alias("th"))
    rows = rows.join(small(found, cells(found, "hit_words", "items")), F.col("doc.doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left").where(F.coalesce(F.size("items") < least_items, F.lit(True)))
    gap = CASED_WORDS.replace("[^", "[")
    pieces = F.regexp_extract_all(F.col("doc.text"), F.lit(f"({gap[:-1]}*{CASED_WORDS})"), F.lit(1))
    places = lambda p: F.array_except(F.when(F.size(p) > 0, F.sequence(F.lit(1), F.size(p))).otherwise(F.array().cast("array<int>")), F.col("hit_words"))
    kept = F.get(F.transform(F.array(pieces), lambda p: F.array_join(F.transform(places(p), lambda i: F.get(p, i - 1)), "")), F.lit(0))
    left = F.trim(F.concat(kept, F.regexp_extract(F.col("doc.text"), f"({gap[:-1]}*)$", 1)))
    text = F.when(F.col("hit_words").isNull(), F.col("doc.text")).otherwise(left)
    return rows.select(*[text.alias(c) if c == "text" else F.when(F.col("hit_words").isNull(), F.col("doc.n_chars")).otherwise(F.length(left)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("doc")[c].alias(c) for c in docs.columns])


def op8_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """decontaminate(), the items as their digest: one row for each row of documents.

    Null and empty texts have no words, hits or items (the digest of the empty string); very long texts
    are read whole, by steps that follow their length; repeated rows and ids come out as often as they
    go in; items that tie are sorted as strings; columns besides doc_id and text are not read. An empty
    table gives an empty one, an empty benchmark no hits.
    """
    return decontaminate(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
ORACLE = rf"""
with d as materialized (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORDS}') as w from documents),
i as materialized (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORDS}') as w from benchmark),
iw as materialized (select distinct item_id, least(len(w), {WINDOW}) as k, array_to_string(w[s : s + least(len(w), {WINDOW}) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) as s from i where len(w) > 0)),
ks as (select distinct k from iw),
dw as (select rid, s, k, array_to_string(w[s : s + k - 1], ' ') as win from (select rid, w, k, unnest(range(1, len(w) - k + 2)) as s from d, ks)),
h as materialized (select distinct dw.rid, dw.s, dw.k, iw.item_id from dw join iw on dw.k = iw.k and dw.win = iw.win),
hit as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(s, s + k)) as p from h) group by rid),
items as (select rid, count(*) as n_items, string_agg(x, ',' order by x) as ids from (select distinct rid, cast(item_id as varchar) as x from h) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_items, 0) >= 2 as contaminated
from d left join hit using (rid) left join items using (rid)
"""
