"""The named queries, each with the SQL that it must agree with where SQL can say it.

Most work on entries, wiki-like texts that are made from orders, lineitem, part and customer by the
same SQL in Spark and in the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.functions import classify, encoding, extract, markup
from codexmill.functions import text as tx
from codexmill.operators import profile, relations, search
from codexmill.plans import pipeline
from codexmill.sources import dump
from codexmill.sources.schemas import FINAL

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

#: Twelve kinds of entry by o_orderkey; the same text in both engines.
ENTRIES = """
select o_orderkey as page_id, replace(p_name, ' ', '_') as page_title, y as year_no, p_size * 10 as pages_no, cast(o_orderkey % 8 + 1 as int) as blob_id,
  cast(case when o_orderkey % 9 = 0 then concat(cast(o_orderkey as string), ',', cast(p_partkey as string)) else cast(o_orderkey as string) end as string) as text_id,
  case o_orderkey % 12
    when 0 then concat('#REDIRECT [[', p_name, ']]')
    when 1 then concat('#REDIRECT[[', p_name, ']]', chr(10), 'moved')
    when 2 then concat(chr(39), chr(39), chr(39), p_name, chr(39), chr(39), chr(39), chr(10), '===Volumes===', chr(10), '<lst type=bracket>', chr(10), 'Verlag: ', p_brand, '. Wien, ', ys, '. ', ps, ' p.', chr(10), '</lst>', chr(10), '[[Category:Fiction / Volumes (German)|', c_name, ']]')
    when 3 then concat('An essay on ', p_name, '. Published by Orell Press. London ', ys, '. See [[Angst|Fear]] and [[Amok]].')
    when 4 then concat(chr(39), chr(39), chr(39), p_name, chr(39), chr(39), chr(39), ' Translated by Jean Example, Paris ', ys, '. ', ps, ' pages. Schachnovelle and Amok. [[Category:', p_type, ' / ', c_mktsegment, '|', c_name, ']] [[Category:Essays / Individual Essays (French)]]')
    when 5 then concat('A review of ', p_name, ' (', ys, '). Language: German. Verlag of Leipzig, ', p_brand, '.')
    when 6 then concat('Letter to ', c_name, ', Berlin, ', ys, ' and 1942. [[X|y]] [[Z]] ', chr(39), chr(39), 'sic', chr(39), chr(39), ' http://example.org/', cast(p_partkey as string), ' end')
    when 7 then concat('The film adaptation of Marie Antoinette, ', ys, '; in German and English. <b>Press</b>')
    when 8 then concat('Wie wÃ¤re der KongreÃŸ von ', ys, '? GrÃ¼n und schÃ¶n, Sao JosÃ© ', p_name)
    when 9 then concat(p_name, ' &amp; ', p_brand, '&nbsp;&#8211; &lt;', ys, '&gt;')
    when 10 then concat(p_name, ' [', p_type, ']. Moskva: Verlag ', p_brand, ', ', ys, '. ', ps, 'p. [[Category:Poetry / Anthologies (Russian)]]')
    else case when o_orderkey % 24 = 11 then null else '' end
  end as content
from (select o_orderkey, o_custkey, cast(1815 + o_orderkey % 206 as int) as y, cast(1815 + o_orderkey % 206 as string) as ys from {orders}) o
  join (select l_orderkey, min(l_partkey) as l_partkey from {lineitem} where l_linenumber = 1 group by l_orderkey) l on o_orderkey = l_orderkey
  join (select *, cast(p_size * 10 as string) as ps from {part}) p on l_partkey = p_partkey join {customer} c on o_custkey = c_custkey
"""
# What the oracles expect, written out apart from what the operators use.
_PERIODS = ["Pre-lifetime (before 1881)", "During Lifetime (1881-1942)", "Post-WWII (1943-1980)", "Late 20th Century (1981-2000)", "Contemporary (after 2000)"]
_BINS = [("1-10", 0, 10), ("11-50", 10, 50), ("51-100", 50, 100), ("101-200", 100, 200), ("201-500", 200, 500), ("501-1000", 500, 1000), ("1000+", 1000, None)]
_MARKERS = ["Ã¤", "Ã¶", "Ã¼", "Ãœ", "ÃŸ", "Ã©", "Ã¨", "Ã²", "Ã¹"]
_CONFIDENCE = {"Redirect": 0.99, "Category": 0.95, "Bibliography Entry": 0.9, "Essay": 0.8, "Translation": 0.8, "Poetry": 0.75, "Correspondence": 0.75, "Unknown": 0.0}
_ENTITIES = [("&nbsp;", " "), ("&mdash;", "—"), ("&ndash;", "–"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&#8211;", "–"), ("&#8212;", "—"), ("&#8216;", "‘"), ("&#8217;", "’"), ("&#8220;", "“"), ("&#8221;", "”"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
_REPAIRS = [("Ã¤", "ä"), ("ÃŸ", "ß"), ("Ã¼", "ü"), ("Ã¶", "ö"), ("Ã©", "é")]

_CLASS = r"case when content is null then null when contains(content, '[[Category:') then 'Category' when contains(content, 'Volumes') or contains(content, '<lst type=bracket>') then 'Bibliography Entry' when regexp_matches(content, '(?i)\b(essay|essays)\b') then 'Essay' when regexp_matches(content, '(?i)\b(translation|translated by)\b') then 'Translation' when regexp_matches(content, '(?i)\b(review|reviews|reviewed by|rezension)\b') then 'Review' when regexp_matches(content, '(?i)\b(letter|correspondence|brief)\b') then 'Correspondence' when regexp_matches(content, '(?i)\b(film|movie|adaptation)\b') then 'Film/Media' when regexp_matches(content, '(?i)\b(biography|biographie|biografie)\b') then 'Biography' else 'Other' end"


def _replaced(x: str, pairs: list[tuple[str, str]]) -> str:
    """SQL that replaces each pair in x, in order."""
    for a, b in pairs:
        x = f"replace({x}, '{a.replace(chr(39), chr(39) * 2)}', '{b.replace(chr(39), chr(39) * 2)}')"
    return x


_E = "e as (" + ENTRIES.format(orders="orders", lineitem="lineitem", part="part", customer="customer") + ")"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ENTRIES, **{t: table(spark, sf_dir, t) for t in ("orders", "lineitem", "part", "customer")})


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if oracle:
            _ORACLES[name] = oracle
        return f

    return add


def on_entries(name: str, f: Callable[[DataFrame], DataFrame], oracle: str | None = None) -> None:
    """oracle goes on after `with e as (...)`."""
    query(name, oracle and f"with {_E}{oracle if oracle.startswith(',') else ' ' + oracle}")(lambda spark, d: f(entries(spark, d)))


def on_table(name: str, source: str, f: Callable[[DataFrame], DataFrame], oracle: str | None = None) -> None:
    query(name, oracle)(lambda spark, d: f(table(spark, d, source)))




def _numbered(df: DataFrame) -> DataFrame:
    """A small ordered result with its rows' places in rn, so that an oracle sees the order too."""
    return df.coalesce(1).withColumn("rn", F.monotonically_increasing_id())


def _c() -> Column:
    return F.col("content")


_LEN = "count(*) as n, count(distinct text) as n_distinct, min(length(text)) as min_len, max(length(text)) as max_len, round(avg(length(text)), 4) as avg_len, cast(median(length(text)) as double) as median_len"

# Profiles of the given tables.
on_table("doc_length_stats", "documents", lambda df: profile.length_stats(df, "text"), f"select {_LEN} from documents")
on_table("doc_length_by_lang", "documents", lambda df: profile.length_stats(df, "text", ["lang"]), f"select lang, {_LEN} from documents group by lang")
on_table("value_counts_event_type", "events", lambda df: profile.value_counts(df, "event_type"), "select event_type, count(*) as n from events where event_type is not null group by 1")
on_table("top_events_users", "events", lambda df: profile.value_counts(df, "user_id", 10), "select user_id, count(*) as n from events where user_id is not null group by 1 order by n desc, user_id limit 10")
on_table("share_of_total", "events", lambda df: profile.shares(df, "event_type"), "select event_type, count(*) as n, round(100.0 * count(*) / (select count(*) from events), 4) as pct from events group by 1")
on_table("share_within_group", "documents", lambda df: profile.shares(df, "lang", ["source"]), "select source, lang, n, round(100.0 * n / sum(n) over (partition by source), 4) as pct from (select source, lang, count(*) as n from documents group by 1, 2)")


@query(
    "missing_profile",
    "with j as (select c_name, o_orderkey, o_orderstatus, case when c_custkey % 5 = 0 then '' else c_mktsegment end as segment from customer left join orders on c_custkey = o_custkey), "
    + "p as ("
    + " union all ".join(f"select '{c}' as \"column\", count(*) - count({c}) as n_null, {e} as n_empty, count(*) as n from j" for c, e in (("c_name", "count(*) filter (c_name = '')"), ("o_orderkey", "0"), ("o_orderstatus", "count(*) filter (o_orderstatus = '')"), ("segment", "count(*) filter (segment = '')")))
    + ') select "column", n_null, cast(n_empty as bigint) as n_empty, round(100.0 * n_null / n, 4) as pct_null from p',
)
def _missing(spark: SparkSession, d: str) -> DataFrame:
    return profile.missing_profile(_customers(spark, d))


def _customers(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left").select("c_name", "o_orderkey", "o_orderstatus", F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment"))


on_table("high_missing", "customer", lambda df: profile.high_missing(df.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).alias("builder"))), "select 'builder' as \"column\", round(100.0 * count(*) filter (c_mktsegment <> 'BUILDING') / count(*), 4) as pct_null from customer")
on_table("duplicate_texts", "documents", lambda df: profile.duplicated(df, "text", "doc_id"), "select doc_id, times from (select doc_id, count(*) over (partition by text) as times from documents) where times > 1")
on_table("html_strip", "pages", lambda df: df.select("page_id", F.md5(markup.strip_html(F.col("html")).cast("binary")).alias("digest")), r"select page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[\s\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{85}]+', ' ', 'g'), '^ | $', '', 'g')) as digest from pages")
on_table("page_urls", "pages", lambda df: df.select("page_id", F.array_join(markup.urls(F.col("url")), " ").alias("urls")), r"select page_id, array_to_string(regexp_extract_all(url, 'https?://\S+'), ' ') as urls from pages")
on_table("html_entities", "pages", lambda df: df.select("page_id", F.length(encoding.decode_entities(F.col("html"))).cast("long").alias("n")), f"select page_id, length({_replaced('html', _ENTITIES)}) as n from pages")
on_table("nfc", "documents", lambda df: df.select("doc_id", F.md5(encoding.nfc(F.replace(F.col("text"), F.lit("ä"), F.lit("ä"))).cast("binary")).alias("digest")), "select doc_id, md5(nfc_normalize(replace(text, 'ä', 'ä'))) as digest from documents")
on_table("part_page_bins", "part", lambda df: profile.page_bins(df.select((F.col("p_size") * F.col("p_size")).alias("pages")), "pages"),
    "with p as (select p_size * p_size as x from part) select bin, n from (" + " union all ".join(f"select '{name}' as bin, count(*) filter (x > {lo}{'' if hi is None else f' and x <= {hi}'}) as n from p" for name, lo, hi in _BINS) + ")")
on_table("part_size_stats", "part", lambda df: profile.number_stats(df, "p_size"), "select count(p_size) as n, cast(min(p_size) as double) as least, cast(max(p_size) as double) as greatest, round(avg(p_size), 4) as mean, cast(median(p_size) as double) as median, cast(max(p_size) - min(p_size) + 1 as double) as span from part")


@query("left_merge_nullsafe", "select d.doc_id, l.quality, l.toxic from (select doc_id, case when doc_id % 50 = 0 then null else doc_id end as k from documents) d left join (select case when doc_id % 50 = 1 then null else doc_id end as k, quality, toxic from labels) l on d.k is not distinct from l.k")
def _left_merge(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 50 != 0, F.col("doc_id")).alias("k"))
    right = table(spark, d, "labels").select(F.when(F.col("doc_id") % 50 != 1, F.col("doc_id")).alias("k"), "quality", "toxic")
    return relations.left_merge(left, right, "k").select("doc_id", "quality", "toxic")


_CHAIN = """
page as (select o_orderkey as page_id, cast(o_orderkey % 2 as int) as page_namespace, concat('0x', hex(c_name)) as page_title, o_orderkey * 10 as page_latest from {orders} join {customer} on o_custkey = c_custkey),
revision as (select o_orderkey * 10 as rev_id, o_orderkey as rev_page from {orders} where o_orderkey % 7 <> 0),
slots as (select o_orderkey * 10 as slot_revision_id, o_orderkey * 100 as slot_content_id from {orders}),
content as (select o_orderkey * 100 as content_id, case when o_orderkey % 3 = 0 then concat('0x', hex(concat('tt:', cast(o_orderkey as string)))) when o_orderkey % 5 = 0 then 'bad' else concat('tt:', cast(o_orderkey as string)) end as content_address from {orders})
"""


def _chain(spark: SparkSession, d: str) -> DataFrame:
    given = {t: table(spark, d, t) for t in ("orders", "customer")}
    return dump.page_texts(*[spark.sql(f"with {_CHAIN} select * from {name}", **given) for name in ("page", "revision", "slots", "content")])


_CHAIN_SQL = f"with {_CHAIN.format(orders='orders', customer='customer')}, linked as (select page_id, c_name as page_title, case when o_orderkey % 3 <> 0 and o_orderkey % 5 = 0 then null else o_orderkey end as text_id from page join revision on page_latest = rev_id join slots on rev_id = slot_revision_id join content on slot_content_id = content_id join orders on page_id = o_orderkey join customer on o_custkey = c_custkey where page_namespace = 0)"
query("link_chain_join", f"{_CHAIN_SQL} select page_id, page_title, text_id from linked")(_chain)
_TUPLES = "select cast(o_orderkey % 8 as int) as blob_id, o_orderkey as text_id, o_comment0 as content, 'utf-8' as flags from (select o_orderkey, concat('text of ', cast(o_orderkey as string)) as o_comment0 from {orders} where o_orderkey % 11 <> 0 union all select o_orderkey, concat('again ', cast(o_orderkey as string)) from {orders} where o_orderkey % 13 = 0)"


def _tuples(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_TUPLES, orders=table(spark, d, "orders"))


query("extract_entries", f"{_CHAIN_SQL}, t as ({_TUPLES.format(orders='orders')}) select page_id, page_title, text_id, content, flags, blob_id from (select page_id, page_title, cast(text_id as varchar) as text_id, content, flags, blob_id, row_number() over (partition by page_id order by blob_id, content) as rn from linked join t using (text_id)) where rn = 1")(lambda spark, d: dump.extract_entries(_chain(spark, d), _tuples(spark, d)))
query("not_found_pages", f"{_CHAIN_SQL}, t as ({_TUPLES.format(orders='orders')}) select page_id, page_title, text_id from linked where text_id is null or text_id not in (select text_id from t)")(lambda spark, d: dump.not_found(_chain(spark, d), _tuples(spark, d)).select("page_id", "page_title", "text_id"))
_BLOBS = """select blob_id, concat('CREATE TABLE x;', chr(10), array_join(collect_list(line), chr(10))) as text from (
  select cast(o_orderkey % 8 as int) as blob_id, concat('INSERT INTO `archive_text` VALUES (', cast(o_orderkey as string), ',_binary ', chr(39), 'say (94, ', o_orderpriority, chr(39), chr(39), 's note', chr(39), ',_binary ', chr(39), 'utf-8', chr(39), '),(', cast(o_orderkey + 10000000 as string), ',_binary ', chr(39), o_orderstatus, chr(39), ',_binary ', chr(39), 'x', chr(39), ');') as line from {orders}) group by blob_id"""


def _blobs(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_BLOBS, orders=table(spark, d, "orders"))


query("insert_tuple_parse", "select cast(o_orderkey % 8 as int) as blob_id, o_orderkey as text_id, concat('say (94, ', o_orderpriority, '''s note') as content, 'utf-8' as flags from orders union all select cast(o_orderkey % 8 as int), o_orderkey + 10000000, o_orderstatus, 'x' from orders")(lambda spark, d: dump.insert_tuples(_blobs(spark, d)))
query("insert_tuple_lines", "select o_orderkey as text_id, concat('say (94, ', o_orderpriority, '''s note') as content, 'utf-8' as flags from orders union all select o_orderkey + 10000000, o_orderstatus, 'x' from orders")(lambda spark, d: dump.insert_tuples_by_line(_blobs(spark, d).select(F.explode(F.split("text", "\n")).alias("value"))))
query("blob_sniff", "select cast(o_orderkey % 8 as int) as blob_id, cast(15 + sum(length(concat('INSERT INTO `archive_text` VALUES (', o_orderkey, ',_binary ''say (94, ', o_orderpriority, '''''s note'',_binary ''utf-8''),(', o_orderkey + 10000000, ',_binary ''', o_orderstatus, ''',_binary ''x'');'))) + count(*) as bigint) as size, true as has_insert, true as has_create, 'multi' as style, count(*) + 1 as about from orders group by 1")(lambda spark, d: dump.sniff(_blobs(spark, d)))
query("upsert", "select c_custkey, c_name, case when c_custkey % 4 = 0 then 'NEW' else c_mktsegment end as c_mktsegment from customer union all select c_custkey + 1000000000, c_name, 'NEW' from customer where c_custkey % 50 = 0")(
    lambda spark, d: (lambda c: dump.upsert(c, c.where("c_custkey % 4 = 0").withColumn("c_mktsegment", F.lit("NEW")).union(c.where("c_custkey % 50 = 0").select(F.col("c_custkey") + 1000000000, "c_name", F.lit("NEW"))), "c_custkey"))(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"))
)
on_table("sample_seeded", "customer", lambda df: relations.sample(df.select("c_custkey", "c_name"), 25, 7, "c_custkey"), "select c_custkey, c_name from customer order by md5(concat(cast(c_custkey as varchar), ':7')), c_custkey limit 25")

# Years, periods, pages of entries.
on_entries("decade_histogram", lambda e: _numbered(profile.decade_histogram(e, "year_no")), "select concat(cast(year_no // 10 * 10 as varchar), 's') as decade, count(*) as n, count(distinct year_no) as n_years, row_number() over (order by year_no // 10 * 10) - 1 as rn from e group by year_no // 10 * 10")
_PERIOD = "case " + " ".join(f"when {{y}} {cond} then '{p}'" for p, cond in zip(_PERIODS, ["< 1881", "<= 1942", "<= 1980", "<= 2000", "> 2000"], strict=True)) + " else '' end"
on_entries("period_histogram", lambda e: profile.period_histogram(e, "year_no"), ", p(period) as (values " + ", ".join(f"('{p}')" for p in _PERIODS) + f") select period, count(e.page_id) as n from p left join e on {_PERIOD.format(y='year_no')} = period group by 1")
on_entries("year_stats", lambda e: profile.number_stats(e, "year_no"), "select count(year_no) as n, cast(min(year_no) as double) as least, cast(max(year_no) as double) as greatest, round(avg(year_no), 4) as mean, cast(median(year_no) as double) as median, cast(max(year_no) - min(year_no) + 1 as double) as span from e")
on_entries("lifetime_split", lambda e: profile.lifetime_split(e, "year_no"), "select count(*) filter (year_no between 1881 and 1942) as lifetime, count(*) filter (year_no > 1942) as posthumous, round(100.0 * count(*) filter (year_no between 1881 and 1942) / count(year_no), 4) as pct_lifetime, round(100.0 * count(*) filter (year_no > 1942) / count(year_no), 4) as pct_posthumous from e")
on_entries(
    "decade_type_pivot",
    lambda e: profile.cross_counts(e.withColumn("kind", classify.classify_content(_c())), extract.decade(F.col("year_no")), "kind", ["Category", "Essay", "Review", "Correspondence", "Film/Media", "Other"]),
    'select cast(year_no // 10 * 10 as bigint) as "row", ' + ", ".join(f"count(*) filter (kind = '{k}') as \"{k}\"" for k in ("Category", "Essay", "Review", "Correspondence", "Film/Media", "Other")) + f" from (select year_no, {_CLASS} as kind from e) group by 1",
)
_CATS = r", c as (select page_id, year_no, unnest(regexp_extract_all(content, '\[\[Category:(.*?)(?:\|.*?)?\]\]', 1)) as category from e)"
on_entries("top5_per_period", lambda e: profile.top_in_groups(e.select(extract.time_period(F.col("year_no")).alias("period"), F.explode(tx.every(_c(), markup.CATEGORY_KEYLESS)).alias("category")), "period", "category"), f"{_CATS}, k as (select {_PERIOD.format(y='year_no')} as period, category, count(*) as n from c group by 1, 2) select period, category, n, rn from (select *, row_number() over (partition by period order by n desc, category) as rn from k) where rn <= 5")
on_entries("category_counts", lambda e: profile.category_counts(e, "content"), f"{_CATS} select category, count(*) as n from c group by 1")
on_entries("top_level_rollup", lambda e: profile.top_level(profile.category_counts(e, "content")), f"{_CATS} select trim(split_part(category, '/', 1)) as branch, count(*) as n from c group by 1")
on_entries("category_tree", lambda e: profile.category_tree(profile.category_counts(e, "content")), f"{_CATS}, p as (select unnest([trim(split_part(category, '/', 1)), category]) as path, unnest([1, 2]) as depth from c), n as (select path, cast(depth as bigint) as depth, count(*) as n from p group by 1, 2) select path, depth, case when depth = 2 then trim(split_part(path, '/', 1)) end as parent, n, case when depth = 1 then (select count(*) from n m where m.depth = 2 and trim(split_part(m.path, '/', 1)) = n.path) else 0 end as n_children from n")
on_entries("category_coverage", lambda e: profile.category_coverage(e, "content"), r"select count(*) as n, count(*) filter (regexp_matches(content, '\[\[Category:.*?\]\]')) as with_categories from e")
on_entries("entry_categories", lambda e: e.select("page_id", markup.format_categories(markup.categories(_c())).alias("categories"), F.coalesce(markup.main_category(markup.categories(_c())), F.lit("")).alias("main_category")),
    r", c as (select page_id, regexp_extract_all(coalesce(content, ''), '\[\[Category:(.*?)\]\]', 1) as l from e) select page_id, array_to_string(l, '; ') as categories, coalesce(trim(split_part(l[1], '/', 1)), '') as main_category from c")
on_entries("internal_links", lambda e: e.select("page_id", F.array_join(markup.internal_links(_c()), ";").alias("links")), r"select page_id, array_to_string(list_filter(regexp_extract_all(coalesce(content, ''), '\[\[(.*?)\]\]', 1), lambda x: not starts_with(x, 'Category:')), ';') as links from e")
on_entries("link_stats", lambda e: profile.link_stats(e, "content"), r", l as (select len(list_filter(regexp_extract_all(coalesce(content, ''), '\[\[(.*?)\]\]', 1), lambda x: not starts_with(x, 'Category:'))) as k from e) select cast(sum(k) as bigint) as total, round(avg(k), 4) as mean, max(k) as most, count(*) filter (k > 0) as with_links from l")

# Features and classes.
_FEATURES = {
    "has_title_markup": r"regexp_matches(content, '''''''.*?''''''')", "has_volumes": "contains(content, 'Volumes')", "has_year": r"regexp_matches(content, '\b(1[8-9]\d{2}|20[0-2]\d)\b')",
    "has_publisher": "regexp_matches(content, '(?i)(Verlag|Publisher|Press)')", "has_location": "regexp_matches(content, 'Wien|Berlin|Frankfurt|Leipzig|London|New York')", "has_list": "contains(content, '<lst')",
    "has_html": r"regexp_matches(content, '<\w+[^>]*>')", "has_category": "contains(content, '[[Category:')", "has_translation": r"regexp_matches(content, '(?i)\b(translation|translated by)\b')", "has_review": r"regexp_matches(content, '(?i)\b(review|reviewed|rezension)\b')",
}
on_entries("content_patterns", lambda e: e.select("page_id", *[v.alias(k) for k, v in classify.content_patterns(_c()).items()]), "select page_id, " + ", ".join(f"coalesce({v}, false) as {k}" for k, v in _FEATURES.items()) + " from e")
on_entries("pattern_summary", lambda e: profile.pattern_summary(e, "content"), " union all ".join(f"select '{k}' as feature, count(*) filter ({v}) as n, round(100.0 * count(*) filter ({v}) / count(*), 4) as pct from e" for k, v in _FEATURES.items()))
on_entries("classify_content", lambda e: e.select("page_id", classify.classify_content(_c()).alias("kind")), f"select page_id, {_CLASS} as kind from e")
_TYPE = r"case when content is null then 'Unknown' when starts_with(content, '#REDIRECT') then 'Redirect' when contains(content, '[[Category:') then 'Category' when contains(content, '<lst type=bracket') or regexp_matches(content, '''''''.*?''''''|\b(Volumes?|Band|Tome)\b|\b(Published|Erschienen)\b|\d+\s*p\.') then 'Bibliography Entry' when regexp_matches(content, '\b(Essay|Essays|Aufsatz)\b') then 'Essay' when regexp_matches(content, '\b(Translation|Translated|Translator)\b') then 'Translation' when regexp_matches(content, '\b(Poem|Gedicht|Poetry|Poesie|Lyrik)\b') then 'Poetry' when regexp_matches(content, '\b(Letter|Brief|Correspondence|Korrespondenz)\b') then 'Correspondence' else 'Unknown' end"
on_entries("identify_content_types", lambda e: e.select("page_id", classify.identify_content_type(_c()).alias("kind"), classify.type_confidence(classify.identify_content_type(_c())).alias("confidence")), f"select page_id, kind, case kind " + " ".join(f"when '{k}' then {v}" for k, v in _CONFIDENCE.items()) + f" end::double as confidence from (select page_id, {_TYPE} as kind from e)")
_MARKUP = {"bold": "''''''.*?''''''", "italic": "''''.*?''''", "category": r"\[\[Category:.*?\]\]", "link": r"\[\[.*?\]\]", "header": "={2,}.*?={2,}", "list": "<lst.*?>", "html": "<[^>]+>", "url": r"https?://\S+"}
on_entries("markup_by_type", lambda e: profile.markup_by_type(e.withColumn("kind", classify.identify_content_type(_c())), "content", "kind"), "select kind, " + ", ".join(f"count(*) filter (regexp_matches(content, '{p}')) as {k}" for k, p in _MARKUP.items()) + f", count(*) as n from (select content, {_TYPE} as kind from e) group by kind")
on_entries("encoding_markers", lambda e: profile.encoding_markers(e.withColumn("kind", classify.identify_content_type(_c())), "content", "kind"), "select kind, " + ", ".join(f"count(*) filter (contains(content, '{m}')) as m{i}" for i, m in enumerate(_MARKERS, 1)) + f", count(*) filter (contains(content, 'Ã')) as affected from (select content, {_TYPE} as kind from e) group by kind")
on_entries("blob_distribution", lambda e: profile.shares(e.withColumn("kind", classify.identify_content_type(_c())), "kind", ["blob_id"]), f"select blob_id, kind, n, round(100.0 * n / sum(n) over (partition by blob_id), 4) as pct from (select blob_id, {_TYPE} as kind, count(*) as n from e group by 1, 2)")
on_entries("language_indicators", lambda e: profile.language_indicators(e, "content"), " union all ".join(f"select '{k}' as language, count(*) filter (regexp_matches(content, '(?i){p}')) as n from e" for k, p in {"German": r"\b(German|Deutsch)\b", "English": r"\b(English|Englisch)\b", "French": r"\b(French|Französisch)\b", "Spanish": r"\b(Spanish|Spanisch)\b", "Italian": r"\b(Italian|Italiano|Italienisch)\b"}.items()))
_WORKS = {
    "Die Welt von Gestern": ["Die Welt von Gestern", "World of Yesterday", "Monde d''hier"], "Schachnovelle": ["Schachnovelle", "Chess Story", "Chess Novella", "Royal Game"], "Brief einer Unbekannten": ["Brief einer Unbekannten", "Letter from an Unknown Woman"],
    "Angst": ["Angst", "Fear", "Amok", "Peur"], "Amok": ["Amok", "Amok Runner"], "Brennendes Geheimnis": ["Brennendes Geheimnis", "Burning Secret"], "Sternstunden der Menschheit": ["Sternstunden der Menschheit", "Decisive Moments"],
    "Marie Antoinette": ["Marie Antoinette", "Marie-Antoinette"], "Joseph Fouché": ["Fouche"], "Ungeduld des Herzens": ["Ungeduld des Herzens", "Beware of Pity"], "Verwirrung der Gefühle": ["Confusion of Feelings", "Confusion des sentiments"],
    "Der Kampf mit dem Dämon": ["Struggle with the Daemon"], "Drei Meister": ["Drei Meister", "Three Masters"], "Rausch der Verwandlung": ["Rausch der Verwandlung", "Post-Office Girl"], "Clarissa": ["Clarissa"],
    "Maria Stuart": ["Maria Stuart", "Mary Stuart", "Marie Stuart"], "Magellan": ["Magellan", "Magallanes"], "Erasmus von Rotterdam": ["Erasmus", "Erasmus von Rotterdam"],
}
#: Mentions of works, one in each entry in turn.
_MENTIONS = ["World of Yesterday", "the Royal Game", "Letter from an Unknown Woman", "fear", "Burning Secret", "decisive moments", "Fouche", "Beware of Pity", "Confusion of Feelings", "Struggle with the Daemon", "Three Masters", "Post-Office Girl", "Clarissa", "Mary Stuart", "Magallanes", "Erasmus", "Angstrom"]
on_entries("work_references", lambda e: profile.work_references(e.select(F.concat("content", F.lit(" "), F.element_at(F.array(*[F.lit(m) for m in _MENTIONS]), (F.col("page_id") % len(_MENTIONS) + 1).cast("int")), F.lit(".")).alias("content")), "content"),
    f", w as (select content || ' ' || ({_MENTIONS})[page_id % {len(_MENTIONS)} + 1] || '.' as content from e) " + " union all ".join(f"select '{k}' as work, cast(" + " + ".join(rf"count(*) filter (regexp_matches(content, '(?i)\b{v}\b'))" for v in vs) + " as bigint) as n from w" for k, vs in _WORKS.items()))
on_entries("timeline", lambda e: profile.timeline(e, "content"), r", y as (select cast(unnest(regexp_extract_all(content, '\b(1[8-9]\d{2}|20[0-2]\d)\b', 1)) as bigint) as year from e) select year, count(*) as mentions, case when year between 1881 and 1942 then 'lifetime' when year > 1942 then 'posthumous' else 'other' end as era from y where year between 1850 and 2025 group by 1")

# Extraction. _FLAT has the plain texts (flat; lines: with line ends) of all entries.
_Q3, _Q2 = "'" * 6, "'" * 4
_FLAT = (
    r", s as (select *, regexp_replace(regexp_replace(regexp_replace(coalesce(content, ''), '\[\[Category:.*?\]\]', '', 'g'), '\{\{DEFAULTSORTKEY:.*?\}\}', '', 'g'), '\[\[([^\]|]*\|)?([^\]]*)\]\]', '\2', 'g') as t0 from e)"
    rf", u as (select *, replace(regexp_replace(regexp_replace(regexp_replace(t0, '(?s)<lst.*?>(.*?)</lst>', '\1', 'g'), '{_Q3}(.*?){_Q3}', '\1', 'g'), '{_Q2}(.*?){_Q2}', '\1', 'g'), '#REDIRECT ', '') as t1 from s)"
    r", f as (select *, trim(regexp_replace(t1, '\s+', ' ', 'g')) as flat, regexp_replace(regexp_replace(t1, '[ \t\r\f\v]+', ' ', 'g'), '^\s+|\s+$', '', 'g') as lines from u)"
)
on_entries("redirect_targets", lambda e: e.select("page_id", markup.redirect_target(_c()).alias("strict"), markup.redirect_target(_c(), False).alias("lenient")), r"select page_id, nullif(regexp_extract(content, '^#REDIRECT \[\[(.*?)\]\]', 1), '') as strict, nullif(regexp_extract(content, '#REDIRECT\s*\[\[(.*?)\]\]', 1), '') as lenient from e")
on_entries("redirect_resolution", lambda e: relations.resolve_redirects(e.groupBy(F.replace(F.col("page_title"), F.lit("_"), F.lit(" ")).alias("title")).agg(F.min(markup.redirect_target(_c())).alias("target")), "title", "target").select("title", "final_title", "dangling"), r", t as (select replace(page_title, '_', ' ') as title, min(nullif(regexp_extract(content, '^#REDIRECT \[\[(.*?)\]\]', 1), '')) as target from e group by 1) select title, coalesce(target, title) as final_title, coalesce(target, title) not in (select title from t) as dangling from t")
on_entries("remove_markup", lambda e: e.select("page_id", markup.remove_wiki_markup(_c()).alias("clean")),
    r", s as (select page_id, regexp_replace(regexp_replace(regexp_replace(coalesce(content, ''), '\[\[Category:.*?\]\]', '', 'g'), '\{\{DEFAULTSORTKEY:.*?\}\}', '', 'g'), '\[\[([^\]|]*\|)?([^\]]*)\]\]', '\2', 'g') as t from e), u as (select page_id, regexp_replace(regexp_replace(regexp_replace(t, '(?s)<lst.*?>(.*?)</lst>', '\1', 'g'), '''''''(.*?)''''''', '\1', 'g'), '''''(.*?)''''', '\1', 'g') as t from s) select page_id, trim(regexp_replace(replace(t, '#REDIRECT ', ''), '\s+', ' ', 'g')) as clean from u")
on_entries("clean_wiki_content", lambda e: e.select("page_id", markup.clean_wiki_content(_c()).alias("clean")), r"select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(content, '={2,}\s*(.*?)\s*={2,}', '\1', 'g'), '\[\[([^\]|]*\|)?([^\]]*)\]\]', '\2', 'g'), '''{2,}', '', 'g'), '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') as clean from e")
on_entries("clean_markup", lambda e: e.select("page_id", markup.clean_markup(_c()).alias("clean")), r"select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(content, '(?i)<br\s*/?>', chr(10), 'g'), '(?s)<(?:div|lst)[^>]*>(.*?)</(?:div|lst)>', '\1', 'g'), '\[\[([^\]|]*\|)?([^\]]*)\]\]', '\2', 'g'), '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') as clean from e")
on_entries("content_titles", lambda e: e.select("page_id", extract.content_title(_c()).alias("title"), extract.title_match(F.col("page_title"), extract.content_title(_c())).alias("title_match")), r", t as (select page_id, replace(page_title, '_', ' ') as p, coalesce(nullif(regexp_extract(content, '''''''(.*?)''''''', 1), ''), list_filter(list_transform(string_split(content, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], '') as title from e) select page_id, title, contains(p, title) or contains(title, p) as title_match from t")
_Y = r"nullif(regexp_extract(content, '\b(1[8-9]\d{2}|20[0-2]\d)\b', 1), '')"
on_entries("biblio_info", lambda e: e.select("page_id", *[v.alias(k) for k, v in extract.biblio_info(_c()).items() if k != "publisher"]), rf"select page_id, {_Y} as year, nullif(regexp_extract(content, '\b(Wien|Berlin|Frankfurt|Leipzig|London|New York|Paris|Hamburg|Salzburg)\b', 1), '') as location, trim(nullif(regexp_extract(content, '(?i)(?:Language|Sprache):\s*(.*?)(?:\.|\n|$)', 1), '')) as language, nullif(regexp_extract(content, '(\d+)(?:\s*)p\.', 1), '') as page_count from e")
on_entries("publishers", lambda e: e.select("page_id", extract.biblio_info(_c())["publisher"].alias("publisher")), r"select page_id, trim(coalesce(nullif(regexp_extract(content, '(?i)(?:Verlag|Publisher|Press):\s*(.*?)(?:\.|\n|$)', 1), ''), nullif(regexp_extract(content, '(?i)(?:published by|verlegt bei)\s*(.*?)(?:\.|\n|$)', 1), ''), nullif(regexp_extract(content, '(?i)\b(?:Verlag|Publishers?)\b[^\n.]*?([\w\s&]+)(?:,|\.|$)', 1), ''))) as publisher from e")
on_entries("bibliographic_data", lambda e: e.select("page_id", *[v.alias(k) for k, v in extract.bibliographic_data(_c(), F.col("page_title")).items()]),
    r", t as (select page_id, page_title, coalesce(content, '') as content from e) select page_id, coalesce(nullif(regexp_extract(content, '''''''(.*?)''''''', 1), ''), replace(page_title, '_', ' ')) as title, array_to_string(regexp_extract_all(content, '\b(1[8-9]\d{2}|20[0-2]\d)\b', 1)[1:3], ', ') as year, "
    r"case when contains(content, 'Wien') then 'Wien' when contains(content, 'London') then 'London' when contains(content, 'Paris') then 'Paris' when contains(content, 'Leipzig') then 'Leipzig' when contains(content, 'Berlin') then 'Berlin' when contains(content, 'Moskva') then 'Moskva' else '' end as location, "
    r"coalesce(trim(nullif(regexp_extract(content, '(?i)(?:Translated by|Translator|Translation by)[:\s]+([^,\n.]+)', 1), '')), '') as translator, "
    r"coalesce(nullif(regexp_extract(content, '(?i)(\d+)\s*p\.', 1), ''), nullif(regexp_extract(content, '(?i)(\d+)\s*pages', 1), ''), '') as page_count, "
    r"trim(coalesce(nullif(regexp_extract(content, '(?i)(?:Verlag|Publisher|Press):\s*([\w\s&.,\-]+)', 1), ''), nullif(regexp_extract(content, '(?i)(?:published by|verlegt bei)\s*([\w\s&.,\-]+)', 1), ''), nullif(regexp_extract(content, '(?i)\b(?:Verlag|Publishers?)\b[^\n.]*?([\w\s&.,\-]+)(?:,|\.|$)', 1), ''), ''), ' ' || chr(10)) as publisher, "
    r"'' as original_title, trim(coalesce(nullif(regexp_extract(content, '(?i)(?:Language|Sprache|Langue|Idioma)[:\s]+(.*?)(?:\.|$|\n)', 1), ''), nullif(regexp_extract(content, '(?i)(?:in|auf|en|in the|translated into)\s+(German|English|French|Spanish|Italian|Russian|Chinese|Japanese|Arabic|Portuguese)\b', 1), ''), '')) as language from t")  # fmt: skip
_EIGHT = "German|English|French|Spanish|Italian|Russian|Arabic|Chinese"
_VOTES = {
    "German": [r"\b(German|Deutsch)\b", r"\b(Verlag|Band|herausgegeben)\b", "(München|Berlin|Frankfurt|Leipzig|Wien)"], "English": [r"\b(English|translated into English)\b", r"\b(London|New York|Oxford|Cambridge)\b", r"\b(Publisher|Press)\b"],
    "French": ["(French|Français|traduit en français)", r"\b(Paris|Éditions)\b", r"\b(traduction|traduit)\b"], "Spanish": [r"\b(Spanish|Español|traducido al español)\b", r"\b(Madrid|Barcelona|Buenos Aires)\b", r"\b(traducción|traducido)\b"],
    "Italian": [r"\b(Italian|Italiano|tradotto in italiano)\b", r"\b(Roma|Milano|Torino|Firenze)\b", r"\b(traduzione|tradotto)\b"], "Russian": [r"\b(Russian)\b", r"\b(Moscow|Moskva|Moskau)\b"],
}
_VOTED = "case " + " ".join("when " + " + ".join(f"cast(regexp_matches(content, '(?i){p}') as int)" for p in ps) + f" >= 2 then '{lang}'" for lang, ps in _VOTES.items()) + " end"
on_entries("detect_language", lambda e: e.select("page_id", extract.detect_language(_c()).alias("language")),
    rf"select page_id, coalesce(nullif(regexp_extract(content, '(?i)\b({_EIGHT}) (edition|translation|version)\b', 1), ''), nullif(regexp_extract(content, '(?i)\b(translated into|translated to|translation into) ({_EIGHT})\b', 2), ''), nullif(regexp_extract(content, '(?i)\b(auf Deutsch|in English|en français|en español|in italiano)\b', 1), ''), {_VOTED}, nullif(regexp_extract(content, '\[\[Category:.*?\(({_EIGHT})\)\]\]', 1), ''), 'Unknown') as language from e")
on_entries("time_periods", lambda e: e.select("page_id", extract.time_period(F.col("year_no")).alias("period")), f"select page_id, {_PERIOD.format(y='year_no')} as period from e")
on_entries("catalog_numbers", lambda e: e.select("page_id", extract.catalog_numbers(F.col("text_id")).alias("x")).select("page_id", "x.*"), "select page_id, case when contains(text_id, ',') then split_part(text_id, ',', 1) else '' end as catalog_number_1, case when contains(text_id, ',') then split_part(text_id, ',', 2) else '' end as catalog_number_2 from e")
_CATLANG = r"coalesce(flatten(list_transform(regexp_extract_all(coalesce(content, ''), '\[\[Category:(.*?)\]\]', 1), lambda k: list_filter(['Russian', 'German', 'English', 'French', 'Spanish', 'Italian', 'Portuguese', 'Japanese', 'Chinese', 'Arabic', 'Hindi', 'Sanskrit', 'Hebrew'], lambda l: contains(k, l))))[1], '')"
on_entries("language_from_categories", lambda e: e.select("page_id", extract.language_from_categories(markup.categories(_c())).alias("language")), f"select page_id, {_CATLANG} as language from e")
_PAGES = r"coalesce(nullif(regexp_extract(flat, '(\d+)\s*(?:p\.|pages)', 1), ''), nullif(regexp_extract(flat, '(\d+)/\(\d+\)p\.', 1), ''), '')"
on_entries("page_counts", lambda e: e.select("page_id", extract.page_count(_c()).alias("pages")), f"{_FLAT} select page_id, {_PAGES} as pages from f")
on_entries("full_entries", lambda e: e.select("page_id", extract.full_entry(_c()).alias("entry")), f"{_FLAT} select page_id, regexp_replace(case when contains(lines, chr(10) || chr(10)) then split_part(lines, chr(10) || chr(10), 1) else substr(lines, 1, 250) end, '^\\s+|\\s+$', '', 'g') as entry from f")
on_entries("fix_encoding", lambda e: e.select("page_id", encoding.fix_encoding(_c()).alias("fixed"), encoding.fix_bytes(_c()).alias("by_bytes")),
    f"select page_id, {_replaced('content', [*_REPAIRS, *_ENTITIES])} as fixed, {_replaced('content', _REPAIRS)} as by_bytes from e")
on_entries("publisher_location", lambda e: e.select("page_id", extract.publisher_location(_c()).alias("x")).select("page_id", "x.*"),
    _FLAT + r""" select page_id, trim(coalesce(nullif(regexp_extract(flat, ':\s+"([^"]+)"', 1), ''), nullif(regexp_extract(flat, '(?:Izdatel''stvo|Publishing|Verlag|Éditions)\s+"?([^",.]+)"?', 1), ''), nullif(regexp_extract(flat, '(?:[A-Z][a-zA-Z\s]+:)?\s*([^,]+?)(?:,|\s+\d{4})', 1), ''), '')) as publisher, trim(coalesce(nullif(regexp_extract(flat, '([A-Z][a-zA-Z\s]+):', 1), ''), nullif(regexp_extract(flat, '(?i)(?:^|\s)(Moscow|Moskva|Berlin|London|New York|Paris|Wien|Vienna|Frankfurt|Leipzig)\b', 1), ''), '')) as location from f""")
on_entries("entry_titles", lambda e: e.select("page_id", extract.titles(_c()).alias("x")).select("page_id", "x.*"),
    _FLAT + r" select page_id, trim(case when regexp_matches(flat, '^[^\[]+\s*\[.*?\]') then regexp_extract(flat, '^([^\[]+)\s*\[(.*?)\]', 1) when regexp_matches(flat, '^(?:.*?\W)?\.(?:\W|$)') then regexp_extract(flat, '^((?:.*?\W)?)\.(?:\W|$)', 1) else flat end) as title, case when regexp_matches(flat, '^[^\[]+\s*\[.*?\]') then regexp_extract(flat, '^([^\[]+)\s*\[(.*?)\]', 2) else '' end as original from f")
on_entries("content_items", lambda e: e.select("page_id", F.explode(extract.content_items(F.concat(F.lit("Contents\n1. First ["), F.col("page_title"), F.lit("]. Translated by Jo Doe, pp. 1-"), F.col("pages_no"), F.lit("\n2. Second\n\nEnd")))).alias("i")).select("page_id", "i.*"), "select page_id, 'First' as title, page_title as original_title, 'Jo Doe' as translator, concat('1-', cast(pages_no as varchar)) as pages from e union all select page_id, 'Second', '', '', '' from e")
_SAID = r"trim(nullif(regexp_extract(content, '(?i)(?:Language|Sprache):\s*(.*?)(?:\.|\n|$)', 1), ''))"
on_entries("primary_languages", lambda e: profile.value_counts(e.select(extract.primary_language(F.coalesce(extract.biblio_info(_c())["language"], F.col("page_title"))).alias("language")), "language", 15).where("language <> 'Unknown'"), rf"select coalesce(nullif(regexp_extract(coalesce({_SAID}, page_title), '^([A-Za-z]+)', 1), ''), 'Unknown') as language, count(*) as n from e group by 1 order by n desc, language limit 15")
on_entries("places", lambda e: e.select("page_id", extract.normalise_place(extract.biblio_info(_c())["location"]).alias("place"), extract.iso_language(extract.language_from_categories(markup.categories(_c()))).alias("iso")),
    rf", p as (select page_id, nullif(regexp_extract(content, '\b(Wien|Berlin|Frankfurt|Leipzig|London|New York|Paris|Hamburg|Salzburg)\b', 1), '') as place, {_CATLANG} as lang from e) select page_id, case place when 'Wien' then 'Vienna' else place end as place, case lang when 'German' then 'de' when 'French' then 'fr' when 'Russian' then 'ru' end as iso from p")

on_entries("scored_fields", lambda e: e.select("page_id", extract.scored_year(_c()).alias("y"), extract.iso_by_indicators(_c()).alias("iso")).select("page_id", "y.year", "y.confidence", "iso"),
    r", t as (select page_id, lower(content) as low, nullif(regexp_extract(content, '(?i)(?:published|erschienen).*?(\d{4})', 1), '') as a, nullif(regexp_extract(content, '\[(\d{4})\]', 1), '') as b, " + _Y + " as c from e) select page_id, coalesce(a, b, c) as year, case when a is not null then 0.9 when b is not null then 0.8 when c is not null then 0.7 end::double as confidence, case when low is null then null when contains(low, 'verlag') then 'de' when contains(low, 'english') or contains(low, 'translated') then 'en' end as iso from t")
_HOUSE = r"coalesce(nullif(regexp_extract(content, '(?i)(?:Verlag|Publisher|Press):\s*(.*?)(?:\.|\n|$)', 1), ''), nullif(regexp_extract(content, '(?i)(?:published by|verlegt bei)\s*(.*?)(?:\.|\n|$)', 1), ''), nullif(regexp_extract(content, '(?i)\b(?:Verlag|Publishers?)\b[^\n.]*?([\w\s&]+)(?:,|\.|$)', 1), ''))"
_TESTS = {"has_volumes_header": "contains(content, '===Volumes===')", "has_triple_quotes": "contains(content, '''''''')", "has_lst_tag": "contains(content, '<lst')", "has_publisher": f"{_HOUSE} is not null", "has_year": r"regexp_matches(content, '\b(1[8-9]\d{2}|20[0-2]\d)\b')", "has_location": r"regexp_matches(content, '\b(Wien|Berlin|Frankfurt|Leipzig|London|New York|Paris|Hamburg|Salzburg)\b')", "has_page_count": r"regexp_matches(content, '\d+\s*p\.')", "is_redirect": "starts_with(content, '#REDIRECT')"}
for _name, _label in (("bibliography_patterns", "Category"), ("bibliography_patterns_review", "Review")):
    on_entries(_name, lambda e, label=_label: profile.bibliography_patterns(e.select("content", classify.classify_content(_c()).alias("kind"), *[v.alias(k) for k, v in extract.biblio_info(_c()).items()]), "content", "kind", label),
        f", b as (select content, {_CLASS} as kind from e), k as (select * from b where kind = '{_label}') " + " union all ".join(f"select '{p}' as pattern, count(*) filter ({v}) as n, round(100.0 * count(*) filter ({v}) / count(*), 4) as pct from k" for p, v in _TESTS.items()))
on_entries("title_match_rate", lambda e: profile.true_rate(e, extract.title_match(F.col("page_title"), extract.content_title(_c()))), r", t as (select replace(page_title, '_', ' ') as p, coalesce(nullif(regexp_extract(content, '''''''(.*?)''''''', 1), ''), list_filter(list_transform(string_split(content, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], '') as title from e) select round(100.0 * count(*) filter (contains(p, title) or contains(title, p)) / count(*), 4) as pct from t")
on_entries("types_unknown_last", lambda e: _numbered(relations.unknown_last(e.groupBy(classify.identify_content_type(_c()).alias("kind")).agg(F.count("*").alias("n")), "kind", "n")), f", k as (select {_TYPE} as kind, count(*) as n from e group by 1) select kind, n, row_number() over (order by kind = 'Unknown', n desc, kind) - 1 as rn from k")
on_entries("one_blob", lambda e: profile.all_equal(e, "blob_id"), "select count(distinct blob_id) = 1 as all_equal from e")


# The whole pipeline, and what looks at its result.
def _final(e: DataFrame, *columns: str, **filters: object) -> DataFrame:
    """The final table, or only some of its columns and the rows that meet filters."""
    return pipeline.finish(pipeline.clean_step(pipeline.analyse(e.select("page_id", "page_title", "text_id", "content", F.lit("utf-8").alias("flags"), "blob_id"))), columns=columns or FINAL, filters=filters)


_FACETS = ("page_id", "main_category", "language", "time_period", "year")
_RAW = {k: v.replace("content", "raw") for k, v in {"year": _Y, "house": _HOUSE, "said": _SAID}.items()}
_DOT = r"^((?:.*?\W)?)\.(?:\W|$)"
_HEAD = r"^([^\[]+)\s*\[(.*?)\]"
_ITEMS = [f"content_item_{i}_{f}" for i in (1, 2, 3) for f in ("title", "original_title", "translator", "pages")]
_FINAL = (
    f", x as (select * replace ({_replaced('content', [*_REPAIRS, *_ENTITIES])} as content), content as raw from e)"
    + _FLAT.replace("from e)", "from x)", 1)
    + rf""", g as (select page_id, text_id, case when contains(text_id, ',') then split_part(text_id, ',', 1) else '' end as catalog_number_1, case when contains(text_id, ',') then split_part(text_id, ',', 2) else '' end as catalog_number_2,
  trim(case when regexp_matches(flat, '{_HEAD}') then regexp_extract(flat, '{_HEAD}', 1) when regexp_matches(flat, '{_DOT}') then regexp_extract(flat, '{_DOT}', 1) else flat end) as title,
  case when regexp_matches(flat, '{_HEAD}') then trim(regexp_extract(flat, '{_HEAD}', 2)) else '' end as original_title,
  regexp_replace(case when contains(lines, chr(10) || chr(10)) then split_part(lines, chr(10) || chr(10), 1) else substr(lines, 1, 250) end, '^\s+|\s+$', '', 'g') as full_bibliographic_entry,
  coalesce(cast(try_cast({_RAW['year']} as double) as varchar), '') as year,
  coalesce(nullif(trim({_RAW['house']}), ''), trim(coalesce(nullif(regexp_extract(flat, ':\s+"([^"]+)"', 1), ''), nullif(regexp_extract(flat, '(?:Izdatel''stvo|Publishing|Verlag|Éditions)\s+"?([^",.]+)"?', 1), ''), nullif(regexp_extract(flat, '(?:[A-Z][a-zA-Z\s]+:)?\s*([^,]+?)(?:,|\s+\d{{4}})', 1), ''), ''))) as publisher,
  coalesce(nullif(regexp_extract(raw, '\b(Wien|Berlin|Frankfurt|Leipzig|London|New York|Paris|Hamburg|Salzburg)\b', 1), ''), trim(coalesce(nullif(regexp_extract(flat, '([A-Z][a-zA-Z\s]+):', 1), ''), nullif(regexp_extract(flat, '(?i)(?:^|\s)(Moscow|Moskva|Berlin|London|New York|Paris|Wien|Vienna|Frankfurt|Leipzig)\b', 1), ''), ''))) as location,
  coalesce(nullif({_RAW['said']}, ''), {_CATLANG}) as language, coalesce(nullif(regexp_extract(raw, '(\d+)(?:\s*)p\.', 1), ''), {_PAGES}) as page_count, flat as clean_content,
  {', '.join(f"'' as {c}" for c in _ITEMS)}, array_to_string(regexp_extract_all(coalesce(content, ''), '\[\[Category:(.*?)\]\]', 1), '; ') as categories,
  coalesce(trim(split_part(regexp_extract_all(coalesce(content, ''), '\[\[Category:(.*?)\]\]', 1)[1], '/', 1)), '') as main_category,
  {_PERIOD.format(y=f"try_cast({_RAW['year']} as double)")} as time_period from f)"""
)
_COLUMNS = ["page_id", "text_id", "catalog_number_1", "catalog_number_2", "title", "original_title", "full_bibliographic_entry", "year", "publisher", "location", "language", "page_count", "clean_content", *_ITEMS, "categories", "main_category", "time_period"]
on_entries("final_table", _final, f"{_FINAL} select {', '.join(_COLUMNS)} from g")
on_entries("validate_final", lambda e: profile.validate(_final(e)), f"{_FINAL} " + " union all ".join(f"select '{c}' as \"column\", count(*) - count({c}) as n_null, count(*) filter (cast({c} as varchar) = '') as n_empty, count(*) filter (regexp_matches(cast({c} as varchar), '[ÃÂ]')) as n_suspicious from g" for c in _COLUMNS))
on_entries("facet_counts", lambda e: search.facet_counts(_final(e, *_FACETS)), f"{_FINAL} select facet, value, count(*) as n from (select 'category' as facet, main_category as value from g union all select 'language', language from g union all select 'timePeriod', time_period from g) where value <> '' group by 1, 2")
on_entries("facet_years", lambda e: _numbered(search.facet_values(_final(e, "year"), "year").select(F.col("value").try_cast("double").alias("value"))), f"{_FINAL}, y as (select distinct cast(year as double) as value from g where year <> '') select value, row_number() over (order by value) - 1 as rn from y")
on_entries("search_entries", lambda e: search.search(_final(e, *_FACETS, *search.SEARCHED, timePeriod=_PERIODS[1]), "marie ANTOINETTE", timePeriod=_PERIODS[1]).select("page_id"), f"{_FINAL} select page_id from g where time_period = '{_PERIODS[1]}' and (" + " or ".join(f"contains(lower({c}), 'marie antoinette')" for c in ("title", "original_title", "full_bibliographic_entry", "publisher", "location", "clean_content")) + ")")
on_entries("search_year", lambda e: search.search(_final(e, *_FACETS, category="Fiction", year="1933"), "", category="Fiction", year="1933").select("page_id", "language"), f"{_FINAL} select page_id, language from g where main_category = 'Fiction' and year = '1933.0'")
on_entries("dashboard", lambda e: search.dashboard(_final(e, *_FACETS)), f"{_FINAL}, t as (select count(*) as n, min(try_cast(year as double)) as a, max(try_cast(year as double)) as b from g), c as (select main_category as label, count(*) as n from g where main_category <> '' group by 1 order by n desc, label limit 12), l as (select language as label, count(*) as n from g where language <> '' group by 1 order by n desc, label limit 10) select 'total' as part, 'entries' as label, n::double as n from t union all select 'total', 'first_year', a from t union all select 'total', 'last_year', b from t union all select 'category', label, n from c union all select 'language', label, n from l union all select 'period', time_period, count(*) from g where time_period <> '' group by 2")
on_entries("entry_page", lambda e: search.page(e.select("page_id", "page_title"), "page_title", 2, 10), "select page_id, page_title from e order by page_title, page_id limit 10 offset 20")
on_entries("entry_detail", lambda e: search.detail(search.by_id(e.select("page_id", F.lit("").alias("title"), F.lit(None).cast("string").alias("publisher")), 7)), "select cast(page_id as varchar) as page_id, 'Untitled' as title, '-' as publisher from e where page_id = 7")


def queries() -> dict[str, Query]:
    from codexmill.plans import catalog_more  # noqa: F401  registers its own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from codexmill.plans import catalog_more  # noqa: F401  registers its own

    return dict(_ORACLES)
