"""More named queries: order, files, streams, and functions on small made-up values, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.functions import classify, encoding, extract, markup
from codexmill.functions import text as tx
from codexmill.operators import profile, relations, search
from codexmill.plans import pipeline, report
from codexmill.plans.catalog import _CATS, _CHAIN_SQL, _CLASS, _FACETS, _FINAL, _PERIOD, _PERIODS, _TUPLES, _TYPE, _Y, _chain, _final, _tuples, on_entries, on_table, query, table
from codexmill.sources import dump, files, schemas
from codexmill.streaming import live

# Descriptions.
_DESCRIBED = "count({x}) as count, round(avg({x}), 4) as mean, round(stddev_samp({x}), 4) as std, cast(min({x}) as double) as least, cast(quantile_cont({x}, 0.25) as double) as q25, cast(quantile_cont({x}, 0.5) as double) as q50, cast(quantile_cont({x}, 0.75) as double) as q75, cast(max({x}) as double) as greatest"
on_entries("describe_years", lambda e: profile.describe(e, F.col("year_no")), "select " + _DESCRIBED.format(x="year_no") + " from e")
on_entries("describe_lengths_by_type", lambda e: profile.describe(e.select(F.length("content").alias("n"), classify.classify_content(F.col("content")).alias("kind")), F.col("n"), ["kind"]), f", k as (select length(content) as n, {_CLASS} as kind from e) select kind, " + _DESCRIBED.format(x="n") + " from k group by kind")
_COUNTED = r", k as (select try_cast(nullif(regexp_extract(content, '(\d+)(?:\s*)p\.', 1), '') as double) as p from e)"
on_entries("page_count_stats", lambda e: profile.number_stats(e.select(extract.biblio_info(F.col("content"))["page_count"].try_cast("double").alias("p")), "p"), f"{_COUNTED} select count(p) as n, min(p) as least, max(p) as greatest, round(avg(p), 4) as mean, median(p) as median, max(p) - min(p) + 1 as span from k")
on_entries("page_count_bins", lambda e: profile.page_bins(e.select(extract.biblio_info(F.col("content"))["page_count"].try_cast("double").alias("p")), "p"), f"{_COUNTED} select bin, n from (" + " union all ".join(f"select '{b}' as bin, count(*) filter (p > {lo}{f' and p <= {hi}' if hi else ''}) as n from k" for b, lo, hi in (("1-10", 0, 10), ("11-50", 10, 50), ("51-100", 50, 100), ("101-200", 100, 200), ("201-500", 200, 500), ("501-1000", 500, 1000), ("1000+", 1000, 0))) + ")")
_MAIN = ["Fiction", "Poetry", "Essays", "none"]
on_entries("period_category_pivot", lambda e: profile.cross_counts(e.withColumn("main", F.coalesce(markup.main_category(markup.categories(F.col("content"))), F.lit("none"))).withColumn("main", F.when(F.col("main").isin(_MAIN), F.col("main")).otherwise("other")), extract.time_period(F.col("year_no")), "main", [*_MAIN, "other"]),
    rf""", k as (select {_PERIOD.format(y='year_no')} as "row", coalesce(trim(split_part(regexp_extract_all(content, '\[\[Category:(.*?)\]\]', 1)[1], '/', 1)), 'none') as main from e) select "row", """ + ", ".join(f"count(*) filter (main = '{m}') as \"{m}\"" for m in _MAIN) + ', count(*) filter (main not in (' + ", ".join(f"'{m}'" for m in _MAIN) + ')) as "other" from k group by 1')
on_entries("bibliography_statistics", lambda e: report.flat(report.bibliography(pipeline.analyse(e.select("page_id", "page_title", "text_id", "content", F.lit("u").alias("flags"), "blob_id"))), ("content_types", "redirects", "periods", "decades")),
    f", k as (select content, {_CLASS} as kind, {_TYPE} as kind2, try_cast({_Y} as double) as y from e) select 'content_types' as section, kind as label, count(*) as n from k group by 2 union all select 'redirects', kind, count(*) from k where kind2 = 'Redirect' group by 2 union all select 'decades', concat(cast(cast(floor(y / 10) * 10 as bigint) as varchar), 's'), count(*) from k where y is not null group by 2 union all select 'periods', p, (select count(*) from k where {_PERIOD.format(y='y')} = p) from (select unnest(['Pre-lifetime (before 1881)', 'During Lifetime (1881-1942)', 'Post-WWII (1943-1980)', 'Late 20th Century (1981-2000)', 'Contemporary (after 2000)']) as p)")
on_entries("types_compared", lambda e: profile.compare({"odd": e.where("page_id % 2 = 1").select(classify.classify_content(F.col("content")).alias("kind")), "even": e.where("page_id % 2 = 0").select(classify.classify_content(F.col("content")).alias("kind"))}, "kind"),
    f", k as (select {_CLASS} as kind, page_id % 2 as odd from e), c as (select 'kind' as part, coalesce(kind, '') as label, count(*) filter (odd = 1) as odd, count(*) filter (odd = 0) as even from k group by 2 union all select 'rows', 'all', count(*) filter (odd = 1), count(*) filter (odd = 0) from k) select *, odd = even as same from c")

# Order, thinning, redirects.
on_entries("year_ticks", lambda e: relations.thin(profile.value_counts(e, "year_no"), "year_no", 20), ", k as (select year_no, count(*) as n from e group by 1), r as (select *, row_number() over (order by year_no) - 1 as i, count(*) over () as c from k) select year_no, n from r where i % ceil(c / 20.0) = 0")
_HOPS = "select cast(c_custkey as string) as title, case when c_custkey % 5 < 4 then cast(c_custkey + 1 as string) when c_custkey % 50 = 4 then 'nowhere' end as target from {customer}"


@query("redirect_chains", f"with t as ({_HOPS.format(customer='customer')}), a as (select title, target, coalesce(target, title) as f1, (target is not null)::int as h1 from t), b as (select a.title, coalesce(t.target, f1) as f2, h1 + (t.target is not null)::int as h2 from a left join t on f1 = t.title), c as (select b.title, coalesce(t.target, f2) as f3, h2 + (t.target is not null)::int as h3 from b left join t on f2 = t.title) select c.title, f3 as final_title, h3 as hops, t.title is null as dangling, h3 > 0 and t.target is not null as unfinished from c left join t on f3 = t.title")
def _chains(spark: SparkSession, d: str) -> DataFrame:
    return relations.resolve_redirects(spark.sql(_HOPS, customer=table(spark, d, "customer")), "title", "target").select("title", "final_title", "hops", "dangling", "unfinished")


# Texts.
_LONG = "concat(c_name, ' ', c_custkey, '  of a long title with ', case when c_custkey % 2 = 0 then 'many more words than a hundred characters can hold, and then some of them again' else 'few' end)"
on_table("short_titles", "customer", lambda df: df.select("c_custkey", extract.short_title(F.expr(_LONG)).alias("title")), f"with t as (select c_custkey, {_LONG} as t from customer) select c_custkey, case when length(t) > 100 then array_to_string(regexp_split_to_array(trim(t), '\\s+')[1:10], ' ') || '...' else t end as title from t")
on_table("places_in_texts", "customer", lambda df: df.select("c_custkey", tx.find(F.col("c_name"), "1").alias("found"), tx.locate(F.col("c_name"), "1").alias("located"), tx.mysql_substring(F.col("c_name"), F.col("c_custkey").cast("int") % 7 - 3, 4).alias("part")), "select c_custkey, cast(instr(c_name, '1') - 1 as int) as found, cast(instr(c_name, '1') as int) as located, case when c_custkey % 7 - 3 = 0 then '' when c_custkey % 7 - 3 > 0 then substr(c_name, c_custkey % 7 - 3, 4) else substr(right(c_name, 3 - c_custkey % 7), 1, 4) end as part from customer")
_LABEL = "concat(p_name, '/', p_type, '/', p_brand, ' ', p_brand)"
on_table("short_labels", "part", lambda df: df.select("p_partkey", tx.shorten_label(F.expr(f"case when p_partkey % 3 = 0 then concat(p_name, p_name, p_name, p_name) else {_LABEL} end")).alias("label")), f"with t as (select p_partkey, case when p_partkey % 3 = 0 then concat(p_name, p_name, p_name, p_name) else {_LABEL} end as t from part) select p_partkey, case when length(t) <= 40 then t when contains(t, '/') and len(string_split(t, '/')) > 2 then concat(string_split(t, '/')[1], '/.../', string_split(t, '/')[-1]) else concat(substr(t, 1, 37), '...') end as label from t")
on_table("leading_numbers", "customer", lambda df: df.select("c_custkey", tx.leading_int(F.concat(F.lit(" "), F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") * -7), F.lit("px 9"))).alias("n"), tx.leading_int(F.col("c_name")).alias("none")), "select c_custkey, case when c_custkey % 3 <> 0 then c_custkey * -7 end as n, cast(null as bigint) as none from customer")
on_table("stamped_names", "events", lambda df: df.select("event_id", tx.stamped("stats", F.col("ts")).alias("name")), "select event_id, 'stats_' || strftime(ts, '%Y%m%d_%H%M') as name from events")
on_table("top_sources", "documents", lambda df: df.groupBy("lang", "source").agg(F.count("*").alias("n")).groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce("source", F.lit("")).alias("k"), "n"))).alias("m")).select("lang", F.array_join(F.transform(tx.top_of_map(F.col("m"), 3), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ";").alias("top")),
    "select lang, string_agg(s || '=' || n, ';' order by n desc, s) as top from (select lang, coalesce(source, '') as s, count(*) as n, row_number() over (partition by lang order by count(*) desc, coalesce(source, '')) as r from documents group by 1, 2) where r <= 3 group by 1")
on_table("json_rows", "nation", lambda df: df.select("n_nationkey", F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.lit("ä\"").alias("odd"))).alias("json")), """select n_nationkey, concat('{"key":', n_nationkey, ',"name":"', n_name, '","odd":"ä\\""}') as json from nation""")
on_table("fill_rules", "customer", lambda df: (lambda x: df.select("c_custkey", tx.first_of(x, F.col("c_name")).alias("if_missing"), F.coalesce(x, F.col("c_name")).alias("if_null")))(F.expr("case c_custkey % 3 when 0 then null when 1 then '' else 'own' end")), "select c_custkey, case c_custkey % 3 when 2 then 'own' else c_name end as if_missing, case c_custkey % 3 when 0 then c_name when 1 then '' else 'own' end as if_null from customer")
on_table("kept_columns", "customer", lambda df: relations.keep_if_any(relations.keep_if_any(profile.drop_empty_columns(df.select("c_custkey", F.lit(None).cast("string").alias("nothing"), F.lit("").alias("blank"), F.when(F.col("c_custkey") % 9 == 0, "x").otherwise("").alias("some"))), ["blank"]), ["some"]), "select c_custkey, case when c_custkey % 9 = 0 then 'x' else '' end as some from customer")
on_table("export_rows", "customer", lambda df: files.for_export(df.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"))), "select cast(c_custkey as varchar) as c_custkey, case when c_custkey % 2 = 0 then c_name else '' end as name from customer")
on_table("escapes", "nation", lambda df: df.select("n_nationkey", tx.decode_escapes(F.concat(F.lit("a\\n"), F.col("n_name"), F.lit("\\'s \\\\n \\\" \\t"))).alias("text")), "select n_nationkey, 'a' || chr(10) || n_name || '''s \\n \" ' || chr(9) as text from nation")

on_table("retyped", "customer", lambda df: relations.retype(df.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise("no number").alias("n"), F.col("c_name").alias("b")), n="bigint", b="binary").select("c_custkey", "n", F.length("b").alias("bytes")), "select c_custkey, case when c_custkey % 2 = 0 then c_custkey end as n, cast(strlen(c_name) as int) as bytes from customer")
_RULED = [("Redirect", r"^#REDIRECT \[\[(.*?)\]\]", 1.0), ("Category", r"\[\[Category:(.*?)(?:\|.*?)?\]\]", 1.0), ("Essay", r"\b(essay|essays|aufsatz)\b", 0.85), ("Translation", r"\b(translation|translated by)\b", 0.9), ("Biography", r"\b(biography|biographie|life of)\b", 0.8), ("Collection", r"\b(collection|sammlung|collected works)\b", 0.75), ("Review", r"\b(review|reviewed|critique|rezension)\b", 0.9), ("Correspondence", r"\b(letter|brief|correspondence)\b", 0.85), ("Film/Media", r"\b(film|movie|adaptation|recording)\b", 0.85)]
_EXTRA = "content || case page_id % 5 when 0 then ' a collection' when 1 then ' the life of' else '' end"
on_entries("rule_types", lambda e: e.select("page_id", classify.rule_type(F.expr(_EXTRA)).alias("x")).select("page_id", "x.kind", "x.confidence"),
    f", t as (select page_id, {_EXTRA} as content from e) select page_id, " + " ".join(["case", *[f"when regexp_matches(content, '(?i){p}') then '{k}'" for k, p, _ in _RULED], "else 'Unknown' end as kind, case", *[f"when regexp_matches(content, '(?i){p}') then {v}" for _, p, v in _RULED], "else 0 end::double as confidence from t"]))
on_entries("route_answers", lambda e: search.answer(_final(e, *_FACETS), search.parse_route("#view=list&filter=category:Poetry,period:" + _PERIODS[4].replace(" ", "%20"))).select("page_id", "year"), f"{_FINAL} select page_id, year from g where main_category = 'Poetry' and time_period = '{_PERIODS[4]}'")
on_entries("first_entries", lambda e: e.select("page_id", "blob_id").where("blob_id between 1 and 8").orderBy("page_id").limit(7), "select page_id, blob_id from e where blob_id between 1 and 8 order by page_id limit 7")

# Encodings: what is broken, and what it should be.
_PAIRS = [
    ("wÃ¤re KongreÃŸ Ã–st Ãœber", "wäre Kongreß Öst Über"), ("BernshteÄ­n ArskiÄ­", "Bernshteĭn Arskiĭ"), ("skiā­. shteā­", "skiĭ. shteĭ"), ("viá¸ á¸am praá¹‡am", "viḍ ḍam praṇam"), ("ká¹­a kÃ¡ á¹£ á¸¥ á¹ƒ", "kṭa ká ṣ ḥ ṃ"),
    ("Ä€li qÄ«l Å«d", "Āli qīl ūd"), ("DÄr BaghdÄd waÊ¾l", "Dār Baghdād wa'l"), ("Ã¡Ã©Ã­Ã³ÃºÃ±", "áéíóúñ"), ("Ã£ Ãµ Ã¢ Ãª Ã® Ã´ Ã» Ã§ Ã¨ Ã€ Â°", "ã õ â ê î ô û ç è À °"), ("Å¡ Å½ Å¾ Å™ Å„ Å‚ Ã¦ Å¸", "š Ž ž ř ń ł æ ÿ"),
    ("itâ€™s â€œsoâ€\u009d â€“ â€” â€¦", "it's \"so\" – — …"), ("a &amp;lt; b&nbsp;&mdash; &#8216;q&#8217;", "a &lt; b — ‘q’"), ("zero​width﻿\u0001 tab\tstays", "zerowidth tab\tstays"), ('say \\"x\\" and ""y""', 'say "x" and "y"'),
    ("Ärger Ñandú 日本 Ðeno č", "Ärger Ñandú 日本 Ðeno č"), ("plain text", "plain text"), ("Ã£Â£o", "ão"),
]
#: What only the deep repair mends: bytes of pairs that no table has.
_DEEP = [("Ð¡Ñ‚ÐµÑ„Ð°Ð½ æ—¥æœ¬", "Стефан 日本"), ("Î±Î²Î³ und Ã¤", "αβγ und ä"), ("ÄŒapek Ä‡ Å‘", "Čapek ć ő")]


def _values(pairs: list[tuple[str, str]], n: int) -> str:
    """SQL rows i, x with the n-th of each pair."""
    return "select * from (values " + ", ".join(f"({i}, '{p[n].replace(chr(39), chr(39) * 2)}')" for i, p in enumerate(pairs)) + ") as t(i, x)"


def _broken(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(i, p[0]) for i, p in enumerate(pairs)], "i int, x string")


query("encoding_pairs", _values(_PAIRS, 1))(lambda spark, d: _broken(spark, _PAIRS).select("i", encoding.fix_encoding(F.col("x")).alias("x")))
query("encoding_pairs_deep", _values([*_PAIRS, *_DEEP], 1))(lambda spark, d: _broken(spark, [*_PAIRS, *_DEEP]).select("i", encoding.fix_encoding_deep(F.col("x")).alias("x")))
on_table("normal_texts", "documents", lambda df: df.select("doc_id", F.md5(encoding.normal(F.replace(F.col("text"), F.lit("ä"), F.lit("ä"))).cast("binary")).alias("digest")), "select doc_id, md5(nfc_normalize(replace(text, 'ä', 'ä'))) as digest from documents")
on_table("latin1_bytes", "nation", lambda df: (lambda b: df.select("n_nationkey", encoding.decode_latin1(b).alias("as_mysql"), F.decode(b, "ISO-8859-1").alias("plain"), encoding.decode_hex_title(F.concat(F.lit("0x"), F.hex(b))).alias("replaced")))(F.concat(F.col("n_name").cast("binary"), F.unhex(F.lit("E4809FFF")))), "select n_nationkey, n_name || 'ä€Ÿÿ' as as_mysql, n_name || 'ä' || chr(128) || chr(159) || 'ÿ' as plain, n_name || '䀟' || chr(65533) as replaced from nation")
on_table("without_controls", "customer", lambda df: df.select("c_custkey", encoding.remove_controls(F.concat(F.lit("\x01​"), F.col("c_name"), F.lit("﻿\x7f\t."))).alias("text")), "select c_custkey, c_name || chr(9) || '.' as text from customer")
on_entries("scored_publishers", lambda e: e.select("page_id", extract.scored_publisher(F.col("content")).alias("x")).select("page_id", "x.publisher", "x.confidence"),
    r", t as (select page_id, trim(nullif(regexp_extract(content, '(?i)(?:Verlag|Publisher|Press):\s*([\w\s&.,\-]+)', 1), ''), ' ' || chr(10)) as a, trim(nullif(regexp_extract(content, '(?i)(?:published by|verlegt bei)\s*([\w\s&.,\-]+)', 1), ''), ' ' || chr(10)) as b, trim(nullif(regexp_extract(content, '(?i)\b(?:Verlag|Publishers?)\b[^\n.]*?([\w\s&.,\-]+)(?:,|\.|$)', 1), ''), ' ' || chr(10)) as c from e) select page_id, coalesce(a, b, c) as publisher, case when a is not null or b is not null then 0.9 when c is not null then 0.8 end::double as confidence from t")

# Lists of contents in four layouts, by page_id.
_LAYOUTS = {0: "Contents\n1. One [Eins]. Translated by A B, pp. 3-9\n2. Two\n\nEnd", 1: "Head\n1. One [Eins], pp. 12\n2. Two\n\nEnd", 2: "1. One [Eins], pp. 4", 3: "One [Eins] x\nTwo [Zwei] tr. C D,\nend"}
_EXPECTED = {0: [("One", "Eins", "A B", "3-9"), ("Two", "", "", "")], 1: [("One", "Eins", "", "12"), ("Two", "", "", "")], 2: [("One", "Eins", "", "4")], 3: [("One  x", "Eins", "", ""), ("Two", "Zwei", "C D", "")]}
on_entries("content_layouts", lambda e: e.select("page_id", F.posexplode(extract.content_items(F.element_at(F.create_map(*[F.lit(x) for k, t in _LAYOUTS.items() for x in (k, t)]), (F.col("page_id") % 4).cast("int")))).alias("place", "i")).select("page_id", "place", "i.*"),
    "select page_id, t.* exclude (k) from e join (values " + ", ".join(f"({k}, {at}, '{a}', '{b}', '{c}', '{p}')" for k, items in _EXPECTED.items() for at, (a, b, c, p) in enumerate(items)) + ") as t(k, place, title, original_title, translator, pages) on page_id % 4 = t.k")

# Extraction.
query("extraction_counts", f"{_CHAIN_SQL}, t as ({_TUPLES.format(orders='orders')}), b as (select page_id, min(blob_id) as blob_id from linked join t using (text_id) group by 1) select blob_id, count(*) as n from linked left join b using (page_id) group by 1")(lambda spark, d: (lambda p, t: dump.extraction_counts(p, dump.extract_entries(p, t)))(_chain(spark, d), _tuples(spark, d)))
query("extraction_probe", f"{_CHAIN_SQL}, t as ({_TUPLES.format(orders='orders')}) select page_id, text_id, coalesce(text_id in (select text_id from t), false) as found from linked order by md5(concat(cast(page_id as varchar), ':5')), page_id limit 5")(lambda spark, d: dump.probe(_chain(spark, d), _tuples(spark, d), 5, 5))
query("compat_window", "select o_orderkey as text_id, length(o_orderpriority) * 150 as n from orders where length(o_orderpriority) * 150 + length(cast(o_orderkey as varchar)) + 14 + 17 + 2 + 10 <= 2000")(
    lambda spark, d: dump.insert_tuples(table(spark, d, "orders").select(F.lit(1).alias("blob_id"), F.concat(F.lit("INSERT INTO `t` VALUES ("), F.col("o_orderkey").cast("string"), F.lit(",_binary '"), F.expr("repeat('x', length(o_orderpriority) * 150)"), F.lit("',_binary 'utf-8');")).alias("text")), compat=True).select("text_id", F.length("content").cast("bigint").alias("n"))
)
_DDL = "CREATE TABLE `page` (\n  `page_id` int unsigned NOT NULL AUTO_INCREMENT,\n  `page_title` varbinary(255) NOT NULL,\n  `page_touched` binary(14),\n  `page_len` int NOT NULL,\n  PRIMARY KEY (`page_id`)\n) ENGINE=InnoDB;\nCREATE TABLE `text` (\n  `old_id` int(10) unsigned NOT NULL,\n  `old_text` longblob NOT NULL\n) ENGINE=InnoDB;\n"
query("ddl_columns", "select * from (values ('page', 'page_id', 'bigint', false), ('page', 'page_title', 'string', false), ('page', 'page_touched', 'string', true), ('page', 'page_len', 'int', false), ('text', 'old_id', 'bigint', false), ('text', 'old_text', 'binary', false)) as t(name, col, kind, optional)")(lambda spark, d: spark.createDataFrame([(t, f.name, f.dataType.simpleString(), f.nullable) for t, s in schemas.from_ddl(_DDL).items() for f in s.fields], "name string, col string, kind string, optional boolean"))


# Files.
def _odd_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 3 != 0, F.concat(F.col("n_name"), F.lit(', "Zwölf"\nlines'))).alias("name"))


_ODD = "select cast(n_nationkey as varchar) as n_nationkey, case when n_nationkey % 3 <> 0 then n_name || ', \"Zwölf\"' || chr(10) || 'lines' end as name from nation"


@query("csv_round_trip", _ODD)
def _csv(spark: SparkSession, d: str) -> DataFrame:
    path = files.scratch(spark, "csv")
    files.write_csv(_odd_names(spark, d), path)
    return files.read_csv(spark, path, required=["n_nationkey", "name"])


@query("csv_latin1", _ODD)
def _latin(spark: SparkSession, d: str) -> DataFrame:
    path = files.scratch(spark, "latin")
    files.for_export(_odd_names(spark, d)).write.options(**files.CSV, emptyValue="", encoding="ISO-8859-1").csv(path)
    return files.read_csv(spark, path)


@query("newest_and_found_files", "select 'newest' as what, n_nationkey as n, n_name as text from nation where n_nationkey % 2 = 0 union all select 'found', 2, ''")
def _newest(spark: SparkSession, d: str) -> DataFrame:
    path, nation = files.scratch(spark, "files"), table(spark, d, "nation")
    for i in (1, 0):
        nation.where(f"n_nationkey % 2 = {i}").select(F.concat("n_nationkey", F.lit("|"), "n_name")).coalesce(1).write.mode("append").text(f"{path}/half{i}")
    newest = spark.read.text(files.newest_file(spark, f"{path}/half*/part-*")).select(F.lit("newest").alias("what"), F.substring_index("value", "|", 1).cast("int").alias("n"), F.substring_index("value", "|", -1).alias("text"))
    return newest.union(files.discover(spark, f"{path}/half*", "part-*.txt").agg(F.lit("found"), F.count("*").cast("int"), F.lit("")))


@query("binary_import", "select blob, cast(sum(length(n_name) + 1) as bigint) as size, count(*) as lines, true as ok from (select n_name, n_nationkey % 3 as blob from nation) group by 1")
def _binary(spark: SparkSession, d: str) -> DataFrame:
    path, nation = files.scratch(spark, "blobs"), table(spark, d, "nation")
    for i in range(3):
        nation.where(f"n_nationkey % 3 = {i}").select("n_name").coalesce(1).write.text(f"{path}/z{i}")
    blobs = dump.read_blobs(spark, f"{path}/z*/part-*").select(F.regexp_extract("path", "/z([0-9])/", 1).cast("int").alias("blob"), "content")
    return blobs.select("blob", F.length("content").cast("bigint").alias("size"), tx.count_literal(dump.blob_text(F.col("content")), "\n").alias("lines")).join(files.loaded(blobs, 3).select("ok"), F.lit(True))


@query("files_compared", "select n_rows, same_rows, same_size from (values (3, false, false), (5, false, false)) as t(n_rows, same_rows, same_size)")
def _compared(spark: SparkSession, d: str) -> DataFrame:
    path, region = files.scratch(spark, "compared"), table(spark, d, "region")
    for i, n in enumerate((3, 5)):
        region.where(f"r_regionkey < {n}").select(F.col("r_regionkey").cast("string")).coalesce(1).write.text(f"{path}/f{i}")
    return files.compare_files(spark.read.text(f"{path}/f*")).select(F.col("n_rows").cast("int").alias("n_rows"), "same_rows", "same_size")


@query("json_report", "select 'types' as name, event_type as label, n, '' as line from (select event_type, count(*) as n from events where event_type is not null group by 1) union all select 'text', '', 0, concat('event_type: ', event_type, '  n: ', n) from (select event_type, count(*) as n from events where event_type is not null group by 1) union all select 'html', '', 0, concat('<tr><td>', event_type, '</td><td>', n, '</td></tr>') from (select event_type, count(*) as n from events where event_type is not null group by 1)")
def _reports(spark: SparkSession, d: str) -> DataFrame:
    stats = {"types": profile.value_counts(table(spark, d, "events"), "event_type")}
    parsed = files.to_json(stats).select(F.explode(F.from_json("json", "types array<struct<event_type: string, n: bigint>>")["types"]).alias("x")).select(F.lit("types").alias("name"), F.col("x.event_type").alias("label"), F.col("x.n").alias("n"), F.lit("").alias("line"))
    text, page = files.text_report("Events", stats), files.html_report("Events", stats)
    lines = [("text", "", 0, x) for x in text.split("\n") if x.startswith("event_type:")] + [("html", "", 0, f"<tr>{x}</tr>") for x in page.split("<tr>")[2:] for x in [x.split("</tr>")[0]]]
    return parsed.union(spark.createDataFrame(lines, "name string, label string, n bigint, line string"))


# A stream over files, to its end.
@query("stream_decades", rf"with y as (select try_cast({_Y.replace('content', 'text')} as bigint) as y from (select concat('of ', 1800 + c_custkey % 220, ' and 1999') as text from customer)) select cast(y // 10 * 10 as bigint) as decade, count(*) as n from y where y is not null group by 1")
def _stream(spark: SparkSession, d: str) -> DataFrame:
    path = files.scratch(spark, "stream")
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("page_id"), F.lit("").alias("page_title"), F.lit("").alias("text_id"), F.concat(F.lit("of "), (F.col("c_custkey") % 220 + 1800).cast("string"), F.lit(" and 1999")).alias("content"), F.lit("u").alias("flags"), F.lit(1).alias("blob_id"))
    rows.write.parquet(f"{path}/in")
    return live.decades_so_far(live.read_entries(spark, f"{path}/in"), f"{path}/checkpoint", "decades_" + path.rsplit("-", 1)[-1])


@query("stream_batches", _CATS.replace(", c as", "with e as (select c_custkey as page_id, 0 as year_no, concat('[[Category:', c_mktsegment, ' / x|k]]') as content from customer), c as") + " select category, count(*) as n from c group by 1")
def _batches(spark: SparkSession, d: str) -> DataFrame:
    path = files.scratch(spark, "batches")
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("page_id"), F.lit("").alias("page_title"), F.lit("").alias("text_id"), F.concat(F.lit("[[Category:"), F.col("c_mktsegment"), F.lit(" / x|k]]")).alias("content"), F.lit("u").alias("flags"), F.lit(1).alias("blob_id"))
    rows.repartition(3).write.parquet(f"{path}/in")
    live.write_batches(live.analysed_stream(live.read_entries(spark, f"{path}/in", 1)), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return profile.category_counts(spark.read.parquet(f"{path}/out"), "content")
