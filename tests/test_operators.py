"""Dump parsing, joins, profiles, search, files and the stream."""

import pytest
from pyspark.sql import functions as F

from codexmill.operators import profile, relations, search
from codexmill.sources import dump, files
from codexmill.sources.schemas import ENTRY
from codexmill.streaming import live

DUMP = "CREATE TABLE `archive_text` (x);\nINSERT INTO `archive_text` VALUES (31,_binary '<P>',_binary 'utf-8'),(94,_binary 'A (94,_binary ''x'')\\' b',_binary 'utf-8');\nINSERT INTO `archive_text` VALUES (11384,_binary '__TOC__\\n\\n===Volumes===\\n',_binary 'utf-8');\n"


def test_tuples(spark):
    blobs = spark.createDataFrame([(1, DUMP), (2, None), (3, "INSERT INTO `t` VALUES (7,_binary 'cut"), (4, f"INSERT INTO `t` VALUES (8,_binary '{'x' * 3000}',_binary 'u');")], "blob_id int, text string")
    got = {r["text_id"]: r for r in dump.insert_tuples(blobs).collect()}
    assert set(got) == {31, 94, 11384, 8}
    assert got[94]["content"] == "A (94,_binary 'x')\\' b"
    assert got[11384]["content"] == "__TOC__\\n\\n===Volumes===\\n"
    assert len(got[8]["content"]) == 3000
    assert {r["text_id"] for r in dump.insert_tuples(blobs, compat=True).collect()} == {31, 94, 11384}
    lines = spark.createDataFrame([(x,) for x in DUMP.split("\n")], "value string")
    by_line = {r["text_id"]: r["content"] for r in dump.insert_tuples_by_line(lines).collect()}
    assert by_line == {k: got[k]["content"] for k in (31, 94, 11384)}


def test_blobs_from_files(spark, tmp_path):
    (tmp_path / "part_00").write_bytes(b"INSERT INTO `t` VALUES (1,_binary 'caf\xc3\xa9',_binary 'u');")
    (tmp_path / "part_02").write_bytes(b"\x80")
    blobs = dump.read_blobs(spark, f"{tmp_path}/part_0*")
    assert sorted(r["blob_id"] for r in blobs.collect()) == [0, 2]
    texts = blobs.select("blob_id", dump.blob_text(F.col("content")).alias("text"))
    assert dump.insert_tuples(texts).first()["content"] == "cafÃ©"
    assert texts.where("blob_id = 2").first()["text"] == "€"


def test_entries_take_the_lowest_blob(spark):
    pages = spark.createDataFrame([(1, "A", 31), (2, "B", 94), (3, "C", None)], "page_id long, page_title string, text_id long")
    tuples = spark.createDataFrame([(2, 31, "late", "u"), (1, 31, "early", "u")], "blob_id int, text_id long, content string, flags string")
    assert [(r["page_id"], r["content"]) for r in dump.extract_entries(pages, tuples).collect()] == [(1, "early")]
    assert sorted(r["page_id"] for r in dump.not_found(pages, tuples).collect()) == [2, 3]


def test_addresses(spark):
    df = spark.createDataFrame([("tt:31",), ("0x74743a3331",), ("zz",), (None,)], "a string")
    assert [r[0] for r in df.select(dump.text_id_of(F.col("a"))).collect()] == [31, 31, None, None]


def test_duplicates_join_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "k int, c string")
    assert sorted(r["k"] for r in profile.duplicated(df, "c", "k").collect()) == [1, 2, 3, 4]


def test_bins_and_profiles(spark):
    pages = spark.createDataFrame([(x,) for x in (0, 1, 10, 11, 50, 51, 100, 200, 500, 501, 1000, 1001, None)], "p int")
    assert {r["bin"]: r["n"] for r in profile.page_bins(pages, "p").collect()} == {"1-10": 2, "11-50": 2, "51-100": 2, "101-200": 1, "201-500": 1, "501-1000": 2, "1000+": 1}
    df = spark.createDataFrame([("", None), ("x", None)], "a string, b string")
    assert [tuple(r) for r in profile.missing_profile(df).orderBy("column").collect()] == [("a", 0, 1, 0.0), ("b", 2, 0, 100.0)]
    assert profile.drop_empty_columns(df).columns == ["a"]
    assert [r["column"] for r in profile.high_missing(df).collect()] == ["b"]
    assert relations.keep_if_any(df, ["b"]).columns == ["a"]


def test_redirect_chain(spark):
    df = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", None), ("D", "X")], "t string, target string")
    got = {r["t"]: (r["final_title"], r["dangling"]) for r in relations.resolve_redirects(df, "t", "target").collect()}
    assert got == {"A": ("C", False), "B": ("C", False), "C": ("C", False), "D": ("X", True)}


@pytest.mark.parametrize("fragment,view,ident,filters", [("#view=12", "detail", "12", {}), ("#view=detail&id=7", "detail", "7", {}), ("", "dashboard", None, {}), ("#view=nope", "dashboard", None, {}), ("#view=list&filter=language:German,period:x&query=a", "list", None, {"language": "German", "timePeriod": "x"})])
def test_routes(fragment, view, ident, filters):
    r = search.parse_route(fragment)
    assert (r.view, r.id, r.filters) == (view, ident, filters)


def test_search_and_detail(spark):
    df = spark.createDataFrame([("1", "Angst", "", "1902.0", "Fiction", "German", ""), ("2", "", "Wien", "", "", "", "")], "page_id string, title string, location string, year string, main_category string, language string, time_period string")
    assert [r["page_id"] for r in search.search(df, "ANGST").collect()] == ["1"]
    assert search.search(df).count() == 2
    assert [r["page_id"] for r in search.search(df, year="1902").collect()] == ["1"]
    assert search.answer(df, search.Route("detail", "2")).first()["title"] == "Untitled"
    assert search.answer(df, search.Route("detail", "9")).columns == ["part", "label", "n"]
    assert [r["value"] for r in search.facet_values(df, "language").collect()] == ["German"]


def test_csv(spark, tmp_path):
    (tmp_path / "latin.csv").write_bytes('page_id,title\n1,"Zwölf ""x"",\nzwei"\n'.encode("latin1"))
    (tmp_path / "utf.csv").write_text('page_id,title\n1,Zwölf\n', encoding="utf-8")
    assert files.read_csv(spark, f"{tmp_path}/latin.csv").first()["title"] == 'Zwölf "x",\nzwei'
    assert files.read_csv(spark, f"{tmp_path}/utf.csv", required=["title"]).first()["title"] == "Zwölf"
    with pytest.raises(ValueError):
        files.read_csv(spark, f"{tmp_path}/utf.csv", required=["year"])
    assert files.newest_file(spark, f"{tmp_path}/*.csv").endswith(".csv")
    assert files.discover(spark, str(tmp_path), "utf*.csv").count() == 1
    df = spark.createDataFrame([(1, None), (2, 'q"x')], "a int, b string")
    files.write_csv(df, f"{tmp_path}/out", 1)
    back = files.read_csv(spark, f"{tmp_path}/out")
    assert sorted((r["a"], r["b"] or "") for r in back.collect()) == [("1", ""), ("2", 'q"x')]


def test_reports(spark):
    stats = {"kinds": spark.createDataFrame([("a<b", 1)], "kind string, n int")}
    assert '"kind" : "a<b"' in files.to_json(stats).first()["json"]
    assert "kind: a<b  n: 1" in files.text_report("T", stats)
    assert "a&lt;b" in files.html_report("T", stats)


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "A", "1", "An essay of 1933", "u", 1), (2, "B", "2", "Verlag: X. 1938, 1941", "u", 1)], ENTRY)
    rows.write.parquet(f"{tmp_path}/in/a", mode="overwrite")
    stream = live.read_entries(spark, f"{tmp_path}/in/*")
    q = live.running_decades(stream).writeStream.outputMode("complete").format("memory").queryName("decades").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c1").start()
    q.awaitTermination(120)
    assert {r["decade"]: r["n"] for r in spark.table("decades").collect()} == {1930: 2}
    q = live.analysed_stream(stream).writeStream.format("memory").queryName("analysed").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c2").start()
    q.awaitTermination(120)
    assert {r["content_type"] for r in spark.table("analysed").collect()} == {"Essay", "Other"}


def test_left_merge_multiplies(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 3), (None, 4)], "k string, w int")
    assert sorted((r["v"], r["w"] or 0) for r in relations.left_merge(a, b, "k").collect()) == [(1, 3), (1, 4), (2, 0)]


def test_command_line(spark, tmp_path):
    from codexmill import cli

    (tmp_path / "part_03").write_text(DUMP)
    report = cli.main(["--extract", f"{tmp_path}/part_*", "--blob-id", "3", "--output", f"{tmp_path}/out"], spark)
    assert "content_type: Bibliography Entry" in report.read_text()
    again = cli.main(["--csv", f"{tmp_path}/out/entries", "--analyze-only", "--limit", "2", "--output", f"{tmp_path}/two"], spark)
    assert again.exists()
    with pytest.raises(SystemExit):
        cli.main([], spark)


def test_files_compared(spark, tmp_path):
    for i, n in enumerate((2, 3)):
        spark.range(n).coalesce(1).write.csv(f"{tmp_path}/f{i}")
    assert sorted(r["n_rows"] for r in files.compare_files(spark.read.csv(f"{tmp_path}/f*")).collect()) == [2, 3]


def test_http_and_charts(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Page(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()
            self.wfile.write('page_id,title\n1,"Zwölf, ""x"""\n2,\n'.encode("latin1" if "latin" in self.path else "utf-8"))

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Page)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    for path in ("utf", "latin"):
        url = f"http://127.0.0.1:{server.server_port}/{path}"
        assert [tuple(r) for r in files.read_http(spark, url, ["title"]).collect()] == [("1", 'Zwölf, "x"'), ("2", None)]
    with pytest.raises(ValueError):
        files.read_http(spark, url, most=5)
    with pytest.raises(ValueError):
        files.read_http(spark, url, ["year"])
    server.shutdown()
    assert files.bars([("a<b", 2), ("c", 1)]).count("<rect") == 2 and "a&lt;b" in files.bars([("a<b", 2)]) and files.bars([]).startswith("<svg")
    stats = {"kinds": spark.createDataFrame([("a", 1)], "kind string, n int")}
    assert "<svg" in files.html_report("T", stats) and "<svg" not in files.html_report("T", stats, charts=False)


def test_database(spark):
    """A table of a database in memory, whose driver comes with Spark."""
    from codexmill.sources import database

    url = "jdbc:derby:memory:codexmill;create=true"
    spark.range(40).selectExpr("cast(id as int) as k", "concat('v', id) as v").write.format("jdbc").options(url=url, dbtable="t", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    got = database.read_table(spark, url, "t", key="k", lower=0, upper=40, parts=3, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert got.rdd.getNumPartitions() == 3 and sorted(r[0] for r in got.where("k < 5").collect()) == [0, 1, 2, 3, 4]


def test_small_results_are_bounded(spark):
    with pytest.raises(ValueError):
        files.to_json({"x": spark.range(11)}, most=10)


def test_filters_before_extraction(spark):
    from codexmill.plans.pipeline import analyse, clean_step, finish

    rows = [(i, "T", str(i), f"Text {y}. [[Category:{c} (German)]]", "u", 1) for i, (y, c) in enumerate([(1902, "Fiction"), (1950, "Fiction"), (1902, "Essays")])]
    entries = clean_step(analyse(spark.createDataFrame(rows, ENTRY)))
    assert [r["page_id"] for r in finish(entries, filters={"year": "1902", "category": "Fiction (German)"}).collect()] == [0]
    whole = {r["page_id"]: r for r in finish(entries).collect()}
    assert [r for r in finish(entries, filters={"year": 1950}).collect()] == [whole[1]]


def test_extract_by_links(spark, tmp_path):
    from codexmill import cli

    (tmp_path / "part_03").write_text(DUMP)
    tables = {"page": "select 7 page_id, 0 page_namespace, '0x41' page_title, 70 page_latest union all select 8, 0, '0x42', 80", "revision": "select 70 rev_id union all select 80", "slots": "select 70 slot_revision_id, 700 slot_content_id union all select 80, 800", "content": "select 700 content_id, 'tt:31' content_address union all select 800, 'tt:999999'"}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/links/{name}.parquet")
    report = cli.main(["--extract", f"{tmp_path}/part_*", "--links", f"{tmp_path}/links", "--no-plots", "--output", f"{tmp_path}/out"], spark)
    assert "blob_id: 3  n: 1" in report.read_text() and "<svg" not in (tmp_path / "out" / "report.html").read_text()
    assert [r["page_id"] for r in files.read_csv(spark, f"{tmp_path}/out/entries").collect()] == ["7"]
    assert [r["page_id"] for r in files.read_csv(spark, f"{tmp_path}/out/not_found").collect()] == ["8"]


def test_validate_reads_its_table_once(spark):
    rows = spark.createDataFrame([(1, "Ã¤", None), (2, "", "x"), (None, "ÂÂ", "")], "i long, a string, b string")
    out = profile.validate(rows)
    assert sorted(tuple(r) for r in out.collect()) == [("a", 0, 1, 2), ("b", 1, 1, 0), ("i", 1, 0, 0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


@pytest.mark.parametrize("piece", [1, 7, 4096])
def test_tuples_in_pieces(spark, monkeypatch, piece):
    """Records and characters that lie across pieces, in texts one after another; no text goes to Python whole."""
    texts = [DUMP + "é€" * 5, None, "", "INSERT INTO `t` VALUES (7,_binary 'cut", f"INSERT INTO `t` VALUES (x,1), (8,_binary '{'ü\'\'' * 1500}',_binary 'u'), (9,_binary '\\\\',_binary 'v');"]
    monkeypatch.setattr(dump, "PIECE", piece)
    blobs = spark.createDataFrame(list(enumerate(texts)), "blob_id int, text string").coalesce(1)
    got = {(r["blob_id"], r["text_id"]): r["content"] for r in dump.insert_tuples(blobs).collect()}
    assert set(got) == {(0, 31), (0, 94), (0, 11384)}
    good = spark.createDataFrame([(4, texts[4].replace("(x,1), ", ""))], "blob_id int, text string")
    assert {(r["text_id"], r["content"]) for r in dump.insert_tuples(good).collect()} == {(8, "ü'" * 1500), (9, "\\\\")}
