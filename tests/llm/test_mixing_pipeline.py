import hashlib

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from codexmill.llm import mixing, queries
from tests.llm import brute
from tests.llm.conftest import prose

D = "/root/testdata/sf0.001"


def plain(rows):
    return sorted((tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


def test_oracles(spark):
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, D)
        assert plain(df.collect()) == plain(duck.sql(f"select {', '.join(df.columns)} from ({sql})").fetchall()), name


def test_marginals_meet_their_targets(spark):
    cells = spark.createDataFrame([(s, la, t, float(1 + 7 * i % 11)) for i, (s, la, t) in enumerate((s, la, t) for s in "abc" for la in "xy" for t in "pq")], "source string, lang string, topic string, t double")
    targets = {"source": {"a": 1, "b": 1, "c": 2}, "lang": {"x": 3, "y": 1}}
    rows = mixing.rake(cells, targets=targets).collect()
    total = sum(r["t"] * r["weight"] for r in rows)
    for d, goal in targets.items():
        for k, share in goal.items():
            got = sum(r["t"] * r["weight"] for r in rows if r[d] == k) / total
            assert abs(got - share / sum(goal.values())) < 1e-6


def test_both_ways_to_rake_agree(spark, monkeypatch):
    cells = spark.createDataFrame([(f"s{i % 7}", f"l{i % 3}", f"t{i % 2}", 0 if i == 5 else 1 + i * i % 13) for i in range(42)], "source string, lang string, topic string, t long")
    for targets in (None, {"lang": {"l0": 2, "l1": 1}}):
        few = {tuple(r[:3]): r for r in mixing.rake(cells, targets=targets).collect()}
        monkeypatch.setattr(mixing, "CELLS", 0)
        many = {tuple(r[:3]): r for r in mixing.rake(cells, targets=targets).collect()}
        monkeypatch.undo()
        assert set(few) == set(many) and len(few) == 42
        assert all(abs(few[k]["weight"] - many[k]["weight"]) < 1e-9 and few[k]["t"] == many[k]["t"] for k in few)
        assert {r["residual"] < 1e-6 for r in (*few.values(), *many.values())} == {True}


def test_targets_that_no_weights_meet_leave_a_residual(spark):
    cells = spark.createDataFrame([("a", "x", "p", 1), ("b", "y", "p", 1)], "source string, lang string, topic string, t long")
    assert mixing.rake(cells, targets={"source": {"a": 9, "b": 1}, "lang": {"x": 1, "y": 9}}).first()["residual"] > 0.5


def test_draw_is_calibrated(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "repeat('w ', 10) as text", "case when id % 3 = 0 then 'hot' else concat('s', id % 5) end as source", "'en' as lang")
    out = mixing.mix(df, targets={"source": {"hot": 1, "s0": 1, "s1": 1, "s2": 1, "s3": 1, "s4": 1}}, budget=1.0)
    by = {r["source"]: r["n"] for r in out.where("sampled").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert max(by.values()) / min(by.values()) < 1.15
    assert out.where("p > 1").count() == 0
    again = mixing.mix(df.repartition(7), targets={"source": {"hot": 1, "s0": 1, "s1": 1, "s2": 1, "s3": 1, "s4": 1}}, budget=1.0)
    assert sorted(r[0] for r in again.where("sampled").select("doc.doc_id").collect()) == sorted(r[0] for r in out.where("sampled").select("doc.doc_id").collect())


def test_mixing_odd_rows(odd, empty):
    rows, got = odd.collect(), mixing.op1_mixing(odd).collect()
    words = lambda t: len(brute.blanks(t))
    assert sorted(((r["doc_id"], r["source"], r["lang"], r["n_tokens"]) for r in got), key=repr) == sorted(((r["doc_id"], r["source"] or "?", r["lang"] or "?", words(r["text"])) for r in rows), key=repr)
    for r in got:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert 0 <= r["p"] <= 1 and r["sampled"] == (int(hashlib.md5(f"{key}:1".encode()).hexdigest()[:13], 16) / 2**52 < r["p"])
    assert mixing.op1_mixing(empty).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    extra = [(10_000 + i, prose(40, 60) + f" x{i}", "en", "src0", 0) for i in range(8)] + [(10_100 + i, f"{prose(600 + i, 50)} {prose(41, 55)} {prose(700 + i, 50)}", "en", "src1", 0) for i in range(6)]
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long"))
    columns = docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        stage(spark, docs, D).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        if k < 4:
            assert docs.columns == columns, name
        if name == "quality":
            bad = {r[0] for r in spark.read.parquet(f"{D}/labels.parquet").where("quality = 0").select("doc_id").collect()}
            assert len(bad & set(got)) <= 0.1 * len(bad) and len(got) >= 0.8 * (len(before) - len(bad))
        elif name == "ngram_jaccard":
            assert set(got) == {d for d, n, c in brute.jaccard(before) if d == c or not n}
        elif name == "substring_dedup":
            for (d, t), (_, gone, kept) in zip(before, brute.repeats([t for _, t in before]), strict=True):
                assert got[d].split() == kept and (gone or got[d] == t)
        elif name == "decontamination":
            for (d, t), (_, hit, found) in zip(before, brute.leaks([t for _, t in before], items), strict=True):
                assert (d in got) == (len(found) < 2) and (hit or got[d] == t)
            assert not any(x[1] for x in brute.leaks([t for d, t in got.items() if d in dict(before) and t != dict(before)[d]], items))
        else:
            rows = mixing.mix(spark.read.parquet(f"{tmp_path}/{k - 1}")).collect()
            assert set(got) == {r["doc"]["doc_id"] for r in rows if int(hashlib.md5(f"{r['doc']['doc_id']}:1".encode()).hexdigest()[:13], 16) / 2**52 < r["p"]}
            assert docs.columns == [*columns, "mixture_weight"]


def test_pipeline_odd_rows(odd, empty, spark):
    for df in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, D)
            assert out.columns[: len(df.columns)] == df.columns, name
            assert out.count() <= df.count()


def test_what_stages_do_with_odd_rows(odd, spark):
    from collections import Counter

    stages = dict(corpus_pipeline.STAGES)
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    kept = lambda name: Counter((r["doc_id"], r["text"]) for r in stages[name](spark, odd, D).select("doc_id", "text").collect())
    groups, want = {}, Counter()
    for row, (_, n, c) in zip(rows, brute.jaccard(rows), strict=True):
        if n:
            groups.setdefault(c, []).append(row)
        else:
            want[row] += 1
    for group in groups.values():
        want[min(group, key=lambda r: (r[0] is not None, r[0] or 0))] += 1
    assert kept("ngram_jaccard") == want
    got = stages["substring_dedup"](spark, odd, D).select("doc_id", "text", "n_chars", "k_id").collect()
    words = lambda t: None if t is None else tuple(brute.blanks(t))
    assert Counter((r["doc_id"], words(r["text"])) for r in got) == Counter((d, None if t is None else tuple(left)) for (d, t), (_, _, left) in zip(rows, brute.repeats([t for _, t in rows]), strict=True))
    assert {r["k_id"] for r in got} == {"own"}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    clean = [x for x, (_, hit, found) in zip(rows, brute.leaks([t for _, t in rows], items), strict=True) if not hit and len(found) < 2]
    assert kept("decontamination") & Counter(clean) == Counter(clean)
    assert kept("quality") <= Counter(rows) and kept("mixing") <= Counter(rows)
