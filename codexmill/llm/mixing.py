"""Mixing sources to target weights, in Spark expressions only.

Iterative proportional fitting rakes the tokens of each (source, language, topic) cell until the three
marginals meet their targets; documents are then drawn with probabilities proportional to their
cell's weight, by a hash of their id, so that a draw doesn't depend on how rows are laid out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexmill.llm.common import cut, small

DIMENSIONS = ("source", "lang", "topic")
#: A cell table of no more rows than this is raked as arrays of one row, in one job; a larger one by exchanges.
CELLS = 5_000
#: Most sweeps over the three marginals, and so many in one job by exchanges; they end where no factor is off 1 by more than SETTLED.
SWEEPS, PER_JOB, SETTLED = 30, 5, 1e-13
WORDS = r"[^\x20\x09-\x0D]+"
#: Powers of the marginals' own shares that make the default targets.
TEMPER = 0.7
#: Most of the tokens that a draw expects to keep.
BUDGET = 0.5
SEED = 1


def n_tokens(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), WORDS.replace("[^", "[")), "")).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A coarse topic for corpora without a topic column: figures (a digit in 200 characters or more), lists (under 12 words a line), else prose."""
    t = F.coalesce(text, F.lit(""))
    digits, lines = F.regexp_count(t, F.lit("[0-9]")), F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1
    return F.when(digits * 200 >= F.greatest(F.length(t), F.lit(1)), "figures").when(tokens < 12 * lines, "lists").otherwise("prose")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number from 0 to below 1 of 52 bits, from md5 of the id and seed; a null id counts as an empty one."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once."""
    return F.get(F.transform(F.array(x), lambda y: f(y)), F.lit(0))


def _named(targets: Mapping[str, float], value: Column) -> Column:
    """A value's share of the targets; 0 for what they don't name."""
    total = float(sum(targets.values()))
    return F.coalesce(F.create_map(*[F.lit(v) for k, share in targets.items() for v in (k, float(share) / total)])[value], F.lit(0.0))


def _rake_arrays(cells: DataFrame, temper: float, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """rake() of few cells: arrays in one row, the sweeps one fold over it."""
    row = cells.agg(F.array_sort(F.collect_list(F.struct(*DIMENSIONS, F.col("t").cast("double").alias("t")))).alias("c")).where(F.size("c") > 0)
    row = row.select("c", F.transform("c", lambda x: x["t"]).alias("t"), F.sequence(F.lit(0), F.size("c") - 1).alias("every"), *[F.array_distinct(F.col(f"c.{d}")).alias(f"values_{d}") for d in DIMENSIONS])

    def place(d: str) -> Column:
        return F.transform("c", lambda x: (F.array_position(f"values_{d}", x[d]) - 1).cast("int"))

    def members(d: str) -> Column:
        return F.transform(f"values_{d}", lambda v: F.filter("every", lambda i: F.get(F.col("c"), i)[d] == v))

    row = cut(row)  # each array is computed once, not wherever it is used
    row = cut(row.select(
        "c", "t", F.aggregate("t", F.lit(0.0), lambda a, x: a + x).alias("all_t"), *[f"values_{d}" for d in DIMENSIONS],
        *[place(d).alias(f"at_{d}") for d in DIMENSIONS], *[members(d).alias(f"of_{d}") for d in DIMENSIONS],
    ))

    def marginal(d: str, w: Column) -> Column:
        return F.transform(f"of_{d}", lambda own: F.aggregate(own, F.lit(0.0), lambda a, i: a + F.get(F.col("t"), i) * F.get(w, i)))

    def goal(d: str) -> Column:
        if d in targets:
            return F.transform(f"values_{d}", lambda v: _named(targets[d], v))
        powers = F.transform(marginal(d, F.transform("t", lambda _: F.lit(1.0))), lambda x: F.when(x > 0, F.pow(x, F.lit(temper))).otherwise(0.0))
        return _let(powers, lambda p: _let(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), lambda s: F.transform(p, lambda x: x / F.when(s > 0, s).otherwise(1.0))))

    row = cut(row.select("*", *[goal(d).alias(f"to_{d}") for d in DIMENSIONS]))

    def step(d: str, state: Column) -> Column:
        factors = F.transform(marginal(d, state["w"]), lambda x, k: F.when(x > 0, F.col("all_t") * F.get(F.col(f"to_{d}"), k) / x).otherwise(1.0))
        off = lambda f: F.greatest(state["off"], F.array_max(F.transform(f, lambda x: F.abs(x - 1.0))))
        return _let(factors, lambda f: F.struct(F.transform(state["w"], lambda x, i: x * F.get(f, F.get(F.col(f"at_{d}"), i))).alias("w"), off(f).alias("off")))

    def sweep(state: Column, _: Column) -> Column:
        done = F.struct(state["w"].alias("w"), F.lit(0.0).alias("off"))
        for d in DIMENSIONS:
            done = _let(done, partial(step, d))
        return F.when(state["off"] <= SETTLED, state).otherwise(done)

    start = F.struct(F.transform("t", lambda _: F.lit(1.0)).alias("w"), F.lit(1.0).alias("off"))
    row = row.select("c", F.aggregate(F.sequence(F.lit(1), F.lit(SWEEPS)), start, sweep).alias("s"))
    each = row.select(F.col("s.off").alias("residual"), F.explode(F.arrays_zip(F.col("c"), F.col("s.w").alias("w"))).alias("x"))
    return each.select(*[F.col(f"x.c.{d}").alias(d) for d in DIMENSIONS], "x.c.t", F.col("x.w").alias("weight"), "residual")


def _rake_exchanges(cells: DataFrame, temper: float, targets: Mapping[str, Mapping[str, float]], total: float) -> DataFrame:
    """rake() of many cells: a marginal is a sum over a window."""
    cells = cells.withColumns({"weight": F.lit(1.0), "off": F.lit(1.0)})
    for d in DIMENSIONS:
        own = F.sum("t").over(Window.partitionBy(d)).cast("double")
        cells = cells.withColumn(f"to_{d}", _named(targets[d], F.col(d)) if d in targets else F.when(own > 0, F.pow(own, F.lit(temper))).otherwise(0.0))
    cells = cut(cells)
    for d in DIMENSIONS:
        if d not in targets:
            norm = cells.select(d, f"to_{d}").distinct().agg(F.sum(f"to_{d}")).first()[0] or 1.0
            cells = cells.withColumn(f"to_{d}", F.col(f"to_{d}") / F.lit(float(norm)))
    for _ in range(SWEEPS // PER_JOB):
        for _ in range(PER_JOB):
            cells = cells.withColumn("off", F.lit(0.0))
            for d in DIMENSIONS:
                now = F.sum(F.col("t") * F.col("weight")).over(Window.partitionBy(d))
                cells = cells.withColumn("factor", F.coalesce(F.lit(total) * F.col(f"to_{d}") / F.when(now > 0, now), F.lit(1.0)))
                cells = cells.withColumns({"weight": F.col("weight") * F.col("factor"), "off": F.greatest("off", F.abs(F.col("factor") - 1.0))})
        cells = cut(cells)
        residual = cells.agg(F.max("off")).first()[0] or 0.0
        if residual <= SETTLED:
            break
    return cells.select(*DIMENSIONS, "t", "weight", F.lit(residual).alias("residual"))


def rake(cells: DataFrame, temper: float = TEMPER, targets: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """cells (source, lang, topic, t; none null) with their weight: marginals of t * weight are targets' shares, or the own shares to the power temper.

    residual, the same in all rows: by how much the last sweep's factors were off 1 at most; targets that
    no weights meet together leave a large one. Values that a dimension's targets don't name get weight
    0; a marginal without tokens is left alone.
    """
    cells = cut(cells)
    n, total = cells.agg(F.count("*"), F.coalesce(F.sum("t"), F.lit(0))).first()
    if n <= CELLS:
        return _rake_arrays(cells, temper, targets or {})
    return _rake_exchanges(cells, temper, targets or {}, float(total))


def mix(docs: DataFrame, topic: Column | None = None, targets: Mapping[str, Mapping[str, float]] | None = None, temper: float = TEMPER, budget: float = BUDGET, seed: int = SEED) -> DataFrame:
    """docs' columns in the struct doc, with source, lang, topic, n_tokens, weight, p and sampled.

    A null source, lang or topic is a value of its own (`?`). p = weight * min(budget, 1 / greatest
    weight): no probability is cut off, so the drawn tokens have the targets' marginals in
    expectation. Rows of one id are drawn together; a text without words has no say in the weights.
    """
    names = {d: F.coalesce(F.col(f"doc.{d}"), F.lit("?")) for d in ("source", "lang")}
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    rows = rows.withColumn("n_tokens", n_tokens(F.col("doc.text")))
    topic = topic_of(F.col("doc.text"), F.col("n_tokens")) if topic is None else topic
    rows = rows.select("doc", *[c.alias(d) for d, c in names.items()], F.coalesce(topic, F.lit("?")).alias("topic"), "n_tokens")
    cells = cut(rake(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("t")), temper, targets))
    most, n = cells.agg(F.max("weight"), F.count("*")).first()
    weights = cells.select(*DIMENSIONS, "weight")
    rate = min(budget, 1.0 / (most or 1.0))
    return rows.join(small(weights, n, 100_000), list(DIMENSIONS)).select("doc", *DIMENSIONS, "n_tokens", "weight", (F.col("weight") * rate).alias("p")).withColumn("sampled", uniform(F.col("doc.doc_id"), seed) < F.col("p"))


def op1_mixing(docs: DataFrame) -> DataFrame:
    """Every document with its cell, weight, probability and whether it is drawn; one row for each row of documents.

    A null source or lang is the value `?`; a null or empty text has no tokens (topic `lists`); very long
    texts are counted whole; rows of one id are drawn together or not at all, a null id counts as an
    empty one; columns besides doc_id, text, source and lang are not read. An empty table gives an empty one.
    """
    return mix(docs).select("doc.doc_id", *DIMENSIONS, "n_tokens", F.round("weight", 6).alias("weight"), F.round("p", 6).alias("p"), "sampled")


def _sweep() -> str:
    step = "(select i, source, lang, topic, t, all_t, to_source, to_lang, to_topic, 1.0::double as weight from prev)"
    for d in DIMENSIONS:
        step = f"(select * exclude (weight), weight * coalesce(all_t * to_{d} / nullif(sum(t * weight) over (partition by {d}), 0), 1.0) as weight from {step.replace('1.0::double as weight from prev', 'weight from prev')})"
    return step


ORACLE = rf"""
with recursive d as materialized (select doc_id, coalesce(source, '?') as source, coalesce(lang, '?') as lang,
    cast(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) as bigint) as n_tokens,
    case when len(regexp_extract_all(coalesce(text, ''), '[0-9]')) * 200 >= greatest(length(coalesce(text, '')), 1) then 'figures'
      when len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) < 12 * (length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1) then 'lists'
      else 'prose' end as topic from documents),
c as (select source, lang, topic, cast(sum(n_tokens) as double) as t from d group by all),
s as (select source, sum(t) ** {TEMPER} as x from c group by 1), l as (select lang, sum(t) ** {TEMPER} as x from c group by 1), p as (select topic, sum(t) ** {TEMPER} as x from c group by 1),
start as (select c.*, sum(t) over () as all_t, s.x / (select sum(x) from s) as to_source, l.x / (select sum(x) from l) as to_lang, p.x / (select sum(x) from p) as to_topic
  from c join s using (source) join l using (lang) join p using (topic)),
prev as (select 0 as i, source, lang, topic, t, all_t, to_source, to_lang, to_topic, cast(1 as double) as weight from start
  union all select i + 1, source, lang, topic, t, all_t, to_source, to_lang, to_topic, weight from {_sweep()} where i < {SWEEPS}),
w as materialized (select source, lang, topic, weight, weight * least({BUDGET}, 1 / max(weight) over ()) as p from prev where i = {SWEEPS})
select doc_id, source, lang, topic, n_tokens, round(weight, 6) as weight, round(p, 6) as p,
  cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':{SEED}'), 1, 13)) as bigint) / {1 << 52}.0 < p as sampled
from d join w using (source, lang, topic)
"""
