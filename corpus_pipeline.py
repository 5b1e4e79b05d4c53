"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, mixture.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that works on all that its
predecessor kept; all but the last return the columns of documents. The rows of the last have the
mixture's weight besides. Columns besides doc_id, text, lang, source and n_chars are carried along, whatever
their names; very long texts are read whole; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.llm import decontam, jaccard, mixing, quality, substring
from codexmill.llm.common import cut, fold_of, small, table, text_hash


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score under 0.3) go.

    Null and empty texts are scored as empty ones; equal rows stay or go together; without labels all stay.
    """
    rules = quality.train(docs, table(spark, sf_dir, "labels").where(fold_of("doc_id", 5) != 0).select("doc_id", "quality"))
    # explode() of one value: else the filter, pushed below, would compute the statistics once a rule.
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.explode(F.array(quality.statistics(F.col("text")))).alias("s"))
    return rows.where(rules.score(F.col("s")) >= 0.3).select("doc.*")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id stays; a null one counts as smallest.

    Documents without words (null, empty or blank) are in no group and all stay. Of equal rows (one id and
    text) one stays; of rows of one id that tie, the one whose text has the least hash.
    """
    found = cut(jaccard.ngram_jaccard(docs).where("n_shingles > 0").groupBy(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th")).agg(F.first("first").alias("stays"), F.count("*").alias("times")))
    same = F.col("doc.doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), text_hash().alias("th"))
    gone = found.where("not stays").select("k_id", "k_th")
    kept = rows.join(small(gone, gone.count()), same, "left_anti")
    again = found.where("stays and times > 1").select("k_id", "k_th")
    n = again.count()
    if n:  # one id and text in several rows
        once = kept.join(small(again, n), same, "left_semi").groupBy(F.col("doc.doc_id"), "th").agg(F.first("doc").alias("doc")).select("doc", "th")
        kept = kept.join(small(again, n), same, "left_anti").union(once)
    return kept.select("doc.*")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur more than once are cut out of the texts.

    No row goes: a text of which nothing is left is empty; null texts stay null; repeated rows repeat all
    they have. n_chars follows where a text changes.
    """
    found = substring.remove_repeated(docs)
    size = F.when(F.col("n_removed") > 0, F.length("clean"))
    return found.select(*[F.col("clean").alias(c) if c == "text" else F.coalesce(size, F.col("rest.n_chars")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("rest")[c].alias(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with windows of two benchmark items or more go; from the others the words of a hit go.

    Null and empty texts have no hits and stay; equal rows fare alike; n_chars follows where a text changes.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of the documents by calibrated probabilities, with 1 / p as mixture_weight.

    A null source or lang is a value of its own; a text without words has no say in the weights but is drawn
    like the others of its cell; rows of one id are drawn together, a null id counts as an empty one.
    """
    return mixing.mix(docs).where("sampled").select("doc.*", (1 / F.col("p")).alias("mixture_weight"))


STAGES = [
    ("quality", quality_stage),
    ("ngram_jaccard", jaccard_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: A classifier, an FM-index and a set join aren't SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each one's rows are materialised before the next reads them several times."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
