"""Exact Jaccard join over word shingles, after set-relation skipping.

Which sets can link at all is settled on an inverted index over set prefixes (in the order of token
hashes). What a set is linked to then follows from a very similar set wherever it can:

1. shingle every whole text; equal sets are one set from here on;
2. a set stays only if enough of its prefix is shared with another set (`slack` tokens beyond the
   usual prefix make that test sharp, and exact), and then enough of all of it;
3. answers by relation: in the lists of a few tokens of each set, every set is compared with the
   list's leading set only; linked sets form components, and inside one no other pair needs work;
4. skipping: a list whose sets are all in one component is skipped whole. The others fall into blocks
   by size, of which a set meets its own and the next ones only; there the sets outside the list's
   largest component are compared with the rest, but for pairs that positions or the distances to a
   common leading set rule out;
5. components of all links.

Nothing is capped; every comparison is of whole sets, as hashes of 64 bits. Sets are one only if 128 bits
and the sizes agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.llm.common import cut, small, text_hash
from codexmill.llm.graph import components
from codexmill.llm.textkit import BLANK, Hasher, U, grams, mix

#: Tokens of a set whose lists take part in step 3.
LEADING = 8


def shingles(docs: DataFrame, width: int, percent: int, slack: float, keep: str, salt: int = 0) -> DataFrame:
    """One row per row of docs: doc_id, th, sid (64-bit id of the set, by salt), again (64 bits more of it), n (its size), tokens.

    tokens are the set's hashes in ascending order: the extended prefix (keep "prefix") or all ("all").
    Words are what blanks part, A-Z lower-cased; a text of fewer than width words is one shingle, a text
    without words has the empty set (n 0).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BLANK, lower=True)
        for b in batches:
            for lo, hi, words, starts in hasher.rows(b.column("text")):
                whole, sizes, sids, more, parts = grams(words, width), [], [], [], []
                for i, j in zip(starts[:-1], starts[1:], strict=True):
                    if j - i >= width:
                        tokens = np.unique(whole[i : j - width + 1])
                    elif j > i:
                        tokens = mix(grams(words[i:j], int(j - i)) + U(j - i))
                    else:
                        tokens = words[:0]
                    n = len(tokens)
                    sizes.append(n)
                    sids.append(int((mix(tokens + U(7 + salt)).sum(dtype=U) ^ U(n))) if n else 0)
                    more.append(int(mix(tokens ^ U(0x9E3779B97F4A7C15)).sum(dtype=U)) if n else 0)
                    parts.append(tokens if keep == "all" else tokens[: prefix_length(n, percent) + int(np.ceil(slack * n))])
                out = [b.column("doc_id").slice(lo, hi - lo), b.column("th").slice(lo, hi - lo), pa.array(mix(np.array(sids, U)).view(np.int64)), pa.array(np.array(more, U).view(np.int64)), pa.array(np.array(sizes, np.int64))]
                ends = np.cumsum([0, *map(len, parts)])
                flat = np.concatenate(parts) if parts else words[:0]
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((flat ^ U(1 << 63)).view(np.int64))))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "th", "sid", "again", "n", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_hash().alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, sid long, again long, n long, tokens array<long>")


def prefix_length(n: int, percent: int) -> int:
    """Of two linked sets, one of so many first tokens of each is common to both."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _linked(common: Column, na: Column, nb: Column, percent: int) -> Column:
    return 100 * common >= percent * (na + nb - common)


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with na, nb and common, the sizes of the sets and of what they share."""
    a = sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).cast("long").alias("common"))


def distinct_sets(rows: DataFrame) -> DataFrame:
    """Materialised: sid, n, copies, least (doc_id), head (doc_id and th) of the sets that aren't empty, and whether one sid stands for several."""
    both = F.struct("n", "again")
    return cut(rows.where("n > 0").groupBy("sid").agg(F.max("n").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "th")).alias("head"), (F.min(both) != F.max(both)).alias("several")))


def candidates(docs: DataFrame, rows: DataFrame, known: DataFrame, width: int, percent: int, slack: float, salt: int) -> DataFrame:
    """Step 2, materialised: sid, n, tokens (those that another of these sets has, rarest first) of the sets that may link."""
    index = rows.where("n > 0").select("sid", F.explode("tokens").alias("token"))
    shared = cut(index.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo <> hi").select("token"))
    enough = F.greatest(F.lit(1), F.floor(F.col("n") * slack) - 1)
    hits = index.join(shared, "token").groupBy("sid").agg(F.count("*").alias("hits"))
    alive = cut(hits.join(known, "sid").where(F.col("hits") >= enough * F.col("copies")).select(F.col("head.doc_id").alias("k_id"), F.col("head.th").alias("k_th")))

    # Only the sets that stay are gathered, one row each, however many rows have them.
    theirs = docs.select("doc_id", "text", text_hash().alias("th")).join(small(alive, alive.count()), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left_semi").select("doc_id", "text")
    whole = cut(shingles(theirs, width, percent, slack, "all", salt).groupBy("sid").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")))
    each = whole.select("sid", "n", F.explode("tokens").alias("token"))
    known = cut(each.groupBy("token").agg(F.count("*").alias("k")).where("k > 1"))
    kept = each.join(known, "token").groupBy("sid").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("k", "token"))).alias("t"))
    # A set's answers lie within its shared tokens: too few of them and it has none.
    return cut(kept.where(100 * F.size("t") >= percent * F.col("n")).select("sid", "n", F.col("t.token").alias("tokens")))


def link_sets(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root): components of the sets that have links. Positions count the unshared tokens, which come first."""
    alone = F.col("n") - F.size("tokens")

    # 3. every set against the leading set of its lists: the one with the smallest share of tokens of its own
    first = sets.select("sid", F.struct((1 - alone / F.col("n")).alias("s"), F.col("sid").alias("lead")).alias("rank"), F.explode(F.slice(F.array_sort(F.transform("tokens", lambda t: F.xxhash64(t))), 1, LEADING)).alias("token"))
    lead = cut(first.groupBy("token").agg(F.max("rank").alias("top"), F.count("*").alias("k")).where("k > 1").select("token", F.col("top.sid").alias("lead")))
    star = cut(first.join(lead, "token").where("sid <> lead").select(F.col("sid").alias("a"), F.col("lead").alias("b")).distinct())
    measured = cut(_compare(star, sets))
    comps = cut(components(measured.where(_linked(F.col("common"), F.col("na"), F.col("nb"), percent)).select("a", "b")))

    # 4. lists that still hold several components
    prefix = F.expr(f"cast(n - ceil({percent} * n / 100D) + 1 as int)") - alone
    lists = cut(
        sets.join(comps.withColumnRenamed("node", "sid"), "sid", "left")
        .where(prefix > 0)
        .select("sid", "n", alone.alias("alone"), F.coalesce("root", "sid").alias("root"), F.posexplode(F.slice("tokens", F.lit(1), prefix)).alias("pos", "token"))
        .select("sid", "n", "root", (F.col("pos") + F.col("alone")).alias("pos"), F.col("alone"), "token")
    )
    mixed = cut(lists.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy("token").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1").select("token", "main"))
    # Linked sets' sizes are so near that their blocks are the same or neighbours.
    block = F.floor(F.ln("n") / F.lit(math.log(100 / percent))).cast("int") if percent < 100 else F.col("n").cast("int")
    entries = cut(lists.join(mixed, "token").withColumn("block", block))
    x = entries.where("root <> main").select("token", "main", F.explode(F.sequence(F.col("block") - 1, F.col("block") + 1)).alias("block"), *[F.col(c).alias(f"x_{c}") for c in ("sid", "n", "pos", "root")])
    y = entries.select("token", "block", *[F.col(c).alias(f"y_{c}") for c in ("sid", "n", "pos", "root")])
    bound = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    pairs = x.join(y, ["token", "block"]).where(
        (F.col("x_root") != F.col("y_root"))
        & ((F.col("y_root") == F.col("main")) | (F.col("x_sid") < F.col("y_sid")))
        & (100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
        & ((100 + percent) * bound >= percent * (F.col("x_n") + F.col("y_n")))
    )
    pairs = cut(pairs.select(F.col("x_sid").alias("a"), F.col("y_sid").alias("b")).distinct())
    # A pair whose distances to a common leading set differ by more than a link allows has no link.
    apart = measured.select("a", F.col("b").alias("lead"), (1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("d"))
    known = pairs.join(apart.withColumnRenamed("d", "da"), "a").join(apart.select(F.col("a").alias("b"), "lead", F.col("d").alias("db")), ["b", "lead"])
    ruled_out = known.where(F.abs(F.col("da") - F.col("db")) > 1 - percent / 100 + 1e-9).select("a", "b").distinct()
    more = _compare(pairs.join(ruled_out, ["a", "b"], "left_anti"), sets).where(_linked(F.col("common"), F.col("na"), F.col("nb"), percent)).select("a", "b")
    more = more.join(comps.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(comps.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    over = cut(components(more))
    below = comps.select("node", F.col("root").alias("mid")).union(over.select("node", F.col("node").alias("mid"))).distinct()
    return below.join(over.select(F.col("node").alias("mid"), F.col("root").alias("top")), "mid", "left").groupBy("node").agg(F.min(F.coalesce("top", "mid")).alias("root"))


def ngram_jaccard(docs: DataFrame, width: int = 5, percent: int = 80, slack: float = 0.1) -> DataFrame:
    """One row per row of docs: doc_id, th, n_shingles, component_id, first.

    component_id is the smallest doc_id that links reach, the row's own included (null only where all
    of them are null); rows with equal sets are linked, rows without words with nothing. first holds
    for one set of doc_id and th in each component (for a row without words: itself).
    """
    for salt in range(8):
        rows = cut(shingles(docs, width, percent, slack, "prefix", salt))
        known = distinct_sets(rows)
        if not known.where("several").limit(1).count():
            break
    comps = link_sets(candidates(docs, rows, known, width, percent, slack, salt), percent)
    placed = cut(known.select("sid", "least", "head").join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid")))
    tops = cut(placed.groupBy("root").agg(F.min("least").alias("component_id"), F.min("head").alias("head")))  # a plain exchange follows: a large component can be split
    named = placed.select("sid", "root").join(tops, "root").select("sid", "component_id", "head")
    full = rows.where("n > 0").join(named, "sid").select("doc_id", "th", F.col("n").alias("n_shingles"), "component_id", (F.struct("doc_id", "th").eqNullSafe(F.col("head"))).alias("first"))
    return full.union(rows.where("n = 0").select("doc_id", "th", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("first")))


def op5_ngram_jaccard(docs: DataFrame) -> DataFrame:
    """ngram_jaccard() by five words and four fifths: one row for each row of documents.

    Null and empty texts have no shingles and are linked with nothing; very long texts are read whole,
    in pieces; repeated rows are linked, as their sets are equal; of tied ids there is but one smallest;
    columns besides doc_id and text are not read. An empty table gives an empty one.
    """
    return ngram_jaccard(docs).select("doc_id", "n_shingles", "component_id")
