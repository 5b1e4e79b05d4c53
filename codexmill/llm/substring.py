"""Removal of long word sequences that occur more than once, exactly and over all documents.

A window is `width` consecutive words. Each window is assigned to an anchor, the least of its word
8-gram hashes (equal windows have equal anchors at equal places), and neighbouring windows of one
anchor form a segment. So whatever repeats meets under one anchor:

1. anchors that occur once are dropped, and with them all that is unique;
2. equal segments are counted before anything is gathered: all windows of one that occurs twice repeat.
   Those that occur very often are few; a bounded number of the commonest is broadcast and looked up
   where the documents are, the others are counted by a shuffle;
3. the different segments of an anchor go to shards. A shard builds a compressed FM-index (wavelet
   matrix) over blocks of its segments and streams their windows through backward search: a window
   repeats if its matching statistic reaches the width in two places;
4. an anchor with very many different segments isn't gathered in one shard: its windows are counted
   by their own hash, with partial counts;
5. each document's repeated windows cover the words to remove.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.common import cut, partitions, text_hash
from codexmill.llm.fmindex import FMIndex
from codexmill.llm.textkit import _SEEDS, BLANK, Hasher, U, grams, mix

GRAM = 8
#: Words in a block that an FM-index is built over, at least; one anchor's segments stay together.
BLOCK_WORDS = 100_000
#: A segment that occurs so often is found in the documents against a broadcast, not by a shuffle,
#: as long as there are no more such anchors, and no more such segments, than this (a few MB each; else fewer, commoner ones).
COMMON, BROADCAST_ANCHORS = 16, 200_000
#: An anchor with more different segments than this is counted by window instead.
SEGMENTS = 4_000


def _runs(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Segments of a group of rows: row, first window's place in the row, windows, anchor's hash, segment's hash."""
    g, per = grams(words, GRAM), width - GRAM + 1
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    n = len(words) - width + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),) * 2
    least = np.empty(n, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(g, per)
    for i in range(0, n, 1 << 16):
        least[i : i + (1 << 16)] = view[i : i + (1 << 16)].argmin(1) + np.arange(i, min(n, i + (1 << 16)))
    s = np.flatnonzero(row[:n] == row[width - 1 :])
    if not len(s):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),) * 2
    at = least[s]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (s[1:] != s[:-1] + 1)]))
    first, count = s[new], np.diff(np.append(new, len(s)))
    anchor = at[new]
    total = (count * 64 + (anchor - first)).astype(U)
    for j in range(width + per - 1):
        inside = j < count + width - 1
        i = np.where(inside, first + j, 0)
        total = total + np.where(inside, mix(words[i] + _SEEDS[j]) * _SEEDS[j], U(0))
    return row[first], first - starts[row[first]], count, g[anchor], mix(total)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among known, sorted and not empty."""
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _among_segments(anchor: np.ndarray, seg: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which segments are among known: a row of segments, sorted and all different, and a row of their anchors."""
    at = np.minimum(np.searchsorted(known[0], seg), known.shape[1] - 1)
    return (known[0][at] == seg) & (known[1][at] == anchor)


def _segments(docs: DataFrame, width: int, anchors: np.ndarray | None = None, without: np.ndarray | None = None) -> DataFrame:
    """doc_id, th, anchor, seg, place (first window << 8 | windows): of some anchors only (sorted), or without some segments (as _among_segments has them), from a broadcast."""
    given = docs.sparkSession.sparkContext.broadcast((anchors, without))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, without = given.value
        hasher = Hasher(BLANK, lower=False)
        for b in batches:
            for lo, _, words, starts in hasher.rows(b.column("text")):
                row, first, count, anchor, seg = _runs(words, starts, width)
                anchor, seg = anchor.view(np.int64), seg.view(np.int64)
                if anchors is not None or without is not None:
                    stay = _among(anchor, anchors) if anchors is not None else ~_among_segments(anchor, seg, without)
                    row, first, count, anchor, seg = row[stay], first[stay], count[stay], anchor[stay], seg[stay]
                at = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(at), b.column("th").take(at), pa.array(anchor), pa.array(seg), pa.array(first << 8 | count)], ["doc_id", "th", "anchor", "seg", "place"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_hash().alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, anchor long, seg long, place long")


def _common_hits(docs: DataFrame, width: int, common: np.ndarray) -> DataFrame:
    """doc_id, th, found: the documents' segments among common, all of whose windows repeat; one row a document."""
    given = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BLANK, lower=False)
        for b in batches:
            for lo, hi, words, starts in hasher.rows(b.column("text")):
                row, first, count, anchor, seg = _runs(words, starts, width)
                hit = _among_segments(anchor.view(np.int64), seg.view(np.int64), given.value)
                row, e = row[hit], first[hit] << 32 | ((np.int64(1) << count[hit]) - 1)
                ends = np.searchsorted(row, np.arange(hi - lo + 1))
                some = pa.array(np.flatnonzero(np.diff(ends)))
                found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(e))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo).take(some), b.column("th").slice(lo, hi - lo).take(some), found.take(some)], ["doc_id", "th", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_hash().alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, found array<long>")


def _with_entries(docs: DataFrame, entries: DataFrame, how: str) -> DataFrame:
    """docs joined with entries (doc_id, th, found array): rest (a struct of the columns besides text), text, found."""
    keyed = entries.select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"), "found")
    left = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("rest"), text_hash().alias("th"), "text")
    return left.join(keyed, F.col("rest.doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), how).select("rest", "th", "text", "found")


def _contents(docs: DataFrame, variants: DataFrame, width: int) -> DataFrame:
    """The words of each variant (anchor, place, lone, hot, doc_id, th), as 64-bit hashes; of hot ones only windows' hashes are needed, which _windows() takes from them."""
    entries = cut(variants.groupBy("doc_id", "th").agg(F.collect_list(F.struct("anchor", "place", "lone", "hot")).alias("found")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BLANK, lower=False)
        for b in batches:
            found, ths = b.column("found"), b.column("th")
            ids = b.column("rest").field("doc_id")
            for lo, hi, words, starts in hasher.rows(b.column("text")):
                owners, rows, out = [], [], []
                for i in range(lo, hi):
                    for e in found[i].as_py():
                        first, count = starts[i - lo] + (e["place"] >> 8), e["place"] & 255
                        owners.append(i)
                        rows.append(e)
                        out.append(words[first : first + count + width - 1].tobytes())
                at = pa.array(owners, pa.int64())
                cols = [pa.array([e[c] for e in rows], t) for c, t in (("anchor", pa.int64()), ("place", pa.int64()), ("lone", pa.bool_()), ("hot", pa.bool_()))]
                yield pa.RecordBatch.from_arrays([ids.take(at), ths.take(at), *cols, pa.array(out, pa.binary())], ["doc_id", "th", "anchor", "place", "lone", "hot", "words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_entries(docs.select("doc_id", "text"), entries, "inner").mapInArrow(run, f"doc_id {kind}, th long, anchor long, place long, lone boolean, hot boolean, words binary")


def _windows(contents: DataFrame, width: int) -> DataFrame:
    """doc_id, th, anchor, place, lone, bit, hash: one row for each window of the contents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                hashes = [grams(np.frombuffer(w.as_py(), U), width) for w in part.column("words")]
                sizes = [len(h) for h in hashes]
                owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                bits = np.concatenate([np.arange(n) for n in sizes])
                yield pa.RecordBatch.from_arrays([*[part.column(c).take(owner) for c in ("doc_id", "th", "anchor", "place", "lone")], pa.array(bits), pa.array(np.concatenate(hashes).view(np.int64))], ["doc_id", "th", "anchor", "place", "lone", "bit", "hash"])

    kind = contents.schema["doc_id"].dataType.simpleString()
    return contents.mapInArrow(run, f"doc_id {kind}, th long, anchor long, place long, lone boolean, bit long, hash long")


def _search(contents: DataFrame, width: int) -> DataFrame:
    """doc_id, th, e: first window << 32 | mask of each lone segment with windows that occur twice in its shard; bit j is window j."""

    def block(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        parts = [r[-1] for r in rows]
        sizes = np.array([len(p) for p in parts])
        known, ids = np.unique(np.concatenate(parts), return_inverse=True)
        text = np.zeros(sizes.sum() + len(parts), np.int32)  # symbol 0 parts and ends the segments
        begin = np.cumsum([0, *(sizes[:-1] + 1)])
        text[np.repeat(begin - np.cumsum([0, *sizes[:-1]]), sizes) + np.arange(sizes.sum())] = ids + 1
        asked = np.flatnonzero([r[3] for r in rows])  # of segments that repeat whole all windows are known
        counts = sizes[asked] - width + 1
        owner = np.repeat(asked, counts)
        bit = np.concatenate([np.arange(c) for c in counts] or [np.zeros(0, np.int64)])
        hit = FMIndex(text, len(known) + 1, width + 1).repeated(text, begin[owner] + bit, width)
        masks = np.zeros(len(parts), np.int64)
        np.add.at(masks, owner[hit], np.int64(1) << bit[hit])
        some = np.flatnonzero(masks)
        e = [(rows[i][2] >> 8 << 32) | int(masks[i]) for i in some]
        return pa.RecordBatch.from_arrays([pa.array([rows[i][0] for i in some], kind), pa.array([rows[i][1] for i in some], pa.int64()), pa.array(e, pa.int64())], ["doc_id", "th", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, last, kind = [], 0, None, None
        for b in batches:
            kind = b.column("doc_id").type
            for doc_id, th, anchor, place, lone, words in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "anchor", "place", "lone", "words")), strict=True):
                if held >= BLOCK_WORDS and anchor != last:
                    yield block(rows, kind)
                    rows, held = [], 0
                rows.append((doc_id, th, place, lone, np.frombuffer(words, U)))
                held += len(words) // 8
                last = anchor
        if rows:
            yield block(rows, kind)

    kind = contents.schema["doc_id"].dataType.simpleString()
    return contents.repartition(partitions(contents.sparkSession), "anchor").sortWithinPartitions("anchor").mapInArrow(run, f"doc_id {kind}, th long, e long")


def _common(docs: DataFrame, width: int, often: DataFrame) -> DataFrame | None:
    """The commonest segments, one row each as in kinds; None if there are none.

    They occur COMMON times or more, or as many times more as it takes for their anchors to be no more
    than BROADCAST_ANCHORS, whatever the corpus's size.
    """
    found = {r["e"]: r["n"] for r in often.groupBy(F.floor(F.log2("k")).alias("e")).agg(F.count("*").alias("n")).collect()}
    least = COMMON
    while sum(n for e, n in found.items() if 2 << e > least) > BROADCAST_ANCHORS:  # 2 << e: above all k of e
        least *= 2
    hot = often.where(F.col("k") >= least).select("anchor").toPandas()["anchor"].to_numpy()
    if not len(hot):
        return None
    kinds = cut(_kinds(_segments(docs, width, anchors=np.sort(hot))).where(F.col("m") >= least).dropDuplicates(["seg"]))
    found = {r["e"]: r["n"] for r in kinds.groupBy(F.floor(F.log2("m")).alias("e")).agg(F.count("*").alias("n")).collect()}
    while sum(n for e, n in found.items() if 2 << e > least) > BROADCAST_ANCHORS:  # an anchor may have any number of segments
        least *= 2
    kinds = kinds.where(F.col("m") >= least)
    return kinds if kinds.limit(1).count() else None


def _kinds(segments: DataFrame) -> DataFrame:
    """One row for each segment that differs: how often it occurs, and one place where it does."""
    return segments.groupBy("anchor", "seg").agg(F.count("*").alias("m"), F.first("doc_id").alias("doc_id"), F.first("th").alias("th"), F.first("place").alias("place"))


def repeated_windows(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, th, found: per document its repeated windows, each entry first window << 32 | mask."""
    if width < GRAM + 1 or width > 39:
        raise ValueError("width must be 9 to 39")
    often = cut(_segments(docs, width).groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1"))
    common = _common(docs, width, often)
    known = None
    if common is not None:
        pairs = common.select("seg", "anchor").toPandas().sort_values("seg")
        known = np.stack([pairs["seg"].to_numpy(), pairs["anchor"].to_numpy()])
    segments = cut(_segments(docs, width, without=known).join(often.select("anchor"), "anchor"))  # both sides plain exchanges: Spark can split a hot anchor
    kinds = _kinds(segments)
    kinds = cut(kinds if common is None else kinds.union(common))
    several = cut(kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("m") == 1).alias("lone")).where("kinds > 1 and lone > 0").select("anchor", "kinds"))
    different = kinds.join(several, "anchor").select("*", (F.col("m") == 1).alias("lone"), (F.col("kinds") > SEGMENTS).alias("hot"))
    # Segments that repeat whole: all their windows, wherever they are. The others occur once, and bring their place along.
    whole = segments.join(kinds.where("m > 1").select("anchor", "seg"), ["anchor", "seg"], "left_semi")
    hits = whole.selectExpr("doc_id", "th", "shiftleft(shiftright(place, 8), 32) | (shiftleft(1L, cast(place & 255 as int)) - 1) as e")
    contents = cut(_contents(docs, different, width))
    hits = hits.union(_search(contents.where("not hot"), width))
    if several.where(F.col("kinds") > SEGMENTS).limit(1).count():
        one = _windows(contents.where("hot"), width)
        twice = cut(one.groupBy("anchor", "hash").agg(F.count("*").alias("k")).where("k > 1").select("anchor", "hash"))
        again = one.where("lone").join(twice, ["anchor", "hash"], "left_semi").groupBy("doc_id", "th", "place").agg(F.expr("bit_or(shiftleft(1L, cast(bit as int)))").alias("mask"))
        hits = hits.union(again.selectExpr("doc_id", "th", "shiftleft(shiftright(place, 8), 32) | mask as e"))
    found = hits.groupBy("doc_id", "th").agg(F.collect_set("e").alias("found"))
    if known is not None:
        found = found.union(_common_hits(docs, width, known)).groupBy("doc_id", "th").agg(F.flatten(F.collect_set("found")).alias("found"))
    return cut(found)


#: A word with the blanks before it.
PIECE = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")


def remove_repeated(docs: DataFrame, width: int = 35) -> DataFrame:
    """One row per row of docs: rest (a struct of its columns besides text), text, n_words, n_removed, kept, clean.

    Every word that lies in a repeated window goes, in all places where it repeats; windows are judged
    on the input. kept has the words left, joined by one space; clean is the text as it was where
    nothing goes, else without the words that go and the blanks before them. A null text has no words
    and stays null in clean. Rows that repeat whole repeat their windows.
    """
    found = repeated_windows(docs, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                total, removed, kept, clean = [], [], [], []
                for value, entries in zip(part.column("text"), part.column("found"), strict=True):
                    text = value.as_py()
                    words = (text or "").encode().split()
                    total.append(len(words))
                    gone = 0
                    if entries.is_valid:
                        e = np.array(entries.as_py(), np.int64)
                        edge = np.zeros(len(words) + 1, np.int64)
                        for j in range(32):
                            first = (e >> 32)[(e >> j) & 1 == 1] + j
                            np.add.at(edge, first, 1)
                            np.add.at(edge, first + width, -1)
                        stay = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
                        gone = len(words) - len(stay)
                        pieces = PIECE.findall(text.encode())
                        text = b"".join([pieces[i] for i in stay]).decode().strip()
                        words = [words[i] for i in stay]
                    removed.append(gone)
                    kept.append(b" ".join(words).decode())
                    clean.append(text)
                yield pa.RecordBatch.from_arrays([part.column("rest"), part.column("text"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(clean, pa.string())], ["rest", "text", "n_words", "n_removed", "kept", "clean"])

    joined = _with_entries(docs, found, "left")
    return joined.mapInArrow(run, f"rest {joined.schema['rest'].dataType.simpleString()}, text string, n_words long, n_removed long, kept string, clean string")


def op6_substring_dedup(docs: DataFrame) -> DataFrame:
    """remove_repeated() by 35 words, what is kept as its digest: one row for each row of documents.

    Null and empty texts, and texts under 35 words, have no windows and keep all their words (none: the
    digest of the empty string); very long texts are read whole, in pieces; repeated rows repeat all their
    windows; columns besides doc_id and text are not read. An empty table gives an empty one.
    """
    return remove_repeated(docs.select("doc_id", "text")).select("rest.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
