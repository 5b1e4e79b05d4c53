"""Document fingerprints by randomised edit embedding.

All texts share one random walk: at step j the text's current character is emitted, and a random bit
of (j, character) says whether to move on to the next. Walks of texts a few edits apart fall into
step again soon, so edit distance becomes Hamming distance between the emitted sequences. The
fingerprint samples those at fixed steps, SAMPLES an octave, so that texts of any length have
steps in common; likeness is the weighted share of equal samples. Near texts are found by bands of
samples, of walks from both ends, and verified by edit distance.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.common import cut, partitions, small, text_hash
from codexmill.llm.graph import components
from codexmill.llm.textkit import U, mix

SAMPLES = 32
FIRST_OCTAVE = 64
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/"
PAD = "-"
#: The walk's bits repeat after so many steps; characters fall into so many classes.
PERIOD, CLASSES = 4096, 64
BLOCK = 1 << 16


def _repeats(seed: int) -> bytes:
    """For each class and step: how many steps its character is emitted for, counted from that step."""
    bits = mix((np.arange(1, CLASSES * PERIOD + 1, dtype=U) + U(seed * CLASSES * PERIOD)) * U(0x9E3779B97F4A7C15)).reshape(CLASSES, PERIOD) & U(1) == 1
    bits[:, ::64] = True  # bounds a run
    out = np.ones((CLASSES, PERIOD), np.uint8)
    run = np.ones(CLASSES, np.uint8)
    for j in range(2 * PERIOD - 1, -1, -1):
        run = np.where(bits[:, j % PERIOD], 1, run + 1).astype(np.uint8)
        out[:, j % PERIOD] = run
    return out.tobytes()


def octave(k: int) -> tuple[int, int]:
    """First step and width of octave k."""
    return (FIRST_OCTAVE << (k - 1), FIRST_OCTAVE << (k - 1)) if k else (0, FIRST_OCTAVE)


def _steps(octaves: int) -> np.ndarray:
    found = []
    for k in range(octaves):
        first, width = octave(k)
        draw = mix(np.arange(1, SAMPLES + 1, dtype=U) + U(1000 * (k + 1)))
        found.append(np.sort(first + ((np.arange(SAMPLES) + (draw >> U(11)).astype(np.float64) / 2.0**53) * (width / SAMPLES)).astype(np.int64)))
    return np.concatenate(found)


def _three(wide: np.ndarray, place: np.ndarray) -> np.ndarray:
    """64 bits of the three characters that end at each place of a text; wide has two more before the text."""
    return mix(wide[place + 2].astype(U) * U(0x100000001B3) + wide[place + 1].astype(U) * U(0x1000193) + wide[place].astype(U))


class Walk:
    """Fingerprints of texts; a walk may go on from a prefix. Each seed has a walk of its own."""

    def __init__(self, seed: int = 0) -> None:
        self.repeats = _repeats(seed)
        self.steps = _steps(40)
        self.letters = np.frombuffer(ALPHABET.encode(), np.uint8)

    def hashes(self, codes: np.ndarray, context: np.ndarray, at: int) -> tuple[int, np.ndarray]:
        """Walks codes from step at, after the characters in context: the step reached and 64 bits of each sample on the way, which are of a character and the two before it."""
        repeats, mask, found = self.repeats, PERIOD - 1, []
        before = np.concatenate([np.zeros(2, np.uint32), context[-2:]])[-2:]
        for lo in range(0, len(codes), BLOCK):
            part = codes[lo : lo + BLOCK]
            wide = np.concatenate([before, part])
            rows = ((mix(part.astype(U) + U(99)) >> U(58)).astype(np.int64) * PERIOD).tolist()
            j = at
            ends = np.array([j := j + repeats[c + (j & mask)] for c in rows], np.int64)
            i, k = np.searchsorted(self.steps, [at, j])
            found.append(_three(wide, np.searchsorted(ends, self.steps[i:k], side="right")))
            at, before = j, wide[-2:]
        return at, np.concatenate(found) if found else np.zeros(0, U)

    def go(self, codes: np.ndarray, context: np.ndarray, at: int) -> tuple[int, np.ndarray]:
        """hashes() with a letter for each sample."""
        at, found = self.hashes(codes, context, at)
        return at, self.letters[(found >> U(58)).astype(np.int64)]

    def finish(self, samples: np.ndarray) -> str:
        return samples.tobytes().decode() + PAD * (-len(samples) % SAMPLES)

    def fingerprint(self, text: str | None, backward: bool = False) -> str:
        codes = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
        codes = codes[::-1] if backward else codes
        return self.finish(self.go(codes, codes[:0], 0)[1])


#: The class of each character of Unicode's first plane.
CLASS_OF = (mix(np.arange(1 << 16, dtype=U) + U(99)) >> U(58)).astype(np.uint8)
#: Texts of about one length walk together, up to so many characters with their repeats for all sides; with fewer lanes than LANES each walks alone.
TOGETHER, LANES = 1 << 23, 64


class Walks:
    """Samples of many texts by several sides (seed, backward) at once, a step of all in one go: what Walk gives for each."""

    def __init__(self, sides: Sequence[tuple[int, bool]]) -> None:
        self.sides = [(Walk(seed), backward) for seed, backward in sides]
        self.repeats = np.frombuffer(b"".join(walk.repeats for walk, _ in self.sides), np.uint8)

    def hashes(self, texts: Sequence[str]) -> list[list[np.ndarray]]:
        found: list[list[np.ndarray]] = [[]] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        while order:
            n = max(1, min(len(order), TOGETHER // max(1, len(texts[order[0]]) * len(self.sides))))
            group, order = order[:n], order[n:]
            if n * len(self.sides) < LANES:
                samples = [self._alone(texts[i]) for i in group]
            else:
                samples = self._together([texts[i] for i in group])
            for i, own in zip(group, samples, strict=True):
                found[i] = own
        return found

    def _alone(self, text: str) -> list[np.ndarray]:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return [walk.hashes(codes[::-1] if backward else codes, codes[:0], 0)[1] for walk, backward in self.sides]

    def _together(self, texts: list[str]) -> list[list[np.ndarray]]:
        """texts by falling length. Lanes are text by text, a text's sides beside each other."""
        sides, several = self.sides, len(self.sides)
        codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
        sizes = np.array([len(c) for c in codes])
        longest = int(sizes[0])
        kinds = np.zeros((longest, len(texts), several), np.uint8)
        for k, c in enumerate(codes):
            own = CLASS_OF[np.minimum(c, 0xFFFF)]
            if c.size and c.max() > 0xFFFF:
                own = (mix(c.astype(U) + U(99)) >> U(58)).astype(np.uint8)
            for i, (_, backward) in enumerate(sides):
                kinds[: len(c), k, i] = own[::-1] if backward else own
        kinds = kinds.reshape(longest, -1)
        first = np.tile(np.arange(several, dtype=np.int32) * (CLASSES * PERIOD), len(texts))
        active = np.searchsorted(-sizes, -np.arange(longest), side="left") * several  # lanes that have a character at this place
        at, ends = np.zeros(len(first), np.int32), np.zeros((len(first), longest), np.int32)
        for lo in range(0, longest, 128):
            rows = kinds[lo : lo + 128].astype(np.int32) * PERIOD + first
            reached = np.zeros(rows.shape, np.int32)
            for t in range(len(rows)):
                n = active[lo + t]
                j = at[:n]
                j += self.repeats[rows[t, :n] + (j & (PERIOD - 1))]
                reached[t, :n] = j
            ends[:, lo : lo + 128] = reached.T
        samples = []
        for k, c in enumerate(codes):
            own, ways = [], {back: np.concatenate([np.zeros(2, np.uint32), c[::-1] if back else c]) for back in (False, True)}
            for i, (walk, backward) in enumerate(sides):
                lane = ends[k * several + i, : len(c)]
                steps = walk.steps[: np.searchsorted(walk.steps, lane[-1])] if len(c) else walk.steps[:0]
                own.append(_three(ways[backward], np.searchsorted(lane, steps.astype(np.int32), side="right")))
            samples.append(own)
        return samples


def likeness(a: str, b: str) -> float:
    """Share of equal samples, each with its octave's width; steps past the end of both texts don't count. 1.0 for two empty texts."""
    n = max(len(a), len(b))
    if not n:
        return 1.0
    x, y = (np.frombuffer(s.ljust(n, PAD).encode(), np.uint8) for s in (a, b))
    weight = np.repeat([octave(k)[1] for k in range(n // SAMPLES)], SAMPLES).astype(np.float64)
    inside = (x != ord(PAD)) | (y != ord(PAD))
    return float((weight * (inside & (x == y))).sum() / max((weight * inside).sum(), 1e-12))


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance, a column of the table as the bits of two integers; most + 1 as soon as it must be over most.

    What both texts begin and end with is left out first.
    """
    head = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[head:], b[head:]
    tail = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b:
        return len(a) or len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = full, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b, strict=True):
        same = where.get(c, 0)
        zero = (((same & up) + up) ^ up) | same | down
        rise, fall = down | (full & ~(zero | up)), up & zero
        distance += bool(rise & top) - bool(fall & top)
        if most is not None and distance - left > most:
            return most + 1
        rise, fall = ((rise << 1) | 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(zero | rise)), rise & zero
    return distance


def _grams(text: str, q: int, bins: int) -> np.ndarray:
    """Counts of a text's runs of q characters, by hash in so many bins."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(U)
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(bins, np.int64)
    total = codes[:n]
    for j in range(1, q):
        total = total * U(0x100000001B3) + codes[j : n + j]
    return np.bincount((mix(total) >> U(40)).astype(np.int64) % bins, minlength=bins)


def alike(a: str, b: str, least: float) -> bool:
    """Whether the edit similarity, 1 - distance / length of the longer, is least or more.

    An edit changes q runs of q characters at most on either side, so texts whose counts of runs differ by
    more are apart without more work.
    """
    n = max(len(a), len(b))
    most = int((1 - least) * n + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    bins = 1 << max(8, min(18, n.bit_length() + 1))
    if n > 40 and any(int(np.abs(_grams(a, q, bins) - _grams(b, q, bins)).sum()) > 2 * q * most for q in (3, 4)):
        return False
    return edit_distance(a, b, most) <= most


def bands_of(samples: Sequence[np.ndarray], per_band: int) -> np.ndarray:
    """Hashes of the bands of each side's last three octaves, and of one more where the last isn't full.

    Only bands within the text count: what pads a fingerprint is the same in all texts of about one length.
    """
    found = []
    for side, h in enumerate(samples):
        octaves = -(-len(h) // SAMPLES)
        first = max(0, octaves - (4 if len(h) % SAMPLES else 3)) * SAMPLES // per_band
        last = len(h) // per_band
        if last > first:
            rows = h[first * per_band : last * per_band].reshape(-1, per_band)
            key = mix(np.arange(first, last, dtype=U) + U((side + 1) << 32))
            for k in range(per_band):
                key = mix(key * U(0x100000001B3) + rows[:, k])
            found.append(key)
    return np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)


def bands(docs: DataFrame, per_band: int, sides: Sequence[tuple[int, bool]]) -> DataFrame:
    """doc_id, th, n_chars, bands of every row of docs, by bands_of() for all sides (seed, backward); none for null and empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = Walks(sides)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = [pa.array(bands_of(own, per_band)) for own in walks.hashes(texts)]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.concat_arrays(found))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("th"), pa.array([len(t) for t in texts], pa.int64()), lists], ["doc_id", "th", "n_chars", "bands"])

    return docs.select("doc_id", text_hash().alias("th"), "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, th long, n_chars long, bands array<long>")


def _lists(kinds: DataFrame, least: float) -> DataFrame:
    """kind, key: the lists that a text is in, if another is there too. A list is a band in one block of lengths; texts within least share a block."""
    block = F.floor(F.ln("n_chars") / F.lit(-math.log(least))) if least < 1 else F.col("n_chars")
    rows = kinds.where("n_chars > 0").select("kind", F.explode("bands").alias("band"), block.alias("block")).select("kind", "band", F.explode(F.array("block", F.col("block") + 1)).alias("block")).select("kind", F.xxhash64("band", "block").alias("key"))
    several = rows.groupBy("key").agg(F.min("kind").alias("lo"), F.max("kind").alias("hi")).where("lo <> hi").select("key")
    return rows.join(several, "key")


def near_classes(docs: DataFrame, least: float = 0.8, per_band: int = 4, walks: int = 2, rounds: int = 4) -> DataFrame:
    """doc_id, th, class_id (smallest doc_id of the class) of every row: texts within edit similarity least of each other, by way of others too.

    Equal texts are one; null and empty texts form one class. Texts share a list if a band of one of their
    walks agrees, forward or backward, by 64 bits of each sample and without padding, so that lists of
    texts that have only their length in common don't arise. In each round every list has another leading text, and those of
    the list that aren't in the leader's class yet are compared with it; so the work follows the number
    of entries, not of pairs. Each link is verified; links may be missed, as with any hashing of this kind
    (tests measure a recall of 0.9 and more at 0.8).
    """
    prints = cut(bands(docs, per_band, [(seed, backward) for seed in range(walks) for backward in (False, True)]).withColumn("kind", F.when(F.col("n_chars") == 0, F.lit(0)).otherwise(F.col("th"))))
    kinds = cut(prints.groupBy("kind").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "th")).alias("of"), F.first("n_chars").alias("n_chars"), F.first("bands").alias("bands")))
    lists = cut(_lists(kinds, least))

    def texts_of(pairs: DataFrame) -> DataFrame:
        """kind, text of the texts in pairs; the others stay where they are."""
        need = cut(pairs.select(F.explode(F.array("a", "b")).alias("kind")).distinct().join(kinds.select("kind", F.col("of.doc_id").alias("k_id"), F.col("of.th").alias("k_th")), "kind"))
        return docs.select("doc_id", text_hash().alias("th"), "text").join(small(need, need.count()), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th"))).groupBy("kind").agg(F.first("text").alias("text"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = pa.array([alike(x.as_py(), y.as_py(), least) for x, y in zip(b.column("x"), b.column("y"), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)], ["a", "b"])

    links, roots = None, kinds.select(F.col("kind").alias("node"), F.col("kind").alias("root")).limit(0)
    for r in range(rounds):
        placed = lists.join(small(roots.withColumnRenamed("node", "kind"), roots.count()), "kind", "left").withColumn("root", F.coalesce("root", "kind"))
        lead = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(F.struct(F.xxhash64("kind", F.lit(r)).alias("h"), "kind", "root")).alias("lead")).where("lo <> hi")
        pairs = cut(placed.join(lead, "key").where(F.col("root") != F.col("lead.root")).select(F.col("kind").alias("a"), F.col("lead.kind").alias("b")).distinct())
        texts = texts_of(pairs)
        both = pairs.join(texts.select(F.col("kind").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("kind").alias("b"), F.col("text").alias("y")), "b")
        # By number, as adaptive execution would put pairs of few bytes, but much work, into one task.
        found = cut(both.select("a", "b", "x", "y").repartition(partitions(docs.sparkSession), "a", "b").mapInArrow(verify, "a long, b long"))
        links = found if links is None else cut(links.union(found))
        roots = cut(components(links))
    placed = cut(kinds.select("kind", "least").join(roots.withColumnRenamed("node", "kind"), "kind", "left").withColumn("root", F.coalesce("root", "kind")))
    named = placed.select("kind", "root").join(placed.groupBy("root").agg(F.min("least").alias("class_id")), "root").select("kind", "class_id")
    return prints.select("doc_id", "th", "kind").join(named, "kind").select("doc_id", "th", "class_id")


def _in_order(docs: DataFrame) -> DataFrame:
    """docs (doc_id, th, text) in about as many runs as there are shuffle partitions, each one partition, sorted by doc_id and th.

    tail marks rows that follow a run: the first of the next one (after the last run: of the first).
    Rows without doc_id come first. A doc_id that fills several runs, as null may, is split by th.
    """
    n = partitions(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    cuts = docs.select(key.alias("k")).agg(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0]
    bounds, times = np.unique(np.array(cuts or [], np.int64), return_counts=True)
    # A run begins at each bound; one that stands for several runs has so many, and one more for the ids after it.
    parts = np.where(times > 1, times, 0)
    first = np.concatenate([[0], 1 + np.cumsum(np.concatenate([[0], parts + 1]))])[:-1] if len(bounds) else np.array([0])
    hot = bool(parts.any())

    @F.pandas_udf("long")
    def run_of(k: pd.Series, th: pd.Series) -> pd.Series:
        k = k.to_numpy()
        at = np.searchsorted(bounds, k, side="right")
        if not hot:
            return pd.Series(first[at])
        begins, several = bounds[np.maximum(at - 1, 0)], np.where(at > 0, parts[np.maximum(at - 1, 0)], 0)
        inside = np.minimum(((th.to_numpy() / 2.0**64 + 0.5) * several).astype(np.int64), np.maximum(several - 1, 0))
        return pd.Series(first[at] + np.where(k == begins, inside, several))

    th = text_hash() if hot else F.lit(0).cast("long")  # else the ids alone are read
    ids = docs.select(key.alias("k"), th.alias("th"))
    heads = sorted((r["run"], r["head"]["k"], r["head"]["th"]) for r in ids.groupBy(run_of("k", "th").alias("run")).agg(F.min(F.struct("k", "th")).alias("head")).collect())  # one row a run
    before = {(k, t): heads[i - 1][0] for i, (_, k, t) in enumerate(heads)}

    @F.pandas_udf("long")
    def tail_of(k: pd.Series, th: pd.Series) -> pd.Series:
        return pd.Series([before.get((x, y if hot else 0), -1) for x, y in zip(k, th, strict=True)], dtype="int64")

    rows = docs.withColumn("k", key)
    rows = rows.select("doc_id", "th", "text", "k", run_of("k", "th").alias("run"), tail_of("k", "th").alias("after"))
    place = F.array(F.struct(F.col("run"), F.lit(0).alias("tail")), F.struct(F.col("after").alias("run"), F.lit(1).alias("tail")))
    rows = rows.select("doc_id", "th", "text", "k", F.explode(F.when(F.col("after") >= 0, place).otherwise(F.slice(place, 1, 1))).alias("at"))
    return rows.select("doc_id", "th", "text", "k", F.col("at.run").cast("int").alias("run"), F.col("at.tail").alias("tail")).repartitionById(int(first[-1] + (parts[-1] if len(parts) else 0) + 1), F.col("run")).sortWithinPartitions("run", "tail", "k", "th")


def op4_fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each text and of the text whose last half is replaced by the next document's beginning, with likenesses.

    One row for each row of documents. Null texts are empty ones, with an empty fingerprint, and two of
    them are alike (1.0); very long texts are read whole; rows that share a doc_id, or have none, follow
    each other by the hash of their texts, rows without one first; other columns are not read. An empty
    table gives an empty one; a single row is its own next document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, held = Walk(), None
        for b in batches:
            out = []
            for doc_id, text, tail in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("tail").to_pylist(), strict=True):
                if tail and held is None:
                    continue
                text = text.as_py() or ""
                codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                keep = len(codes) - len(codes) // 2
                at, first = walk.go(codes[:keep], codes[:0], 0)
                whole = walk.finish(np.concatenate([first, walk.go(codes[keep:], codes[:keep], at)[1]]))
                if held is not None:
                    i, old, old_codes, old_keep, old_at, old_first, mine = held
                    new = codes[: len(old_codes) - old_keep]
                    edited = walk.finish(np.concatenate([old_first, walk.go(new, old_codes[:old_keep], old_at)[1]]))
                    sha = hashlib.sha256((old[:old_keep] + text[: len(new)]).encode()).hexdigest()
                    out.append((i, len(old_codes), sha, mine, edited, likeness(mine, edited), likeness(mine, whole)))
                held = None if tail else (doc_id, text, codes, keep, at, first, whole)
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [b.column("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()], strict=True)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    rows = _in_order(docs.select("doc_id", text_hash().alias("th"), "text"))
    return rows.select("doc_id", "text", "tail").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
