"""SQL dumps as a source: files, INSERT tuples, the chain from page to text, upserts."""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexmill.functions.encoding import decode_hex_title, decode_latin1
from codexmill.functions.text import count_literal, first, let
from codexmill.operators.relations import sample

#: A record that wouldn't fit a window of so many characters from ten before its start is left out in compat mode.
COMPAT_WINDOW = 2000
#: Bytes of a text that go to the tokenizer at once; an Arrow batch holds 10,000 pieces at most.
PIECE = 1024
# A tuple `(id, _binary 'content', _binary 'flags')` as it stands in a dump.
TUPLE = r"\((\d+),\s*_binary '((?:[^'\\]|\\.|'')*)',\s*_binary '((?:[^'\\]|\\.|'')*)'\)"

STOP = re.compile(r"['\\]")


def read_blobs(spark: SparkSession, glob: str) -> DataFrame:
    """Files as rows (blob_id by the number that ends the name, path, content bytes); missing files are no error within a glob."""
    files = spark.read.format("binaryFile").load(glob)
    return files.select(first(F.col("path"), r"(\d+)\D*$").try_cast("int").alias("blob_id"), "path", "content")


def insert_tuples(blobs: DataFrame, text: str = "text", compat: bool = False) -> DataFrame:
    """blob_id, text_id, content, flags: one row per tuple of all INSERT statements, several tuples a statement or one.

    A tokenizer goes through each text once, so that `(94,` inside another record's content is
    content, records of any length count. Texts leave the JVM in pieces of PIECE bytes, so memory beside
    it is a batch of pieces and one record, whatever a text's length. Doubled quotes become one;
    backslash escapes stay as they are. Null texts have no tuples.
    """

    def scan(pieces: Iterator[str]) -> Iterator[tuple[int, str, str]]:
        quote, rest, state, ended = "_binary '", "", 0, False  # 0: before an INSERT, 1: before its VALUES, 2: among its tuples
        while not ended:
            more, n = [rest], 0
            while n <= max(len(rest), 1 << 16):  # twice as much each time that a record isn't whole yet
                piece = next(pieces, None)
                if piece is None:
                    ended = True
                    break
                more.append(piece)
                n += len(piece)
            text, at = "".join(more), 0
            while True:
                if state < 2:
                    sought = ("INSERT INTO", "VALUES")[state]
                    start = text.find(sought, at)
                    if start < 0:
                        at = max(at, len(text) - len(sought) + 1)  # it may have begun
                        break
                    at, state = (start, 1) if state == 0 else (start + len(sought), 2)
                    continue
                opened = at
                while opened < len(text) and text[opened] in " \t\r\n,":
                    opened += 1
                at = opened
                if opened >= len(text):
                    break
                if text[opened] != "(":
                    state = 0
                    continue
                comma = text.find(",", opened)
                if comma < 0 and not ended:
                    break
                number = text[opened + 1 : comma].strip() if comma > 0 else ""
                values, i, short = [], comma, False
                if number.isdigit():
                    for _ in range(2):
                        i = text.find(quote, i)
                        if i < 0:
                            break
                        i += len(quote)
                        begin = i
                        while i < len(text):
                            found = STOP.search(text, i)  # not two find()s: one that finds nothing would read to the end each time
                            stop = found.start() if found else len(text)
                            if stop >= len(text):
                                i = stop
                            elif text[stop] == "\\" or text[stop : stop + 2] == "''":
                                i = stop + 2
                                continue
                            else:
                                i = stop
                                short = stop + 1 == len(text)  # another quote may follow
                            break
                        values.append(text[begin:i])
                        i += 1
                whole = len(values) == 2 and i <= len(text)
                close = text.find(")", i) if whole else -1
                if not ended and (short or close < 0) and number.isdigit():
                    break
                if not whole:
                    at, state = opened + 1, 0
                    continue
                if close < 0:
                    return
                at = close + 1
                if not compat or at - opened + 10 <= COMPAT_WINDOW:
                    yield int(number), values[0].replace("''", "'"), values[1].replace("''", "'")
            rest = text[at:]

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, bytes]]:
        n = 0
        for b in batches:
            for blob, at, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                n += at == 0
                yield n, blob, piece.as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["blob_id", "text_id", "content", "flags"])

        for (_, blob), group in groupby(pieces_of(batches), key=lambda x: x[:2]):
            decoder = codecs.getincrementaldecoder("utf-8")("replace")
            rows, held = [], 0
            for row in scan(decoder.decode(piece) for _, _, piece in group):
                rows.append((blob, *row))
                held += len(row[1])
                if len(rows) >= 1000 or held >= 1 << 20:
                    yield batch()
                    rows, held = [], 0
            if rows:
                yield batch()

    types = [pa.int32(), pa.int64(), pa.string(), pa.string()]
    size = PIECE
    # Of bytes, as the place of a byte is known and that of a character has to be counted out.
    pieces = let(F.col(text).cast("string").cast("binary"), lambda b: F.transform(F.sequence(F.lit(1), F.greatest(F.octet_length(b), F.lit(1)), F.lit(size)), lambda i: F.substring(b, i, F.lit(size))))
    return blobs.where(F.col(text).isNotNull()).select(F.col("blob_id").cast("int"), F.posexplode(pieces).alias("at", "piece")).mapInArrow(run, "blob_id int, text_id long, content string, flags string")


def insert_tuples_by_line(lines: DataFrame, line: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The same for dumps of one statement a line, by Spark's expressions alone."""
    one = [F.regexp_extract_all(line, F.lit(TUPLE), F.lit(g)) for g in (1, 2, 3)]
    rows = lines.where(F.col(line).startswith("INSERT INTO")).select(*keep, F.explode(F.arrays_zip(one[0].alias("a"), one[1].alias("b"), one[2].alias("c"))).alias("t"))
    return rows.select(*keep, F.col("t.a").cast("long").alias("text_id"), F.replace(F.col("t.b"), F.lit("''"), F.lit("'")).alias("content"), F.replace(F.col("t.c"), F.lit("''"), F.lit("'")).alias("flags"))


def blob_text(content: Column) -> Column:
    """A dump's bytes as text, read as MySQL's latin1."""
    return decode_latin1(content)


def sniff(blobs: DataFrame, text: str = "text") -> DataFrame:
    """Per blob: size, whether it begins as a dump, style of its INSERTs, approximate number of tuples."""
    t = F.col(text)
    head = F.substring(t, 1, 1000)
    several = t.rlike(r"VALUES\s+\([^)]+\),\s*\(")
    return blobs.select(
        "blob_id", F.length(t).cast("long").alias("size"), head.contains("INSERT INTO").alias("has_insert"), head.contains("CREATE TABLE").alias("has_create"),
        F.when(several, "multi").when(t.contains("VALUES"), "single").otherwise("none").alias("style"), (count_literal(t, "),(") + 1).alias("about"),
    )


def text_id_of(address: Column) -> Column:
    """`tt:31`, plain or in hexadecimal, to 31; null for anything else."""
    return F.coalesce(first(address, r"tt:(\d+)"), first(decode_hex_title(address), r"tt:(\d+)")).try_cast("long")


def page_texts(page: DataFrame, revision: DataFrame, slots: DataFrame, content: DataFrame, namespace: int = 0) -> DataFrame:
    """page_id, page_title (decoded), text_id of the latest revision of each page of a namespace."""
    linked = page.where(F.col("page_namespace") == namespace).join(revision, F.col("page_latest") == F.col("rev_id")).join(slots, F.col("rev_id") == F.col("slot_revision_id")).join(content, F.col("slot_content_id") == F.col("content_id"))
    return linked.select("page_id", decode_hex_title(F.col("page_title")).alias("page_title"), text_id_of(F.col("content_address")).alias("text_id"))


def extract_entries(pages: DataFrame, tuples: DataFrame) -> DataFrame:
    """Entries (page_id, page_title, text_id, content, flags, blob_id): of several blobs with a text the lowest counts."""
    order = Window.partitionBy("page_id").orderBy("blob_id", "content")
    found = pages.join(tuples, "text_id").withColumn("rn", F.row_number().over(order)).where("rn = 1")
    return found.select("page_id", "page_title", F.col("text_id").cast("string").alias("text_id"), "content", "flags", "blob_id")


def extraction_counts(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """blob_id and n: entries found in each blob; the row without blob_id counts the pages whose text no blob has."""
    return pages.select("page_id").join(entries.select("page_id", "blob_id"), "page_id", "left").groupBy("blob_id").agg(F.count("*").alias("n"))


def probe(pages: DataFrame, tuples: DataFrame, n: int, seed: int) -> DataFrame:
    """page_id, text_id, found of n pages by a seeded draw: whether any blob has their text."""
    known = tuples.select("text_id").distinct().withColumn("found", F.lit(True))
    return sample(pages.select("page_id", "text_id"), n, seed, "page_id").join(known, "text_id", "left").select("page_id", "text_id", F.coalesce("found", F.lit(False)).alias("found"))


def not_found(pages: DataFrame, tuples: DataFrame) -> DataFrame:
    """Pages whose text no blob has."""
    return pages.join(tuples, "text_id", "left_anti")


def upsert(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """table with new's rows in place of those of the same key. A null key matches none."""
    return table.join(new.select(key), key, "left_anti").unionByName(new)
