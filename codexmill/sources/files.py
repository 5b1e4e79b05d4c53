"""CSV in and out, file discovery, JSON and report sinks."""

from __future__ import annotations

import atexit
import csv
import html
import io
import json
import re
import shutil
import tempfile
import urllib.request
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, required: Sequence[str] = ()) -> DataFrame:
    """A CSV of UTF-8 or, if any of its bytes aren't, of Latin-1. Columns are strings without a schema; empty values are null.

    Bytes are looked at line by line where the files are, up to the first that isn't UTF-8.
    """
    bad = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count()
    reader = spark.read.options(**CSV, encoding="ISO-8859-1" if bad else "UTF-8")
    found = (reader.schema(schema) if schema else reader).csv(path)
    absent = [c for c in required if c not in found.columns]
    if absent:
        raise ValueError(f"the file has no column {', '.join(absent)}")
    return found


def newest_file(spark: SparkSession, glob: str) -> str | None:
    """The file that changed last; of those that changed at once the last by name."""
    files = spark.read.format("binaryFile").load(glob).select("path", "modificationTime")
    return files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def discover(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, size and time of the files of a folder that match a glob."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length", "modificationTime")


def compare_files(rows: DataFrame) -> DataFrame:
    """file, n_rows, size, same_rows, same_size of a frame read from files; the last two: whether all files agree."""
    each = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n_rows"), F.max("_metadata.file_size").alias("size"))
    every = Window.partitionBy()  # over a row a file
    return each.select("file", "n_rows", "size", *[(F.min(c).over(every) == F.max(c).over(every)).alias(k) for k, c in (("same_rows", "n_rows"), ("same_size", "size"))])


def loaded(df: DataFrame, expected: int) -> DataFrame:
    """rows, expected, ok: the row count after a load against what was to come."""
    return df.agg(F.count("*").alias("rows")).select("rows", F.lit(expected).cast("long").alias("expected"), (F.col("rows") == expected).alias("ok"))


def read_http(spark: SparkSession, url: str, required: Sequence[str] = (), most: int = 64 << 20, timeout: float = 60) -> DataFrame:
    """A CSV behind a URL, all columns strings; one of more bytes than most is an error. For small tables: they pass through the driver."""
    with urllib.request.urlopen(url, timeout=timeout) as response:
        data = response.read(most + 1)
    if len(data) > most:
        raise ValueError(f"{url} has more than {most} bytes")
    try:
        text = data.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = data.decode("latin-1")
    rows = list(csv.reader(io.StringIO(text, newline="")))
    header, rows = (rows[0], rows[1:]) if rows else ([], [])
    absent = [c for c in required if c not in header]
    if absent:
        raise ValueError(f"the file has no column {', '.join(absent)}")
    return spark.createDataFrame([tuple(x or None for x in (r + [""] * len(header))[: len(header)]) for r in rows], StructType([StructField(c, StringType()) for c in header]))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path for files that every node can read: under spark.checkpoint.dir; on one machine without it, a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        shared = tempfile.mkdtemp(prefix="codexmill-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def for_export(df: DataFrame) -> DataFrame:
    """All columns as strings, '' for null."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Writes a header and ''-filled rows; files: how many, else as many as there are partitions."""
    out = for_export(df)
    (out.coalesce(files) if files else out).write.mode("overwrite").options(**CSV, emptyValue="").csv(path)


def small_rows(df: DataFrame, most: int) -> list[tuple]:
    """A small result's rows, sorted; more than most is an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; write the frame itself")
    return sorted((tuple(r) for r in rows), key=repr)


def to_json(stats: Mapping[str, DataFrame], pretty: bool = True, most: int = 10_000) -> DataFrame:
    """One row, json: each name's rows as an array of objects. For small results."""
    spark = next(iter(stats.values())).sparkSession
    whole = {name: [dict(zip(df.columns, r, strict=True)) for r in small_rows(df, most)] for name, df in stats.items()}
    text = json.dumps(whole, ensure_ascii=False, default=str, **({"indent": 2, "separators": (",", " : ")} if pretty else {"separators": (",", ":")}))
    return spark.createDataFrame([(text,)], "json string")


def write_json(stats: Mapping[str, DataFrame], path: str) -> None:
    to_json(stats).coalesce(1).write.mode("overwrite").text(path)


def text_report(title: str, stats: Mapping[str, DataFrame], most: int = 50) -> str:
    """A plain report of small results."""
    parts = [title, "=" * len(title)]
    for name, df in stats.items():
        parts += ["", name, "-" * len(name)]
        parts += ["  ".join(f"{c}: {r[c]}" for c in df.columns) for r in df.limit(most).collect()]
    return "\n".join(parts) + "\n"


def bars(rows: Sequence[tuple[str, float]], width: int = 640) -> str:
    """A horizontal bar chart as SVG: label and value of each row."""
    most = max([v for _, v in rows], default=0) or 1
    lines = []
    for i, (label, value) in enumerate(rows):
        y, long = 22 * i, round((width - 260) * max(value, 0) / most, 1)
        lines.append(f'<text x="195" y="{y + 15}" text-anchor="end">{html.escape(str(label)[:30])}</text><rect x="200" y="{y + 3}" width="{long}" height="16"/><text x="{205 + long}" y="{y + 15}">{value:g}</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{22 * len(rows)}" font-size="12">{"".join(lines)}</svg>'


def html_report(title: str, stats: Mapping[str, DataFrame], most: int = 50, charts: bool = True) -> str:
    """A page with a table for each small result, and a chart where it has a label and a number."""
    parts = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in stats.items():
        got = df.limit(most).collect()
        rows = "".join("<tr>" + "".join(f"<td>{html.escape('' if r[c] is None else str(r[c]))}</td>" for c in df.columns) + "</tr>" for r in got)
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{''.join(f'<th>{html.escape(c)}</th>' for c in df.columns)}</tr>{rows}</table>")
        texts, numbers = [c for c, t in df.dtypes if t == "string"], [c for c, t in df.dtypes if t in ("int", "bigint", "double")]
        if charts and texts and numbers:
            parts.append(bars([(r[texts[0]], r[numbers[0]] or 0) for r in got]))
    return "\n".join(parts)
