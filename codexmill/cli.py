"""Command line: extract entries from dump files, analyse them, write CSV and a report."""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from codexmill.operators import profile, relations
from codexmill.plans import pipeline, report
from codexmill.sources import dump, files
from codexmill.sources.schemas import ENTRY

log = logging.getLogger("codexmill")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="codexmill", description=__doc__)
    p.add_argument("--csv", help="entries to analyse, a CSV")
    p.add_argument("--extract", metavar="GLOB", help="dump files to extract entries from")
    p.add_argument("--links", metavar="FOLDER", help="Parquet tables page, revision, slots and content: extract by page, and list the pages without text")
    p.add_argument("--no-plots", action="store_true", help="a report without charts")
    p.add_argument("--sample-size", type=int, default=0, help="so many entries by a seeded draw, 0 for all")
    p.add_argument("--limit", type=int, help="so many entries at most")
    p.add_argument("--blob-id", type=int, help="only this dump file, by the number that ends its name")
    p.add_argument("--output", default="analysis_output", help="folder for results")
    p.add_argument("--analyze-only", action="store_true", help="write no entries, only the report")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> Path:
    """Runs the command and returns the report's path."""
    given = parser().parse_args(args)
    logging.basicConfig(level=logging.INFO)
    missing, counts = None, {}
    spark = spark or SparkSession.builder.appName("codexmill").getOrCreate()
    if given.extract:
        blobs = dump.read_blobs(spark, given.extract)
        if given.blob_id is not None:
            blobs = blobs.where(F.col("blob_id") == given.blob_id)
        rows = dump.insert_tuples(blobs.select("blob_id", dump.blob_text(F.col("content")).alias("text")))
        if given.links:
            pages = dump.page_texts(*[spark.read.parquet(f"{given.links}/{t}.parquet") for t in ("page", "revision", "slots", "content")])
            missing, rows = dump.not_found(pages, rows), dump.extract_entries(pages, rows)
            counts = {"blobs": dump.extraction_counts(pages, rows)}
        else:  # texts that no page is known of
            rows = rows.select(F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("page_title"), F.col("text_id").cast("string").alias("text_id"), "content", "flags", "blob_id")
    elif given.csv:
        rows = files.read_csv(spark, given.csv, ENTRY, required=["page_id", "content"])
    else:
        raise SystemExit("one of --csv and --extract is needed")
    if given.sample_size:
        rows = relations.sample(rows, given.sample_size, 0, "text_id")
    if given.limit is not None:
        rows = rows.limit(given.limit)
    analysed = pipeline.analyse(rows)
    out = Path(given.output)
    out.mkdir(parents=True, exist_ok=True)
    if not given.analyze_only:
        files.write_csv(analysed, str(out / "entries"))
        if missing is not None:
            files.write_csv(missing, str(out / "not_found"))
    stats = {"types": profile.shares(analysed, "content_type"), "features": profile.pattern_summary(analysed, "content"), "missing": profile.missing_profile(analysed), **counts, **report.bibliography(analysed)}
    (out / "report.txt").write_text(files.text_report("Entries", stats), encoding="utf-8")
    (out / "report.html").write_text(files.html_report("Entries", stats, charts=not given.no_plots), encoding="utf-8")
    files.write_json(stats, str(out / "report_json"))
    log.info("report in %s", out)
    return out / "report.txt"


if __name__ == "__main__":
    main()
