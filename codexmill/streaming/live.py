"""The row-wise steps over a stream of entry files, and running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codexmill.functions.extract import YEAR, decade
from codexmill.functions.text import first
from codexmill.plans.pipeline import analyse
from codexmill.sources.schemas import ENTRY


def read_entries(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the entries in the Parquet files that arrive in a folder."""
    return spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def analysed_stream(entries: DataFrame) -> DataFrame:
    """The same columns as a batch has: every step is stateless."""
    return analyse(entries)


def running_decades(entries: DataFrame) -> DataFrame:
    """Entries per decade so far; for complete or update mode."""
    year = first(F.col("content"), YEAR).cast("long")
    return entries.select(decade(year).alias("decade")).where("decade is not null").groupBy("decade").agg(F.count("*").alias("n"))


def write_batches(entries: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Each batch of a stream as files of its own, once, however often the run is broken off: progress is what is in out."""
    return entries.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def decades_so_far(entries: DataFrame, checkpoint: str, name: str) -> DataFrame:
    """running_decades() of all files that are there now, as a table in memory."""
    q = running_decades(entries).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    q.awaitTermination()
    return entries.sparkSession.table(name)
