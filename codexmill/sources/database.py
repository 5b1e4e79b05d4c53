"""Tables of a running database, where a JDBC driver is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, key: str | None = None, lower: int = 0, upper: int = 0, parts: int = 1, **options: str) -> DataFrame:
    """A table, in parts by ranges of a numeric key; filters and columns are pushed down to the database."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key:
        reader = reader.options(partitionColumn=key, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts))
    return reader.load()
