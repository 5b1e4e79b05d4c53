"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A broadcast side may hold at most this many rows of a few longs each (about 50 MB as a hash table).
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the cluster's shared checkpoint folder and cuts its lineage.

    The folder is the session's spark.checkpoint.dir; only where that is unset on one machine (tests)
    a temporary one is made. On a cluster without it this is an error: no other node could read that.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not one_machine(context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
            folder = tempfile.mkdtemp(prefix="codexmill-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            context.setCheckpointDir(folder)
    done = df.checkpoint(eager=True)
    del df
    release(spark)
    return done


def one_machine(master: str) -> bool:
    """Whether driver and executors are one process: local and local[...], but not local-cluster[...]."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def release(spark: SparkSession) -> None:
    """Has the driver's JVM drop plans that nothing refers to any more; Spark then deletes their shuffle files, which else pile up until it happens to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its counted rows are within the bound; else as it is, for a shuffled join."""
    return F.broadcast(df) if rows <= bound else df


def text_hash(text: str | Column = "text") -> Column:
    """64 bits of the text; with doc_id it tells rows apart even where doc_id repeats."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("\x00null")))


def fold_of(doc_id: str | Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds; a null id counts as the empty string (remainder 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds


def bounded_sample(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """At most bound rows, those of the smallest hash of key: the same rows at any partitioning."""
    return df.withColumn("__h", F.xxhash64(key)).orderBy("__h", key).limit(bound).drop("__h")
