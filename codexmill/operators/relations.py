"""Joins and row operators that several pipelines use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the columns that there are, in the order asked for."""
    return df.select([c for c in columns if c in df.columns])


def retype(df: DataFrame, **types: str) -> DataFrame:
    """df with some columns of other types; a value that can't be of its new type becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def settle(df: DataFrame) -> DataFrame:
    """df behind a generator of one row each, over which the optimizer neither merges nor pushes expressions.

    For plans of many derived columns: without it a filter on one would carry its whole expression down.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("__r")).select("__r.*")


def keep_if_any(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df, without the columns if none of them has a value that isn't empty."""
    any_value = df.agg(*[F.count_if(F.coalesce(F.col(c) != "", F.lit(False))).alias(c) for c in columns]).first()
    return df if any(any_value) else df.drop(*columns)


def left_merge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in which null meets null; matches multiply rows."""
    other = right.withColumnRenamed(key, "__key")
    return left.join(other, left[key].eqNullSafe(other["__key"]), "left").drop("__key")


def sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows in an order that seed and key alone decide."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary")), key).limit(n)


def unknown_last(df: DataFrame, label: str, n: str) -> DataFrame:
    return df.orderBy(F.col(label) == "Unknown", F.desc(n), label)


def resolve_redirects(df: DataFrame, title: str, target: str, hops: int = 3) -> DataFrame:
    """df with final_title and hops: redirects followed by title, so many times at most; dangling: the target isn't there; unfinished: it is a redirect still."""
    known = df.select(F.col(title).alias("__t"), F.col(target).alias("__n"), F.lit(True).alias("__found")).dropDuplicates(["__t"])
    out = df.withColumns({"final_title": F.coalesce(F.col(target), F.col(title)), "hops": F.when(F.col(target).isNotNull(), 1).otherwise(0)})
    for _ in range(hops - 1):
        out = out.join(known, out["final_title"] == known["__t"], "left")
        on = F.col("__n").isNotNull()
        out = out.withColumns({"hops": F.when(on, F.col("hops") + 1).otherwise(F.col("hops")), "final_title": F.when(on, F.col("__n")).otherwise(F.col("final_title"))}).drop("__t", "__n", "__found")
    out = out.join(known, out["final_title"] == known["__t"], "left")
    return out.withColumns({"dangling": F.col("__found").isNull(), "unfinished": (F.col("hops") > 0) & F.col("__n").isNotNull()}).drop("__t", "__n", "__found")


def thin(df: DataFrame, order: str, most: int) -> DataFrame:
    """Every k-th row of a small ordered result, so that most or fewer remain; the first is one of them."""
    w = Window.orderBy(order)
    rows = df.withColumns({"__i": F.row_number().over(w) - 1, "__n": F.count("*").over(Window.partitionBy())})
    return rows.where(F.col("__i") % F.ceil(F.col("__n") / most) == 0).drop("__i", "__n")
