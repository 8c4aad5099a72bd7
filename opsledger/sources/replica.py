"""Copies of tables that are checked against their source: by rows and contents, range of keys by range of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 1000  # whole numbers of a range of keys


class Differs(Exception):
    """A copy that isn't like its source."""


def contents(df: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """(lo, hi, rows, h1, h2) of each range of ``width`` keys: a hash of its rows as a multiset.

    A row's two 64-bit hashes, of all columns with their nulls told apart from other values, are added
    up in 128 bits or more, so neither the rows' order nor their partitioning counts, but how often
    each is there does. Sums are made before anything is shuffled. Rows without a key are one range.
    """
    told = [x for c in sorted(df.columns) for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    low = (F.floor(F.col(key) / width) * width).alias("lo")
    sums = [F.sum(F.xxhash64(F.lit(s), *told).cast("decimal(38,0)")).alias(h) for s, h in ((1, "h1"), (2, "h2"))]
    return df.groupBy(low).agg(F.count("*").alias("rows"), *sums).select("lo", (F.col("lo") + width - 1).alias("hi"), "rows", "h1", "h2")


def differences(a: DataFrame, b: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """(lo, hi, rows_a, rows_b): the ranges of keys in which the tables aren't the same multiset of rows. Columns go by name."""
    if sorted(a.columns) != sorted(b.columns):
        raise Differs(f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}")
    x = contents(a, key, width).select("lo", F.col("hi").alias("hi_a"), F.struct("rows", "h1", "h2").alias("x"))
    y = contents(b, key, width).select(F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), F.struct("rows", "h1", "h2").alias("y"))
    met = x.join(y, F.col("lo").eqNullSafe(F.col("lo_b")), "full").where(~F.col("x").eqNullSafe(F.col("y")))
    none = F.lit(0).cast("long")
    return met.select(F.coalesce("lo", "lo_b").alias("lo"), F.coalesce("hi_a", "hi_b").alias("hi"), F.coalesce("x.rows", none).alias("rows_a"), F.coalesce("y.rows", none).alias("rows_b"))


def replicate(df: DataFrame, path: str, key: str, width: int = WIDTH) -> int:
    """Copies ``df`` to ``path`` as Parquet and checks the copy; its rows. A copy that differs is an error, which names the first ranges."""
    df.write.parquet(path)
    copy = df.sparkSession.read.parquet(path)
    bad = differences(df, copy, key, width).orderBy("lo").limit(5).collect()
    if bad:
        raise Differs(f"{path} differs in keys " + ", ".join(f"{r['lo']} to {r['hi']} ({r['rows_a']} and {r['rows_b']} rows)" for r in bad))
    return copy.count()
