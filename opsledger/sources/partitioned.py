"""Tables in Hive partitions: written by columns, and scanned by lists of partitions and subpartitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write(df: DataFrame, by: list[str], path: str) -> None:
    """``df`` as Parquet under ``path``, a folder a value of each of ``by``; rows meet by those columns and a hash, so that a folder has few files and a full one isn't one task's."""
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(8))
    df.repartition(*by, spread).write.partitionBy(*by).parquet(path)


def scan(spark: SparkSession, path: str, partitions: list[dict[str, object]], where: str | None = None) -> DataFrame:
    """Rows of the ``partitions``, each a value for some of the partition columns, that meet the condition ``where`` too.

    Partitions that are named twice, or by a partition and its subpartition, are read once. The
    list is one condition on partition columns, so only the folders named are listed and read. No
    partitions give no rows.
    """
    df = spark.read.parquet(path)
    named = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in p.items()]) for p in partitions]
    out = df.where(reduce(lambda a, b: a | b, named)) if named else df.limit(0)
    return out.where(where) if where else out


def scan_matching(spark: SparkSession, path: str, by: str, wanted: DataFrame, column: str) -> DataFrame:
    """Rows of the partitions whose ``by`` is among the values of ``wanted``'s ``column``, which Spark finds out before it reads: dynamic pruning."""
    return spark.read.parquet(path).join(wanted.select(F.col(column).alias(by)).distinct(), by, "left_semi")
