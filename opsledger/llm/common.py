"""Helpers that the operators share: tables, checkpoints, components."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from opsledger.shared import checkpoint, dropped, shared_dir, stored  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def apart(df: DataFrame, needed: list[str], results: list[str]) -> tuple[list[Column], DataFrame]:
    """``df`` with its columns under names that clash with nothing, and those needed under their own too; and how to get the columns back, but for those named like ``results``."""
    names = df.columns
    held = df.toDF(*[f"_in{k}" for k in range(len(names))])
    back = [F.col(f"_in{k}").alias(c) for k, c in enumerate(names) if c not in results]
    return back, held.select("*", *[F.col(f"_in{names.index(c)}").alias(c) for c in needed])


def each(values: pa.Array, step: int = 256) -> Iterator:
    """The values of an Arrow array, of which few are Python objects at a time."""
    for at in range(0, len(values), step):
        yield from values.slice(at, step).to_pylist()


class Recent(dict):
    """What was worked out lately, in two generations of ``most`` entries: a full one becomes the older, and the oldest are forgotten."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most, self.older = most, {}

    def absent(self, wanted: list) -> list:
        """Those of ``wanted`` that aren't known, once each; the others are in the younger generation from now on."""
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        out = {}
        for x in wanted:
            if x in self:
                continue
            if (known := self.older.get(x)) is None:
                out[x] = None
            else:
                self[x] = known
        return list(out)


def connected_components(edges: DataFrame, paths: list[str], max_rounds: int = 60) -> DataFrame:
    """(node, component) for undirected ``edges`` (a, b); component is the smallest node.

    Alternates large-star and small-star rounds: each hangs neighbours on the smallest one
    known, so every edge stays an edge. No neighbourhood is collected: a hub's edges are narrow
    rows that are joined with its minimum, which is stored before, so that the join's exchanges
    are plain and Spark can split the hub. A round's tables go once the next has them; ``paths``
    takes down what the result reads. Null ends and loops are dropped; an empty input gives an
    empty result.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and u > v").distinct()
    old: list[str] = []
    e, before = checkpoint(e, old), None
    for _ in range(max_rounds):
        own: list[str] = []
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpoint(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), own)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = checkpoint(large, own)
        least = checkpoint(large.groupBy("u").agg(F.min("v").alias("m")), own)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v")).where("u > v").distinct()
        new: list[str] = []
        e = checkpoint(small, new)
        dropped(spark, [*old, *own])
        old = new
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    paths += old
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column of distinct longs: the id if it is one, else the place in the table as stored."""
    bad = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").limit(1).count()
    if not bad:
        return docs, "doc_id"
    place = "_place"
    while place in docs.columns:
        place += "_"
    return stored(docs.withColumn(place, F.monotonically_increasing_id())), place


@F.pandas_udf(BinaryType())
def pressed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Texts in UTF-8, compressed for the way through a shuffle."""
    press = zstandard.ZstdCompressor(level=1)
    for s in parts:
        yield pd.Series([None if x is None else press.compress(x.encode("utf-8", "surrogatepass")) for x in s], dtype=object)
