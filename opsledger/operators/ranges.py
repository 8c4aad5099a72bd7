"""Running sums and maxima over a whole order without one place that sees all rows.

Rows are dealt to ranges of the order and stored; what goes from range to range is one figure a
range, or a range and key, so no key and no table is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsledger.shared import stored

CHUNK = 10_000  # numbers of a gap that one row lists


def dealt(df: DataFrame, order: list[str], paths: list[str]) -> DataFrame:
    """``df`` stored in ranges of ``order``, with the range's number as ``_part``."""
    return stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), paths)


def running_sum(df: DataFrame, order: list[str], value: str, name: str, paths: list[str]) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows before, by ``order``, which tells all rows apart. ``paths`` takes down what the result reads."""
    rows = dealt(df, order, paths)
    totals, base, total = {r["_part"]: r["s"] for r in rows.groupBy("_part").agg(F.sum(value).alias("s")).collect()}, [], 0  # a row a range
    for k in range(max(totals, default=-1) + 1):
        base.append(total)
        total += totals.get(k) or 0
    own = F.coalesce(F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn(name, own + (F.element_at(F.lit(base), F.col("_part") + 1) if base else F.lit(0))).drop("_part")


def gaps(df: DataFrame, keys: list[str], lo: str, hi: str) -> DataFrame:
    """Free ranges (gap_lo, gap_hi) between the closed ranges of each key. What a range of rows starts with is the largest ``hi`` that its first key has in earlier ones."""
    rows = dealt(df.select(*keys, lo, hi).where(F.col(lo).isNotNull() & F.col(hi).isNotNull()), [*keys, lo, hi], [])
    order = Window.partitionBy(*keys).orderBy("_part")
    tops = rows.groupBy("_part", *keys).agg(F.max(hi).alias("_top"))
    before = tops.withColumn("_carry", F.max("_top").over(order.rowsBetween(Window.unboundedPreceding, -1))).where("_carry is not null").drop("_top")
    # a range continues one key at most, so there are no more of these rows than ranges
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    met = rows.alias("r").join(F.broadcast(before.alias("b")), [F.col("r._part") == F.col("b._part"), *same], "left").select("r.*", "b._carry")
    end = F.max(hi).over(Window.partitionBy("_part", *keys).orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1))
    return met.withColumn("_end", F.greatest(end, F.col("_carry"))).where(F.col(lo) > F.col("_end") + 1).select(*keys, (F.col("_end") + 1).alias("gap_lo"), (F.col(lo) - 1).alias("gap_hi"))


def missing_numbers(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Numbers absent between the smallest and the largest of each key, a gap's listed in pieces."""
    once = df.select(*keys, number).distinct()
    free = gaps(once.withColumn("_hi", F.col(number)), keys, number, "_hi")
    pieces = free.select(*keys, F.explode(F.sequence("gap_lo", "gap_hi", F.lit(CHUNK).cast("long"))).alias("_from"), "gap_hi")
    return pieces.select(*keys, F.explode(F.sequence("_from", F.least(F.col("_from") + CHUNK - 1, F.col("gap_hi")))).alias("missing"))
