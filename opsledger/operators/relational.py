"""Report operators that are more than one built-in: hierarchies, intervals, gaps, crosstabs, subtotals, change capture."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.operators.ranges import gaps, missing_numbers  # noqa: F401
from opsledger.shared import checkpoint


def hierarchy(df: DataFrame, child: str, parent: str, start: Column, depth: int | None = None) -> DataFrame:
    """Rows reachable from ``start`` with level, root and path; a row that is on its own path already isn't taken again.

    Each round joins only the last level, which is checkpointed; it ends with the first empty
    one. Levels beyond ``depth`` are left out if it is given.
    """
    edges = df.select(F.col(child).alias("node"), F.col(parent).alias("up"))
    level = checkpoint(edges.where(start).select("node", F.lit(1).alias("level"), F.col("node").alias("root"), F.array("node").alias("path")))
    out, k = [level], 1
    while not level.isEmpty() and (depth is None or k < depth):
        k += 1
        level = checkpoint(level.alias("l").join(edges.alias("e"), F.col("e.up") == F.col("l.node")).where(~F.array_contains("l.path", F.col("e.node"))).select(F.col("e.node").alias("node"), F.lit(k).alias("level"), "l.root", F.concat("l.path", F.array("e.node")).alias("path")))
        out.append(level)
    return reduce(DataFrame.unionByName, out)


STEP = 3  # a level's bins are 2 ** STEP times as wide as those of the level below


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], a_range: tuple[str, str], b_range: tuple[str, str]) -> DataFrame:
    """Pairs of rows whose closed ranges of whole numbers overlap, with the common part (lo, hi).

    A range is dealt, by its width, to the level whose bins are the next power of eight, and so to
    two bins at most; the join is by equality of level and bin. The wider range of a pair looks up
    the narrower's levels: each side is sent once to every wider level that the other side has, in
    the one or two bins it touches there. A pair that meets twice counts where its common part starts.
    """
    (alo, ahi), (blo, bhi) = a_range, b_range
    level = lambda lo, hi: F.ceil(F.log2((F.col(hi) - F.col(lo) + 1).cast("double")) / STEP).cast("int")
    left = a.where(F.col(alo) <= F.col(ahi)).withColumn("_own", level(alo, ahi))
    right = b.where(F.col(blo) <= F.col(bhi)).withColumn("_own", level(blo, bhi))
    mine, other = ({r[0] for r in x.select("_own").distinct().collect()} for x in (left, right))  # 22 at most

    def dealt(df: DataFrame, lo: str, hi: str, wider: set[int]) -> DataFrame:
        levels = F.array_union(F.array("_own"), F.filter(F.lit(sorted(wider)) if wider else F.array().cast("array<int>"), lambda k: k > F.col("_own")))
        df = df.withColumn("_level", F.explode(levels))
        cell = lambda c: F.expr(f"shiftright({c}, _level * {STEP})")
        return df.withColumn("_bin", F.explode(F.array_distinct(F.array(cell(lo), cell(hi)))))

    left, right = dealt(left, alo, ahi, other).withColumnRenamed("_own", "_a"), dealt(right, blo, bhi, mine).withColumnRenamed("_own", "_b")
    lo, hi = F.greatest(alo, blo), F.least(ahi, bhi)
    met = left.join(right, [*keys, "_level", "_bin"]).where(F.col("_level") == F.greatest("_a", "_b"))
    met = met.withColumn("lo", lo).withColumn("hi", hi).where((F.col("lo") <= F.col("hi")) & (F.expr(f"shiftright(lo, _level * {STEP})") == F.col("_bin")))
    return met.drop("_level", "_bin", "_a", "_b")


def crosstab(df: DataFrame, keys: list[str], over: Column, values: list, agg: Column, name: str) -> DataFrame:
    return df.withColumn("_over", over).groupBy(*keys).pivot("_over", values).agg(agg).select(*keys, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(f"{name}_{v}") for v in values])


def with_subtotals(df: DataFrame, keys: list[str], aggs: list[Column], total: str = "TOTAL") -> DataFrame:
    """Groups, subtotals and the grand total, keys of totals labelled."""
    g = df.rollup(*keys).agg(*aggs, *[F.grouping(k).alias(f"_g_{k}") for k in keys])
    return g.select(*[F.when(F.col(f"_g_{k}") == 1, total).otherwise(F.col(k).cast("string")).alias(k) for k in keys], *[c for c in g.columns if c not in keys and not c.startswith("_g_")])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], keep_old: list[str] = ()) -> DataFrame:
    """Rows of ``source`` replace those of ``target`` with their keys; a null in ``keep_old`` leaves the old value. ``source`` has a row per key."""
    new = source.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_new"), F.lit(True).alias("_hit"))
    out = target.withColumn("_was", F.lit(True)).join(new, keys, "full")
    rest = [c for c in target.columns if c not in keys]
    pick = lambda c: F.when(F.col("_hit"), F.coalesce(F.col(f"_new.{c}"), F.col(c)) if c in keep_old else F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
    return out.select(*keys, *map(pick, rest)).select(*target.columns)


def update_from(target: DataFrame, source: DataFrame, keys: list[str], sets: dict[str, str]) -> DataFrame:
    """Columns of matched rows take the source's values; ``source`` must have a row per key."""
    if not source.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError("the source has several rows for a key")
    s = source.select(*keys, *[F.col(v).alias(f"_s_{k}") for k, v in sets.items()], F.lit(True).alias("_hit"))
    return target.join(s, keys, "left").select(*[F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in sets else F.col(c) for c in target.columns])


def changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """INSERT, UPDATE and DELETE with row images as text, in which a null is NULL and quotes stand around values; columns are compared one by one, null equal to null."""
    rest = [c for c in old.columns if c not in keys]
    quoted = lambda c: F.coalesce(F.concat(F.lit("'"), F.replace(F.col(c).cast("string"), F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))
    image = F.concat_ws("|", *map(quoted, rest)) if rest else F.lit("")
    o, n = old.select(*keys, F.struct(*rest).alias("_old"), image.alias("old_image")), new.select(*keys, F.struct(*rest).alias("_new"), image.alias("new_image"))
    same = reduce(lambda x, c: x & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), rest, F.lit(True))
    action = F.when(F.col("old_image").isNull(), "INSERT").when(F.col("new_image").isNull(), "DELETE").when(~same, "UPDATE")
    return o.join(n, keys, "full").withColumn("action", action).where("action is not null").drop("_old", "_new")


def ranked(df: DataFrame, key: str) -> DataFrame:
    """(key, rank from 1): ``df``'s distinct keys in the order of their MD5, ranked by ranges of it, not in one place."""
    h = df.select(F.col(key).alias("_k"), F.md5(F.col(key).cast("string")).alias("_h")).withColumn("_part", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # 4096 rows at most
    base = h.groupBy("_part").count().withColumn("_base", F.coalesce(F.sum("count").over(w), F.lit(0))).select("_part", "_base")
    n = F.row_number().over(Window.partitionBy("_part").orderBy("_h", "_k"))
    return h.withColumn("_n", n).join(F.broadcast(base), "_part").select(F.col("_k").alias(key), (F.col("_base") + F.col("_n")).alias("rank"))


def permutation(df: DataFrame, key: str, low: int, seed: str) -> DataFrame:
    """Deals the numbers from ``low`` on to rows, in the order of a keyed hash; ranks are made by ranges, not in one place.

    ``df`` has distinct keys.
    """
    h = df.select(key, F.xxhash64(F.lit(seed), key).alias("_h")).withColumn("_part", F.shiftrightunsigned(F.col("_h").bitwiseXOR(F.lit(-(1 << 63))), 54).cast("int"))
    counts = h.groupBy("_part").count()
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # 1024 rows at most
    base = counts.withColumn("_base", F.coalesce(F.sum("count").over(w), F.lit(0))).select("_part", "_base")
    n = F.row_number().over(Window.partitionBy("_part").orderBy("_h", key))
    return h.withColumn("_n", n).join(F.broadcast(base), "_part").select(key, (F.col("_base") + F.col("_n") - 1 + low).alias("number"))
