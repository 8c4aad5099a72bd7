"""Masking plans: which columns are masked how, as set algebra over metadata; one select per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions import masks
from opsledger.shared import dropped, stored
from opsledger.sources import versioned

KEY = ["owner", "table", "column"]


def select_columns(history: DataFrame, final: DataFrame, exceptions: DataFrame, applied: DataFrame | None = None, reprocess: bool = False) -> DataFrame:
    """(owner, table, column, identifier): current history, else the final list, with forced columns added and excluded ones taken out."""
    current = history.where("current = 'Y' and mask = 'Y'").select(*KEY, "identifier")
    chosen = current if not history.where("current = 'Y'").isEmpty() else final.where("mask = 'Y'").select(*KEY, "identifier")
    active = exceptions.where("active = 'Y'")
    forced = active.where("action = 'FORCE'").select(*KEY, F.col("forced_identifier").alias("identifier")).join(chosen, KEY, "left_anti")
    out = chosen.unionByName(forced).join(active.where("action = 'EXCLUDE'"), KEY, "left_anti")
    if applied is not None and not reprocess:
        out = out.join(applied, KEY, "left_anti")
    return out.dropDuplicates(KEY)


def long_enough(columns: DataFrame) -> DataFrame:
    """Those of (…, identifier, length) that their identifier's mask fits into."""
    least = F.coalesce(*[F.when(F.upper("identifier").contains(k), v) for k, v in masks.LEAST_LENGTH.items()], F.lit(1))
    return columns.where(F.col("length").isNull() | (F.col("length") >= least))


def masked(df: DataFrame, plan: dict[str, tuple[str, int | None]]) -> DataFrame:
    """One projection: column -> (identifier, length)."""
    return df.select(*[masks.fit(masks.mask(plan[c][0], F.col(c)), plan[c][1]).alias(c) if c in plan else F.col(c) for c in df.columns])


def rebuilt(spark: SparkSession, root: str, plan: dict[str, tuple[str, int | None]]) -> tuple[int, int]:
    """Masks the versioned table under ``root`` in place: one projection, in which every masked column is cast back to its declared type; (rows before, rows after).

    A mask that its type can't hold gives null. Readers see the old rows until all new ones are written.
    """

    def cast(df: DataFrame) -> DataFrame:
        new = {c: masks.fit(masks.mask(i, F.col(c).cast("string")), n).try_cast(df.schema[c].dataType) for c, (i, n) in plan.items()}
        return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])

    return versioned.rewrite(spark, root, cast)


TAIL = 6  # characters at the end of a value that tell it from equal ones
ROUNDS = 64


def without_collisions(df: DataFrame, column: str, key: str) -> DataFrame:
    """``df`` with values of ``column`` that no two rows share; lengths and nulls stay.

    Every row of a shared value gets another end, of digits from the hash of ``key`` and the
    round. A round keeps those that are new and not taken by any settled row, of equal ones
    that with the least key, and only the others go on; so what is joined shrinks from round to
    round. ``key`` tells rows apart. Values too short to be told apart are an error.
    """
    spark, paths = df.sparkSession, []
    values = stored(df.where(F.col(column).isNotNull()).select(F.col(key).alias("k"), F.col(column).alias("v")), paths)
    several = stored(values.groupBy("v").agg(F.count("*").alias("n")).where("n > 1"), paths)
    left = stored(values.join(several, "v", "left_semi"), paths)
    taken = [values.join(several, "v", "left_anti").select("v")]
    settled: list[DataFrame] = []
    for r in range(ROUNDS):
        if left.isEmpty():
            break
        size = F.least(F.length("v"), F.lit(TAIL))
        digits = F.lpad(F.pmod(F.xxhash64(F.lit(r), "k"), F.lit(10**TAIL)).cast("string"), TAIL, "0")
        tried = stored(left.withColumn("w", F.concat(F.substr("v", F.lit(1), F.length("v") - size), F.substr(digits, F.lit(TAIL + 1) - size))), paths)
        winners = tried.groupBy("w").agg(F.min("k").alias("k"))
        for t in taken:
            winners = winners.join(t.select(F.col("v").alias("w")), "w", "left_anti")
        winners = stored(winners, paths)
        settled.append(winners)
        taken = [taken[0], reduce(DataFrame.unionByName, settled).select(F.col("w").alias("v"))]
        left = stored(tried.join(winners, "k", "left_anti").select("k", "v"), paths)
    else:
        raise ValueError(f"values of {column} are too short to be told apart")
    new = stored(reduce(DataFrame.unionByName, settled)) if settled else values.limit(0).select(F.col("v").alias("w"), "k")
    if settled:
        dropped(spark, paths)
    out = df.join(new.select(F.col("k").alias(key), F.col("w").alias("_new")), key, "left")
    return out.withColumn(column, F.coalesce("_new", column)).select(*df.columns)


def fully_excluded(columns: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(owner, table) whose columns are all excluded."""
    out = exceptions.where("active = 'Y' and action = 'EXCLUDE'").select(*KEY).distinct().withColumn("_hit", F.lit(1))
    g = columns.join(out, KEY, "left").groupBy("owner", "table").agg(F.count("*").alias("_n"), F.count("_hit").alias("_hits"))
    return g.where("_n = _hits").select("owner", "table")


def selected(columns: DataFrame, exceptions: DataFrame, tables: str, of: dict[str, str]) -> DataFrame:
    """(table, column, state) of columns named in comma-separated lists, names in any case and with blanks: of each table all columns, or those of its own list.

    State is SKIP_TABLE for a table whose columns are all excluded, else MASK.
    """
    named = [x.strip().lower() for x in tables.split(",") if x.strip()]
    want = reduce(lambda a, b: a | b, [(F.lower("table") == n) & (F.lower("column").isin([c.strip().lower() for c in of[n].split(",")]) if n in of else F.lit(True)) for n in named], F.lit(False))
    out = fully_excluded(columns, exceptions).withColumn("_all", F.lit(True))
    return columns.where(want).join(out, ["owner", "table"], "left").select("table", "column", F.when(F.col("_all"), "SKIP_TABLE").otherwise("MASK").alias("state"))


def synced(target: DataFrame, source: DataFrame, keys: list[str], column: str, value: str, length: int) -> DataFrame:
    """``column`` takes the matched row's ``value``; the rule is skipped whole if any value is longer than ``length``.

    ``source`` has a row per key; other rows keep their value.
    """
    too_long = source.agg(F.max(F.length(value))).first()[0]
    if too_long is not None and too_long > length:
        return target
    s = source.select(*keys, F.col(value).alias("_value"), F.lit(True).alias("_hit"))
    return target.join(s, keys, "left").withColumn(column, F.when(F.col("_hit"), F.col("_value")).otherwise(F.col(column))).select(*target.columns)


def sync_mismatches(target: DataFrame, source: DataFrame, keys: list[str], column: str, value: str) -> int:
    return target.join(source.select(*keys, F.col(value).alias("_value")), keys).where(~F.col(column).eqNullSafe(F.col("_value"))).count()
