"""Random values that a row's key and a column's name determine: the same under any partitioning, and again after a lost task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PER_DIGEST = 8  # letters that one digest gives, of four hexadecimal digits each


def _digest(seed: str, column: str, key: Column, block: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.lit(column), F.coalesce(key.cast("string"), F.lit("")), block.cast("string")))


def text(key: Column, column: str, n: int, seed: str = "") -> Column:
    """``n`` lower-case letters. Digests of seed, column, key and a counter are their source; a letter is more likely than another by less than one in 2,500."""
    blocks = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(max(0, n - 1) // PER_DIGEST)), lambda b: _digest(seed, column, key, b)), "")
    letter = lambda hexes: lambda k: F.char((F.conv(F.substr(hexes, k * 4 - 3, F.lit(4)), 16, 10).cast("int") % 26 + 97).cast("int"))
    out = F.transform(F.array(blocks), lambda h: F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), letter(h)), ""))  # the digests are made once
    return F.element_at(out, 1) if n > 0 else F.lit("")


def number(key: Column, column: str, low: float, high: float, seed: str = "") -> Column:
    """A number from ``low`` on, below ``high``, of 52 random bits."""
    bits = F.conv(F.substring(_digest(seed, column, key, F.lit("n")), 1, 13), 16, 10).cast("long")
    return F.lit(float(low)) + bits * F.lit((float(high) - float(low)) / 2.0**52)


def encoded(n: Column, width: int) -> Column:
    """A whole number in letters b to z, last digit first, to base 25, with 'a' in front up to ``width``, and cut off after it; null as all 'a'.

    A digit takes its place by a division that rounds to the nearest, so not every number has a code of its own.
    """
    letters = F.lit("bcdefghijklmnopqrstuvwxyz")
    start = F.struct(F.lit("").alias("out"), n.cast("long").alias("n"), F.lit(False).alias("done"))

    def step(acc: Column, _: Column) -> Column:
        v = acc["n"]
        rest = F.when(v >= 25, F.call_function("div", 2 * v + 25, F.lit(50).cast("long"))).otherwise(0)
        return F.when(acc["done"], acc).otherwise(F.struct(F.concat(acc["out"], F.substr(letters, (v % 25 + 1).cast("int"), F.lit(1))).alias("out"), rest.alias("n"), (rest == 0).alias("done")))

    code = F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, step)["out"]
    return F.lpad(F.when(n.isNull(), "").otherwise(code), width, "a")
