"""Reports with computed lines: sums, means and extremes below each group and at the end, all lines in their order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.operators.ranges import running_sum
from opsledger.shared import dropped, stored

FUNCTIONS = {"SUM": F.sum, "AVG": F.avg, "MAX": F.max, "MIN": F.min, "COUNT": F.count}
REPORT = "report"


def computed_lines(df: DataFrame, breaks: list[str], order: list[str], computes: list[tuple[str, str, str]]) -> DataFrame:
    """The rows of ``df`` by ``breaks`` and ``order``, which together tell them apart, and a line for each function and break of ``computes`` below its group; ``line`` counts from 1.

    ``computes``: (function, measure, break or REPORT). A computed line has its function as
    ``label``, the values of its break and of those before it, and the measures that it is
    computed of; details have no label. Lines of inner breaks come before those of outer ones,
    the report's last; in a group, functions go in the order of ``computes``. Nulls are groups of their
    own and come first. Line numbers are made by ranges of the order, not in one place.
    """
    spark, paths = df.sparkSession, []
    measures = list(dict.fromkeys(m for _, m, _ in computes))
    functions = list(dict.fromkeys(f for f, _, _ in computes))
    closed = lambda k: [F.lit(int(n >= k)).alias(f"_e{n}") for n in range(len(breaks))]
    parts = [df.select(*breaks, *order, *[F.col(m).cast("double").alias(m) for m in measures], F.lit(None).cast("string").alias("label"), *closed(len(breaks)), F.lit(0).alias("_kind"))]
    for on in dict.fromkeys(b for _, _, b in computes):
        depth = 0 if on == REPORT else breaks.index(on) + 1
        for f in functions:
            own = [m for g, m, b in computes if (g, b) == (f, on)]
            if not own:
                continue
            g = df.groupBy(*breaks[:depth]).agg(*[FUNCTIONS[f](m).cast("double").alias(m) for m in own])
            empty = lambda c: F.lit(None).cast(df.schema[c].dataType).alias(c)
            parts.append(g.select(*breaks[:depth], *[empty(c) for c in [*breaks[depth:], *order]], *[F.col(m) if m in own else F.lit(None).cast("double").alias(m) for m in measures], F.lit(f).alias("label"), *closed(depth), F.lit(1 + functions.index(f)).alias("_kind")))
    rows = reduce(DataFrame.unionByName, parts).withColumn("_one", F.lit(1))
    place = [x for n, b in enumerate(breaks) for x in (f"_e{n}", b)] + ["_kind", *order]
    out = stored(running_sum(rows, place, "_one", "_before", paths).withColumn("line", F.col("_before") + 1).select("line", *breaks, *order, *measures, "label"))
    dropped(spark, paths)
    return out
