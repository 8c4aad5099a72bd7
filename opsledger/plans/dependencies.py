"""What hangs on a masked column: rules from parent to child columns in their order, and policies for constraints and triggers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsledger.plans.masking import sync_mismatches, synced
from opsledger.shared import dropped, stored


def levels(rules: DataFrame) -> DataFrame:
    """``rules`` (parent, child, and any other columns) with ``level``: 1 where no rule makes the parent, else one more than the latest that does; null on and below a cycle.

    Each round settles the rules whose parents are all settled, and the longest chain ends it;
    rules that no round settles wait for themselves. A rule from a column to itself is a cycle.
    """
    spark, paths = rules.sparkSession, []
    edges = stored(rules.select("parent", "child").distinct(), paths)
    left, settled, k = edges, [], 0
    while True:
        k += 1
        waiting = left.select(F.col("child").alias("w")).distinct()
        ready = stored(left.join(waiting, F.col("parent") == F.col("w"), "left_anti").withColumn("level", F.lit(k)), paths)
        if ready.isEmpty():
            break
        settled.append(ready)
        left = stored(left.join(ready, ["parent", "child"], "left_anti"), paths)
    done = stored(reduce(DataFrame.unionByName, settled, edges.limit(0).withColumn("level", F.lit(0))))
    dropped(spark, paths)
    return rules.join(done, ["parent", "child"], "left")


def synced_in_order(tables: dict[str, DataFrame], rules: DataFrame, lengths: dict[str, int]) -> tuple[dict[str, DataFrame], list[tuple]]:
    """``tables`` after the ``rules`` (parent, child, as "table.column"; src_key, dst_key), parents before children; and what became of each.

    Each rule gives the child column its parent's value in the row with the same key; level by
    level, so that a value goes down a chain in one pass. A rule on a cycle isn't applied; one
    whose values are longer than ``lengths`` of the child is skipped. The outcome: (parent, child,
    level, state, differing rows afterwards), state one of SYNCED, SKIPPED_LENGTH, CYCLE.
    """
    out, told = dict(tables), []
    for r in sorted(levels(rules).collect(), key=lambda r: (r["level"] is None, r["level"], r["child"])):  # a row a rule
        (st, sc), (dt, dc) = r["parent"].split("."), r["child"].split(".")
        if r["level"] is None:
            told.append((r["parent"], r["child"], None, "CYCLE", None))
            continue
        source = out[st].select(F.col(r["src_key"]).alias(r["dst_key"]), F.col(sc).alias("_parent"))
        most = lengths.get(r["child"], 1 << 30)
        new = synced(out[dt], source, [r["dst_key"]], dc, "_parent", most)
        state = "SKIPPED_LENGTH" if new is out[dt] else "SYNCED"
        out[dt] = new
        told.append((r["parent"], r["child"], r["level"], state, sync_mismatches(new, source, [r["dst_key"]], dc, "_parent")))
    return out, told


def policies(found: DataFrame) -> DataFrame:
    """Of dependencies (kind, owner, object, table, and overrides usage, before, after): each once, of the first table, with what to do about it before and after masking.

    Kind, owner and object are compared in upper case without outer blanks. Foreign keys are
    disabled and enabled without validation, primary and unique keys only reported, triggers disabled and
    enabled, others left alone; an override that isn't null holds instead. Triggers come first.
    """
    norm = lambda c: F.upper(F.trim(c))
    one = Window.partitionBy(norm("kind"), norm("owner"), norm("object"))
    rows = found.withColumn("rn", F.row_number().over(one.orderBy("table"))).where("rn = 1")
    k = norm("kind")
    foreign, unique, trigger = k.isin("FK", "R", "FOREIGN KEY", "CONSTRAINT"), k.isin("P", "PRIMARY KEY", "U", "UNIQUE"), k == "TRIGGER"
    either = lambda own, a, b, c, d: F.coalesce(norm(own), F.when(foreign, a).when(unique, b).when(trigger, c).otherwise(d)).alias(own)
    return rows.select(
        k.alias("kind"), norm("owner").alias("owner"), norm("object").alias("object"), "table", F.when(trigger, 1).otherwise(2).alias("turn"),
        either("usage", "INTEGRITY", "INTEGRITY", "OPERATION", "OPERATION"), either("before", "DISABLE", "REPORT", "DISABLE", "REPORT"), either("after", "ENABLE_NOVALIDATE", "REVIEW", "ENABLE", "NONE"),
    )
