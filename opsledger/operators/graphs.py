"""Closures, pre-orders and blocker forests: rounds of joins over stored deltas, for graphs of any size and depth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsledger.operators.ranges import running_sum
from opsledger.shared import dropped, stored

PARTS = 8  # tables of sets kept side by side before they are written as one
REACH = 16  # rows of a join an edge, or a set, up to which closures go several edges at once


def strides(e: DataFrame, most: int | None, paths: list[str]) -> tuple[DataFrame, DataFrame, list[int]]:
    """(up, down, hops) of all pairs at most a stride of edges of ``e`` apart, how many each ``up`` has by strides, and these: powers of two up to that stride.

    The stride is doubled while the join that doubles it has at most REACH rows an edge, which is
    counted before, and while it is not above ``most``; so the pairs grow with the edges.
    """
    hops, stride = stored(e.withColumn("hops", F.lit(1)), paths), 1
    size = hops.count()
    while most is None or 2 * stride <= most:
        far = hops.where(F.col("hops") == stride).select(F.col("up").alias("start"), F.col("down").alias("mid"), F.col("hops").alias("so_far"))
        ways = hops.groupBy(F.col("up").alias("mid")).agg(F.count("*").alias("n"))
        rows = far.join(ways, "mid").agg(F.sum(F.col("n").cast("double"))).first()[0]
        if not rows or rows > REACH * size:
            break
        on = far.join(hops, F.col("mid") == F.col("up")).where("start <> down").select(F.col("start").alias("up"), "down", (F.col("so_far") + F.col("hops")).alias("hops"))
        hops = stored(hops.unionByName(on).groupBy("up", "down").agg(F.min("hops").alias("hops")), paths)
        stride *= 2
    steps = [2**k for k in range(stride.bit_length())]
    return hops, stored(hops.groupBy("up").agg(*[F.count_if(F.col("hops") <= s).alias(f"n{s}") for s in steps]), paths), steps


def first_met(found: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """``found`` (node, block, depth, bits), each bit of a node and block at its least depth only, and not if ``seen`` (node, block, seen) has it."""
    out = found.repartition("node", "block").groupBy("node", "block", "depth").agg(F.bit_or("bits").alias("bits"))
    out = out.withColumn("seen", F.lit(0).cast("long")) if seen is None else out.join(seen, ["node", "block"], "left")
    before = F.bit_or("bits").over(Window.partitionBy("node", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1))
    out = out.withColumn("had", F.coalesce("seen", F.lit(0)).bitwiseOR(F.coalesce(before, F.lit(0))))
    return out.select("node", "block", "depth", F.col("bits").bitwiseAND(F.bitwise_not("had")).alias("bits")).where("bits <> 0")


def closure(edges: DataFrame, roots: DataFrame, depth: int | None = None) -> DataFrame:
    """(root, node, depth): what each of ``roots`` (root) reaches over ``edges`` (up, down), itself at depth 0, with the least number of edges.

    Semi-naive: a round joins only the pairs at the greatest depth that the last one found, and keeps
    those that no round had, so cycles end and diamonds don't multiply: work grows with pairs and
    edges, not with paths. Up to 64 roots, next to each other in their order, are the bits of one number, so
    that what they have in common is stored and shuffled once. Nodes without edges of their own are left
    to the end. A round goes as many edges on as ``strides`` has, or fewer, where its join would
    have over REACH rows a set; one edge always goes. Edges with a null end and null roots play no part;
    repeated rows count once. ``depth``, if given, is the greatest.
    """
    spark, paths = edges.sparkSession, []
    own: list[str] = []
    names = roots.select("root").where("root is not null").distinct().orderBy("root").withColumn("at", F.monotonically_increasing_id())
    names = stored(names.select("root", F.expr("shiftright(at, 6)").alias("block"), F.expr("int(at & 63)").alias("bit")), own)
    e = stored(edges.select("up", "down").where("up <> down").distinct(), paths)
    e = e.join(e.select(F.col("down").alias("up")).unionByName(names.select(F.col("root").alias("up"))), "up", "left_semi")  # others begin at nodes that nothing leads to
    going = e.select(F.col("up").alias("down"))
    ends = stored(e.join(going, "down", "left_anti").select("up", "down", F.count("*").over(Window.partitionBy("down")).alias("ways")), own)
    hops, sizes, steps = strides(e.join(going, "down", "left_semi").select("up", "down"), depth, paths)
    new = stored(names.select(F.col("root").alias("node"), "block", F.lit(0).alias("depth"), F.expr("shiftleft(1L, bit)").alias("bits")), own)
    held, k, parts = [new], 0, []
    while depth is None or k < depth:
        last = new.where(F.col("depth") == k)
        met = last.join(sizes, F.col("node") == F.col("up")).agg(F.count("*").alias("n"), *[F.sum(f"n{s}").alias(f"n{s}") for s in steps]).first()
        if not met["n"]:
            break
        step = max(s for s in steps if s == 1 or met[f"n{s}"] <= REACH * met["n"])
        top = k + step if depth is None else min(k + step, depth)
        found = last.join(hops.where(F.col("hops") <= top - k), F.col("node") == F.col("up")).select(F.col("down").alias("node"), "block", (F.col("hops") + k).alias("depth"), "bits")
        seen = reduce(DataFrame.unionByName, held).groupBy("node", "block").agg(F.bit_or("bits").alias("seen"))
        new = stored(first_met(found, seen), parts)
        held.append(new)
        k = top
        if len(held) > PARTS:
            old, parts = parts, []
            held = [stored(reduce(DataFrame.unionByName, held), parts)]
            new = held[0]
            dropped(spark, old)
    dropped(spark, paths)
    sets = reduce(DataFrame.unionByName, held)
    on = sets if depth is None else sets.where(F.col("depth") < depth)
    last = on.join(ends, F.col("node") == F.col("up")).select("ways", F.col("down").alias("node"), "block", (F.col("depth") + 1).alias("depth"), "bits")
    last = last.where("ways = 1").drop("ways").unionByName(first_met(last.where("ways > 1")))  # what one edge leads to is met once
    blocks = names.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("bit", "root"))), lambda x: x["root"]).alias("roots"))
    pairs = sets.unionByName(last).join(blocks, "block").select("node", "depth", "bits", F.posexplode("roots").alias("bit", "root"))
    return pairs.where("getbit(bits, bit) = 1").select("root", "node", "depth")


def pre_order(df: DataFrame, key: list[str], parent: list[str], by: list[str]) -> DataFrame:
    """The rows of ``df`` that hang on a root, with ``level``, ``size`` of their subtree and ``place`` in pre-order, from 1; siblings go by ``by``, then key.

    A row whose ``parent`` columns are all null is a root; keys and parents are compared column
    by column. Levels are found top-down, sizes bottom-up; a row's place is its parent's, plus
    the sizes of its elder siblings, plus one. The siblings' running sizes are made by ranges, so
    neither all rows nor the children of one row are one task. Rows on a cycle or below one hang on
    no root and are left out, as are those whose parent doesn't exist. Keys that repeat are an error.
    """
    spark, paths = df.sparkSession, []
    if not df.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError("keys repeat, so this is no forest")
    node, up = F.struct(*[F.col(k).alias(f"k{n}") for n, k in enumerate(key)]), F.struct(*[F.col(p).alias(f"k{n}") for n, p in enumerate(parent)])
    rootless = reduce(lambda a, b: a & b, [F.col(p).isNull() for p in parent])
    rows = stored(df.select(node.alias("node"), F.when(~rootless, up).alias("up"), F.struct(*by).alias("by")), paths)
    levels = [stored(rows.where("up is null").withColumn("level", F.lit(1)), paths)]
    while True:
        last = levels[-1].select(F.col("node").alias("above"))
        nxt = stored(rows.join(last, F.col("up") == F.col("above")).select("node", "up", "by", F.lit(len(levels) + 1).alias("level")), paths)
        if nxt.isEmpty():
            break
        levels.append(nxt)
    sized: list[DataFrame] = []
    below = None
    for level in reversed(levels):
        if below is None:
            now = level.withColumn("size", F.lit(1).cast("long"))
        else:
            sums = below.groupBy(F.col("up").alias("above")).agg(F.sum("size").alias("more"))
            now = level.join(sums, F.col("node") == F.col("above"), "left").select(*level.columns, (F.coalesce("more", F.lit(0)) + 1).alias("size"))
        below = stored(now, paths)
        sized.append(below)
    whole = reduce(DataFrame.unionByName, sized)
    summed = stored(running_sum(whole, ["up", "by", "node"], "size", "elder", paths), paths)
    first = stored(summed.groupBy("up").agg(F.min("elder").alias("start")), paths)
    roots = first.where("up is null").select("start").first()
    start = roots["start"] if roots else 0
    placed = [stored(summed.where("level = 1").select("node", "level", "size", (F.col("elder") - start + 1).alias("place")), paths)]
    starts = first.where("up is not null").withColumnRenamed("up", "above")
    for k in range(2, len(levels) + 1):
        above = placed[-1].select(F.col("node").alias("parent"), F.col("place").alias("from"))
        now = summed.where(F.col("level") == k).join(above, F.col("up") == F.col("parent")).join(starts, F.col("up") == F.col("above"))
        placed.append(stored(now.select("node", "level", "size", (F.col("from") + 1 + F.col("elder") - F.col("start")).alias("place")), paths))
    found = stored(reduce(DataFrame.unionByName, placed))
    dropped(spark, paths)
    return df.join(found.select(*[F.col(f"node.k{n}").alias(k) for n, k in enumerate(key)], "level", "size", "place"), key)


def final_blockers(waits: DataFrame, node: str, up: str) -> DataFrame:
    """(node, blocker, level, cycle, waiters) for each row of ``waits``, one a node: who blocks it in the end.

    Pointer jumping: a round doubles the steps that each pointer takes, so a chain of n ends
    after log2(n) rounds. A row whose ``up`` is null, or itself, waits for no one: it is its own
    blocker, at level 1. A blocker that has no row of its own ends a chain. Chains that come to a
    cycle have ``cycle`` true, no level, and the cycle's least node as blocker. ``waiters``: rows
    of the same blocker, without the blocker itself. Nodes that repeat are an error.
    """
    spark, paths = waits.sparkSession, []
    if not waits.groupBy(node).count().where("count > 1").isEmpty():
        raise ValueError("nodes repeat")
    free = F.col("up").isNull() | (F.col("up") == F.col("node"))
    start = waits.select(F.col(node).alias("node"), F.col(up).alias("up")).select("node", F.when(free, F.col("node")).otherwise(F.col("up")).alias("at"), F.when(free, 0).otherwise(1).cast("long").alias("steps"), F.col("node").alias("least"), free.alias("done"))
    now = stored(start, paths)
    rounds = max(1, now.where("not done").count()).bit_length() + 1
    for _ in range(rounds):
        if now.where("not done").isEmpty():
            break
        old, paths = paths, []
        ahead = now.select(F.col("node").alias("n2"), F.col("at").alias("at2"), F.col("steps").alias("s2"), F.col("least").alias("l2"), F.col("done").alias("d2"))
        met = now.join(ahead, F.col("at") == F.col("n2"), "left")
        go = ~F.col("done") & F.col("n2").isNotNull()
        pick = lambda a, b: F.when(go, b).otherwise(F.col(a)).alias(a)
        met = met.select("node", pick("at", F.col("at2")), pick("steps", F.col("steps") + F.col("s2")), pick("least", F.least("least", "l2")), F.when(F.col("done") | F.col("n2").isNull(), True).otherwise(F.col("d2")).alias("done"))
        now = stored(met, paths)
        dropped(spark, old)
    # chains that haven't ended stand on their cycle, whose rows have seen all of it
    cycles = now.where("not done").select(F.col("node").alias("n2"), F.col("least").alias("on"))
    ended = now.where("done").select("node", F.col("at").alias("blocker"), (F.col("steps") + 1).alias("level"), F.lit(False).alias("cycle"))
    turning = now.where("not done").join(cycles, F.col("at") == F.col("n2")).select("node", F.col("on").alias("blocker"), F.lit(None).cast("long").alias("level"), F.lit(True).alias("cycle"))
    out = stored(ended.unionByName(turning), paths)
    counts = stored(out.groupBy("blocker").agg(F.count_if(F.col("node") != F.col("blocker")).alias("waiters")), paths)
    result = stored(out.join(counts, "blocker").select("node", "blocker", "level", "cycle", "waiters"))
    dropped(spark, paths)
    return result
