"""Sharding by histogram sort.

Rows are ordered by (hash of the text, hash of the id). Rounds of exact byte counts below
evenly spaced candidate boundaries narrow each splitter's bracket, 4096 times a round, until
the bracket holds no more bytes than the tolerance; then rows move once, to the shard between
two splitters. Equal texts lie side by side: a boundary falls inside such a group only where
the shards' sizes couldn't be near equal otherwise, that is where the group alone holds more
than GROUP of a shard, and then the ids' hashes are probed in turn.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsledger.llm.common import checkpoint, table

SHARDS = 8
TOLERANCE = 1e-3  # of a shard's bytes: where a splitter may miss its target
GROUP = 1e-2  # of a shard's bytes: shards that differ less are near equal, and a group of equal texts up to this is never cut
BITS = 12
LOW = -(1 << 63)


def _split(rows: DataFrame, targets: list[int], tolerance: float, group: float) -> list[tuple[int, int]]:
    """For each target, the boundary (first hash, second hash) with about that many bytes below it."""
    # a bracket: (level, first hash prefix or value, second hash prefix) -> targets within, less the bytes below it
    brackets: dict[tuple[int, int, int], list[tuple[int, int]]] = {(0, 0, 0): list(enumerate(targets))}
    found: dict[int, tuple[int, int]] = {}
    a, b = F.col("h").bitwiseXOR(F.lit(LOW)), F.col("g").bitwiseXOR(F.lit(LOW))
    for level in range(11):
        first = level < 6
        used = BITS * (level if first else level - 6)  # bits of the hash that are fixed so far
        shift = max(0, 64 - used - BITS)
        value = a if first else b
        cell = F.shiftrightunsigned(value, shift).alias("cell")
        own = [k for k in brackets if k[0] == level]
        if own:
            near = rows
            if level:
                pre = F.shiftrightunsigned(value, 64 - used) if used else F.lit(0)
                near = rows.where(pre.isin([_signed(k[1]) for k in own])) if first else rows.where(a.isin([_signed(k[1]) for k in own]))
            by = [cell] if first else [a.alias("top"), cell]
            counts = [r.asDict() | {"cell": r["cell"] % (1 << 64)} for r in near.groupBy(*by).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()]
            for k in own:
                wanted = brackets.pop(k)
                if first:
                    step = BITS if level < 5 else 64 - used
                    mine = sorted((r["cell"], r["size"], r["n"]) for r in counts if not level or r["cell"] >> step == k[1])
                else:
                    step = BITS if level < 11 else 64 - used
                    mine = sorted((r["cell"], r["size"], r["n"]) for r in counts if r["top"] == _signed(k[1]) and (not used or r["cell"] >> step == k[2]))
                below = 0
                for c, size, count in mine:
                    end = below + size
                    inside = [(n, t) for n, t in wanted if below < t <= end]
                    for n, t in inside:
                        full = shift == 0
                        if size <= tolerance or count == 1 or (full and (not first or size <= group)):
                            up = t - below > end - t  # to the nearer end of the cell
                            edge = (c + up) << shift
                            found[n] = (edge, 0) if first else (k[1], edge)
                        elif first and full:
                            brackets.setdefault((6, c, 0), []).append((n, t - below))
                        else:
                            brackets.setdefault((level + 1, c, 0) if first else (level + 1, k[1], c), []).append((n, t - below))
                    below = end
                for n, t in wanted:
                    if t > below or t <= 0:
                        found[n] = (1 << 64, 0) if t > below else (0, 0)
    for k, left in brackets.items():  # rows that repeat both hashes can't be told apart
        for n, _ in left:
            found[n] = (k[1], k[2] << max(0, 64 - BITS * (k[0] - 6)))
    return [found[n] for n in range(len(targets))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _range(splitters: list[tuple[int, int]]) -> Column:
    """The number of splitters at or below a row, found by bisection."""

    def below(s: tuple[int, int]) -> Column:
        if s[0] >= 1 << 64:
            return F.lit(True)
        h, g = s[0] + LOW, min(s[1], (1 << 64) - 1) + LOW
        return (F.col("h") < h) | ((F.col("h") == h) & (F.col("g") < g))

    def find(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(below(splitters[mid]), find(lo, mid)).otherwise(find(mid + 1, hi))

    return find(0, len(splitters))


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row of ``docs``; shards hold nearly equal bytes.

    A null text has size 1 and a null checksum's value of the empty text, 0. Null ids and
    repeated rows take part as any other; an empty table gives an empty result. Only ids,
    sizes and hashes move, not texts; to the driver come at most 4096 counts a splitter and
    round, however many rows there are. Slots number a shard's rows in the order they are read
    in, through counts by read partition. Other columns play no part.
    """
    t = F.col(text_col)
    rows = checkpoint(docs.select(F.col(id_col).alias("id"), (F.coalesce(F.octet_length(t), F.lit(0)).cast("long") + 1).alias("size"), F.crc32(F.coalesce(t, F.lit(""))).alias("text_crc32"), F.xxhash64(t).alias("h"), F.xxhash64(F.col(id_col), F.lit(1)).alias("g")))
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return rows.select("id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    splitters = sorted(_split(rows, [total * k // shards for k in range(1, shards)], TOLERANCE * total / shards, GROUP * total / shards))
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("part", F.shiftright("row", 33)).withColumn("shard", _range(splitters))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = dealt.withColumn("n", F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")).cast("long") - 1)
    return numbered.join(starts, ["shard", "part"]).select("id", "size", "text_crc32", "shard", (F.col("start") + F.col("n")).alias("slot"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharded(table(spark, sf_dir, "documents"))
    return s.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
