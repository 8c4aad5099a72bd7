"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut into two halves, each with a codebook of its own, fitted on a bounded
sample. A vector lies in the cell of its halves' two nearest centroids, so K centroids a half
make K * K cells. A query walks the cells by the sum of its two squared distances to their
centroids: a heap holds the next pair of each row of the sorted table of sums, until the cells
walked hold as many vectors as the search looks at. Those vectors are ranked by their cosines.

How many vectors to look at is measured, not guessed: for some rows the exact neighbours are
found by looking at all vectors, and the walk must be long enough to reach the share RECALL of
them. Vectors that differ little from their neighbours need a short walk, vectors without
structure a long one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from opsledger.llm.common import dropped, stored, table
from opsledger.llm.whitening import usable

NEAREST = 5
EVERY = 50
SAMPLE = 16_384  # vectors that the codebooks are fitted on, at most, about
MEASURED = 256  # rows whose exact neighbours are found, to set the length of the walk
RECALL = 0.96  # of those rows' neighbours, the share that the walk reaches
ROUNDS = 10  # of fitting a codebook
MOST = 512  # centroids of a half, at most
BLOCK = 4096  # vectors, and queries, of a task's block, about
SEED = 11


def centroids_for(n: int) -> int:
    """Centroids of each half for ``n`` vectors: a power of two, so that a cell holds some ten vectors as long as there are fewer than MOST."""
    return int(min(MOST, max(1, 2 ** round(np.log2(max(1.0, np.sqrt(n) / 3.5))))))


def squared(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` and ``c``."""
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * a @ c.T + (c * c).sum(axis=1), 0)


def codebook(x: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` centroids of ``x``, by Lloyd's rounds from evenly spread rows; a centroid without rows stays where it is."""
    x = x[np.lexsort(x.T[::-1])] if x.shape[1] else x[:1]
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(ROUNDS):
        of = squared(x, c).argmin(axis=1)
        n = np.bincount(of, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, of, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


@dataclass
class Index:
    """The codebooks of both halves, how many vectors each cell holds, and the blocks that those of each centroid of the first half are dealt to."""

    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray | None = None
    blocks: np.ndarray | None = None

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.first.shape[1]
        return squared(x[:, :h], self.first), squared(x[:, h:], self.second)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.halves(x)
        return a.argmin(axis=1), b.argmin(axis=1)

    def walk(self, a: np.ndarray, b: np.ndarray, sizes: list[list[int]]) -> Iterator[tuple[int, int, int]]:
        """Cells that hold vectors (centroid of the first half, of the second, how many), by the sum of a query's squared distances ``a`` and ``b``, nearest first."""
        rows, columns = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
        a, b = np.sort(a).tolist(), np.sort(b).tolist()
        heap = [(a[0] + b[0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            if j == 0 and i + 1 < len(rows):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
            if j + 1 < len(columns):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if n := sizes[rows[i]][columns[j]]:
                yield rows[i], columns[j], n

    def reach(self, x: np.ndarray, cells: list[np.ndarray]) -> np.ndarray:
        """How many vectors the walk of each row of ``x`` has looked at once it has been in each of its ``cells``."""
        sizes, out = self.sizes.tolist(), []
        a, b = self.halves(x)
        for k, wanted in enumerate(cells):
            seen, after = 0, {}
            for i, j, n in self.walk(a[k], b[k], sizes):
                seen += n
                after[i * len(self.second) + j] = seen
            out += [after[c] for c in wanted.tolist()]
        return np.array(out, np.int64)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


@F.pandas_udf(BinaryType())
def unit_bytes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Vectors scaled to length one, as bytes of doubles."""
    for s in parts:
        x = np.stack(s.to_list()).astype(np.float64) if len(s) else np.zeros((0, 1))
        x /= np.abs(x).max(axis=1, initial=0, keepdims=True)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        yield pd.Series([v.tobytes() for v in x], dtype=object)


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Of unit vectors, pair by pair; summed along each pair alone, so that a pair's value is the same in any block."""
    return np.clip((q * x).sum(axis=1), -1.0, 1.0)


FOUND = "q long, e long, score double, least long, cell int"
ENTRY = "eid long, k1 long, k2 long, least long, asked boolean, x binary, cell int"
TASK = "i int, block int, kind int, id long, least long, cell int, seen binary, x binary"


def best(q: np.ndarray, own: np.ndarray, e: pd.DataFrame, x: np.ndarray, seen: np.ndarray | None, k: int) -> pd.DataFrame:
    """Rows of FOUND: the ``k`` vectors ``x`` (with eid, least and cell in ``e``) nearest to each query (vectors ``own``, ids ``q``), ties to the least id; ``seen`` tells which it looks at."""
    out = []
    for at in range(0, len(q), 512):
        s = own[at : at + 512] @ x.T
        if seen is not None:
            s[~seen[at : at + 512]] = -np.inf
        n = min(k, s.shape[1])
        last = -np.partition(-s, n - 1, axis=1)[:, n - 1]
        i, j = np.nonzero((s >= last[:, None] - 1e-12) & (s > -np.inf))
        score, least = cosines(own[at + i], x[j]), e["least"].to_numpy()[j]
        order = np.lexsort((least, -score, i))
        i, j = i[order], j[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        i, j, order = i[place < k], j[place < k], order[place < k]
        out.append(pd.DataFrame({"q": q[at + i], "e": e["eid"].to_numpy()[j], "score": score[order], "least": least[order], "cell": e["cell"].to_numpy()[j]}))
    return pd.concat(out)


def nearest_first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of FOUND of each query; Spark drops the others of a task before they are shuffled."""
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "least", "e"))
    return found.withColumn("place", place).where(F.col("place") <= k).drop("place")


def entries_of(rows: DataFrame, asked, paths: list[str]) -> DataFrame:
    """(k1, k2, least, asked, x): each distinct vector of ``rows`` once, scaled to length one, with its least id."""
    once = rows.groupBy("k1", "k2").agg(F.first("v").alias("v"), F.coalesce(F.min("vec_id"), F.lit(2**63 - 1)).alias("least"), F.bool_or(asked).alias("asked"))
    return stored(once.select("k1", "k2", "least", "asked", unit_bytes("v").alias("x")), paths)


def fit(entries: DataFrame, n: int) -> Index:
    """The codebooks of ``n`` vectors, fitted on about SAMPLE of them at most, picked by their hashes: what comes to the driver."""
    sample = entries.where(F.pmod(F.xxhash64("k1"), F.lit(n)) < SAMPLE).orderBy("k1", "k2").select("x").collect()
    x = _matrix(pd.Series([bytes(r["x"]) for r in sample])) if sample else np.zeros((1, 1))
    h, k = x.shape[1] // 2, centroids_for(n)
    return Index(codebook(x[:, :h], k), codebook(x[:, h:], k))


def coded(entries: DataFrame, index: Index) -> DataFrame:
    """Rows of ENTRY: ``entries`` with ids and cells (the centroid of the first half, times those of the second, plus its)."""

    def code(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            if len(p):
                a, b = index.cells(_matrix(p["x"]))
                yield p.assign(cell=(a * len(index.second) + b).astype(np.int32))

    return entries.withColumn("eid", F.monotonically_increasing_id()).select("eid", "k1", "k2", "least", "asked", "x").mapInPandas(code, ENTRY)


def length_of_walk(entries: DataFrame, index: Index, recall: float, k: int) -> int:
    """How many vectors a walk must look at to reach the share ``recall`` of the ``k`` exact neighbours of MEASURED rows, which come to the driver; their neighbours are found among all."""
    rows = entries.orderBy(F.xxhash64("k2"), "eid").limit(MEASURED).select("eid", "x").collect()
    if len(rows) < 2:
        return 1
    q, own = np.array([r["eid"] for r in rows]), _matrix(pd.Series([bytes(r["x"]) for r in rows]))

    def exact(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for p in parts:
            for at in range(0, len(p), BLOCK):
                e = p.iloc[at : at + BLOCK]
                found = best(q, own, e, _matrix(e["x"]), None, k + 1)
                kept = found if kept is None else pd.concat([kept, found]).sort_values(["q", "score", "least"], ascending=[True, False, True]).groupby("q").head(k + 1)
        if kept is not None:
            yield kept

    found = nearest_first(entries.select("eid", "least", "cell", "x").mapInPandas(exact, FOUND), k + 1).where("q <> e").select("q", "cell").collect()
    cells = {i: [] for i in q.tolist()}
    for r in found:
        cells[r["q"]].append(r["cell"])
    reached = index.reach(own, [np.array(cells[i][:k], np.int64) for i in q.tolist()])
    return int(np.quantile(reached, recall, method="higher"))


def _routed(index: Index, least: int):
    """Rows of TASK of queries: one for each block of each first centroid that the query's walk of ``least`` vectors comes to, with the second centroids there as bits."""

    def route(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes, blocks = index.sizes.tolist(), index.blocks.tolist()
        for p in parts:
            for at in range(0, len(p), 256):
                own = p.iloc[at : at + 256]
                a, b = index.halves(_matrix(own["x"]))
                rows = []
                for r, (q, x) in enumerate(zip(own["eid"].tolist(), own["x"], strict=True)):
                    looked, seen = 0, {}
                    for i, j, n in index.walk(a[r], b[r], sizes):
                        seen.setdefault(i, []).append(j)
                        looked += n
                        if looked >= least:
                            break
                    for i, js in seen.items():
                        bits = np.zeros(len(index.second), bool)
                        bits[js] = True
                        rows += [(i, block, 1, q, 0, 0, np.packbits(bits).tobytes(), x) for block in range(blocks[i])]
                if rows:
                    yield pd.DataFrame(rows, columns=[c.split()[0] for c in TASK.split(", ")])

    return route


def _ranked(columns: int, k: int):
    """Rows of FOUND from rows of TASK in order: a block's vectors, then the queries that come to it."""

    def rank(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, pending, e, x = None, [], None, None
        for p in parts:
            keys = p[["i", "block", "kind"]].to_numpy()
            for run in np.split(np.arange(len(p)), np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1):
                if not len(run):
                    continue
                now, g = tuple(keys[run[0], :2].tolist()), p.iloc[run]
                if now != key:
                    key, pending, e = now, [], None
                if g["kind"].iloc[0] == 0:
                    pending.append(g)
                    continue
                if e is None:
                    if not pending:
                        raise RuntimeError("queries came without their block")
                    e = pd.concat(pending).rename(columns={"id": "eid"})
                    e, x, pending = e.drop(columns=["x", "seen"]), _matrix(e["x"]), []
                    second = e["cell"].to_numpy(np.int64) % columns
                bits = np.unpackbits(np.frombuffer(b"".join(g["seen"]), np.uint8).reshape(len(g), -1), axis=1)[:, :columns].astype(bool)
                yield best(g["id"].to_numpy(np.int64), _matrix(g["x"]), e, x, bits[:, second], k)

    return rank


def search(entries: DataFrame, index: Index, least: int, k: int) -> DataFrame:
    """Rows of FOUND: of each asked entry, itself included, the ``k`` nearest entries of the cells that its walk comes to.

    Entries of one first centroid are dealt to blocks of about BLOCK, so no cell is one task's;
    queries stream past a block, however many there are.
    """
    columns, blocks = len(index.second), index.blocks
    many = F.element_at(F.lit(blocks.tolist()), F.col("i") + 1)
    held = entries.withColumn("i", F.expr(f"cast(cell div {columns} as int)")).withColumn("block", F.pmod(F.xxhash64("eid"), many).cast("int"))
    held = held.select("i", "block", F.lit(0).alias("kind"), F.col("eid").alias("id"), "least", "cell", F.lit(None).cast("binary").alias("seen"), "x")
    asked = entries.where("asked").select("eid", "x").mapInPandas(_routed(index, least), TASK)
    tasks = max(int(blocks.sum()) // 4, 1)
    dealt = held.unionByName(asked).repartition(tasks, "i", "block").sortWithinPartitions("i", "block", "kind")
    return nearest_first(dealt.mapInPandas(_ranked(columns, k), FOUND), k)


def nearest(vectors: DataFrame, asked: str, k: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id, embedding) that meets the SQL condition ``asked``, its ``k`` nearest others by cosine, ties to the smaller id.

    Vectors that are null, empty, zero, of another length than most, or hold a null or
    non-finite component take no part. Equal vectors are indexed and ranked once, and each of
    their rows is a candidate; so rows that repeat an id are, but a row never for itself. Null
    ids come last among ties. With fewer than ``k`` others a query gets all; an empty table
    gives an empty result. Other columns play no part.
    """
    spark = vectors.sparkSession
    paths: list[str] = []
    rows = usable(vectors.select("vec_id", F.col("embedding").alias("v")), "v").where("exists(v, c -> c <> 0)")
    rows = rows.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(7), "v"))
    entries = entries_of(rows, F.coalesce(F.expr(asked), F.lit(False)), paths)
    n = entries.count()
    index = fit(entries, max(n, 1))
    entries = stored(coded(entries, index), paths)
    index.sizes = np.zeros((len(index.first), len(index.second)), np.int64)
    for r in entries.groupBy("cell").count().collect():
        index.sizes.ravel()[r["cell"]] = r["count"]
    index.blocks = np.maximum(1, -(-index.sizes.sum(axis=1) // BLOCK))
    least = length_of_walk(entries, index, recall, k)
    found = stored(search(entries, index, least, k + 1).select("q", "e", "score"), paths)

    # of equal vectors the first k + 1 rows: one may be the query's own
    order = [F.col("vec_id").asc_nulls_last()]
    ids = rows.select("k1", "k2", "vec_id").withColumn("place", F.row_number().over(Window.partitionBy("k1", "k2").orderBy(*order))).where(F.col("place") <= k + 1)
    ids = ids.withColumn("copy", F.row_number().over(Window.partitionBy("k1", "k2", "vec_id").orderBy("place")))
    named = entries.select("k1", "k2", F.col("eid").alias("e"))
    ids = stored(ids.join(named, ["k1", "k2"]).select("e", "vec_id", "copy"), paths)
    queries = stored(rows.where(asked).select(F.col("vec_id").alias("query_id"), "k1", "k2").join(named.withColumnRenamed("e", "q"), ["k1", "k2"]).select("query_id", "q"), paths).withColumn("row", F.monotonically_increasing_id())
    out = queries.join(found, "q").join(ids, "e").where(~((F.col("e") == F.col("q")) & F.col("vec_id").eqNullSafe(F.col("query_id")) & (F.col("copy") == 1)))
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), *order))
    out = stored(out.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
    dropped(spark, paths)
    return out


def op13_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), f"vec_id % {EVERY} = 0")
