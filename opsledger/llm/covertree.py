"""Near-duplicate embeddings by dual traversal of cover trees.

A label's vectors form one cover tree: nested levels whose centres lie further apart than the
level's radius, which halves from level to level. The top of a large label's tree is laid over a
bounded sample and cuts the label into nodes, each with a core within half the reach of its
centre, whose members all link. Only nodes whose centres are no further apart than the reach and
both covering radii allow meet in a task, and a vector goes to another node only if it can reach
one of its members. There the tree goes on: two nodes are dropped together by the same bound,
counted together once all their pairs must link, and split otherwise, down to exact comparisons.
A task returns link counts and a spanning forest, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm.common import apart, checkpoint, connected_components, dropped, table

COSINE = 0.93
BLOCK = 4096  # vectors of a node that meets others whole; fuller ones meet in parts
SAMPLE = 4096  # vectors of a label that the top of its tree is laid over, about
LEAF = 16  # rows of a node that isn't split
LEVELS = 24  # halvings of the radius
PAIRS = 1 << 14
SLACK = 1e-6  # of a distance, for rounding


def reach_of(cosine: float) -> float:
    """The distance of unit vectors that have that cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def net(x: np.ndarray, rows: np.ndarray, radius: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres among ``rows``, the first of them one, further apart than ``radius``; the nearest centre's number and distance of each row, at most ``radius``."""
    centres, near, of = [int(rows[0])], distances(x[rows], x[rows[:1]])[:, 0], np.zeros(len(rows), np.int64)
    near[0] = 0
    todo = np.flatnonzero(near > radius)
    while len(todo):
        batch = todo[:256]
        between, free, new = distances(x[rows[batch]], x[rows[batch]]), np.ones(len(batch), bool), []
        for k in range(len(batch)):
            if free[k]:
                new.append(k)
                free &= between[k] > radius
        new = batch[new]
        for part in np.array_split(np.arange(len(rows)), len(rows) // 4096 + 1):
            d = distances(x[rows[part]], x[rows[new]])
            best = d.argmin(axis=1)
            d = d[np.arange(len(part)), best]
            closer = d < near[part]
            near[part[closer]], of[part[closer]] = d[closer], best[closer] + len(centres)
        near[new], of[new] = 0, np.arange(len(new)) + len(centres)
        centres += rows[new].tolist()
        todo = todo[near[todo] > radius]
    return centres, of, near


class Tree:
    """Nodes over unit vectors ``x``: centre row, covering radius, range in ``order`` and range of children; a leaf has none."""

    def __init__(self, x: np.ndarray) -> None:
        self.x, order = x, np.arange(len(x))
        top = distances(x, x[:1]).max()
        nodes = [[0, float(top), 0, len(x), 0, 0]]
        level, radius = [0], 2.0
        for _ in range(LEVELS):
            radius, after = radius / 2, []
            for k in level:
                c, r, a, b, _, _ = nodes[k]
                if b - a <= LEAF or r == 0:
                    continue
                if r <= radius:  # the level's only centre is the node's own
                    after.append(k)
                    continue
                rows = order[a:b]
                at = np.flatnonzero(rows == c)[0]
                rows[0], rows[at] = rows[at], rows[0]
                centres, of, near = net(x, rows, radius)
                by = np.argsort(of, kind="stable")
                ends = a + np.cumsum(np.bincount(of, minlength=len(centres)))
                wide = np.zeros(len(centres))
                np.maximum.at(wide, of, near)
                order[a:b] = rows[by]
                nodes[k][4:] = [len(nodes), len(nodes) + len(centres)]
                after += range(len(nodes), len(nodes) + len(centres))
                nodes += [[i, w, s, e, 0, 0] for i, w, s, e in zip(centres, wide.tolist(), [a, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            level = after
            if not level:
                break
        self.order = order
        self.radius = np.array([n[1] for n in nodes])
        self.centre, self.first, self.last, self.child, self.past = (np.array([n[k] for n in nodes], np.int64) for k in (0, 2, 3, 4, 5))


def _products(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with i in [a0, a1) and j in [b0, b1), of every pair of ranges."""
    na, nb = a1 - a0, b1 - b0
    n = na * nb
    of = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return a0[of] + at // nb[of], b0[of] + at % nb[of]


class Links:
    """What the traversal of trees s and t finds: each row's links, weighed, and edges that connect what links."""

    def __init__(self, s: Tree, t: Tree, ws: np.ndarray, wt: np.ndarray, cosine: float) -> None:
        self.s, self.t, self.cosine, self.reach = s, t, cosine, reach_of(cosine)
        self.ws, self.wt = ws[s.order], wt[t.order]  # weights by place in the order
        self.ns, self.nt = np.zeros(len(ws) + 1), np.zeros(len(wt) + 1)  # gains from a place on
        self.held_s, self.held_t = np.zeros(len(ws) + 1, np.int64), np.zeros(len(wt) + 1, np.int64)  # ranges that link as one
        self.sum_s, self.sum_t = np.concatenate(([0], np.cumsum(self.ws))), np.concatenate(([0], np.cumsum(self.wt)))
        self.at_s, self.at_t = np.zeros(len(ws)), np.zeros(len(wt))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.compared = 0  # distances worked out
        self.walk()

    def walk(self) -> None:
        s, t = self.s, self.t
        todo = [(np.array([0]), np.array([0]))]
        while todo:
            i, j = todo.pop()
            if len(i) > PAIRS:
                todo += [(i[k : k + PAIRS], j[k : k + PAIRS]) for k in range(0, len(i), PAIRS)]
                continue
            self.compared += len(i)
            d = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", s.x[s.centre[i]], t.x[t.centre[j]])))
            self.settle(i, j, d, todo)

    def settle(self, i: np.ndarray, j: np.ndarray, d: np.ndarray, todo: list) -> None:
        """Of node pairs at distance ``d``: those too far go, those all linked are counted, leaves are compared, the others are split."""
        s, t = self.s, self.t
        wide = s.radius[i] + t.radius[j]
        near = d <= wide + self.reach + SLACK
        whole = d + wide <= self.reach - SLACK
        if whole.any():
            self.count(i[whole], j[whole])
        i, j = i[near & ~whole], j[near & ~whole]
        leaf_s, leaf_t = s.past[i] == 0, t.past[j] == 0
        both = leaf_s & leaf_t
        if both.any():
            self.compare(i[both], j[both])
        i, j, leaf_s, leaf_t = i[~both], j[~both], leaf_s[~both], leaf_t[~both]
        if not len(i):
            return
        a0, a1 = np.where(leaf_s, i, s.child[i]), np.where(leaf_s, i + 1, s.past[i])
        b0, b1 = np.where(leaf_t, j, t.child[j]), np.where(leaf_t, j + 1, t.past[j])
        size = (a1 - a0) * (b1 - b0)
        for k in np.flatnonzero(size > PAIRS).tolist():  # many children: one product of matrices
            step = max(1, (PAIRS << 4) // int(b1[k] - b0[k]))
            y = t.x[t.centre[b0[k] : b1[k]]]
            for a in range(int(a0[k]), int(a1[k]), step):
                e = min(a + step, int(a1[k]))
                d = distances(s.x[s.centre[a:e]], y)
                self.compared += d.size
                u, v = np.nonzero(d <= s.radius[a:e, None] + t.radius[None, b0[k] : b1[k]] + self.reach + SLACK)
                self.settle(u + a, v + b0[k], d[u, v], todo)
        small = np.flatnonzero(size <= PAIRS)
        total = np.cumsum(size[small])
        for part in np.split(small, np.flatnonzero(np.diff(total // PAIRS)) + 1):
            if len(part):
                todo.append(_products(a0[part], a1[part], b0[part], b1[part]))

    def count(self, i: np.ndarray, j: np.ndarray) -> None:
        s, t = self.s, self.t
        a, b, c, e = s.first[i], s.last[i], t.first[j], t.last[j]
        for n, x, y, gain in ((self.ns, a, b, self.sum_t[e] - self.sum_t[c]), (self.nt, c, e, self.sum_s[b] - self.sum_s[a])):
            np.add.at(n, x, gain)
            np.subtract.at(n, y, gain)
        for held, x, y in ((self.held_s, a, b), (self.held_t, c, e)):
            np.add.at(held, x + 1, 1)
            np.subtract.at(held, y, 1)
        self.edges.append((a, c))

    def compare(self, i: np.ndarray, j: np.ndarray) -> None:
        s, t = self.s, self.t
        size = (s.last[i] - s.first[i]) * (t.last[j] - t.first[j])
        total = np.cumsum(size)
        for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(total // PAIRS)) + 1):
            u, v = _products(s.first[i[part]], s.last[i[part]], t.first[j[part]], t.last[j[part]])
            self.compared += len(u)
            hit = np.einsum("ij,ij->i", s.x[s.order[u]], t.x[t.order[v]]) >= self.cosine
            u, v = u[hit], v[hit]
            self.at_s += np.bincount(u, self.wt[v], len(self.at_s))
            self.at_t += np.bincount(v, self.ws[u], len(self.at_t))
            if len(u):
                self.edges.append((u, v))

    def result(self, left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(links of each of ``n`` rows, ends of edges); ``left`` and ``right``: the rows that s and t are over, the same for a tree with itself."""
        rows_s, rows_t = left[self.s.order], right[self.t.order]
        out = np.zeros(n)
        out[rows_s] += np.cumsum(self.ns)[:-1] + self.at_s
        if self.s is self.t:
            out[rows_s] -= self.ws  # each row meets itself
        else:
            out[rows_t] += np.cumsum(self.nt)[:-1] + self.at_t
        ends = [(rows_s[u], rows_t[v]) for u, v in self.edges]
        for held, rows in ((self.held_s, rows_s), (self.held_t, rows_t)):
            at = np.flatnonzero(np.cumsum(held)[:-1] > 0)
            ends.append((rows[at], rows[at - 1]))
        return np.rint(out).astype(np.int64), *map(np.concatenate, zip(*ends, strict=True))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each of ``n`` rows reaches over pairs (a, b)."""
    low = np.arange(n)
    while len(a):
        x, y = low[a], low[b]
        apart_ = x != y
        if not apart_.any():
            break
        a, b, x, y = a[apart_], b[apart_], x[apart_], y[apart_]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = low[low]
            if (jumped == low).all():
                break
            low = jumped
    return low


FOUND = "did long, n long, root long"
NODE = "g long, chunk long, did long, times long, x binary, node int, d double"
MEET = "g long, p int, q int, side int, did long, times long, x binary"


def _vectors(g: pd.DataFrame, column: str = "x") -> np.ndarray:
    return np.frombuffer(b"".join(g[column]), np.float64).reshape(len(g), -1)


def _none(schema: str) -> pd.DataFrame:
    return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")}, dtype=object)


def part_links(g: pd.DataFrame, cosine: float = COSINE) -> pd.DataFrame:
    """Of two parts that meet (did, own, side, times, x; sides 0 and 1, or one part with itself if ``own``): each row's links, weighed by how often the other occurs, and the smallest row it reaches."""
    g = g.sort_values("did", ignore_index=True)
    x, did, times, side = _vectors(g), g["did"].to_numpy(), g["times"].to_numpy(np.float64), g["side"].to_numpy()
    own = bool(g["own"].iloc[0])
    left = np.arange(len(g)) if own else np.flatnonzero(side == 0)
    right = left if own else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return _none(FOUND)
    s = Tree(x[left])
    t = s if own else Tree(x[right])
    n, a, b = Links(s, t, times[left], times[right], cosine).result(left, right, len(g))
    low = _roots(len(g), a, b)
    some = (n > 0) | (low != np.arange(len(g)))
    return pd.DataFrame({"did": did[some], "n": n[some], "root": did[low[some]]})


def top_centres(g: pd.DataFrame, cosine: float = COSINE) -> pd.DataFrame:
    """Centres of a label's nodes: the top of the cover tree over a sample (g, did, x, want), the radius halved until there are ``want`` centres, of which the first are taken."""
    x, want = _vectors(g), max(2, int(g["want"].iloc[0]))
    radius, centres = 2.0, [0]
    while len(centres) < want and radius > reach_of(cosine) / 2:
        radius /= 2
        centres, _, _ = net(x, np.array([*centres, *np.setdiff1d(np.arange(len(x)), centres)]), radius)
    return pd.DataFrame({"g": g["g"].iloc[0], "c": [x[k].tobytes() for k in centres[:want]]}).rename_axis("centre").reset_index()[["g", "centre", "c"]]


def to_nodes(g: pd.DataFrame, centres: pd.DataFrame, cosine: float = COSINE) -> pd.DataFrame:
    """The node of each row: twice the nearest centre's number, and one more in its core."""
    if not len(g):
        return _none(NODE)
    d = distances(_vectors(g), _vectors(centres.sort_values("centre", ignore_index=True), "c"))
    best = d.argmin(axis=1)
    d = d[np.arange(len(g)), best]
    return g.assign(node=2 * best + (d <= reach_of(cosine) / 2 - SLACK), d=d)[[c.split()[0] for c in NODE.split(", ")]]


def to_pairs(g: pd.DataFrame, nodes: pd.DataFrame, cosine: float = COSINE) -> pd.DataFrame:
    """A row for each node pair where a vector of ``g`` may link; cores don't meet themselves. ``nodes``: (other, c, radius)."""
    if not len(g):
        return _none(MEET)
    own, other = g["node"].to_numpy(), nodes["other"].to_numpy()
    near = distances(_vectors(g), _vectors(nodes, "c")) <= nodes["radius"].to_numpy() + reach_of(cosine) + SLACK
    near &= (own[:, None] != other) | (other % 2 == 0)
    r, c = np.nonzero(near)
    p, q = np.minimum(own[r], other[c]), np.maximum(own[r], other[c])
    return g.iloc[r].assign(p=p, q=q, side=np.where(own[r] == p, 0, 1))[[c.split()[0] for c in MEET.split(", ")]]


def node_pairs(dealt: DataFrame, groups: DataFrame, cosine: float, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of labels too large for one task (g, n, did, times, x): the rows of MEET, and the links inside cores, as of FOUND.

    The rows of a label are worked on in chunks of about BLOCK, each beside all the label's centres.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    large = checkpoint(dealt.withColumn("chunk", F.pmod(F.xxhash64("did"), blocks)), paths)
    sample = large.where(F.pmod(F.xxhash64(F.lit("sample"), "did"), F.col("n")) < SAMPLE).select("g", "did", "x", blocks.alias("want"))
    centres = checkpoint(sample.groupBy("g").applyInPandas(lambda g: top_centres(g.sort_values("did", ignore_index=True), cosine), "g long, centre int, c binary"), paths)
    chunks = groups.select("g", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("chunk"))
    nodes = checkpoint(large.groupBy("g", "chunk").cogroup(centres.join(chunks, "g").groupBy("g", "chunk")).applyInPandas(lambda a, b: to_nodes(a, b, cosine), NODE), paths)
    cover = checkpoint(nodes.groupBy("g", "node").agg(F.max("d").alias("radius"), F.sum("times").alias("all"), F.min("did").alias("root")).withColumn("centre", F.floor(F.col("node") / 2).cast("int")), paths)
    near = cover.join(centres, ["g", "centre"]).join(chunks, "g").select(F.col("g").alias("of"), F.col("chunk").alias("part"), F.col("node").alias("other"), "c", "radius")
    met = nodes.groupBy("g", "chunk").cogroup(near.groupBy("of", "part")).applyInPandas(lambda a, b: to_pairs(a, b, cosine), MEET)
    cores = nodes.where("node % 2 = 1").join(cover.select(F.col("g").alias("of"), F.col("node").alias("other"), "all", "root"), (F.col("g") == F.col("of")) & (F.col("node") == F.col("other"))).select("did", (F.col("all") - F.col("times")).alias("n"), "root")
    return met, cores


def linked(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) with n_links, component_id and kept.

    Vectors that are null, empty, zero, or hold a null or non-finite component, and those
    without a label, link with nothing; so do vectors of unlike length. Equal vectors of a
    label are linked, and compared once for all of them. Rows that repeat an id count as
    separate vectors; a null id is kept, and only where its component has no other is
    component_id null. An empty table gives an empty result. Other columns are kept, whatever
    their names; those named like a result are replaced.
    """
    back, vectors = apart(vectors, ["vec_id", "embedding", "label"], ["n_links", "component_id", "kept"])
    x = F.col("embedding").cast("array<double>")
    good = F.expr("label is not null and embedding is not null and size(embedding) > 0 and forall(x, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and exists(x, v -> v <> 0)")
    rows = vectors.withColumn("x", x).withColumn("good", F.coalesce(good, F.lit(False))).withColumn("k1", F.xxhash64("label", "x")).withColumn("k2", F.xxhash64("x", F.lit(7), "label"))
    once = rows.where("good").groupBy("k1", "k2").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.min("vec_id").alias("least"), F.count("*").alias("times"))
    # scaled by the largest component first: squares neither overflow nor vanish
    unit = once.withColumn("x", F.expr("transform(x, v -> v / array_max(transform(x, w -> abs(w))))")).withColumn("x", F.expr("transform(x, v -> v / sqrt(aggregate(x, 0D, (s, w) -> s + w * w)))"))

    @F.pandas_udf("binary")
    def in_bytes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([np.asarray(v, np.float64).tobytes() for v in s], dtype=object)

    spark, paths = vectors.sparkSession, []
    once = checkpoint(unit.withColumn("dim", F.size("x")).withColumn("x", in_bytes("x")).withColumn("did", F.monotonically_increasing_id()), paths)
    groups = checkpoint(once.groupBy("label", "dim").agg(F.count("*").alias("n")).withColumn("g", F.monotonically_increasing_id()), paths)
    dealt = once.join(groups, ["label", "dim"]).select("g", "n", "did", "times", "x")
    met, cores = dealt.where(F.col("n") <= BLOCK).select("g", F.lit(0).alias("p"), F.lit(0).alias("q"), F.lit(0).alias("side"), "did", "times", "x"), None
    wide = groups.where(F.col("n") > BLOCK).select("g", "n")
    if not wide.isEmpty():
        more, cores = node_pairs(dealt.where(F.col("n") > BLOCK), wide, cosine, paths)
        met = checkpoint(met.unionByName(more), paths)
    part = lambda side: F.ceil(F.count_if(F.col("side") == side) / BLOCK).cast("int")
    pairs = checkpoint(met.groupBy("g", "p", "q").agg(part(0).alias("left"), part(1).alias("right")).where("p = q or left > 0 and right > 0"), paths)
    tasks = pairs.agg(F.sum(F.when(F.col("p") == F.col("q"), F.col("left") * (F.col("left") + 1) / 2).otherwise(F.col("left") * F.col("right"))).cast("long")).first()[0] or 1
    mine = F.pmod(F.xxhash64("did"), F.when(F.col("side") == 0, F.col("left")).otherwise(F.col("right"))).cast("int")
    theirs = F.explode(F.sequence(F.lit(0), F.when((F.col("p") != F.col("q")) & (F.col("side") == 0), F.col("right")).otherwise(F.col("left")) - 1))
    cut = met.join(pairs, ["g", "p", "q"]).withColumn("mine", mine).withColumn("theirs", theirs)
    first = F.when(F.col("p") == F.col("q"), F.col("mine") <= F.col("theirs")).otherwise(F.col("side") == 0)
    cut = cut.select("g", "p", "q", F.when(first, F.col("mine")).otherwise(F.col("theirs")).alias("i"), F.when(first, F.col("theirs")).otherwise(F.col("mine")).alias("j"), ((F.col("p") == F.col("q")) & (F.col("mine") == F.col("theirs"))).alias("own"), F.when(first, 0).otherwise(1).alias("side"), "did", "times", "x")
    keys = ["g", "p", "q", "i", "j"]
    found = cut.repartition(tasks, *keys).groupBy(*keys).applyInPandas(lambda g: part_links(g, cosine), FOUND)
    found = checkpoint(found if cores is None else found.unionByName(cores), paths)
    comp = connected_components(found.select(F.col("did").alias("a"), F.col("root").alias("b")), paths)
    counts = found.groupBy("did").agg(F.sum("n").alias("n"))
    named = once.select("k1", "k2", "did", "least", "times").join(comp, F.col("did") == F.col("node"), "left").join(counts, "did", "left").withColumn("component", F.coalesce("component", "did"))
    named = checkpoint(named.select("k1", "k2", "least", "times", "component", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n")), paths)
    least = named.groupBy("component").agg(F.min("least").alias("name"))
    named = checkpoint(named.join(least, "component").select("k1", "k2", "n", "name", F.lit(True).alias("good")))
    dropped(spark, paths)
    out = rows.join(named, ["k1", "k2", "good"], "left")
    out = out.withColumn("n_links", F.coalesce("n", F.lit(0)).cast("long")).withColumn("component_id", F.expr("if(good, name, vec_id)"))
    return out.select(*back, "n_links", "component_id", F.expr("vec_id <=> component_id").alias("kept"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")
