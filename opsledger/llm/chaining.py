"""Fuzzy passages that documents share, by collinear chaining of k-mer seeds.

Seeds are word k-mers picked by local minima of their hashes, so any run of SPARSE + SEED - 1
words that two documents share has one in common; a passage of LEAST words or more that is alike
enough has such a run. Each seed joins its occurrences to the first document that has it. The
matches of a document with one source are chained: through a Fenwick tree of best scores by
source position, a match extends the best chain that ends before it in both documents, less a
cost for the gap. Chains are then aligned word by word, and passages of LEAST words or more
whose five-word shingles are alike enough are kept.

A seed's first document need not be the one that has the passage. Where the seeds of a document
go on from one first document to another, or to another place in it, the seeds before and after
the crossing, all within MARGIN words, are joined in pairs to the first document that has the pair, so passages that
earlier documents have in parts only are met too. And windows of LEAST words all of whose seeds are in
several documents, and which no equal run of an alignment holds, are joined to the first document
that has the whole window, and runs of them that no passage holds are passages too: every window
of LEAST words that an earlier document has lies in one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from opsledger.llm.common import dropped, each, keyed, pressed, stored, table

SEED = 8
SPARSE = 18  # k-mers of which one is a seed; with SEED, any 25 equal words have one, as the longer side of one edit in LEAST words has
SHINGLE = 5
LEAST = 50
SIMILAR = 0.8
GAP = 0.1  # of a word's score, for each word of a gap in either document
MARGIN = 64  # words beyond a chain's ends that the alignment may take in; twice as many beyond a lone match
SHIFT = 8  # words by which edits may move a run's place in its source
DOCS = 500  # documents whose seeds are paired at once
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_M = np.uint64(0x9E3779B97F4A7C15)
CACHE = 100_000
BLOCK = 256  # words of a source's block
SALTED = 128  # slices of a source that one group aligns, about


class Hashes(dict):
    """Word -> hash of 31 bits, the lowest of 32 left clear."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word) >> 33 << 1
        return h


def hashes(text: str | bytes, seen: Hashes) -> np.ndarray:
    words = (text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")).split()
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def grams(h: np.ndarray, k: int = SEED) -> np.ndarray:
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = np.zeros(n, np.uint64)
    for i in range(k):
        g = g * _M + h[i : i + n]
    return (g ^ (g >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def minima(g: np.ndarray) -> np.ndarray:
    """The place of the seed of each run of SPARSE k-mers."""
    bits = np.uint64(int(len(g)).bit_length())
    v = (g >> bits << bits) | np.arange(len(g), dtype=np.uint64)
    n = 1
    while 2 * n <= SPARSE:
        v = np.minimum(v[: len(v) - n], v[n:])
        n *= 2
    if SPARSE > n:
        v = np.minimum(v[: len(v) - (SPARSE - n)], v[SPARSE - n :])
    return (v & np.uint64((1 << int(bits)) - 1)).astype(np.int64)


def seeds(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the seeds of a document's words ``h``; a run of one k-mer has one."""
    g = grams(h)
    if len(g) < SPARSE:
        at = np.array([int(g.argmin())]) if len(g) else np.zeros(0, np.int64)
        return at, g[at]
    at = minima(g)
    at = at[np.concatenate(([True], at[1:] != at[:-1]))]
    s = g[at]
    same = np.concatenate(([False], (s[1:] == s[:-1]) & (at[1:] - at[:-1] < SPARSE)))
    return at[~same], s[~same]


def windows(h: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the windows of LEAST words whose seeds are all among those at ``held``.

    Only runs of k-mers that lie in a window count, so equal windows have equal seeds in all documents.
    """
    if len(h) < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = grams(h)
    known = np.isin(g[minima(g)], g[held[held < len(g)]])
    n = LEAST - SEED - SPARSE + 2
    unknown = np.concatenate(([0], np.cumsum(~known)))
    at = np.flatnonzero(unknown[n:] == unknown[:-n])
    w = np.zeros(len(at), np.uint64)
    for i in (*range(0, LEAST - SEED, SEED), LEAST - SEED):
        w = w * _M + g[at + i]
    return at, w


def near(pos: np.ndarray, h: np.ndarray, src: np.ndarray, spos: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first place, second place) of pairs of a document's seeds, in order of place, whose links belong to different runs.

    A run's links have one source and about one distance to it. The last two seeds of a run are
    paired with the first two of each run that begins within MARGIN words of its end, and, if ``whole``, all
    seeds of different runs within MARGIN words of each other.
    """
    off = spos - pos
    run = np.concatenate(([0], np.cumsum((src[1:] != src[:-1]) | (np.abs(off[1:] - off[:-1]) > SHIFT))))[: len(pos)]
    begin, end = np.searchsorted(run, run, "left"), np.searchsorted(run, run, "right") - 1
    at = np.arange(len(pos))
    last, first = end - at < 2, at - begin < 2
    left, right = [], []
    for s in range(1, len(pos)):
        ok = last[:-s] & first[s:] & (pos[begin[s:]] - pos[end[:-s]] <= MARGIN)
        if whole:
            ok |= pos[s:] - pos[:-s] <= MARGIN
        k = np.flatnonzero(ok & (run[s:] != run[:-s]))
        if not len(k):  # seeds that are further apart enclose such pairs
            break
        left.append(k), right.append(k + s)
    a, b = (np.concatenate([np.zeros(0, np.int64), *z]) for z in (left, right))
    g = h.view(np.uint64)[a] * _M + h.view(np.uint64)[b]
    return ((g ^ (g >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64), pos[a], pos[b]


def crossings(pos: np.ndarray, h: np.ndarray, src: np.ndarray, spos: np.ndarray, whole: bool = False) -> list[tuple[int, int, int]]:
    """The pairs of ``near`` as tuples."""
    return list(zip(*(v.tolist() for v in near(pos, h, src, spos, whole)), strict=True))


def chains(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Ranges (first, last of the document, first, last of the source) of the chains of matches (x, y), best first; a match is in one chain at most."""
    order = np.lexsort((y, x))
    x, y = x[order].tolist(), y[order].tolist()
    levels = sorted(set(y))
    rank = {v: k + 1 for k, v in enumerate(levels)}
    tree = [(-1e18, -1)] * (len(levels) + 1)
    score, back = [0.0] * len(x), [-1] * len(x)
    waiting: list[int] = []
    for i in range(len(x)):
        if i and x[i] != x[i - 1]:
            for j in waiting:  # matches at one place of the document don't chain
                k, v = rank[y[j]], (score[j] + GAP * (x[j] + y[j]), j)
                while k < len(tree):
                    if v > tree[k]:
                        tree[k] = v
                    k += k & -k
            waiting = []
        k, best = rank[y[i]] - 1, (-1e18, -1)
        while k:
            if tree[k] > best:
                best = tree[k]
            k -= k & -k
        gain = best[0] - GAP * (x[i] + y[i])
        if best[1] >= 0 and gain > 0:
            score[i], back[i] = SEED + gain, best[1]
        else:
            score[i] = SEED
        waiting.append(i)
    used, out = [False] * len(x), []
    for i in sorted(range(len(x)), key=lambda i: (-score[i], i)):
        if used[i]:
            continue
        j, first = i, i
        while j >= 0 and not used[j]:
            used[j], first, j = True, j, back[j]
        out.append((x[first], x[i] + SEED, y[first], y[i] + SEED))
    return out


def _alike(a: np.ndarray, b: np.ndarray) -> float:
    u, v = np.unique(grams(a, SHINGLE)), np.unique(grams(b, SHINGLE))
    both = len(np.intersect1d(u, v, assume_unique=True))
    return both / max(1, len(u) + len(v) - both)


def align(a: np.ndarray, b: np.ndarray) -> tuple[list[tuple[int, int, int, int, float]], list[tuple[int, int]]]:
    """Passages (first, last in a, first, last in b, similarity) of two word ranges, and the equal runs (first, last in a) of LEAST words or more.

    Shingles found once in either range anchor the alignment; anchors are chained again and grown
    word by word. A passage that isn't alike enough is cut at its widest gap.
    """
    ga, gb = grams(a, SHINGLE), grams(b, SHINGLE)
    ua, ia, na = np.unique(ga, return_index=True, return_counts=True)
    ub, ib, nb = np.unique(gb, return_index=True, return_counts=True)
    _, ka, kb = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    once = (na[ka] == 1) & (nb[kb] == 1)
    x, y = ia[ka[once]], ib[kb[once]]
    if not len(x):
        if len(a) == len(b) and (a == b).all():
            return ([(0, len(a), 0, len(b), 1.0)], [(0, len(a))]) if len(a) >= LEAST else ([], [])
        x, y = ia[ka], ib[kb]
        if not len(x):
            return [], []
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    # longest increasing run of partners: patience sorting
    import bisect

    tails, at, prev = [], [], np.full(len(y), -1)
    for i, v in enumerate(y.tolist()):
        k = bisect.bisect_left(tails, v)
        prev[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    keep, i = [], at[-1]
    while i >= 0:
        keep.append(i)
        i = int(prev[i])
    keep.reverse()
    runs: list[list[int]] = []  # equal runs: first, last in a, first, last in b
    for p, q in zip(x[keep].tolist(), y[keep].tolist(), strict=True):
        if runs and p - q == runs[-1][0] - runs[-1][2] and p <= runs[-1][1]:
            runs[-1][1], runs[-1][3] = max(runs[-1][1], p + SHINGLE), max(runs[-1][3], q + SHINGLE)
        elif runs and (p < runs[-1][1] or q < runs[-1][3]):
            continue
        else:
            runs.append([p, p + SHINGLE, q, q + SHINGLE])
    for k, r in enumerate(runs):
        low_a, low_b = (runs[k - 1][1], runs[k - 1][3]) if k else (0, 0)
        while r[0] > low_a and r[2] > low_b and a[r[0] - 1] == b[r[2] - 1]:
            r[0], r[2] = r[0] - 1, r[2] - 1
        high_a, high_b = (runs[k + 1][0], runs[k + 1][2]) if k + 1 < len(runs) else (len(a), len(b))
        while r[1] < high_a and r[3] < high_b and a[r[1]] == b[r[3]]:
            r[1], r[3] = r[1] + 1, r[3] + 1
    out, todo = [], [(0, len(runs))]
    while todo:
        s, e = todo.pop()
        p, q = runs[s], runs[e - 1]
        if q[1] - p[0] < LEAST:
            continue
        like = _alike(a[p[0] : q[1]], b[p[2] : q[3]])
        if like >= SIMILAR:
            out.append((p[0], q[1], p[2], q[3], like))
        elif e - s > 1:
            gaps = [max(runs[k][0] - runs[k - 1][1], runs[k][2] - runs[k - 1][3]) for k in range(s + 1, e)]
            cut = s + 1 + int(np.argmax(gaps))
            todo += [(s, cut), (cut, e)]
    return out, [(r[0], r[1]) for r in runs if r[1] - r[0] >= LEAST]


def _held(place: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether each window of LEAST words lies in one of ``spans``, which are sorted."""
    begin = np.array([x for x, _ in spans], np.int64)
    reach = np.concatenate(([-1], np.maximum.accumulate(np.array([y for _, y in spans], np.int64)))) if spans else np.array([-1])
    return reach[np.searchsorted(begin, place, "right")] >= place + LEAST


def _missed(same: Iterable[dict], spans: Iterable[dict] | None) -> list[dict]:
    """Runs of a document's windows that one source has, without those inside ``spans``; the source's range is the one that holds them."""
    pos, src, spos = (np.fromiter((r[c] for r in same), np.int64) for c in ("pos", "src", "spos"))
    new = ~_held(pos, sorted((r["first"], r["last"]) for r in spans) if spans is not None else [])
    order = np.flatnonzero(new)[np.argsort(pos[new])]
    pos, src, spos = pos[order], src[order], spos[order]
    out = []
    for k in np.split(np.arange(len(pos)), np.flatnonzero((np.diff(pos) != 1) | (np.diff(src) != 0)) + 1):
        if len(k):
            out.append({"first": int(pos[k[0]]), "last": int(pos[k[-1]]) + LEAST, "src": int(src[k[0]]), "sfirst": int(spos[k].min()), "slast": int(spos[k].max()) + LEAST})
    return out


def _seeded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, d, pos, lead) of every seed; lead: the document's first with that hash."""
    seen = Hashes()
    for p in parts:
        at, ds, hs, leads = [], [], [], []
        for d, text in zip(each(p["d"]), each(p["text"]), strict=True):
            h = hashes(text, seen)
            if len(h) >= LEAST:
                x, s = seeds(h)
                lead = np.zeros(len(x), bool)
                lead[np.unique(s, return_index=True)[1]] = True
                at.append(x), hs.append(s.view(np.int64)), leads.append(lead)
                ds.append(np.full(len(x), d, np.int64))
        if at:
            yield pa.RecordBatch.from_pydict({"h": np.concatenate(hs), "d": np.concatenate(ds), "pos": np.concatenate(at).astype(np.int32), "lead": np.concatenate(leads)})


def _crossed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, pair, pos, pos2) of the pairs of each document's seeds; DOCS documents at once, whose places are set wide apart."""
    for p in parts:
        for at in range(0, p.num_rows, DOCS):
            part = p.slice(at, DOCS)
            own, ds = part["own"], part["d"].to_numpy()
            n = own.value_lengths().to_numpy()
            pos, h, src, spos = (v.to_numpy(zero_copy_only=False).astype(np.int64) for v in own.flatten().flatten())
            pos += np.repeat(np.arange(len(n)), n) << 32
            order = np.argsort(pos, kind="stable")
            pair, a, b = near(pos[order], h[order], src[order], spos[order], True)
            if len(pair):
                yield pa.RecordBatch.from_pydict({"d": ds[a >> 32], "pair": pair, "pos": (a & 0xFFFFFFFF).astype(np.int32), "pos2": (b & 0xFFFFFFFF).astype(np.int32)})


@F.pandas_udf(ArrayType(StructType([StructField(c, IntegerType()) for c in ("a", "b", "c", "e")])))
def _chained(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        out = []
        for rows in s:
            x = np.fromiter((r["pos"] for r in rows), np.int64, len(rows))
            y = np.fromiter((r["spos"] for r in rows), np.int64, len(rows))
            ends = [(*c, MARGIN if c[1] - c[0] > SEED else 2 * MARGIN) for c in chains(x, y)]
            out.append([{"a": max(0, p - m), "b": q + m, "c": max(0, u - m), "e": v + m} for p, q, u, v, m in ends])
        yield pd.Series(out)


SLICE = "src long, salt int, whole boolean, d long, a int, c int, e int, words binary"
PIECE = "d long, src long, first int, last int, sfirst int, slast int, similarity double, hs array<long>"


def _sliced(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of SLICE: for each chain of a document its words there, held seeds marked; for each salt of a source its BLOCKs that chains need, ``a`` their bits' first block."""
    seen, names = Hashes(), [x.split()[0] for x in SLICE.split(", ")]
    unpress = zstandard.ZstdDecompressor()
    for p in parts:
        rows, size = [], 0
        for d, text, cuts, held, blocks, salts in zip(p["d"].tolist(), p["text"], p["cuts"], p["held"], p["blocks"], p["salts"], strict=True):
            h = hashes(unpress.decompress(text), seen).astype(np.uint32)
            if blocks is not None:
                keep = np.unique(np.asarray(blocks, np.int64))
                at = (keep[:, None] * BLOCK + np.arange(BLOCK)).ravel()
                b = np.concatenate((np.array([len(keep)], np.uint32), keep.astype(np.uint32), h[at[at < len(h)]])).tobytes()
                for salt in range(int(salts)):
                    rows.append((d, salt, True, None, None, None, None, b))
                    size += len(b)
            if cuts is not None:
                if held is not None:
                    h[np.asarray(held, np.int64)] |= np.uint32(1)
                for c in cuts:
                    b = h[c["a"] : c["b"]].tobytes()
                    rows.append((c["src"], c["salt"], False, d, c["a"], c["c"], c["e"], b))
                    size += len(b)
            if size > 8 << 20:
                yield pd.DataFrame(rows, columns=names)
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)


def _aligned(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of PIECE from rows of SLICE, a source's words before the slices aligned with them: passages, and, without ``src``, equal runs and runs of windows whose seeds are all held, with their hashes ``hs``."""
    names, source, words, starts, keep = [x.split()[0] for x in PIECE.split(", ")], None, None, None, None
    for p in parts:
        rows = []
        for src, salt, whole, d, a, c, e, b in zip(*(p[x.split()[0]] for x in SLICE.split(", ")), strict=True):
            x = np.frombuffer(b, np.uint32)
            if whole:
                n, source = int(x[0]), (src, salt)
                keep, words = x[1 : n + 1].astype(np.int64), x[n + 1 :].astype(np.uint64)
                continue
            if source != (src, salt):
                raise RuntimeError("a slice came without its source")
            at = int(np.searchsorted(keep, c // BLOCK)) * BLOCK + int(c) % BLOCK
            own, other = (x >> 1 << 1).astype(np.uint64), words[at : at + int(e) - int(c)]
            found, runs = align(own, other)
            d, a, c = int(d), int(a), int(c)
            if d != src:
                rows += [(d, src, a + p_, a + q, c + r, c + s, like, None) for p_, q, r, s, like in found]
            place, w = windows(own, np.flatnonzero(x & 1))
            if len(place):
                rows += [(d, None, a + first, a + last, None, None, None, None) for first, last in runs]
                w = w.view(np.int64)
                rows += [(d, None, a + int(place[k[0]]), None, None, None, None, w[k]) for k in np.split(np.arange(len(place)), np.flatnonzero(np.diff(place) != 1) + 1)]
        if rows:
            yield pd.DataFrame(rows, columns=names, dtype=object)


@F.pandas_udf(ArrayType(StructType([StructField("h", LongType()), StructField("pos", IntegerType())])))
def _open(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Windows of a document that none of its equal runs holds."""
    for s in parts:
        out = []
        for rows in s:
            w = {r["first"] + i: h for r in rows if r["hs"] is not None for i, h in enumerate(r["hs"])}
            place = np.array(sorted(w), np.int64)
            runs = sorted((r["first"], r["last"]) for r in rows if r["hs"] is None)
            held = _held(place, runs)
            out.append([{"h": w[i], "pos": i} for i in place[~held].tolist()])
        yield pd.Series(out)


@F.pandas_udf(ArrayType(StructType([StructField(c, LongType() if c == "src" else IntegerType()) for c in ("first", "last", "src", "sfirst", "slast")])))
def _missed_runs(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for s, t in parts:
        yield pd.Series([_missed(rows, own) for rows, own in zip(s, t, strict=True)])


def _first(found: DataFrame) -> DataFrame:
    """(h, src, spos): of each hash in several documents the first document and its place there."""
    g = found.groupBy("h").agg(F.min("d").alias("src"), F.min_by("pos", "d").alias("spos"), F.max("d").alias("m"))
    return g.where("src < m").select("h", "src", "spos")


def passages(docs: DataFrame, key: str, paths: list[str] | None = None) -> DataFrame:
    """(d, first, last, src, sfirst, slast, similarity): word ranges of documents that an earlier one has too; ``key`` names a column of distinct longs.

    Joins are by seed, document or window, whose larger side Spark may split; a source with many
    slices is sent, in the blocks that they need, to as many salted groups as hold SALTED of them.
    ``paths`` takes down the stored tables that the result reads.
    """
    spark, own = docs.sparkSession, []
    docs = docs.where("text is not null").select(F.col(key).cast("long").alias("d"), "text")
    found = stored(docs.mapInArrow(_seeded, "h long, d long, pos int, lead boolean"), own)
    links = stored(found.select("h", "d", "pos").join(_first(found.where("lead")), "h").select("h", "d", "pos", "src", "spos"), own)
    crossed = stored(links.groupBy("d").agg(F.collect_list(F.struct("pos", "h", "src", "spos")).alias("own")).select("d", "own").mapInArrow(_crossed, "d long, pair long, pos int, pos2 int"), own)
    begun = crossed.groupBy("pair").agg(F.min(F.struct("d", "pos", "pos2")).alias("first"), F.max("d").alias("m")).where("first.d < m")
    begun = stored(begun.select("pair", F.col("first.d").alias("src"), F.col("first.pos").alias("spos"), F.col("first.pos2").alias("spos2")), own)
    both = crossed.join(begun, "pair").where("d <> src").select("d", "src", F.explode(F.array(F.struct("pos", "spos"), F.struct(F.col("pos2").alias("pos"), F.col("spos2").alias("spos")))).alias("r")).select("d", "r.pos", "src", "r.spos")
    met = links.where("d <> src or pos <> spos").select("d", "pos", "src", "spos").unionByName(both).groupBy("d", "src").agg(F.collect_set(F.struct("pos", "spos")).alias("met"))
    pairs = stored(met.select("d", "src", F.explode(_chained("met")).alias("r")).select("d", "src", "r.*"), own)
    salts = pairs.groupBy("src").agg(F.ceil(F.count("*") / SALTED).cast("int").alias("salts"))
    cuts = pairs.join(salts, "src").withColumn("salt", F.pmod(F.xxhash64("d", "a"), F.col("salts")).cast("int")).groupBy("d").agg(F.collect_list(F.struct("src", "salt", "a", "b", "c", "e")).alias("cuts"))
    held = links.groupBy("d").agg(F.collect_set("pos").alias("held"))
    blocks = pairs.select("src", F.explode(F.expr(f"sequence(c div {BLOCK}, (e - 1) div {BLOCK})")).alias("block")).distinct().groupBy("src").agg(F.collect_list("block").alias("blocks")).join(salts, "src").withColumnRenamed("src", "d")
    needed = cuts.join(held, "d").join(blocks, "d", "full")
    texts = docs.select("d", pressed("text").alias("text"))
    slices = texts.hint("merge").join(needed, "d").select("d", "text", "cuts", "held", "blocks", "salts").mapInPandas(_sliced, SLICE)
    pieces = stored(slices.repartition("src", "salt").sortWithinPartitions("src", "salt", F.desc("whole")).mapInPandas(_aligned, PIECE), paths)
    dropped(spark, own)
    alike = pieces.where("src is not null").drop("hs").distinct()
    wide = stored(pieces.where("src is null").groupBy("d").agg(F.collect_list(F.struct("first", "last", "hs")).alias("got")).select("d", F.explode(_open("got")).alias("r")).select("r.h", "d", "r.pos"), paths)
    one = wide.groupBy("h", "d").agg(F.min("pos").alias("pos"))
    same = wide.join(_first(one), "h").where("d <> src").groupBy("d").agg(F.collect_list(F.struct("pos", "src", "spos")).alias("same"))
    spans = alike.groupBy("d").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    exact = same.join(spans, "d", "left").select("d", F.explode(_missed_runs("same", "spans")).alias("r")).select("d", "r.src", "r.first", "r.last", "r.sfirst", "r.slast", F.lit(1.0).alias("similarity"))
    return alike.unionByName(exact)


@F.pandas_udf(ArrayType(StringType()))
def _cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Texts, as ``pressed`` leaves them, without the words of the spans; none where no word is left."""
    unpress = zstandard.ZstdDecompressor()
    for texts, spans in parts:
        out = []
        for text, own in zip(texts, spans, strict=True):
            if text is None:
                out.append([None])
                continue
            b = unpress.decompress(text)
            at, kept = 0, []
            if own is not None:
                words = [m.span() for m in WORD.finditer(b)]
                for first, last in sorted((s["first"], s["last"]) for s in own):
                    x, y = words[first][0], words[last - 1][1]
                    if y > at:
                        kept.append(b[at : max(at, x)])
                        at = y
            b = b"".join([*kept, b[at:]])
            out.append([] if own is not None and not b.split() else [b.decode("utf-8", "surrogatepass")])
        yield pd.Series(out)


def without_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without the passages that an earlier document has too, n_chars brought up to date.

    The document with the smallest id keeps a passage. Null and empty texts stay; documents of
    which no word is left go. Rows that repeat an id, or have none, are told apart by their
    place. An empty table gives an empty result; other columns are kept, whatever their names.
    """
    d, key = keyed(docs)
    names = [c for c in d.columns if c not in ("text", "n_chars")]
    has = "n_chars" in docs.columns
    paths: list[str] = []
    found = stored(passages(d.select(key, "text"), key, paths))
    dropped(docs.sparkSession, paths)
    spans = found.groupBy(F.col("d").alias("_in_d")).agg(F.collect_list(F.struct("first", "last")).alias("_in_spans"))
    held = d.select(*[F.col(f"`{c}`").alias(f"_in{k}") for k, c in enumerate(names)], pressed("text").alias("_in_text"), *[F.col("n_chars").alias("_in_chars")] * has)
    # merged at every size, so that no task runs two Python functions one after another
    out = held.hint("merge").join(spans, F.col(f"_in{names.index(key)}") == F.col("_in_d"), "left").withColumn("_in_text", F.explode(_cut("_in_text", "_in_spans")))  # one call a row, as a filter on its result would be a second
    back = {c: F.col(f"_in{k}").alias(c) for k, c in enumerate(names)} | {"text": F.col("_in_text").alias("text")}
    if has:
        back["n_chars"] = F.when(F.col("_in_spans").isNull(), F.col("_in_chars")).otherwise(F.char_length("_in_text").cast(docs.schema["n_chars"].dataType)).alias("n_chars")
    return out.select(*[back[c] for c in docs.columns])


def shared(docs: DataFrame) -> DataFrame:
    """A row per passage that two documents share: doc_id, first_word, last_word (past it), n_words, and where match_doc_id, the first to have it, has it."""
    d, key = keyed(docs.select("doc_id", "text"))
    found = passages(d, key).select("d", "src", F.col("first").cast("long").alias("first_word"), F.col("last").cast("long").alias("last_word"), (F.col("last") - F.col("first")).cast("long").alias("n_words"), F.col("sfirst").cast("long").alias("match_first_word"), F.col("slast").cast("long").alias("match_last_word"), "similarity")
    if key == "doc_id":
        return found.withColumnsRenamed({"d": "doc_id", "src": "match_doc_id"})
    ids = d.select(F.col(key).alias("place"), "doc_id")
    found = found.join(ids, F.col("d") == F.col("place")).drop("place", "d")
    return found.join(ids.withColumnRenamed("doc_id", "match_doc_id"), F.col("src") == F.col("place")).drop("place", "src")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(table(spark, sf_dir, "documents"))
