"""Removal of byte strings that repeat, by suffix arrays of shards.

Every window of WINDOW bytes belongs to the smallest hashed 32-gram in it, its anchor: equal
windows have equal anchors, so the windows to be compared meet wherever anchors are dealt to
shards by their hash. The windows of one anchor form a piece of text. Pieces that are equal are
known by a 128-bit hash; one of each goes to its anchor's shard if the anchor has several. A shard
sorts the suffixes of its pieces (Larsson-Sadakane refinement in numpy) and takes common prefixes
(Kasai): a window repeats if a neighbour shares WINDOW bytes. An anchor with more than MOST pieces
is spread over shards by load, whose sorted window digests are then merged by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from opsledger.llm.common import dropped, keyed, pressed, stored, table

WINDOW = 200
GRAM = 32
BLOCK = 1 << 18  # bytes that are hashed at a time, if no document is longer
PIECES = 1024  # pieces of a shard, on average
MOST = 128  # pieces of one anchor in one shard
_M = np.uint64(0x9E3779B97F4A7C15)


def _grams(a: np.ndarray, length: int, multiplier: np.uint64 = _M) -> np.ndarray:
    """Polynomial hash of the ``length`` bytes from each place on; ``length`` a sum of powers of two."""
    x, m, n = a.astype(np.uint64) + np.uint64(1), np.array([multiplier], np.uint64), 1
    out, have, power = None, 0, None
    while True:
        if length & n:
            if out is None:
                out, have = x, n
            else:  # the longer part first
                size = len(a) - have - n + 1
                out = x[:size] * power + out[n : n + size]
                have += n
            power = m if power is None else power * m
        if 2 * n > length:
            break
        x, m, n = x[: len(x) - n] * m + x[n:], m * m, 2 * n
    out = out ^ (out >> np.uint64(29))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def anchors(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(text, anchor's hash, first and past-last window start) of each run of windows with one anchor."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths) - lengths
    a = np.frombuffer(b"".join(texts), np.uint8)
    if len(a) < window:
        return (np.zeros(0, np.int64),) * 4
    h = _grams(a, GRAM)
    low = 32  # bits of a place, the same for texts of any length: windows that are equal must have the same anchor
    v = (h >> np.uint64(low) << np.uint64(low)) | np.arange(len(h), dtype=np.uint64)
    span, n = window - GRAM + 1, 1
    while 2 * n <= span:
        v = np.minimum(v[: len(v) - n], v[n:])
        n *= 2
    if span > n:
        v = np.minimum(v[: len(v) - (span - n)], v[span - n :])
    at = (v & np.uint64((1 << low) - 1)).astype(np.int64)
    counts = np.maximum(lengths - window + 1, 0)
    own = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())  # windows within one text
    text = np.repeat(np.arange(len(texts)), counts)
    at = at[own]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])))) if len(at) else np.zeros(0, np.int64)
    text, first = text[new], own[new] - starts[text[new]]
    last = np.concatenate((own[new[1:] - 1], own[-1:])) - starts[text] + 1 if len(new) else first
    return text, h[at[new]].view(np.int64), first, last


def suffix_array(a: np.ndarray) -> np.ndarray:
    """All suffixes in order: sorted by eight bytes, then only groups not yet apart are refined, by the ranks that lie twice as far each time."""
    n = len(a)
    padded = np.concatenate((a, np.zeros(8, np.uint8)))
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + n]
    sa = np.argsort(key, kind="stable").astype(np.int32)  # a shard is far below 2 GB
    key = key[sa]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    del key
    rank = np.zeros(n + 1, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0)) + 1  # past the end: 0
    depth = 8
    ends = np.concatenate((new[1:], [True]))
    open_ = np.flatnonzero(~(new & ends))
    while len(open_):
        at = sa[open_]
        beyond = rank[np.minimum(at + depth, n)]
        both = rank[at].astype(np.int64) * (n + 1) + beyond
        order = np.argsort(both, kind="stable")
        both, at = both[order], at[order]
        sa[open_] = at
        split = np.concatenate(([True], both[1:] != both[:-1]))
        fresh = open_[np.maximum.accumulate(np.where(split, np.arange(len(at)), 0))] + 1
        rank[at] = fresh
        single = split & np.concatenate((split[1:], [True]))
        open_ = open_[~single]
        depth *= 2
    return sa


def common_prefixes(a: np.ndarray, sa: np.ndarray, starts: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Of suffixes ``sa``, the prefix shared with the one before, up to ``most``.

    Kasai's walk in text order, in every piece at once: at the next place, at most one byte
    less is shared. ``sa`` holds the first ``counts`` places from each of ``starts`` only; where
    the partner's next place isn't among them, the count starts anew.
    """
    n = len(a)
    padded = np.concatenate((a, np.zeros(8, np.uint8)))
    eight = np.zeros(n, np.uint64)
    for k in range(8):
        eight = eight << np.uint64(8) | padded[k : k + n]
    before = np.full(n + 1, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    valid = np.zeros(n + 2, bool)
    valid[sa] = True
    shared = np.zeros(n + 1, np.int32)
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    h, was = np.zeros(len(starts), np.int64), np.full(len(starts), -2, np.int64)
    for step in range(int(counts[0]) if len(counts) else 0):
        live = int(np.searchsorted(-counts, -step, side="left"))
        i = starts[:live] + step
        j = before[i]
        h = np.where(valid[was[:live] + 1] & (was[:live] >= 0), np.maximum(h[:live] - 1, 0), 0)
        todo = np.flatnonzero((j >= 0) & (h < most))
        while len(todo):
            x, y = i[todo] + h[todo], j[todo] + h[todo]
            inside = (x < n) & (y < n)
            differ = eight[np.minimum(x, n - 1)] ^ eight[np.minimum(y, n - 1)]
            same = np.where(inside, 8, 0)
            some = inside & (differ != 0)
            if some.any():
                same[some] = _leading(differ[some])
            h[todo] += same
            todo = todo[(same == 8) & (h[todo] < most)]
        h = np.minimum(np.where(j >= 0, h, 0), most)
        shared[i] = h
        was = j
    return shared[sa]


def _leading(x: np.ndarray) -> np.ndarray:
    """Whole zero bytes at the high end."""
    out = np.zeros(len(x), np.int64)
    for k in range(1, 8):
        out += x >> np.uint64(64 - 8 * k) == 0
    return out


def runs(flags: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int]]:
    """(piece, first, past-last) of the runs of set places among the first ``counts`` from each of ``starts``."""
    piece = np.repeat(np.arange(len(starts)), counts)
    off = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
    on = flags[np.repeat(starts, counts) + off]
    piece, off = piece[on], off[on]
    if not len(piece):
        return []
    cut = np.flatnonzero(np.concatenate(([True], (piece[1:] != piece[:-1]) | (off[1:] != off[:-1] + 1))))
    last = np.concatenate((cut[1:], [len(piece)])) - 1
    return list(zip(piece[cut].tolist(), off[cut].tolist(), (off[last] + 1).tolist(), strict=True))


SPANS = "d long, first int, last int, h long, part int, shard int, run binary"
RUN = np.dtype([("d1", "<i8"), ("d2", "<i8"), ("d", "<i8"), ("first", "<i4"), ("need", "?")])
PART = 50_000  # windows of one digest range, about


def shard_spans(g: pd.DataFrame, window: int = WINDOW) -> pd.DataFrame:
    """Of one shard's pieces (d, start, h, multi, salted, shard, piece): covered bytes, and of salted anchors the digest of each window that isn't equal to one before it."""
    g = g.sort_values(["d", "start"], ignore_index=True)
    pieces = g["piece"].tolist()
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    a = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    starts = np.cumsum(lengths + 1) - lengths - 1
    counts = lengths - window + 1
    place = (np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())).astype(np.int32)
    valid = np.zeros(len(a), bool)
    valid[place] = True
    sa = suffix_array(a)
    sa = sa[valid[sa]]
    shared = common_prefixes(a, sa, starts, counts, window)
    pair = np.flatnonzero(shared >= window)
    repeats = np.zeros(len(a), bool)
    repeats[sa[pair]] = True
    repeats[sa[pair - 1]] = True
    multi, salted = g["multi"].to_numpy(), g["salted"].to_numpy()
    d, s = g["d"].tolist(), g["start"].tolist()
    out = [(d[p], s[p] + x, s[p] + y + window - 1, None, None, None, None) for p, x, y in runs(repeats, starts, counts) if not multi[p]]
    if salted.any():
        owner = np.zeros(len(a), np.int32)
        owner[place] = np.repeat(np.arange(len(starts), dtype=np.int32), counts)
        leaders = sa[(shared < window) & salted[owner[sa]]]
        own = owner[leaders]
        run = np.empty(len(leaders), RUN)
        run["d1"], run["d2"] = (_grams(a, window, m).view(np.int64)[leaders] for m in (_M, np.uint64(0xD6E8FEB86659FD93)))
        run["need"] = ~repeats[leaders] & ~multi[own]  # the others only show that this shard has the window
        run["d"] = np.where(run["need"], g["d"].to_numpy()[own], 0)
        run["first"] = np.where(run["need"], g["start"].to_numpy()[own] + leaders - starts[own], 0)
        run = run[np.lexsort((run["d2"], run["d1"]))]
        parts = max(1, int(g["m"].iloc[0]) * 128 // PART)  # the same for all shards of this anchor
        part = ((run["d1"].view(np.uint64) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        for x in range(parts):
            mine = run[part == x]
            if len(mine):
                out.append((None, None, None, int(g["h"].iloc[0]), x, int(g["shard"].iloc[0]), mine.tobytes()))
    return pd.DataFrame(out, columns=[x.split()[0] for x in SPANS.split(", ")], dtype=object).astype({c: "Int64" for c in ("d", "first", "last", "h", "part", "shard")})


def merged(g: pd.DataFrame, window: int = WINDOW) -> pd.DataFrame:
    """The windows of one digest range that another shard has too.

    The shards' runs are merged into one; each window asked for is searched in it, and found at
    least twice if another shard has it, as a shard sends no window twice.
    """
    run = np.concatenate([np.frombuffer(b, RUN) for b in g["run"]])
    run = run[np.lexsort((run["d2"], run["d1"]))]
    asked = run[run["need"]]
    lo, hi = np.searchsorted(run["d1"], asked["d1"], "left"), np.searchsorted(run["d1"], asked["d1"], "right")
    hit = np.zeros(len(asked), bool)
    for m in np.flatnonzero(hi - lo > 1).tolist():
        hit[m] = (run["d2"][lo[m] : hi[m]] == asked["d2"][m]).sum() > 1
    found = asked[hit]
    return pd.DataFrame({"d": found["d"], "first": found["first"], "last": found["first"] + window})


PIECE = "d long, first int, last int, o long, h long, p1 long, p2 long"


def covered(docs: DataFrame, window: int = WINDOW, paths: list[str] | None = None) -> DataFrame:
    """(d, spans) of the texts of ``docs`` (d, text) with a window that another text has, or the same text elsewhere.

    Texts that are equal count as one here, told by the 128-bit hash that a piece's origin ``o`` is made of.
    ``paths`` takes down the stored tables that the result reads.
    """

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            ds, texts = p["d"].to_numpy(), p["text"].tolist()
            del p
            at = 0
            while at < len(texts):
                own, size, start = [], 0, at
                while at < len(texts) and (start == at or size + len(texts[at]) <= BLOCK):
                    own.append(texts[at].encode("utf-8", "surrogatepass"))
                    size += len(own[-1])
                    at += 1
                t, h, first, last = anchors(own, window)
                name = [*map(xxhash.xxh3_128_digest, own)]
                cut = [*zip(t.tolist(), first.tolist(), last.tolist(), strict=True)]
                o = np.fromiter((xxhash.xxh3_64_intdigest(name[i] + x.to_bytes(8)) for i, x, _ in cut), np.uint64, len(t)).view(np.int64)
                ph = np.frombuffer(b"".join(xxhash.xxh3_128_digest(own[i][x : y + window - 1]) for i, x, y in cut), np.int64).reshape(-1, 2)
                yield pd.DataFrame({"d": ds[start:at][t], "first": first.astype(np.int32), "last": last.astype(np.int32), "o": o, "h": h, "p1": ph[:, 0], "p2": ph[:, 1]})

    found = stored(docs.where(F.octet_length("text") >= window).mapInPandas(find, PIECE), paths)
    same = stored(found.groupBy("p1", "p2").agg(F.min("h").alias("h"), F.min("o").alias("least"), F.min_by("d", F.struct("o", "d")).alias("by"), (F.min("o") != F.max("o")).alias("multi")), paths)
    mixed = same.groupBy("h").agg(F.count("*").alias("m")).where("m > 1")
    known = stored(same.join(mixed, "h", "left").where("multi or m is not null").select("p1", "p2", "least", "by", "multi", "m"), paths)
    met = stored(found.join(known, ["p1", "p2"]).withColumn("sent", F.col("m").isNotNull() & (F.col("o") == F.col("least")) & (F.col("d") == F.col("by"))).where("multi or sent").select("d", "first", "last", "h", "multi", "sent", F.coalesce("m", F.lit(0)).alias("m")), paths)
    sent = met.where("sent").groupBy("d").agg(F.collect_list(F.struct("first", "last", "h", "multi", "m")).alias("cuts"))

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpress = zstandard.ZstdDecompressor()
        for p in parts:
            rows, held = [], 0
            for d, text, cuts in zip(p["d"], p["text"], p["cuts"], strict=True):
                b = unpress.decompress(text)
                for c in cuts:
                    rows.append((d, c["first"], c["h"], c["multi"], c["m"], b[c["first"] : c["last"] + window - 1]))
                    held += 400
                if held > 4 << 20:
                    yield pd.DataFrame(rows, columns=["d", "start", "h", "multi", "m", "piece"])
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=["d", "start", "h", "multi", "m", "piece"])

    shards = max(1, -(-met.where("sent").count() // PIECES))
    pieces = docs.where(F.octet_length("text") >= window).select("d", pressed("text").alias("text")).hint("merge").join(sent, "d").mapInPandas(cut, "d long, start int, h long, multi boolean, m long, piece binary")
    salt = F.pmod(F.xxhash64("d", "start"), F.ceil(F.col("m") / MOST)).cast("int")
    dealt = pieces.withColumn("salted", F.col("m") > MOST).withColumn("shard", F.when(F.col("salted"), salt).otherwise(0)).withColumn("to", F.when(F.col("salted"), F.xxhash64("h", "shard")).otherwise(F.pmod(F.xxhash64("h"), F.lit(shards))))
    spans = stored(dealt.groupBy("to").applyInPandas(lambda g: shard_spans(g, window), SPANS), paths)
    cross = spans.where("h is not null").select("h", "part", "shard", "run").groupBy("h", "part").applyInPandas(lambda g: merged(g, window), "d long, first int, last int")
    whole = met.where("multi").select("d", "first", (F.col("last") + window - 1).alias("last"))
    every = whole.unionByName(spans.where("h is null").select("d", "first", "last")).unionByName(cross)
    return every.groupBy("d").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


CUT = StructType([StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept_sha256", StringType()), StructField("kept", StringType()), StructField("removed", ArrayType(ArrayType(IntegerType())))])


def _cutter(with_text: bool):
    kind = CUT if with_text else StructType(CUT.fields[:3])

    @F.pandas_udf(kind)
    def apply(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        unpress = zstandard.ZstdDecompressor()
        for texts, copies, spans in parts:
            out = []
            for text, copied, own in zip(texts, copies, spans, strict=True):
                b = b"" if text is None else unpress.decompress(text)
                cuts: list[list[int]] = []
                if copied:
                    cuts = [[0, len(b)]]
                elif own is not None:
                    for x, y in sorted((s["first"], s["last"]) for s in own):
                        if cuts and x <= cuts[-1][1]:
                            cuts[-1][1] = max(cuts[-1][1], y)
                        else:
                            cuts.append([x, y])
                edges = [0, *(e for c in cuts for e in c), len(b)]
                kept = b"".join(b[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)) if cuts else b
                row = (sum(y - x for x, y in cuts), len(cuts), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode("utf-8", "replace"), cuts) if with_text else row)
            yield pd.DataFrame(out, columns=kind.names)

    return apply


def deduplicated(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, and others) with n_bytes and a struct ``cut``: n_removed, n_spans, kept_sha256, and with ``with_text`` the kept text and the removed byte ranges.

    A null text counts as empty. Texts shorter than the window, empty tables and documents
    without repeats are left whole; rows that repeat a text lose all of it if it is as long as
    the window, whatever their ids, which are told apart by their places where they repeat or are
    null. Every other column is kept, whatever its name, but for the input text, and for columns
    named like a result.
    """
    named, key = keyed(docs)
    names = [c for c in named.columns if c != "text"]
    text = named.select(F.col(f"`{key}`").cast("long").alias("d"), "text")
    paths: list[str] = []
    rows = text.where(F.octet_length("text") >= window).select("d", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), F.octet_length("text").alias("n"))
    several = stored(rows.groupBy("k1", "k2", "n").agg(F.count("*").alias("times")).where("times > 1").drop("times"), paths)
    copies = rows.join(several, ["k1", "k2", "n"]).select("d", F.lit(True).alias("copied"))
    info = stored(covered(text, window, paths).join(copies, "d", "full").select("d", F.coalesce("copied", F.lit(False)).alias("copied"), F.when(F.col("copied").isNull(), F.col("spans")).alias("spans")))
    dropped(docs.sparkSession, paths)
    held = named.select(*[F.col(f"`{c}`").alias(f"_in{k}") for k, c in enumerate(names)], pressed("text").alias("_text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = held.hint("merge").join(info, F.col(f"_in{names.index(key)}") == F.col("d"), "left").withColumn("cut", _cutter(with_text)("_text", F.coalesce("copied", F.lit(False)), "spans"))
    back = [F.col(f"_in{names.index(c)}").alias(c) for c in docs.columns if c not in ("text", "n_bytes", "cut")]
    return out.select(*back, "n_bytes", "cut")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False).select("doc_id", "n_bytes", "cut.*")
