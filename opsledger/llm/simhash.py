"""Near-duplicates by SimHash fingerprints, found through Golay-code keys.

A fingerprint's 64 bits are cut into three segments, each a word of the perfect binary
(23, 12) Golay code's space once padded with zeros. Of two fingerprints with at most two
differing bits, one segment at least is equal (pigeonhole), and in each other segment the
words lie within two bits: the unit balls around them share a word, hence the codeword that
this word decodes to. A row's keys are (equal segment, codeword index of a ball word of the
next segment): at most 18. Rows that share a key are verified by their differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from opsledger.llm.common import apart, checkpoint, connected_components, dropped, each, keyed, table

MAX_BITS = 2
CUTS = ((0, 22), (22, 21), (43, 21))  # first bit and bits of each segment
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        parts = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        parts = [joined[a:b] for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), parts), np.uint64, len(parts)).view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    ones = np.concatenate([np.bincount(h[:, k], minlength=256) @ bits for k in range(8)])
    return int(np.packbits(2 * ones > len(parts), bitorder="little").view(np.uint64)[0])


@F.arrow_udf(LongType())
def fingerprint_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for s in texts:
        yield pa.array(np.fromiter(map(fingerprint, each(s)), np.uint64, len(s)).view(np.int64))


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """The remainder of each 23-bit word's low and high halves by the generator, and the error that each remainder stands for."""

    def remainder(w: int) -> int:
        for k in range(22, 10, -1):
            if w >> k & 1:
                w ^= GENERATOR << (k - 11)
        return w

    unit = [remainder(1 << k) for k in range(23)]
    leader = np.zeros(2048, np.int64)
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                e = (1 << a) | (1 << b) | (1 << c)
                s = 0
                for k in {a, b, c}:
                    s ^= unit[k]
                leader[s] = e
    return np.array(unit, np.int64), leader


def codewords(words: np.ndarray) -> np.ndarray:
    """The index (its 12 high bits) of the codeword nearest to each 23-bit word."""
    unit, leader = golay()
    s = np.zeros_like(words)
    for k in range(23):
        s ^= np.where(words >> k & 1, unit[k], 0)
    return (words ^ leader[s]) >> 11


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every fingerprint, keys of a row distinct."""
    u = fps.astype(np.int64).view(np.uint64)
    segments = [((u >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in CUTS]
    flips = np.array([0, *(1 << k for k in range(23))], np.int64)
    rows, keys = [], []
    for i, exact in enumerate(segments):
        near = np.sort(codewords(segments[(i + 1) % 3][:, None] ^ flips), axis=1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(new)
        rows.append(r)
        keys.append((np.int64(i) << 40) | (exact[r] << 12) | near[r, c])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        for at in range(0, len(p), 4096):
            fp = p["fp"].to_numpy(np.int64)[at : at + 4096]
            r, k = fuzzy_keys(fp)
            yield pd.DataFrame({"key": k, "fp": fp[r]})


def linked(fps: DataFrame, paths: list[str], small: int = 32) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` within two bits, as links do.

    Keys with up to ``small`` fingerprints give their verified pairs. The members of a fuller
    key meet instead at the words of their unit balls (65 each): two words within two bits
    share one, and each member is tied to the smallest at it. So the edges of a large group
    grow with its size, not its square, and no link's connection is lost. ``paths`` takes down
    the stored tables that the result reads.
    """
    keyed = checkpoint(fps.select("fp").mapInPandas(_keyed, "key long, fp long"), paths)
    full = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = checkpoint(keyed.join(full, "key"), paths)
    few = met.where(F.col("n") <= small).select("key", "fp")
    other = few.select("key", F.col("fp").alias("fp2"))
    pairs = few.join(other, "key").where("fp < fp2 and bit_count(fp ^ fp2) <= 2").select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
    many = met.where(F.col("n") > small).select("fp").distinct()
    balls = many.select("fp", F.explode(F.expr("concat(array(0L), transform(sequence(0, 63), k -> shiftleft(1L, k)))")).alias("flip")).select("fp", F.expr("fp ^ flip").alias("at"))
    least = balls.groupBy("at").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return pairs.unionByName(balls.join(least, "at").where("fp <> b").select(F.col("fp").alias("a"), "b")).distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint long, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over links of at most two differing bits. Null
    and wordless texts have fingerprint zero, linked like any other; rows that repeat an id
    repeat in the result; null ids are kept and never name a component that has another id; an
    empty table gives an empty result. Other columns play no part.
    """
    spark, paths = docs.sparkSession, []
    prints = checkpoint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).withColumn("fp", fingerprint_of("t")).drop("t"), paths)
    distinct = checkpoint(prints.groupBy("fp").agg(F.min("id").alias("least")), paths)
    comp = connected_components(linked(distinct, paths), paths)
    named = distinct.join(comp, distinct["fp"] == comp["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = checkpoint(named, paths)
    names = checkpoint(named.groupBy("component").agg(F.min("least").alias("component_id")), paths)
    out = checkpoint(prints.join(named.join(names, "component").select("fp", "component_id"), "fp").select("id", F.col("fp").alias("fingerprint"), "component_id"))
    dropped(spark, paths)
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with its smallest id stays.

    Rows are told apart where they repeat an id or have none: of those with one id the first as
    stored stays, and a row without an id only where its component has none with one. An empty
    table gives an empty result; other columns are kept, whatever their names.
    """
    back, held = apart(docs, ["doc_id", "text"], [])
    d, key = keyed(held)
    c = components(d.select(key, "text"), key).select("id", F.col("component_id").alias("of"))
    if key == "doc_id":
        keep = c.where("id = of").select(F.col("id").alias("kept_key"))
    else:
        ids = d.select(F.col(key).alias("place"), F.col("doc_id").alias("name"))
        first = c.join(ids, F.col("id") == F.col("place")).groupBy("of").agg(F.min(F.struct(F.col("name").isNull(), "name", "place")).alias("s"))
        keep = first.select(F.col("s.place").alias("kept_key"))
    return d.join(keep, F.col(key) == F.col("kept_key"), "left_semi").select(*back)


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = components(table(spark, sf_dir, "documents"))
    return c.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
