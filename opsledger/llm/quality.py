"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Words and word pairs are hashed into buckets. Two smoothed multinomials over the buckets,
one of trusted rows and one of all rows, give each document the mean log ratio of its
n-grams; documents under the threshold are rejected, as are those that the base rules fail.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm.common import each, table

BUCKETS = 1 << 14
TRUSTED = 20_000  # most labelled rows that the target is fitted on: those of the smallest hashed ids
SMOOTH = 1.0
THRESHOLD = -0.07  # nats an n-gram; rows like the target score near zero
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
CACHE = 100_000  # words whose hash a task remembers
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """Word -> 64-bit hash; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(words: list[bytes], seen: Hashes) -> np.ndarray:
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def buckets_of(h: np.ndarray) -> np.ndarray:
    """Bucket of each word and of each pair of neighbours."""
    pairs = h[:-1] * _MIX + h[1:]
    return (np.concatenate([h, pairs ^ (pairs >> np.uint64(29))]) % np.uint64(BUCKETS)).astype(np.int64)


def rules(text: str, words: list[bytes], h: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    repeated = 0
    if len(words) > 3:
        t = (h[:-2] * _MIX + h[1:-1]) * _MIX + h[2:]
        order = np.argsort(t, kind="stable")
        s = t[order]
        same = s[1:] == s[:-1]
        if same.any():
            twice = np.zeros(len(t), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            inside = np.zeros(len(words), bool)
            for k in range(3):
                inside[k : k + len(t)] |= twice
            repeated = int(inside.sum())
    return chars, symbols, len(lines) - len(set(lines)), repeated


def count_buckets(docs: DataFrame) -> DataFrame:
    """(bucket, raw, target) of ``docs`` (text, trusted): each task sums before its rows go out."""

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, seen = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), Hashes()
        for p in parts:
            for text, trusted in zip(each(p["text"]), each(p["trusted"]), strict=True):
                if text is None:
                    continue
                b = np.bincount(buckets_of(word_hashes(text.encode("utf-8", "surrogatepass").split(), seen)), minlength=BUCKETS)
                raw += b
                if trusted:
                    target += b
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": some, "raw": raw[some], "target": target[some]})

    return docs.mapInArrow(counted, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio of each bucket. The target is at most TRUSTED labelled rows, the raw side every row of ``docs``; what comes to the driver is one row a bucket. No trusted rows: all ratios are zero."""
    trusted = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRUSTED).withColumn("trusted", F.lit(True))
    rows = count_buckets(docs.select("doc_id", "text").join(F.broadcast(trusted), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))).collect()
    raw, target = np.full(BUCKETS, SMOOTH), np.full(BUCKETS, SMOOTH)
    for r in rows:
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    if target.sum() <= SMOOTH * BUCKETS:
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


SCORES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def score(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one struct column ``quality_rules`` of the fields of SCORES, which replaces one of that name.

    A null text counts as one without words; a text without words scores 0 and fails the base
    rules. Every row is judged alone, so repeated rows get equal verdicts, whatever their ids.
    An empty table gives an empty result. Other columns are kept, whatever their names.
    """

    @F.arrow_udf(SCORES)
    def judge(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen = Hashes()
        for texts in parts:
            out: list[list] = [[] for _ in range(8)]
            for text in each(texts):
                text = text or ""
                words = text.encode("utf-8", "surrogatepass").split()
                h = word_hashes(words, seen)
                n = len(words)
                chars, symbols, lines, repeated = rules(text, words, h)
                failed = n < 50 or 100 * repeated > 50 * n
                mean = float(ratio[buckets_of(h)].mean()) if n else 0.0
                for column, value in zip(out, (n, chars, symbols, lines, repeated, failed, mean, not failed and mean >= threshold), strict=True):
                    column.append(value)
            kinds = [{"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[x.split()[1]] for x in SCORES.split(", ")]
            yield pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], [x.split()[0] for x in SCORES.split(", ")])

    return docs.withColumn("quality_rules", judge("text"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, table(spark, sf_dir, "labels")).select("doc_id", "quality_rules.*")
