"""Packing of token sequences by minimum bin slack.

A document longer than a sequence is cut into whole sequences and a rest. Rests are dealt to
windows of bounded size; in each, a sequence takes the longest rest left, and a bitset
dynamic program over the multiset of the other lengths finds the sum closest to the room
that remains, with the counts of each length traced back.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm.common import Recent, checkpoint, each, table

CAPACITY = 2048
END = 1
WINDOW = 4096  # pieces that are packed together, on average
REMEMBERED = 100_000  # words whose ids a task keeps, about twice
BATCH = 3_000_000  # characters that are encoded together, about


WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"  # the file's own pre-tokens
PLAIN = bytes([*range(0x01, 0x0B), *range(0x0C, 0x1C), *range(0x20, 0x80), *range(0xA1, 0x100)])  # Latin-1 of texts whose words can be told apart without the library


def plain(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, PLAIN) and "<|" not in text
    except UnicodeEncodeError:
        return False


def segments(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all segments, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Ids:
    """Ids of texts by the library, which sees each word once in a while: a word's ids don't hang on its neighbours.

    Texts with other than Latin letters, or with what may be a special token, go to it whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import normalizers, pre_tokenizers

        self.path = path
        # plain words are normal and pre-tokens already, so only their bytes are left to be told
        self.merger = self._loaded()
        self.merger.normalizer = normalizers.Sequence([])
        self.merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.merger.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[k for x, k in vocab.items() if x.endswith("</w>")]] = True
        self.seen = Recent(remembered)

    def _loaded(self):
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    @functools.cached_property
    def tokenizer(self):
        """The file's own, for texts that go to it whole."""
        return self._loaded()

    def words(self, words: list[str]) -> None:
        missing = self.seen.absent(words)
        for at in range(0, len(missing), 2000):
            part = missing[at : at + 2000]
            ids = np.array(self.merger.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stops = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            b = ids.tobytes()
            for w, start, stop in zip(part, [0, *stops[:-1]], stops, strict=True):
                self.seen[w] = b[start:stop]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian."""
        out: list[bytes | None] = [None] * len(texts)
        odd = [k for k, x in enumerate(texts) if not plain(x)]
        if odd:
            for k, e in zip(odd, self.tokenizer.encode_batch([texts[k] for k in odd], add_special_tokens=False), strict=True):
                out[k] = np.array(e.ids, "<u4").tobytes()
        rest = [k for k in range(len(texts)) if out[k] is None]
        if not rest:
            return out
        cut = pc.split_pattern(pa.array([texts[k].lower() for k in rest], pa.large_string()), " ")
        chunks = cut.values.dictionary_encode()
        parts = pc.split_pattern(pc.replace_substring_regex(pc.replace_substring_regex(chunks.dictionary, WORD, "\\0\0"), r"\s+", ""), "\0")
        words = parts.values.dictionary_encode()
        names = words.dictionary.to_pylist()
        self.words([w for w in names if w])
        held = [self.seen[w] if w else b"" for w in names]
        flat = np.frombuffer(b"".join(held), "<u4")
        n = np.fromiter(map(len, held), np.int64, len(held)) // 4
        start = np.cumsum(n) - n
        # from words to chunks, then from chunks to texts
        w = words.indices.to_numpy()
        bounds = parts.offsets.to_numpy()
        flat, sums = flat[segments(start[w], n[w])], np.concatenate(([0], np.cumsum(n[w])))
        start, n = sums[bounds[:-1]], sums[bounds[1:]] - sums[bounds[:-1]]
        c = chunks.indices.to_numpy()
        flat, sums = flat[segments(start[c], n[c])], np.concatenate(([0], np.cumsum(n[c])))
        bounds = sums[cut.offsets.to_numpy()] * 4
        b = flat.tobytes()
        for k, x, y in zip(rest, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            out[k] = b[x:y]
        return out


def closest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as close to ``room`` as can be, not above it.

    ``counts``: lengths that are left, and how many. A set bit k of a bitset says that the
    lengths so far can sum to k; counts are cut into powers of two, so each bitset is one
    shift of the last, and the walk back over the bitsets gives the counts.
    """
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0:
            n = min(take, left)
            more = (sums | sums << length * n) & mask
            if more != sums:
                steps.append((sums, length, n))
                sums = more
            left -= n
            take *= 2
        if sums >> room:
            break
    at, out = sums.bit_length() - 1, {}
    for before, length, n in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + n
            at -= length * n
    return out


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; pieces of equal length are taken in their order."""
    stock: dict[int, list[int]] = {}
    for k in range(len(lengths) - 1, -1, -1):
        stock.setdefault(int(lengths[k]), []).append(k)
    counts = {x: len(v) for x, v in stock.items()}
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n = 0
    for longest in sorted(stock, reverse=True):
        while counts[longest]:
            counts[longest] -= 1
            chosen = {longest: 1}
            if longest < capacity:
                for x, k in closest({a: b for a, b in counts.items() if b}, capacity - longest).items():
                    chosen[x] = chosen.get(x, 0) + k
                    counts[x] -= k
            at = 0
            for x, k in chosen.items():
                for _ in range(k):
                    piece = stock[x].pop()
                    sequence[piece], offset[piece] = n, at
                    at += x
            n += 1
    return sequence, offset


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, batch: int = BATCH, remembered: int = REMEMBERED) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece of every document."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(path, remembered)
        end = np.array([END], "<u4").tobytes()
        for p in parts:
            held: list[tuple] = []
            size = 0
            for at, row in enumerate(zip(each(p["doc_id"]), each(p["text"]), strict=True), 1):
                held.append(row)
                size += len(row[1] or "")
                if size < batch and at < p.num_rows:
                    continue
                rows = []
                for (doc_id, _), b in zip(held, ids.encode([x or "" for _, x in held]), strict=True):
                    b += end
                    total = len(b) // 4
                    for start in range(0, total, capacity):
                        part = b[4 * start : 4 * (start + capacity)]
                        rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), (pa.string(), *[pa.int64()] * 4), strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                held, size = [], 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    # a null id travels as a string, which pandas doesn't turn into a float
    out = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(cut, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, window: int = WINDOW, batch: int = BATCH, remembered: int = REMEMBERED) -> DataFrame:
    """A row per piece with sequence_id and offset, gapless in its sequence.

    Null texts count as empty; an empty text is the end id alone. Null ids, repeated ids and
    equal lengths are packed as any other; an empty table gives an empty result. Windows are
    dealt by row, so one document's pieces or many copies spread over all of them. ``batch``:
    characters that are encoded together, of which more take less time and more memory.
    """
    p = checkpoint(pieces(docs, path, capacity, batch, remembered)).withColumn("row", F.monotonically_increasing_id())
    windows = max(1, -(-p.count() // window))
    kind = dict(p.dtypes)["doc_id"]

    def together(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("row", ignore_index=True)
        sequence, offset = pack(g["length"].to_numpy(), capacity)
        return g.assign(sequence_id=(g["window"].to_numpy(np.int64) << 24) | sequence, offset=offset)[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    dealt = p.withColumn("window", F.pmod(F.xxhash64("row"), F.lit(windows))).withColumn("doc_id", F.col("doc_id").cast("string"))
    out = dealt.groupBy("window").applyInPandas(together, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), batch=4 * BATCH, remembered=3 * REMEMBERED)
