"""BPE encoding and decoding with segment trees over the ranks of adjacent pairs.

A pre-token's symbols are the leaves of a segment tree: leaf i holds (rank, i) of the pair
that starts at symbol i, or nothing. The root is the leftmost pair of the lowest rank; a
merge changes at most three leaves, each updated up to the root in logarithmic time, until
the root holds nothing. Trees of equally many leaves are merged side by side in numpy; long
pre-tokens have a tree of their own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm.common import Recent, table

PRE_TOKENS = regex.compile(r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")  # the published byte-level pattern
SPACE_RUN = regex.compile(r" \s")
CUT = re.compile(r" (?=\S)")
WIDEST = 64  # leaves of the trees that are merged side by side
CELLS = 1 << 20
REMEMBERED = 300_000
NONE = np.int64(1) << 62


class Vocabulary:
    """Of a byte-level BPE file: byte symbols, merges by pair, bytes of each id, special tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        vocab, merges = j["model"]["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in j["model"]["merges"]]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        rest = [b for b in range(256) if b not in set(plain)]
        to_char = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
        to_byte = {c: b for b, c in to_char.items()}
        self.byte_ids = np.array([vocab[to_char[b]] for b in range(256)], np.int64)
        self.special = {x["content"]: x["id"] for x in j["added_tokens"]}
        self.bytes_of = {k: bytes(to_byte[c] for c in s) for s, k in vocab.items() if s not in self.special} | {k: s.encode() for s, k in self.special.items()}
        self.text_of = {k: str(k) for k in self.bytes_of}
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self.shift, self.mask = np.uint64(64 - 19), (1 << 19) - 1
        self.slot_key, self.slot_rank = np.full(1 << 19, -1, np.int64), np.full(1 << 19, -1, np.int64)
        self.probes = 0
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self.slots(keys).tolist(), strict=True)):
            n = 1
            while self.slot_key[slot] >= 0:
                slot = slot + 1 & self.mask
                n += 1
            self.slot_key[slot], self.slot_rank[slot] = key, rank
            self.probes = max(self.probes, n)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it doesn't merge: a hash table with open addresses."""
        want = left << 20 | right
        slot = self.slots(want)
        held = self.slot_key[slot]
        out = np.where(held == want, self.slot_rank[slot], -1)
        todo = np.flatnonzero((held != want) & (held >= 0))
        for _ in range(self.probes):
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & self.mask
            held = self.slot_key[slot[todo]]
            hit = held == want[todo]
            out[todo[hit]] = self.slot_rank[slot[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        return out


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_long(v: Vocabulary, word: bytes) -> list[int]:
    ids = v.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    n = len(ids)
    width = 1 << max(1, (n - 1).bit_length())
    none = 1 << 62
    tree = [none] * (2 * width)
    after, before = [*range(1, n), n], [*range(-1, n - 1)]
    rank_of, merged = v.rank_of, v.merged.tolist()

    def leaf(i: int) -> int:
        j = after[i]
        r = rank_of.get(ids[i] << 20 | ids[j]) if j < n else None
        return none if r is None else r * width + i

    for i in range(n):
        tree[width + i] = leaf(i)
    for k in range(width - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: int) -> None:
        k = width + i
        tree[k] = value
        while k > 1:
            k >>= 1
            low = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == low:
                break
            tree[k] = low

    dead = [False] * n
    while tree[1] < none:
        rank, i = divmod(tree[1], width)
        j = after[i]
        ids[i], after[i], dead[j] = merged[rank], after[j], True
        if after[j] < n:
            before[after[j]] = i
        put(j, none)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    return [x for x, gone in zip(ids, dead, strict=True) if not gone]


def merge_side_by_side(v: Vocabulary, words: list[bytes], width: int) -> list[list[int]]:
    """``words`` of at most ``width`` bytes; ``width``: a power of two."""
    w, levels = len(words), width.bit_length() - 1
    lengths = np.fromiter(map(len, words), np.int64, w)
    col = np.arange(width)
    there = col < lengths[:, None]
    ids = np.full((w, width + 1), -1, np.int64)
    ids[:, :width][there] = v.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    after = np.broadcast_to(col + 1, (w, width)).copy()
    after[after >= lengths[:, None]] = width
    before = np.broadcast_to(col - 1, (w, width)).copy()
    tree = np.full((w, 2 * width), NONE, np.int64)
    r, c = np.nonzero(there[:, 1:])
    rank = v.rank(ids[r, c], ids[r, c + 1])
    tree[r, width + c] = np.where(rank >= 0, rank * width + c, NONE)
    for k in range(levels - 1, -1, -1):
        tree[:, 1 << k : 2 << k] = tree[:, 2 << k : 4 << k].reshape(w, -1, 2).min(2)
    flat = tree.reshape(-1)
    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        rank, i = np.divmod(tree[live, 1], width)
        j = after[live, i]
        k = after[live, j]
        new = v.merged[rank]
        ids[live, i], after[live, i], ids[live, j] = new, k, -1
        inner = k < width
        before[live[inner], k[inner]] = i[inner]
        h = before[live, i]
        first = np.maximum(h, 0)
        ranks = v.rank(np.concatenate([new, ids[live, first]]), np.concatenate([ids[live, k], new]))
        own, left = ranks[: len(live)], ranks[len(live) :]
        base = live * (2 * width)
        flat[base + width + j] = NONE
        flat[base + width + i] = np.where((own >= 0) & inner, own * width + i, NONE)
        put = h >= 0
        flat[(base + width + first)[put]] = np.where(left >= 0, left * width + first, NONE)[put]
        nodes = np.concatenate([width + j, width + i, width + first])
        bases = np.concatenate([base, base, base])
        for _ in range(levels):
            nodes >>= 1
            at = bases + 2 * nodes
            flat[bases + nodes] = np.minimum(flat[at], flat[at + 1])
        live = live[tree[live, 1] < NONE]
    kept = ids[:, :width]
    r, c = np.nonzero(kept >= 0)
    ends = np.searchsorted(r, np.arange(1, w + 1)).tolist()
    out, flat_ids = [], kept[r, c].tolist()
    start = 0
    for end in ends:
        out.append(flat_ids[start:end])
        start = end
    return out


def merge_words(v: Vocabulary, words: list[bytes]) -> list[list[int]]:
    out: list[list[int]] = [[]] * len(words)
    classes: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        width = 2
        while width < len(word):
            width *= 2
        classes.setdefault(width, []).append(k)
    for width, members in classes.items():
        if width > WIDEST:
            for k in members:
                out[k] = merge_long(v, words[k])
            continue
        step = CELLS // width
        for at in range(0, len(members), step):
            part = members[at : at + step]
            for k, ids in zip(part, merge_side_by_side(v, [words[k] for k in part], width), strict=True):
                out[k] = ids
    return out


class Codec:
    """Encodes texts; remembers what chunks between spaces became, as text of ids and as decoded bytes."""

    def __init__(self, path: str) -> None:
        self.v = vocabulary(path)
        self.first = Recent(REMEMBERED)  # of chunks without the space before them
        self.later = Recent(REMEMBERED)
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.v.special, key=len, reverse=True))) or r"(?!)")

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Cut at spaces where no pre-token crosses."""
        return CUT.split(text) if text.endswith(" ") or SPACE_RUN.search(text) else text.split(" ")

    def learn(self, missing: list[str], known: Recent, before: str) -> None:
        text_of, bytes_of = self.v.text_of.__getitem__, self.v.bytes_of.__getitem__
        missing = known.absent(missing)
        cut = [PRE_TOKENS.findall(before + c) for c in missing]
        words = list({x: None for tokens in cut for x in tokens})
        done = dict(zip(words, merge_words(self.v, [x.encode() for x in words]), strict=True))
        for c, tokens in zip(missing, cut, strict=True):
            ids = done[tokens[0]] if len(tokens) == 1 else [i for x in tokens for i in done[x]]
            known[c] = ",".join(map(text_of, ids)), b"".join(map(bytes_of, ids))

    def encode(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """(ids joined by commas, decoded bytes) of each text."""
        pieces: list[list[str]] = []
        owner, special = [], []
        for k, text in enumerate(texts):
            at = 0
            for m in self.special.finditer(text):
                pieces += [self.chunks(text[at : m.start()]), []]
                owner += [k, k]
                special += [None, m[0]]
                at = m.end()
            pieces.append(self.chunks(text[at:]))
            owner.append(k)
            special.append(None)
        flat = pa.array([c for p in pieces for c in p[1:]], pa.large_string()).dictionary_encode()
        names, codes = flat.dictionary.to_pylist(), flat.indices.to_pylist()
        self.learn([p[0] for p in pieces if p], self.first, "")
        self.learn(names, self.later, " ")
        table = [*map(self.later.__getitem__, names)]
        as_text, as_bytes = [x for x, _ in table], [x for _, x in table]
        out_text: list[list[str]] = [[] for _ in texts]
        out_bytes: list[list[bytes]] = [[] for _ in texts]
        at = 0
        for p, k, name in zip(pieces, owner, special, strict=True):
            if name is not None:
                out_text[k].append(str(self.v.special[name]))
                out_bytes[k].append(name.encode())
                continue
            own = codes[at : at + len(p) - 1]
            at += len(p) - 1
            x, y = self.first[p[0]]
            if x:
                out_text[k].append(x)
                out_bytes[k].append(y)
            if own:
                out_text[k].append(",".join(map(as_text.__getitem__, own)))
                out_bytes[k].append(b"".join(map(as_bytes.__getitem__, own)))
        return [(",".join(x), b"".join(y)) for x, y in zip(out_text, out_bytes, strict=True)]


def encoded(docs: DataFrame, path: str, batch_chars: int = 4_000_000) -> DataFrame:
    """``docs`` with a struct ``bpe`` (n_tokens, ids_sha256, decoded_sha256, ids array) of ``text``.

    Null counts as empty, which has no token. Special tokens in a text are found as the
    library finds them. Texts of any length are encoded whole. Repeated rows give equal results,
    whatever their ids; an empty table gives an empty result. Other columns are kept; one named
    bpe is replaced.
    """
    return docs.withColumn("bpe", _coder(path, batch_chars, True)("text"))


def _coder(path: str, batch_chars: int, with_ids: bool):
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    @F.pandas_udf(kind)
    def code(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(path)
        for s in parts:
            texts, rows, at = [x or "" for x in s], [], 0
            while at < len(texts):
                end, n = at, 0
                while end < len(texts) and (end == at or n + len(texts[end]) <= batch_chars):
                    n += len(texts[end])
                    end += 1
                for ids, back in codec.encode(texts[at:end]):
                    text = back.decode("utf-8", "replace").encode()
                    row = (ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text).hexdigest())
                    rows.append((*row, np.array(ids.split(",") if ids else [], np.int32)) if with_ids else row)
                at = end
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 3 + with_ids])

    return code


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", _coder(public_tokenizers.path("byte_bpe_50k.json"), 4_000_000, False)("text").alias("bpe")).select("doc_id", "bpe.*")
