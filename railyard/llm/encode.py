"""Encoding of a corpus with a public byte-level BPE vocabulary.

Method: batched numpy merge rounds. The byte symbols of many distinct words lie in one flat array; in every
round the pairs of neighbours are looked up by binary search over the sorted pair keys, and in each word
the pair of lowest rank is merged; words without a pair left are put aside. Words are cached per worker,
so each distinct word is encoded about once. A single word beyond LONG_WORD characters would need about as many
rounds as it has different pairs; such words go through a heap of pairs instead, with the same result.

Defined cases: a null and an empty text give an empty list; blank text has ids; special tokens in a text are
ordinary text; a text of any length is encoded whole. The vocabulary is read on the driver (its path is a
parameter) and sent to the executors as a few arrays of a size that the vocabulary fixes (under 5 MB).
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.core import spread

TOKENIZERS = "/opt/tokenizers"
#: Splits a text before the merges (fixed value of the public vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 400_000
LONG_WORD = 2000
NONE = np.iinfo(np.int32).max


def read_ranks(name: str, folder: str = TOKENIZERS) -> dict[bytes, int]:
    """Token bytes to id of a rank file."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, f.read().splitlines()))}


def pair_table(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """Sorted keys left * size + right of all pairs that make a token, the token of each, and the ids of the bytes."""
    size = max(ranks.values()) + 1
    found = [(ranks[t[:i]] * size + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    keys = np.array([k for k, _ in found], np.int64)
    order = np.argsort(keys)
    tokens = np.array([r for _, r in found], np.int32)
    return {"size": np.int64(size), "keys": keys[order], "tokens": tokens[order], "bytes": np.array([ranks[bytes([b])] for b in range(256)], np.int32)}


def merge_words(words: list[bytes], table: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Token ids of each word, by merge rounds over all words at once. A token's id is its rank."""
    keys, tokens, size = table["keys"], table["tokens"], table["size"]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    symbols = table["bytes"][np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    done_symbols, done_owner = [], []
    while len(symbols):
        rank = np.full(len(symbols), NONE, np.int32)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        key = symbols[inside] * size + symbols[inside + 1]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[at] == key
        rank[inside[hit]] = tokens[at[hit]]
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        least = np.minimum.reduceat(rank, starts)
        counts = np.diff(np.append(starts, len(symbols)))
        least = np.repeat(least, counts)
        live = least != NONE
        if not live.all():
            done_symbols.append(symbols[~live])
            done_owner.append(owner[~live])
            symbols, owner, rank, least = symbols[live], owner[live], rank[live], least[live]
            if not len(symbols):
                break
        merge = np.flatnonzero(rank == least)
        # of pairs that overlap (one symbol many times in a row) every second one is merged, from the left
        first = np.concatenate(([True], np.diff(merge) != 1))
        place = np.arange(len(merge))
        merge = merge[(place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0]
        symbols[merge] = rank[merge]
        keep = np.ones(len(symbols), bool)
        keep[merge + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int32)
    owner = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    return np.split(symbols[order], np.cumsum(np.bincount(owner, minlength=len(words)))[:-1]) if words else []


def merge_long(word: bytes, table: dict[str, np.ndarray], tokens: dict[int, int]) -> list[int]:
    """Token ids of one long word: the pairs wait in a heap by rank and place, neighbours are linked."""
    size, n = int(table["size"]), len(word)
    symbols = table["bytes"][np.frombuffer(word, np.uint8)].tolist()
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := tokens.get(symbols[i] * size + symbols[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = right[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue
        symbols[i], symbols[j] = rank, -1
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
        for x in (left[i], i):
            y = right[x] if x >= 0 else n
            if y < n and (r := tokens.get(symbols[x] * size + symbols[y])) is not None:
                heapq.heappush(heap, (r, x, symbols[x], symbols[y]))
    return [s for s in symbols if s >= 0]


class Encoder:
    """Encodes texts in batches; keeps the words it has met."""

    def __init__(self, table: dict[str, np.ndarray]):
        self.table = table
        self.find = regex.compile(PATTERN).findall
        self.cache: dict[str, list[int]] = {}
        self.tokens: dict[int, int] = {}

    def split(self, texts: list[str | None]) -> list[list[str]]:
        """The words of each text; those not met before are merged and kept."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache, parts = self.cache, [self.find(t) if t else [] for t in texts]
        new = list({w for words in parts for w in words if w not in cache})
        for w in [w for w in new if len(w) > LONG_WORD]:
            self.tokens = self.tokens or dict(zip(self.table["keys"].tolist(), self.table["tokens"].tolist()))
            cache[w] = merge_long(w.encode(), self.table, self.tokens)
        new = [w for w in new if w not in cache]
        for at in range(0, len(new), 100_000):
            some = new[at : at + 100_000]
            cache.update((w, ids.tolist()) for w, ids in zip(some, merge_words([w.encode() for w in some], self.table)))
        return parts

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        cache = self.cache
        return [[i for w in words for i in cache[w]] for words in self.split(texts)]

    def count(self, texts: list[str | None]) -> list[int]:
        cache = self.cache
        return [sum(len(cache[w]) for w in words) for words in self.split(texts)]


def shared_table(spark: SparkSession, name: str, folder: str = TOKENIZERS):
    """The pair table as a broadcast; its size is that of the vocabulary, whatever the corpus."""
    return spark.sparkContext.broadcast(pair_table(read_ranks(name, folder)))


def slices(texts: list[str | None], most_chars: int = 4_000_000) -> Iterator[list[str | None]]:
    """Runs of texts of about that many characters together, so that memory stays bounded beside long texts."""
    some: list[str | None] = []
    n = 0
    for t in texts:
        some.append(t)
        n += len(t or "")
        if n >= most_chars:
            yield some
            some, n = [], 0
    if some:
        yield some


def encode_texts(documents: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, ids array<int>) for each row of ``documents``; row-local, no shuffle."""
    table = shared_table(documents.sparkSession, tokenizer, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(table.value)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1).to_pylist()):
                ids = encoder.encode(texts)
                sizes = np.fromiter(map(len, ids), np.int32, len(ids))
                flat = np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum(dtype=np.int64)))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), lists], names=[id_col, "ids"])
                at += len(texts)

    slim = spread(documents).select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return slim.mapInArrow(run, f"{id_col} long, ids array<int>")
