"""Evaluation texts leaking into training text.

Method: SimHash of item-sized windows. Every held-out item is cut into windows of WINDOW words, every message
into all its windows of that size; each window has a 128-bit SimHash of its words. A multi-index over eight
16-bit blocks holds every item window under all block values within RADIUS // 8 bits of its own, so by the
pigeonhole principle a lookup of a message window's eight blocks meets every item window within RADIUS.
Candidates are verified by the exact weighted similarity of the two windows' shingles: words and pairs of
neighbouring words, each weighted by how often it stands in the window; the sum of the lesser weights has to be
LEAST_ALIKE of the sum of the greater ones. Of the 16 words and 15 pairs of a window three edits, the most of the
definition, leave 13 and 9, hence 22 / 40. What passes is aligned with the item word by word.

A message window that holds fewer than 22 words and pairs of any item cannot be so similar, so it gets no
fingerprint.

An item leaks where a message holds a run of at least RUN words of it, from one equal word to another, of
which at most one in EDIT is replaced, left out or added. A run of RUN words holds a whole window of the item
wherever it begins, since windows begin every STRIDE words.

Words are runs of letters and digits; case, character width, invisible characters, punctuation, quoting, line
ends, JSON escapes and words broken at a line end make no difference.

The items are a stated query set of bounded size: they are taken in blocks of at most BLOCK items, each block
a broadcast of known size (the index takes about 0.25 MB an item in a worker) and one pass over the chats. Nothing is shuffled; a chat's messages are searched
where they lie.

Defined cases: null or empty messages, entries, contents and item texts hold nothing; items of fewer than RUN
words cannot leak; a chat and item come out once, however often the passage occurs; rows with a null id are
left out; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.core import spread

RUN, EDIT = 20, 6
WINDOW, STRIDE = 16, 5
RADIUS, BLOCKS = 31, 8
#: Words and pairs that a window has, those that it shares where it is alike, and the similarity that this makes.
SHINGLES, LEAST_SHARED = 2 * WINDOW - 1, 22
LEAST_ALIKE = LEAST_SHARED / (2 * SHINGLES - LEAST_SHARED)
BLOCK = 1000
#: Characters that are searched at once.
PORTION = 400_000

WORD = re.compile(r"[^\W_]+")
INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁯︀-️﻿]")
ESCAPED = re.compile(r"\\+(?:u([0-9a-fA-F]{4})|([nrtbf\"'/]))")
BROKEN = re.compile(r"([^\W\d_]+)([-‐‑­¬]?)[ \t]*\r?\n[ \t>|*#]*([^\W\d_]+)")


def _unescape(m: re.Match) -> str:
    return chr(int(m[1], 16)) if m[1] else {"n": "\n", "r": "\n", "t": " ", "b": " ", "f": " "}.get(m[2], m[2])


def plain(text: str) -> str:
    """Letters in one width and case, escapes undone, invisible characters removed."""
    if "\\" in text:
        for _ in range(3):
            undone = ESCAPED.sub(_unescape, text)
            if undone == text:
                break
            text = undone
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    text = text.replace("­\n", "-\n").replace("­\r\n", "-\n")
    return unicodedata.normalize("NFKC", INVISIBLE.sub("", text)).casefold()


def words_of(text: str, known=frozenset()) -> list[str]:
    """The words; two parts at a line end are one word where the items know it and not both parts."""
    text = plain(text)
    if "\n" in text and known:

        def join(m: re.Match) -> str:
            a, b = m[1], m[3]
            whole = a + b
            one = whole in known if m[2] else whole in known and not (a in known and b in known)
            return whole if one else f"{a} {b}"

        text = BROKEN.sub(join, text)
        text = BROKEN.sub(join, text)
    return WORD.findall(text)


def _hash_bits(word: str) -> np.ndarray:
    return np.unpackbits(np.frombuffer(xxhash.xxh3_128_digest(word.encode()), np.uint8)).astype(np.int8) * 2 - 1


def simhashes(bits: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash, as eight 16-bit blocks, of the windows that begin at ``starts``; bits: +1 or -1 by word and bit."""
    # the sums may wrap: their differences lie within WINDOW of zero
    sums = np.zeros((len(bits) + 1, 128), np.int8)
    np.cumsum(bits, axis=0, dtype=np.int8, out=sums[1:])
    windows = sums[starts + WINDOW] - sums[starts]
    return np.packbits(windows > 0, axis=1).view(">u2").astype(np.uint16)


def ball(bits: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` of ``bits`` bits."""
    return np.array([sum(1 << i for i in c) for r in range(radius + 1) for c in itertools.combinations(range(bits), r)], np.uint16)


def shingles(windows: np.ndarray) -> np.ndarray:
    """The words and pairs of each window of word codes, as numbers that differ from repeat to repeat, so that the size of an
    intersection is the sum of the lesser counts."""
    pairs = (windows[:, :-1].astype(np.int64) + 1 << 26) + windows[:, 1:] + 1
    both = np.concatenate([windows.astype(np.int64) + 1, pairs], axis=1)
    repeat = np.tril(both[:, :, None] == both[:, None, :], -1).sum(axis=2)
    return (both << 5) + repeat


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity, row by row, of what ``shingles`` gives."""
    shared = (a[:, :, None] == b[:, None, :]).any(axis=2).sum(axis=1)
    return shared / (a.shape[1] + b.shape[1] - shared)


def align(item: np.ndarray, text: np.ndarray) -> bool:
    """Whether ``text`` holds a run of the item as the module defines it.

    One table of edit distances for all beginnings of the run in the item at once, grown word by word; it
    need not grow beyond 2 * RUN words, as a longer run that is good has a part of that size that is.
    """
    n, m = len(item), len(text)
    if n < RUN or m < RUN * (EDIT - 1) // EDIT:
        return False
    first = np.arange(n - RUN + 1)
    slope = np.arange(m + 1, dtype=np.int16)
    far = np.int16(10_000)
    # begun with an equal word
    row = np.full((len(first), m + 1), far, np.int16)
    row[:, 1:][item[first][:, None] == text[None, :]] = 0
    for size in range(2, 2 * RUN):
        live = first + size <= n
        if not live.all():
            row, first = row[live], first[live]
            if not len(first):
                return False
        equal = item[first + size - 1][:, None] == text[None, :]
        across = row[:, :-1] + ~equal
        if size >= RUN and np.any(equal & (row[:, :-1] <= size // EDIT)):
            return True
        new = row + np.int16(1)
        np.minimum(new[:, 1:], across, out=new[:, 1:])
        new -= slope
        np.minimum.accumulate(new, axis=1, out=new)
        new += slope
        row = np.minimum(new, far)
        alive = row.min(axis=1) <= 2 * RUN // EDIT
        if not alive.all():
            row, first = row[alive], first[alive]
            if not len(first):
                return False
    return False


class Finder:
    """Finds the items that leak in texts. items: (item_id, text)."""

    def __init__(self, items: list[tuple[int, str]]):
        split = [(i, words_of(t)) for i, t in items]
        split = [(i, w) for i, w in split if len(w) >= RUN]
        self.known = {w: n for n, w in enumerate(sorted({x for _, w in split for x in w}))}
        self.item_ids = [i for i, _ in split]
        self.items = [np.array([self.known[x] for x in w], np.int32) for _, w in split]
        bits = np.stack([_hash_bits(w) for w in self.known]) if self.known else np.zeros((0, 128), np.int8)
        self.cache: dict[str, int] = dict(self.known)
        self.bits = np.zeros((max(1024, 2 * len(bits)), 128), np.int8)
        self.bits[: len(bits)] = bits
        owner, begin, prints, words = [], [], [], []
        for k, w in enumerate(self.items):
            starts = np.unique(np.append(np.arange(0, len(w) - WINDOW + 1, STRIDE), len(w) - WINDOW))
            owner.append(np.full(len(starts), k))
            begin.append(starts)
            prints.append(simhashes(bits[w], starts))
            words.append(w[starts[:, None] + np.arange(WINDOW)])
        if not split:
            return
        self.owner, self.begin = np.concatenate(owner), np.concatenate(begin)
        self.prints, self.words = np.concatenate(prints), np.concatenate(words)
        self.wide = self.prints.view(np.uint64).reshape(-1, 2)
        self.shingles = shingles(self.words)
        self.pairs = np.unique(np.concatenate([w[:-1].astype(np.int64) * len(self.known) + w[1:] for w in self.items]))
        masks = ball(16, RADIUS // BLOCKS)
        # per block: item windows by block value, as one sorted list and its offsets
        self.lists, self.offsets = [], []
        for b in range(BLOCKS):
            values = (self.prints[:, b][:, None] ^ masks[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            self.lists.append((order // len(masks)).astype(np.int32))
            self.offsets.append(np.concatenate(([0], np.cumsum(np.bincount(values, minlength=1 << 16)))))

    def code(self, words: list[str]) -> np.ndarray:
        """Row of each word in the table of bits; words of the items come first."""
        cache = self.cache
        for w in words:
            if w not in cache:
                if len(cache) == len(self.bits):
                    self.bits = np.concatenate([self.bits, np.zeros_like(self.bits)])
                self.bits[len(cache)] = _hash_bits(w)
                cache[w] = len(cache)
        return np.array([cache[w] for w in words], np.int32)

    def candidates(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(message window, item window) within RADIUS whose words are alike."""
        found = []
        for at in range(0, len(starts), 4096):
            some = starts[at : at + 4096]
            covered = np.zeros(some[-1] + WINDOW - some[0], bool)
            covered[(some[:, None] - some[0] + np.arange(WINDOW)).ravel()] = True
            part = simhashes(self.bits[codes[some[0] : some[-1] + WINDOW][covered]], np.cumsum(covered)[some - some[0]] - 1)
            wide = part.view(np.uint64).reshape(-1, 2)
            pairs = []
            for b in range(BLOCKS):
                low, high = self.offsets[b][part[:, b]], self.offsets[b][part[:, b].astype(np.int64) + 1]
                n = high - low
                window = np.repeat(np.arange(len(part)), n)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n)
                item = self.lists[b][place]
                near = np.bitwise_count(wide[window] ^ self.wide[item]).sum(axis=1) <= RADIUS
                pairs.append((at + window[near]) * len(self.owner) + item[near])
            found.append(np.unique(np.concatenate(pairs)))
        pairs = np.concatenate(found)
        window, item = pairs // len(self.owner), pairs % len(self.owner)
        keep = np.zeros(len(pairs), bool)
        for at in range(0, len(pairs), 20_000):
            mine, place = np.unique(window[at : at + 20_000], return_inverse=True)
            mine = shingles(codes[starts[mine][:, None] + np.arange(WINDOW)])
            keep[at : at + 20_000] = similarity(mine[place], self.shingles[item[at : at + 20_000]]) >= LEAST_ALIKE
        return window[keep], item[keep]

    def starts(self, codes: np.ndarray) -> np.ndarray:
        """Windows with at least as many words and pairs of the items as the similarity asks for; codes: -1 for other words."""
        known = codes >= 0
        both = known[:-1] & known[1:]
        pair = codes[:-1].astype(np.int64) * len(self.known) + codes[1:]
        both[both] = self.pairs[np.searchsorted(self.pairs, pair[both]).clip(max=len(self.pairs) - 1)] == pair[both]
        words, pairs = np.concatenate(([0], np.cumsum(known))), np.concatenate(([0], np.cumsum(both)))
        return np.flatnonzero(words[WINDOW:] - words[:-WINDOW] + pairs[WINDOW - 1 :] - pairs[: -WINDOW + 1] >= LEAST_SHARED)

    def leaks(self, texts: list[str]) -> list[set[int]]:
        """For each text the places, in item_ids, of the items that leak in it."""
        out: list[set[int]] = [set() for _ in texts]
        if not self.items:
            return out
        words = [words_of(t, self.known) if len(t) >= 2 * WINDOW else [] for t in texts]
        sizes = np.array([len(w) for w in words])
        known = self.known
        codes = np.fromiter((known.get(x, -1) for w in words for x in w), np.int32, sizes.sum())
        if len(codes) < WINDOW:
            return out
        text = np.repeat(np.arange(len(texts)), sizes)
        starts = self.starts(codes)
        starts = starts[text[starts] == text[starts + WINDOW - 1]]
        if not len(starts):
            return out
        if len(self.cache) > 500_000:  # far below the 2 ** 26 codes that a pair of words can hold
            self.cache = dict(known)
        begins = np.cumsum(sizes) - sizes
        for i in np.unique(text[starts]):
            codes[begins[i] : begins[i] + sizes[i]] = self.code(words[i])
        window, item = self.candidates(codes, starts)
        at, owner = starts[window], self.owner[item]
        mine = text[at] * len(self.items) + owner
        order = np.lexsort((at, mine))
        at, begun, mine = at[order], self.begin[item[order]], mine[order]
        # stretches of a message that hold candidates of one item, with room for a run around each
        cuts = np.flatnonzero((np.diff(mine) > 0) | (np.diff(at) > 2 * RUN)) + 1
        for p, g, m in zip(np.split(at, cuts), np.split(begun, cuts), np.split(mine, cuts)):
            if not len(m):
                continue
            i, k = divmod(int(m[0]), len(self.items))
            if k not in out[i]:
                low, high = begins[i], begins[i] + sizes[i]
                words_k = self.items[k][max(0, g.min() - 2 * RUN) : g.max() + WINDOW + 2 * RUN]
                if align(words_k, codes[max(low, p[0] - 2 * RUN - 8) : min(high, p[-1] + WINDOW + 2 * RUN + 8)]):
                    out[i].add(k)
        return out


#: The finders of this worker; building one takes seconds.
_FINDERS: dict[bytes, Finder] = {}


def _finder(items: list[tuple[int, str]]) -> Finder:
    key = xxhash.xxh3_128_digest(repr(items).encode())
    if key not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[key] = Finder(items)
    return _FINDERS[key]


def portions(texts: list[str], most: int) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` characters together; a longer text is a portion of its own."""
    some: list[str] = []
    size = 0
    for t in texts:
        if some and size + len(t) > most:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def _search(chats: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    shared = chats.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(shared.value)
        seen: dict[str, set[int]] = {}
        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            # texts repeat in dialogs (prompts, delivered again), so each is searched once
            fresh = [t for t in dict.fromkeys(t for texts in lists for t in texts) if t not in seen]
            here: dict[str, set[int]] = {}
            for some in portions(fresh, PORTION):
                here.update(zip(some, finder.leaks(some)))
            chat, item = [], []
            for chat_id, texts in zip(ids, lists):
                hits = sorted(set().union(*(here[t] if t in here else seen[t] for t in texts)))
                chat += [chat_id] * len(hits)
                item += [finder.item_ids[k] for k in hits]
            if len(seen) > 20_000:
                seen.clear()
            seen.update((t, h) for t, h in here.items() if len(t) <= 4000)
            yield pa.RecordBatch.from_arrays([pa.array(chat, pa.int64()), pa.array(item, pa.int64())], names=["chat_id", "item_id"])

    contents = F.filter(F.transform("messages", lambda m: m["content"]), lambda c: F.length(c) >= 2 * WINDOW)
    slim = spread(chats).filter("chat_id is not null").select(F.col("chat_id").cast("long").alias("chat_id"), contents.alias("texts")).filter(F.size("texts") > 0)
    return slim.mapInArrow(run, "chat_id long, item_id long")


def find_leaks(chats: DataFrame, items: DataFrame) -> DataFrame:
    """(chat_id, item_id) of every item that leaks in a message of the chat."""
    texts = items.filter("item_id is not null and item_text is not null").select(F.col("item_id").cast("long").alias("item_id"), "item_text").distinct()
    rows = sorted((r["item_id"], r["item_text"]) for r in texts.collect())  # the stated query set
    found = [_search(chats, rows[at : at + BLOCK]) for at in range(0, len(rows), BLOCK)]
    if not found:
        return chats.sparkSession.createDataFrame([], "chat_id long, item_id long")
    return reduce(DataFrame.unionByName, found).distinct()


def leak_report(chats: DataFrame, items: DataFrame) -> DataFrame:
    """Per item: the chats in which it leaks."""
    n = find_leaks(chats, items).groupBy("item_id").agg(F.count("*").alias("n_chats"))
    named = items.filter("item_id is not null").groupBy("item_id").agg(F.min("domain_name").alias("domain_name"), F.min("field_name").alias("field_name"))
    return named.join(n, "item_id", "left").na.fill(0, ["n_chats"])
