"""Same or near-same records across splits.

Method: similarity-hash bit fingerprints. Each ticket gets a 256-bit SimHash of its words and of its values (numbers,
dates, times, each in one spelling, and neighbouring pairs of them), a value weighing VALUE_WEIGHT words, since a
changed value makes another request and a changed word need not. The fingerprint is cut into eight blocks of 32
bits; tickets of the training split and of the evaluation splits that share a block are joined: by the pigeonhole
principle all pairs within a Hamming radius of 7. Candidates are verified on templates and texts, then counted by split
and source.

A ticket without any value has only words, and one slip turns about a tenth of its bits, so it is fingerprinted by
the letter triples of its words and met through blocks of 20 bits of PERMUTATIONS permuted copies of the
fingerprint, within a radius of 64: with n bits of 256 turned a block stays whole with (1 - n / 256) ** 20.

Tickets of equal content form one class, and only classes are joined: a group of copies costs one row per block. A
block that many classes share is cut on both sides into parts of about HOT classes, and each part meets each of the
other side. Reports count by the sizes of classes; only ``overlap_pairs`` expands them to tasks.

Verification: small talk (sentences that are frequent in the corpus, also with slips) and greetings are set
aside; the values must be equal; the words are aligned, slips of the pen are matched, and a replaced word
counts as a changed value where both words are about equally frequent, as the alternatives of one slot are
(a slip or a synonym is far rarer than the word it stands for; of two rare words that differ by a slip, one may be
the other's slip, but not where names and codes stand). A frequent sentence that is one of several alternatives
(others about as frequent differ from it in a word or two) holds values and is no small talk. These verdicts rest
on the frequencies in the corpus, by WORD_SHARE, TALK_SHARE and RIVAL. Frequent words and sentences are bounded
tables: at most (mean words) / SHARE of them can reach a share of the corpus.

Defined cases
- a null ticket, or one without words, matches nothing; a null or empty template fits any.
- repeated exports of a task_no count once (the first by exported_at); tasks without a split are left out, as
  are splits of unknown tasks; repeated split rows count once. Columns not named here are ignored.
- a task that is in sft_train and in an evaluation split is paired with others on both sides, never with itself.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.core import bound, checkpointed, clean_label

TRAIN = "sft_train"
EVAL = ("heldout_eval", "sft_val", "rl_val")
RADIUS, BLOCKS = 7, 8
#: Words that a value weighs in the fingerprint.
VALUE_WEIGHT = 12
#: Of tickets without values: permuted copies, bits of a block, radius.
PERMUTATIONS, WORD_BLOCK, WORD_RADIUS = 5, 20, 64
#: Classes that a part of a block holds about.
HOT = 2000
#: Share of the distinct tickets from which on a word, and a sentence, is frequent.
WORD_SHARE, TALK_SHARE = 0.0002, 0.01
#: Two words are alternatives of one slot where the rarer has at least this part of the other's frequency.
RIVAL = 0.1
LEAST_ALIKE = 0.7
#: Most words of a greeting.
LEAD = 3
#: Share of its words that a sentence has in common with a frequent one where it is that one, reworded.
TALK_ALIKE = 0.5

MONTHS = {name: i % 12 + 1 for i, name in enumerate(
    "januar februar maerz april mai juni juli august september oktober november dezember "
    "january february march april may june july august september october november december".split()
)}
MONTHS |= {name[:3]: n for name, n in MONTHS.items()} | {"mrz": 3}
_NAMES = "|".join(sorted(MONTHS, key=len, reverse=True))
ISO_DATE = re.compile(r"(?<![\w-])(\d{4})-(\d{1,2})-(\d{1,2})(?![\w-]*\d)")
DAY_DATE = re.compile(r"(?<![\w.])(\d{1,2})\s?[./-]\s?(\d{1,2})\s?[./-]\s?(\d{4}|\d{2})(?!\d)")
NAMED_DATE = re.compile(rf"(?<!\w)(\d{{1,2}})(?:\.|st|nd|rd|th)?\s+(?:of\s+)?({_NAMES})\.?,?\s+(\d{{4}})(?!\d)")
DATE_NAMED = re.compile(rf"(?<!\w)({_NAMES})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?!\d)")
TIME = re.compile(r"(?<![\w.:])(\d{1,2})\s?[:.]\s?(\d{2})(?::00)?(?![\d:]|\.\d)(?:\s?(am|pm|a\.m\.|p\.m\.)(?!\w))?(?:\s?(?:uhr|h)\b)?")
HOUR = re.compile(r"(?<!\w)(\d{1,2})\s?uhr(?:\s?(\d{2})(?!\d))?")
AM_PM = re.compile(r"(?<![\w.:])(\d{1,2})\s?(am|pm)(?!\w)")
DIGIT = re.compile(r"\d")
ANY_MONTH = re.compile(rf"\d\w{{0,2}}\.?\s+(?:of\s+)?(?:{_NAMES})|(?:{_NAMES})\.?\s+\d")
HALF_DAY = re.compile(r"\d\s?[ap]m")
WIDE_BLANK = re.compile(r"[^\S\n ]+ *|  +[^\S\n]*")
TOKEN = re.compile(r"[DT]\d+|[^\W\d_]+|\d+")
SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n\s*\n")
GREETING = re.compile(r"^((?:[^\W\d_]+ ){0,2}[^\W\d_]+)\s?[,!:]+\s")
INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿]")


def _date(y: str, m: str | int, d: str) -> str:
    return f" D{int(y) + (2000 if len(y) == 2 else 0):04d}{int(m):02d}{int(d):02d} "


def _time(h: str, m: str | None, half: str | None = None) -> str:
    hour = int(h) % 12 + 12 * (half[0] == "p") if half else int(h)
    return f" T{hour:02d}{int(m or 0):02d} "


def canonical(text: str) -> str:
    """One spelling of letters, dates and times; dates become D20260131, times T0912."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", INVISIBLE.sub("", text))
    text = text.casefold().replace("ä", "ae").replace("ö", "oe").replace("ü", "ue")
    text = WIDE_BLANK.sub(" ", text)
    if not DIGIT.search(text):
        return text
    # each form is looked for only where a part of it stands
    if "-" in text:
        text = ISO_DATE.sub(lambda m: _date(*m.groups()), text)
    if ANY_MONTH.search(text):
        text = NAMED_DATE.sub(lambda m: _date(m[3], MONTHS[m[2]], m[1]), text)
        text = DATE_NAMED.sub(lambda m: _date(m[3], MONTHS[m[1]], m[2]), text)
    text = DAY_DATE.sub(lambda m: _date(m[3], m[2], m[1]), text)
    text = TIME.sub(lambda m: _time(m[1], m[2], m[3]), text)
    if HALF_DAY.search(text):
        text = AM_PM.sub(lambda m: _time(m[1], None, m[2]), text)
    return HOUR.sub(lambda m: _time(m[1], m[2]), text) if "uhr" in text else text


def tokens_of(text: str) -> list[str]:
    return [t.lstrip("0") or "0" if t[0].isdigit() else t for t in TOKEN.findall(text)]


def sentences_of(text: str | None) -> list[str]:
    """The sentences of a ticket as words joined by blanks; a greeting before the first counts as one."""
    out = []
    for part in SENTENCE.split(canonical(text or "")):
        part = part.strip() + " "
        if m := GREETING.match(part):
            out.append(" ".join(tokens_of(m[1])))
            part = part[m.end() :]
        out.append(" ".join(tokens_of(part)))
    return [s for s in out if s]


def has_number(token: str) -> bool:
    return token[-1].isdigit()


def slots(sentence: str, other: str) -> bool:
    """Whether the two are one sentence with other words in one place or two, not by slips."""
    a, b = sentence.split(), other.split()
    if len(a) != len(b) or len(a) < 4:
        return False
    changed = [(x, y) for x, y in zip(a, b) if x != y]
    return 0 < len(changed) <= max(1, len(a) // 4) and not all(slip(x, y) for x, y in changed)


def small_talk(counts: dict[str, int], least: float, least_lead: float) -> list[str]:
    """The sentences without a number in at least ``least`` tickets (``least_lead`` for those of at most LEAD words), but for those
    that are one of several alternatives."""
    plain = {s: n for s, n in counts.items() if not any(map(has_number, s.split()))}
    enough = lambda s, n: n >= (least_lead if len(s.split()) <= LEAD else least)
    return sorted(s for s, n in plain.items() if enough(s, n) and not any(m >= RIVAL * n and slots(s, other) for other, m in plain.items()))


class Talk:
    """Knows the frequent sentences and takes them out of a ticket, also where they have slips. frequency: tickets per frequent word."""

    def __init__(self, frequent: list[str], frequency: dict[str, int], least: float):
        self.exact, self.frequency, self.least = set(frequent), frequency, least
        self.phrases = sorted((f" {s} " for s in frequent if len(s.split()) > 3), key=len, reverse=True)
        self.any = ahocorasick.Automaton()
        for p in self.phrases:
            self.any.add_word(p, p)
        self.any.make_automaton()
        # a frequent sentence shares at least one of any half of its words and one more with a sentence that is it, reworded
        self.by_word: dict[str, list[str]] = {}
        for s in frequent:
            words = sorted(set(s.split()), key=lambda w: (frequency.get(w, 0), w))
            for w in words[: int(len(words) * (1 - TALK_ALIKE)) + 1] if len(s.split()) > 3 else ():
                self.by_word.setdefault(w, []).append(s)
        self.known: dict[str, bool] = {}

    def reworded(self, words: list[str], talk: list[str]) -> bool:
        """Whether a sentence is a frequent one in other words: at least half are the same, and no words stand for others about as frequent, as values do."""
        if len(set(words) & set(talk)) < TALK_ALIKE * max(len(set(words)), len(set(talk))):
            return False
        for op, i, j, k, m in SequenceMatcher(None, talk, words, autojunk=False).get_opcodes():
            if op == "replace":
                x, y = (min(self.frequency.get(w, self.least / 2) for w in part) for part in (talk[i:j], words[k:m]))
                if min(x, y) >= RIVAL * max(x, y) and not slip(" ".join(talk[i:j]), " ".join(words[k:m])):
                    return False
        return True

    def is_talk(self, sentence: str) -> bool:
        if sentence in self.exact:
            return True
        if sentence not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            words = sentence.split()
            near = {b for w in words for b in self.by_word.get(w, ())} if not any(map(has_number, words)) else ()
            self.known[sentence] = any(self.reworded(words, b.split()) for b in near)
        return self.known[sentence]

    def core(self, sentences: list[str]) -> str:
        """What remains; a ticket of nothing but frequent sentences stays as it is."""
        rest = []
        for s in sentences:
            if self.is_talk(s):
                continue
            s = f" {s} "
            if len(self.any) and next(self.any.iter(s), None):
                for p in self.phrases:
                    if p in s:
                        s = s.replace(p, " ")
            if s.strip():
                rest.append(s.strip())
        return " ".join(rest or sentences)


_BITS: dict[str, np.ndarray] = {}


def _bits(feature: str) -> np.ndarray:
    """+1 or -1 for each of the 256 bits of the feature's hash."""
    if (b := _BITS.get(feature)) is None:
        if len(_BITS) > 200_000:
            _BITS.clear()
        raw = np.frombuffer(xxhash.xxh3_128_digest(feature.encode(), 1) + xxhash.xxh3_128_digest(feature.encode(), 2), np.uint8)
        b = _BITS[feature] = np.unpackbits(raw).astype(np.int8) * 2 - 1
    return b


def features(core: str) -> tuple[list[str], list[str]]:
    """(words or letter triples, values and neighbouring pairs of them) of a text; the latter are empty where it has no value."""
    words = set(core.split())
    values = sorted(filter(has_number, words))
    if values:
        # pairs of values keep one of few (a date that many tickets have) from ruling the sum
        return sorted(words.difference(values)), [*values, *(f"{a} {b}" for a, b in zip(values, values[1:]))]
    return sorted({f" {w} "[i : i + 3] for w in words for i in range(len(w))}), []


def fingerprints(cores: list[str]) -> list[tuple[np.ndarray, bool] | None]:
    """For each text the 256 bits of the SimHash, and whether it has values; None for a text without words."""
    out: list[tuple[np.ndarray, bool] | None] = []
    for at in range(0, len(cores), 512):
        found = [features(c) for c in cores[at : at + 512]]
        rows = [_bits(f) for few, many in found for f in (*few, *many)]
        weights = [w for few, many in found for w in (*[1] * len(few), *[VALUE_WEIGHT] * len(many))]
        sizes = np.array([len(few) + len(many) for few, many in found])
        totals = np.zeros((len(found), 256), np.int32)
        if rows:
            weighted = np.stack(rows).astype(np.int16)
            weighted *= np.array(weights, np.int16)[:, None]
            totals[sizes > 0] = np.add.reduceat(weighted, (np.cumsum(sizes) - sizes)[sizes > 0], axis=0, dtype=np.int32)
        out += [(t > 0, bool(many)) if few or many else None for t, (few, many) in zip(totals, found)]
    return out


_ORDER = np.concatenate([np.random.RandomState(seed).permutation(256)[: 256 // WORD_BLOCK * WORD_BLOCK] for seed in range(PERMUTATIONS)])
_WORTH = 1 << np.arange(WORD_BLOCK, dtype=np.int64)


def blocks_of(bits: np.ndarray, has_values: bool) -> np.ndarray:
    """The keys under which a fingerprint is met: the place of a block and its bits in one number."""
    if has_values:
        blocks = np.packbits(bits).view(">u4").astype(np.int64)
        return blocks + (np.arange(BLOCKS, dtype=np.int64) << 32)
    blocks = bits[_ORDER].reshape(-1, WORD_BLOCK) @ _WORTH
    return blocks + (np.arange(BLOCKS, BLOCKS + len(blocks), dtype=np.int64) << 32)


def slip(a: str, b: str, most: int = 2) -> bool:
    """Whether b is a with at most two slips (one in a short word): a letter left out, added, changed or two swapped."""
    most = 1 if min(len(a), len(b)) < 6 else most
    if abs(len(a) - len(b)) > most or min(len(a), len(b)) < 3:
        return False
    before2, before = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if before2 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], before2[j - 2] + 1)
        before2, before = before, row
    return before[-1] <= most


def shortened(word: str) -> set[str]:
    """The word, and it without any one of its letters."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


class Verifier:
    """Decides whether two tickets make the same request. frequency: tickets per frequent word; least: below that none is known;
    naming: frequent words after which a rare one stands as a rule, so that it is a name or code."""

    def __init__(self, frequency: dict[str, int], least: float, naming: frozenset[str] = frozenset()):
        self.frequency, self.least, self.naming = frequency, max(1.0, least), naming
        self.slips: dict[str, str] = {}
        # two words that differ by one slip share a form with one letter less; words of two swapped letters do as well
        self.by_shortened: dict[str, list[str]] = {}
        for w, n in frequency.items():
            if n >= 10 * self.least:
                for d in shortened(w):
                    self.by_shortened.setdefault(d, []).append(w)

    def rivals(self, a: str, b: str) -> bool:
        """Whether two words or phrases are about equally frequent; a phrase counts as its rarest word."""
        x, y = (min(self.frequency.get(w, self.least / 2) for w in p.split()) for p in (a, b))
        return min(x, y) >= RIVAL * max(x, y)

    def may_be_slip(self, x: str, y: str, before: str) -> bool:
        """Whether a difference of x and y may be a slip: not where both are alternatives of one slot, unless both are rare and no name stands there."""
        rare = x not in self.frequency and y not in self.frequency and min(len(x), len(y)) > 3
        return not self.rivals(x, y) or (rare and before not in self.naming)

    def mended(self, words: list[str], other: set[str]) -> list[str]:
        """``words`` with rare ones that the other side lacks read as the frequent word of which they are a slip."""
        return [self.mend(w) if w not in self.frequency and w not in other else w for w in words]

    def mend(self, word: str) -> str:
        """The most frequent of the words, each far more frequent than a rare one, of which this is one slip."""
        if word not in self.slips:
            near = {w for d in shortened(word) for w in self.by_shortened.get(d, ())} if len(word) > 3 else ()
            near = [(self.frequency[w], w) for w in near if slip(word, w, 1)]
            if len(self.slips) > 100_000:
                self.slips.clear()
            self.slips[word] = max(near)[1] if near else word
        return self.slips[word]

    def same(self, a: str, b: str) -> bool:
        if a == b:
            return True
        left, right = a.split(), b.split()
        if Counter(filter(has_number, left)) != Counter(filter(has_number, right)):
            return False
        left = [w for w in left if not has_number(w)]
        right = [w for w in right if not has_number(w)]
        only_left, only_right = Counter(left) - Counter(right), Counter(right) - Counter(left)
        if len(left) + len(right) == 0:
            return True
        # slips: the word of one side that stands for one of the other
        for y in list(only_right):
            for x in list(only_left):
                if only_left[x] and only_right[y] and slip(x, y) and self.may_be_slip(x, y, left[left.index(x) - 1] if left.index(x) else ""):
                    right[right.index(y)] = x
                    only_left[x] -= 1
                    only_right[y] -= 1
        left, right = self.mended(left, set(right)), self.mended(right, set(left))
        left, right = self.joined(left, right), self.joined(right, left)
        kept = 0
        for op, i, j, k, m in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
            if op == "equal":
                kept += j - i
            elif op == "replace" and j - i <= 3 and m - k <= 3:
                pairs = zip(left[i:j], right[k:m]) if j - i == m - k else [(" ".join(left[i:j]), " ".join(right[k:m]))]
                if any(self.rivals(x, y) for x, y in pairs):
                    return False
        return 2 * kept >= LEAST_ALIKE * (len(left) + len(right))

    @staticmethod
    def joined(words: list[str], other: list[str]) -> list[str]:
        """``words`` with two neighbours written as one where the other side writes them so."""
        wanted = set(other) - set(words)
        out: list[str] = []
        for w in words:
            if out and out[-1] + w in wanted:
                out[-1] += w
            else:
                out.append(w)
        return out


def tasks_in_splits(tasks: DataFrame, splits: DataFrame) -> DataFrame:
    """One row per task_no in a split of interest: ticket, template, source, is_train and its evaluation splits."""
    s = splits.select("task_id", clean_label("split").alias("split")).filter(F.col("split").isin(TRAIN, *EVAL) & F.col("task_id").isNotNull())
    s = s.groupBy("task_id").agg(F.max(F.col("split") == TRAIN).alias("is_train"), F.collect_set(F.when(F.col("split") != TRAIN, F.col("split"))).alias("eval_splits"))
    row = F.struct("task_id", "ticket", clean_label("template").alias("template"), "source")
    t = tasks.filter("task_no is not null").groupBy("task_no").agg(F.min_by(row, F.struct(F.col("exported_at").isNull(), "exported_at", "ticket")).alias("row"))
    return t.select("task_no", "row.*").join(s, "task_id")


def _sentences(tasks: DataFrame) -> DataFrame:
    @F.pandas_udf("array<string>")
    def split(tickets: pd.Series) -> pd.Series:
        return tickets.map(sentences_of)

    return tasks.withColumn("sentences", split(F.col("ticket").cast("string"))).drop("ticket").filter(F.size("sentences") > 0)


def _naming(rows: DataFrame, known: dict[str, int]) -> frozenset[str]:
    """Frequent words followed by a rare word more often than not; at most as many as there are frequent words."""
    if not known:
        return frozenset()
    frequent = F.broadcast(rows.sparkSession.createDataFrame([(w,) for w in known], "word string"))
    words = F.filter(F.split("core", " "), lambda w: ~w.rlike(r"\d$"))
    pairs = bound(words, lambda w: F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.struct(x.alias("before"), F.get(w, i + 1).alias("word"))))
    n = rows.select(F.explode(pairs).alias("p")).groupBy("p.before", "p.word").agg(F.count("*").alias("n"))
    n = n.join(frequent.withColumnRenamed("word", "before"), "before", "left_semi").join(frequent.withColumn("known", F.lit(True)), "word", "left")
    share = n.groupBy("before").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("rare"))
    return frozenset(r["before"] for r in share.filter("2 * rare > all").collect())


def _frequent(texts: DataFrame, n: int) -> tuple[dict[str, int], dict[str, int], float]:
    """(tickets of each frequent sentence and of its likely alternatives; of each frequent word; the least number of the latter):
    few, whatever the corpus holds."""
    least = max(1.0, WORD_SHARE * n)
    words = F.array_distinct(F.flatten(F.transform("sentences", lambda s: F.split(s, " "))))
    both = F.concat(
        F.transform(F.array_distinct("sentences"), lambda s: F.struct(F.lit(True).alias("whole"), s.alias("value"))),
        F.transform(F.filter(words, lambda w: ~w.rlike(r"\d$")), lambda w: F.struct(F.lit(False).alias("whole"), w.alias("value"))),
    )
    counts = texts.select(F.explode(both).alias("x")).groupBy("x.whole", "x.value").agg(F.count("*").alias("n"))
    rows = counts.filter(F.col("n") >= F.when(F.col("whole"), F.lit(max(3.0, RIVAL * TALK_SHARE * n))).otherwise(F.lit(least))).collect()
    return {r["value"]: r["n"] for r in rows if r["whole"]}, {r["value"]: r["n"] for r in rows if not r["whole"]}, least


def classes_of(tasks: DataFrame) -> tuple[DataFrame, DataFrame, Verifier]:
    """(members: task_no, class_id, source, is_train, eval_splits; classes: class_id, core, template, is_train, is_eval, bits, blocks; the verifier)."""
    rows = checkpointed(_sentences(tasks))
    texts = checkpointed(rows.select("sentences").distinct())  # a ticket counts once, however many copies it has
    lead = F.col("sentences")[0]
    has_lead = (F.size("sentences") > 1) & (F.size(F.split(lead, " ")) <= LEAD)
    n, leads = texts.agg(F.count("*"), F.count_if(has_lead)).collect()[0]
    sentences, known, least = _frequent(texts, n)
    talk = small_talk(sentences, max(3.0, TALK_SHARE * n), max(3.0, min(TALK_SHARE * n, TALK_SHARE * leads)))  # a greeting among those tickets that have one
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast((talk, known, least))

    @F.pandas_udf("string")
    def core(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        talk = Talk(*shared.value)
        for sentences in batches:
            yield sentences.map(lambda x: talk.core(list(x)))

    rows = rows.withColumn("core", core("sentences")).drop("sentences")
    rows = checkpointed(rows.withColumn("class_id", F.unhex(F.md5(F.concat_ws("\x00", F.coalesce(F.concat(F.lit("t"), F.col("template")), F.lit("n")), "core")))))

    @F.pandas_udf("struct<bits:array<long>,blocks:array<long>>")
    def prints(cores: pd.Series) -> pd.DataFrame:
        found = fingerprints(cores.tolist())
        return pd.DataFrame({"bits": [np.packbits(p[0]).view(">i8").astype(np.int64) if p else None for p in found], "blocks": [blocks_of(*p) if p else None for p in found]})

    classes = rows.groupBy("class_id").agg(
        F.first("core").alias("core"), F.first("template").alias("template"), F.max("is_train").alias("is_train"), F.max(F.size("eval_splits") > 0).alias("is_eval")
    )
    classes = checkpointed(classes.withColumn("p", prints("core")).select("*", "p.bits", "p.blocks").drop("p").filter("bits is not null"))
    return rows.drop("core", "template"), classes, Verifier(known, least, _naming(classes, known))


def candidates(classes: DataFrame) -> DataFrame:
    """Pairs (train_class, eval_class) that share a block, each once."""
    keys = classes.select("class_id", "is_train", "is_eval", F.explode("blocks").alias("block"))
    # most blocks are of one class only and go no further than this count; a block of many classes is cut on both sides into
    # parts of about HOT, and each part meets each of the other side
    parts = keys.groupBy("block").agg(F.count_if("is_train").alias("n_train"), F.count_if("is_eval").alias("n_eval")).filter("n_train > 0 and n_eval > 0")
    parts = parts.select("block", *(F.ceil(F.col(f"n_{x}") / HOT).cast("int").alias(f"{x}_parts") for x in ("train", "eval")))
    keys = keys.join(parts, "block")

    def cut(mine: str, other: str) -> DataFrame:
        rows = keys.filter(f"is_{mine}").withColumn(f"{mine}_part", F.pmod(F.xxhash64("class_id"), F.col(f"{mine}_parts")).cast("int"))
        rows = rows.withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)))
        return rows.select("block", "train_part", "eval_part", F.col("class_id").alias(f"{mine}_class"))

    return cut("train", "eval").join(cut("eval", "train"), ["block", "train_part", "eval_part"]).select("train_class", "eval_class").distinct()


def overlap_classes(classes: DataFrame, verifier: Verifier) -> DataFrame:
    """Verified pairs (train_class, eval_class)."""
    texts = classes.select("class_id", "core", "template", "bits", (F.size("blocks") > BLOCKS).alias("plain"))
    side = lambda name, x: texts.select(F.col("class_id").alias(name), F.struct("core", "template", "bits", "plain").alias(x))
    pairs = candidates(classes).join(side("train_class", "x"), "train_class").join(side("eval_class", "y"), "eval_class")
    fit = F.coalesce(F.col("x.template") == F.col("y.template"), F.lit(True))
    away = [F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(4)]
    near = (F.col("x.plain") == F.col("y.plain")) & (sum(away[1:], away[0]) <= F.when(F.col("x.plain"), WORD_RADIUS).otherwise(RADIUS))
    shared = classes.sparkSession.sparkContext.broadcast((verifier.frequency, verifier.least, verifier.naming))

    @F.pandas_udf("boolean")
    def same(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        check = Verifier(*shared.value)
        for x, y in batches:
            yield pd.Series([check.same(p, q) for p, q in zip(x, y)], dtype=bool)

    return pairs.filter(fit & near).filter(same("x.core", "y.core")).select("train_class", "eval_class")


def overlap_pairs(tasks: DataFrame, splits: DataFrame) -> DataFrame:
    """(task_no_a, task_no_b), a < b, each pair of tasks once: the classes expanded, as the last step."""
    rows, classes, verifier = classes_of(tasks_in_splits(tasks, splits))
    a = rows.filter("is_train").select(F.col("class_id").alias("train_class"), F.col("task_no").alias("train_task"))
    b = rows.filter(F.size("eval_splits") > 0).select(F.col("class_id").alias("eval_class"), F.col("task_no").alias("eval_task"))
    pairs = overlap_classes(classes, verifier).join(a, "train_class").join(b, "eval_class").filter("train_task <> eval_task")
    return pairs.select(F.least("train_task", "eval_task").alias("task_no_a"), F.greatest("train_task", "eval_task").alias("task_no_b")).distinct()


def overlap_report(tasks: DataFrame, splits: DataFrame) -> DataFrame:
    """Per evaluation split and source: overlapping pairs, and tasks of either side that are in one.

    From the sizes of classes: a class pair has (train tasks) x (evaluation tasks) pairs, less those of a task with itself.
    """
    rows, classes, verifier = classes_of(tasks_in_splits(tasks, splits))
    links = checkpointed(overlap_classes(classes, verifier))
    group = ["eval_split", "source"]
    train = rows.filter("is_train").groupBy(F.col("class_id").alias("train_class")).agg(F.count("*").alias("n_train"))
    evals = rows.withColumn("eval_split", F.explode("eval_splits")).groupBy(F.col("class_id").alias("eval_class"), *group)
    evals = evals.agg(F.count("*").alias("n_eval"), F.count_if("is_train").alias("n_both"))
    both = links.join(train, "train_class").join(evals, "eval_class").withColumn("own", F.when(F.col("train_class") == F.col("eval_class"), F.col("n_both")).otherwise(F.lit(0)))
    # an evaluation task that is a train task too has itself among the train tasks of its class
    per_eval = both.groupBy("eval_class", *group).agg(
        F.sum(F.col("n_train") * F.col("n_eval") - F.col("own")).alias("n_pairs"), F.max("n_eval").alias("n_eval"), F.max("own").alias("own"), F.sum("n_train").alias("n_train")
    )
    per_eval = per_eval.groupBy(*group).agg(F.sum("n_pairs").alias("n_pairs"), F.sum(F.when(F.col("n_train") > 1, F.col("n_eval")).otherwise(F.col("n_eval") - F.col("own"))).alias("n_eval_tasks"))
    per_train = both.groupBy("train_class", *group).agg(F.max("n_train").alias("n_train"), F.max("own").alias("own"), F.sum("n_eval").alias("n_eval"))
    per_train = per_train.groupBy(*group).agg(F.sum(F.when(F.col("n_eval") > 1, F.col("n_train")).otherwise(F.col("n_train") - F.col("own"))).alias("n_train_tasks"))
    on = reduce(lambda x, y: x & y, (per_eval[c].eqNullSafe(per_train[c]) for c in group))
    return per_eval.join(per_train, on).select(*(per_eval[c] for c in group), "n_pairs", "n_eval_tasks", "n_train_tasks").filter("n_pairs > 0")
