"""Garbled text from wrong character encoding: found, and restored where possible.

Method: best-first graph search. States are texts of a place (a stretch without blanks), edges are encode,
decode and unescape operations; a cost for the plausibility of each character beside its neighbours guides the
search to the cheapest text that can be reached; visited texts are kept in a hash set. A place is garbled where
the cheapest text is clearly cheaper than the place itself, or where it holds characters that stand for lost
bytes. It counts as restored only where the cheapest text is ahead of every other one by AHEAD, or where the other
garbled places of the text tell which reading holds; else it stays as it is and is counted as not restored. Places that are plausible as they are need no search, and the answers are kept
per worker.

The cost: a letter counts by the case and script of its neighbours (an accented capital after a small letter, Greek
inside a Latin word, a superscript before a letter are implausible), by whether the letters of its word belong to
one alphabet, and by whether it stands beside its neighbours in the pieces of a public vocabulary for many languages
(``Pairs``, some thousand pairs of letters; without the file only the alphabets count); a symbol by what stands around
it; a control character or one for a lost byte always counts much.

The graph: bytes of UTF-8 read in an encoding leave sequences that hardly arise otherwise, so such an edge is followed
as long as it makes the text cheaper, and texts so reached are only read so again. Encodings of one byte and of two
are exchanged as single last steps. So the graph is finite without any bound on states or depth.

Defined cases: null, empty and blank texts have no garbled place; drawn lines, formulas, other scripts and
escapes (HTML, URL, JSON) are left as they are; an escape is only undone where that leads to a cheaper text
than its plain reading. Texts are searched whole, whatever their length: a long place is searched in parts that
end between two plain ASCII characters, where no sequence and no escape does. Columns other than the id and the
text are ignored. A place that cannot be restored stays as it is in the restored text.
"""

from __future__ import annotations

import heapq
import html
import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.core import spread
from railyard.llm.encode import TOKENIZERS, read_ranks

#: Encodings in which UTF-8 bytes may have been read.
AS_READ = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1250", "cp1251", "cp852", "iso8859-2", "iso8859-15", "cp1253", "cp1254", "cp1257", "koi8-r", "cp866")
#: (read as, was) for texts of one byte a character, the likeliest first; of these also a part of a place may be garbled.
SWAPPED = (("cp437", "cp1252"), ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "mac_roman"), ("latin-1", "cp850"), ("latin-1", "mac_roman"), ("cp1252", "cp1250"), ("cp1251", "cp1252"), ("cp1252", "cp1251"))
#: All others of one byte that are tried, each read as each.
READ_ONE = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "koi8-r", "cp1250")
WAS_ONE = ("cp1251", "koi8-r", "cp866", "cp1250", "iso8859-2", "cp1253", "cp1254", "cp1257", "cp1255", "cp1256", "cp1252", "mac_roman", "cp852")
#: Encodings of two bytes, read as one of one byte.
WAS_TWO = ("cp932", "gbk", "euc_jp", "euc_kr", "big5")
#: A place is garbled if the cheapest text is cheaper by so much, and by so large a part of what the changed stretch costs.
MARGIN, PART = 3.0, 0.3
#: A place is restored if no other text comes so near to the cheapest.
AHEAD = 0.3
#: Garbled places from which on a text tells the alphabet of those that can be read in several ways.
ENOUGH = 3
#: A place is searched from so much above the cost of its characters on.
SUSPECT = 1.9
#: A text so little above the cost of its characters, for each of them, is not changed any further.
PLAUSIBLE, PLAUSIBLE_EACH = 0.9, 0.65
#: A place of more characters is searched in parts.
LONG = 200
VOCABULARY = "byte_bpe_multi_50k"

#: Letters beyond ASCII of the languages met most (fixed values): German, French, Spanish, Portuguese, Polish, Italian, Czech and
#: Slovak, Hungarian, Romanian, Turkish and Azerbaijani, Swedish, Finnish and Estonian, Danish and Norwegian, Icelandic, Croatian
#: and Slovene, Lithuanian, Latvian, Dutch, Catalan, Albanian, Welsh, Irish, Maltese, Esperanto.
ALPHABETS = [frozenset(letters + letters.upper().replace("SS", "")) for letters in (
    "äöüßẞ", "éèêëàâîïôùûüçœæÿ", "áéíóúñü", "ãõáéíóúâêôçàü", "ąćęłńóśźż", "àèéìíòóùú", "áäčďéěíĺľňóôŕřšťúůýž", "áéíóöőúüű", "ăâîșțşţ", "çğıöşüâîûəİ", "åäöéõüšž",
    "æøåéóòôéü", "áéíóúýþðæö", "čćđšž", "ąčęėįšųūž", "āčēģīķļņšūž", "éëïóöüèêáí", "àçèéíïòóúü", "çë", "âêîôûŵŷ", "áéíóú", "ċġħżàèìòù", "ĉĝĥĵŝŭ",
)]
#: Letters that stand alone as a word.
ALONE = set("àÀéÉèêóÓôÔáÁíÍúÚ")
QUOTES = set("“”„‟‚‘’‛«»‹›")
DASHES = set("–—−‐‑‒…•·")
LOST = "�"


def _kind(c: str) -> str:
    """a: ASCII letter, d: digit, s: blank, p: other ASCII, l: Latin letter beyond it, o: letter of another script,
    q: quote, h: dash, x: control or lost, b: box drawing, m: other."""
    n = ord(c)
    if n < 128:
        return "a" if c.isalpha() else "d" if c.isdigit() else "s" if c.isspace() else "p" if c.isprintable() else "x"
    if n < 0xA0 or c == LOST or 0xE000 <= n < 0xF900:
        return "x"
    if c in QUOTES:
        return "q"
    if c in DASHES:
        return "h"
    if c.isspace() or n in (0xAD, 0x200B, 0x200C, 0x200D, 0xFEFF) or 0xFE00 <= n < 0xFE10:
        return "s"
    if 0x2500 <= n < 0x25A0:
        return "b"
    if c in "ªºµⁿﬁﬂˆ˜ƒ":
        return "m"
    category = unicodedata.category(c)
    if category == "Cn":
        return "x"
    if category[0] == "L":
        return "l" if _latin(c) else "o"
    return "k" if category[0] == "M" else "m"


@lru_cache(maxsize=4096)
def _latin(c: str) -> bool:
    return unicodedata.name(c, "").startswith("LATIN")


@lru_cache(maxsize=8192)
def _script(c: str) -> str:
    script = unicodedata.name(c, "?").split(" ")[0].split("-")[0]
    return "CJK" if script in ("HIRAGANA", "KATAKANA", "HANGUL", "HALFWIDTH", "FULLWIDTH") else script


@lru_cache(maxsize=8192)
def kind(c: str) -> str:
    return _kind(c)


class Pairs:
    """Letters beyond ASCII and pairs with them, in small letters, that stand in the pieces of a vocabulary."""

    def __init__(self, pieces: list[str] = ()):
        self.letters = {c for p in pieces for c in p.lower() if c > "\x7f"}
        self.pairs = {x + y for p in pieces for x, y in zip(p.lower(), p.lower()[1:]) if not (x + y).isascii()}

    @classmethod
    @lru_cache(maxsize=4)
    def read(cls, folder: str = TOKENIZERS, name: str = VOCABULARY) -> Pairs:
        if not os.path.exists(os.path.join(folder, f"{name}.tiktoken")):
            return cls()
        pieces = (token.decode("utf-8", "ignore") for token in read_ranks(name, folder))
        return cls([p for p in pieces if not p.isascii() and "\x00" not in p])


_PAIRS = Pairs()


@lru_cache(maxsize=65536)
def foreign(letters: frozenset[str]) -> frozenset[str]:
    """Those of a word's letters beyond ASCII that are not of the alphabet that has most of them."""
    return min((letters - a for a in ALPHABETS), key=len)


def _unseen(c: str, before: str, after: str) -> int:
    """How many of the letters beside c does it not stand beside in the vocabulary."""
    pairs = _PAIRS.pairs
    if not pairs:
        return 0
    c, before, after = c.lower(), before.lower(), after.lower()
    return (before.isalpha() and before != c and before + c not in pairs) + (after.isalpha() and after != c and c + after not in pairs)


def _letter_cost(c: str, before: str, after: str, strange: bool) -> float:
    left, right = kind(before), kind(after)
    cost = (2.5 if strange else 1.0) + 0.3 * _unseen(c, before, after)
    if c.isupper():
        if before.islower() and left in "al":
            cost += 4
        if before.isupper() and left in "al" and after.islower() and right in "al":
            cost += 2
        if right in "mbxhq" and after not in "’":
            cost += 4 if right != "q" else 1
        if c == "Ã" and after not in "OESoes":
            cost += 3
        elif c == "Õ" and after not in "Ee":
            cost += 3
    else:
        if after.isupper() and right in "al":
            cost += 4
        if right in "mbx" and after not in "°":
            cost += 3
        if c == "ã" and not (after in "oesi" or right in "spqh"):
            cost += 4
        elif c == "õ" and after != "e":
            cost += 4
    if (left == "l" and before != c) or (right == "l" and after != c):
        cost += 1.5 if strange else 0.3
    if left in "bx" or (left == "m" and before in "√≈ƒ∂∫≠≤¬†‡∞"):
        cost += 2
    if left in "sp" and right in "sp" and c not in ALONE:
        cost += 3.5
    return cost


WORDS = re.compile(r"[^\W\d_]+")


def cost_of(text: str) -> float:
    """Implausibility of a stretch of text; ASCII costs nothing, any other character 1 where it is in its place."""
    if text.isascii():
        return 6.0 * sum(1 for c in text if c < " " and c not in "\t\r\n\x0b\x0c")
    total = 0.0
    padded = f" {text} "
    lone = len(text) < 10 and not any(c.isascii() and c.isalnum() for c in text)
    strange: frozenset[str] = frozenset()
    for w in WORDS.findall(text):
        if not w.isascii():
            strange |= foreign(frozenset(c for c in w if c > "\x7f" and kind(c) == "l"))
    for i, c in enumerate(text, 1):
        k = kind(c)
        if k in "adsp":
            if k == "s" and ord(c) > 127:
                total += 1
            continue
        before, after = padded[i - 1], padded[i + 1]
        left, right = kind(before), kind(after)
        letters = (left in "al") + (right in "al")
        if k == "x":
            total += 6
        elif k == "l":
            total += _letter_cost(c, before, after, c in strange) + (0.8 if lone else 0)
        elif k == "o":
            cased = (c.islower() and after.isupper() and right == "o") or (c.isupper() and before.islower() and left == "o")
            mixed = any(kind(x) == "o" and _script(x) != _script(c) for x in (before, after))
            single = left in "sp" and right in "sp"
            script = _script(c)
            total += 1.5 * (bool(_PAIRS.letters) and c.lower() not in _PAIRS.letters)
            if script == "CJK":
                total += 1 + 1.0 * bool(letters)
            else:
                total += 1 + 5 * bool(letters) + 4 * (cased or mixed) + 3 * (right in "mhq") + 1.5 * single
                total += (0.5 if script == "CYRILLIC" else 0.3) * _unseen(c, before, after)
        elif k == "k":
            total += (1 if left in "ok" else 4) + 1.5 * (bool(_PAIRS.letters) and c not in _PAIRS.letters)
        elif k == "q":
            inside = (letters == 2 and c != "’") or (c in "„‚" and left in "al")
            total += 1 + (0.5 if c in "«»‹›" else 0) + 1.5 * (c == "‘" and left in "al") + 5 * inside + (2 if left in "l" and before.isupper() and before in "ÃÂÄÅĂĹÔ" else 0)
        elif k == "h":
            total += 1 + (3 if letters == 2 and c in "…·" else 0) + (2.5 if letters and c == "•" else 0) + (2 if left in "alo" and right in "alo" else 0)
        elif k == "b":
            corner = left == "b" and c not in "─│═║━┃" and before not in "─│═║━┃" and not ("▀" <= c <= "▟" and "▀" <= before <= "▟")
            total += 1 + (5 if letters or left == "o" or right == "o" else 0) + 1.5 * corner
        elif c in "¹²³⁴ⁿ":
            total += 1 + (5 if right in "al" or (left in "al" and right == "m" and after not in "√²³") else 0)
        elif c in "°§€£$%‰µ½¼¾⅓⅔©®™":
            near = (left in "al") + (right in "al" and not (c == "°" and after in "CFKcfk") and not (c == "µ" and after in "mAsVFglH") and not (c in "©®™" and left in "sp"))
            near -= c in "®™©" and left in "al" and right in "spq"
            total += 1 + 4 * max(0, near) + (3 if left == "l" and before in "ÃÂãâÄÅ" else 0)
        elif c in "¿¡" and left in "sp":
            total += 1
        else:
            total += 1 + 4.5 * letters + (c > "\u2190" and bool(_PAIRS.letters) and c not in _PAIRS.letters)
        # signs, quotes and dashes of several kinds in a row
        if k in "mqh" and left in "mqh" and before != c:
            total += 0.8
    return total


def excess(text: str) -> float:
    """What a text costs beyond the least that its characters can cost."""
    return cost_of(text) - sum(c > "\x7f" for c in text)


def plausible(text: str, cost: float) -> bool:
    n = sum(c > "\x7f" for c in text)
    return cost - n < max(PLAUSIBLE, PLAUSIBLE_EACH * n)


def _sequences(encoding: str) -> tuple[re.Pattern, dict[str, int]] | None:
    """What UTF-8 sequences look like when read in an encoding, and the byte of each of its characters."""
    byte = {}
    for b in range(128, 256):
        try:
            byte[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            byte[chr(b)] = b  # as web browsers and many tools do
    by_byte = {b: c for c, b in byte.items()}
    chars = lambda a, z: "[" + re.escape("".join(by_byte[b] for b in range(a, z + 1) if b in by_byte)) + "]"
    more = chars(0x80, 0xBF)
    return re.compile(f"{chars(0xC2, 0xDF)}{more}|{chars(0xE0, 0xEF)}{more}{more}|{chars(0xF0, 0xF4)}{more}{more}{more}"), byte


def _reader(encoding: str) -> Callable[[str], str]:
    pattern, byte = _sequences(encoding)

    def again(m: re.Match) -> str:
        try:
            return bytes(byte[c] for c in m[0]).decode("utf-8")
        except UnicodeDecodeError:
            return m[0]

    return lambda text: pattern.sub(again, text)


def _swapper(read_as: str, was: str, all_letters: bool) -> Callable[[str], str]:
    """Each character by itself: all of a text (nothing where one has no byte in ``read_as``), or those that are no common letters."""
    table = {}
    for b in range(128, 256):
        try:
            table[ord(bytes([b]).decode(read_as))] = bytes([b]).decode(was)
        except UnicodeDecodeError:
            continue
    if all_letters:
        known = frozenset(map(chr, table))
        return lambda text: text.translate(table) if all(c < "\x80" or c in known for c in text) else text
    common = ALPHABETS[0] | ALPHABETS[1] | ALPHABETS[2] | ALPHABETS[3] | ALPHABETS[4]
    table = {n: c for n, c in table.items() if chr(n) not in common}
    return lambda text: text.translate(table)


_CONT = "[\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸÿ]"
_LOWERED = re.compile(f"([ãâåäðÿ])({_CONT})")
_RAISED = re.compile(f"Â(?=€{_CONT})")
_SPACED = re.compile("([Ãã])(?= |$)")


def _recase(text: str) -> str:
    """Undoes lower or upper case put upon garbled text."""
    raised = _LOWERED.sub(lambda m: (m[1] if m[2] == "€" else m[1].upper()) + ("Ÿ" if m[2] == "ÿ" else m[2]), text)
    return _RAISED.sub("â", raised)


_CUT_SHORT = re.compile(f"â€(?!{_CONT})")


def _quoted(text: str) -> str:
    """The closing quote, whose last byte has no character in cp1252 and is often dropped."""
    return _CUT_SHORT.sub("”", text)


def _unblank(text: str) -> str:
    """A no-break space that became a blank is part of a character again."""
    return _SPACED.sub("Ã\xa0", text)


def _unescape(text: str) -> str:
    return html.unescape(text) if "&" in text else text


def _whole(read_as: str, was: str) -> Callable[[str], str]:
    def run(text: str) -> str:
        try:
            return text.encode(read_as).decode(was)
        except UnicodeError:
            return text

    return run


def _wide(read_as: str, was: str) -> Callable[[str], str]:
    """Two bytes a character; only where all become East Asian signs, and known ones."""
    whole = _whole(read_as, was)

    def known(c: str) -> bool:
        return c < "\x80" or "\u3000" <= c < "\u3040" or "\uff00" <= c or (_script(c) == "CJK" and (not _PAIRS.letters or c in _PAIRS.letters))

    def run(text: str) -> str:
        new = whole(text)
        return new if all(map(known, new)) else text

    return run


def _lettered(step: Callable[[str], str]) -> Callable[[str], str]:
    """Without results that hold drawn lines or control characters."""

    def run(text: str) -> str:
        new = step(text)
        return text if any(kind(c) in "bx" for c in new) else new

    return run


Operation = tuple[Callable[[str], str], float]
UNESCAPE = 0.5


def _after(first: Callable[[str], str], second: Callable[[str], str]) -> Callable[[str], str]:
    """Both steps; a text in small letters stays so."""

    def run(text: str) -> str:
        if (new := first(text)) == text:
            return text
        return second(new).lower() if text == text.lower() else second(new)

    return run


#: UTF-8 read as something else leaves sequences that hardly arise otherwise: where undoing it helps, nothing else is tried.
SEQUENCES: list[Operation] = [(_reader(e), 0.1 + 0.02 * i) for i, e in enumerate(AS_READ)]
SEQUENCES += [(_after(f, _reader(e)), 0.3 + 0.02 * i) for f in (_recase, _unblank) for i, e in enumerate(AS_READ[:2])]
SEQUENCES += [(_quoted, 0.35)]
#: Steps of which one ends a path.
OTHERS: list[Operation] = [(_swapper(a, b, every), 0.4 + 0.02 * i + (not every) * 0.2) for i, (a, b) in enumerate(SWAPPED) for every in (True, False)]
OTHERS += [(_lettered(_swapper(a, b, True)), 1.0 + 0.02 * i) for i, (a, b) in enumerate((a, b) for b in WAS_ONE for a in READ_ONE if a != b and (a, b) not in SWAPPED)]
OTHERS += [(_whole(e, "utf-8"), 0.4) for e in ("gb18030", "cp932")] + [(_wide(a, b), 1.5 + 0.1 * i) for i, b in enumerate(WAS_TWO) for a in ("latin-1", "cp1252")]


def reachable(text: str) -> dict[str, float]:
    """The texts that operations lead to by best-first search, each with its cost and that of the path."""
    found = {text: cost_of(text)}
    queue = [(found[text], 0.0, False, text)]
    while queue:
        total, paid, read, at = heapq.heappop(queue)
        cost = total - paid
        if at != text and plausible(at, cost):
            continue
        clear = False
        for operation, price in SEQUENCES:
            new = operation(at)
            if new in found:
                continue
            new_cost = cost_of(new)
            found[new] = new_cost + paid + price
            if new_cost < cost:
                clear = clear or plausible(new, new_cost)
                heapq.heappush(queue, (new_cost + paid + price, paid + price, True, new))
        if read or clear:
            continue
        for operation, price in OTHERS:
            new = operation(at)
            if new not in found:
                found[new] = cost_of(new) + paid + price
        new = _unescape(at)
        if new not in found:
            found[new] = cost_of(new) + paid + UNESCAPE
            heapq.heappush(queue, (found[new], paid + UNESCAPE, False, new))
    return found


def changed(a: str, b: str) -> str:
    """The stretch of a that b has otherwise."""
    n = min(len(a), len(b))
    i = next((i for i in range(n) if a[i] != b[i]), n)
    j = next((j for j in range(n - i) if a[-1 - j] != b[-1 - j]), n - i)
    return a[i : len(a) - j]


def parts_of(place: str) -> list[str]:
    """A long place in parts of about LONG characters or more that end between two ASCII characters and not in an escape."""
    parts, at = [], 0
    for m in CUTS.finditer(place):
        if m.end() - at >= LONG:
            parts.append(place[at : m.end()])
            at = m.end()
    return [*parts, place[at:]] if at < len(place) else parts


#: An ASCII character, or a whole escape, before which an ASCII character stands and after which one follows.
CUTS = re.compile(r"(?<=[\x00-\x7f])(?:&[A-Za-z#][A-Za-z0-9]{0,30};|[\x00-\x25\x27-\x7f])(?=[\x00-\x7f])")
BLANKS = re.compile(r"([ \t\r\n]+)")


#: Texts of nothing but ASCII and sequences of UTF-8 read in an encoding, at least three of the latter.
TILED = [(re.compile(f"(?:[\\x00-\\x7f]*(?:{pattern.pattern})){{3,}}[\\x00-\\x7f]*"), _reader(e)) for e in AS_READ[:5] for pattern, _ in [_sequences(e)]]


def hidden(place: str) -> bool:
    """Whether a place whose characters are plausible by themselves (drawn lines, signs) is wholly made of sequences that stand for words."""
    for pattern, read in TILED:
        if pattern.fullmatch(place):
            new = read(place)
            if all(c.isalpha() for c in new if c > "\x7f") and plausible(new, cost_of(new)):
                return True
    return False


def letters_of(text: str) -> frozenset[str]:
    return frozenset(c for c in text if c > "\x7f" and kind(c) == "l")


class Mender:
    """Judges places of a text; keeps its answers."""

    def __init__(self, pairs: Pairs | None = None) -> None:
        global _PAIRS
        _PAIRS = Pairs.read() if pairs is None else pairs
        self.known: dict[str, tuple[bool, tuple[str, ...]]] = {}

    def judge(self, place: str) -> tuple[bool, tuple[str, ...]]:
        """(garbled, the texts that it may have been, the cheapest first; none but the place itself where that is unknown)"""
        if place not in self.known:
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[place] = self._judge(place)
        return self.known[place]

    @staticmethod
    def _judge(place: str) -> tuple[bool, tuple[str, ...]]:
        cost = cost_of(place)
        escaped = "&" in place and not html.unescape(place).isascii()
        least = sum(c > "\x7f" for c in place)
        if cost - least < SUSPECT and not (escaped and excess(html.unescape(place)) >= SUSPECT) and not hidden(place):
            return LOST in place, (place,)
        plain = html.unescape(place) if escaped else place
        base = max(cost, cost_of(plain)) if escaped else cost
        found = reachable(place)
        best = min(found, key=lambda t: (found[t], t))
        gain = base - found[best]
        if best not in (place, plain) and gain >= MARGIN and gain >= PART * min(base, cost_of(changed(plain, best))):
            return True, tuple(sorted((t for t, total in found.items() if total < found[best] + AHEAD), key=lambda t: (found[t], t)))
        return LOST in place, (place,)

    def restore(self, text: str | None) -> tuple[int, int, str | None]:
        """(garbled places, those of them not restored, the text with the others restored)

        A place that may have been one of several texts is restored where the text has at least ENOUGH garbled places and
        only one of its readings is written in the alphabet in which most of these can be read.
        """
        if not text or (text.isascii() and "&" not in text):
            return 0, 0, text
        parts = []
        for i, x in enumerate(BLANKS.split(text)):
            parts += parts_of(x) if len(x) > 2 * LONG and not i % 2 else [x]
        garbled: dict[int, tuple[str, ...]] = {}
        for i, place in enumerate(parts):
            if not place.isascii() or "&" in place:
                is_garbled, options = self.judge(place)
                if is_garbled:
                    garbled[i] = options
        if not garbled:
            return 0, 0, text
        alphabet: frozenset[str] = frozenset()
        if len(garbled) >= ENOUGH:
            alphabet = max(ALPHABETS, key=lambda a: sum(any(letters_of(o) <= a for o in options) for options in garbled.values()))
        lost = 0
        for i, options in garbled.items():
            fit = options if len(options) == 1 else [o for o in options if letters_of(o) <= alphabet]
            lost += len(fit) != 1 or fit[0] == parts[i] or LOST in fit[0]
            if len(fit) == 1:
                parts[i] = fit[0]
        return len(garbled), lost, "".join(parts)


def find_garbled(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """One row for each document with a garbled place: id, n_places, n_unrestored, restored (the text). Row-local.

    Pure ASCII texts without an entity are set aside before they reach Python.
    """

    shared = documents.sparkSession.sparkContext.broadcast(Pairs.read(folder))  # some thousand pairs of letters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mender = Mender(shared.value)
        for batch in batches:
            rows = [(i, *mender.restore(t)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            rows = [r for r in rows if r[1]]
            columns = list(zip(*rows)) if rows else [()] * 4
            types = [pa.int64(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[id_col, "n_places", "n_unrestored", "restored"])

    slim = spread(documents).select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).filter(F.col(text_col).rlike(r"[^\x00-\x7f]|&[A-Za-z#]"))
    return slim.mapInArrow(run, f"{id_col} long, n_places int, n_unrestored int, restored string")
