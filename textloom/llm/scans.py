"""Problem 1: noise in text from scanned pages, and its repair.

Running headers and page numbers are found first, by their likeness to the title or the source's name and by their
form. The lines that are left are de-lined: their letters become one stream for the whole document, in which spaces,
line ends and hyphens at line ends are marked gaps. One Viterbi search over the places of the stream chooses the words
of least cost. An arc of its lattice is a known word as it stands, a known word with misread characters, one that goes
on over gaps (a merge), one of several that stand together without a gap (a split), any of these at once, or an
unknown word. What the classes say is read from the arcs of the best path: a word over a hyphen at a line's end, or
one with misread characters, a stray space, a lacking space. Far from any unknown word or hyphen there is only one
arc for each word, so the search is linear. The words known are those of the other formats of the corpus, counted over
all documents. Paragraph boundaries are then chosen by dynamic programming over the lines that are left.
"""

from __future__ import annotations

import bisect
import difflib
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import BitFilter, bit_filter, cut_lineage, emit, format_of, map_arrow, parts_for, spread

#: How often a word must be read to be in the lexicon; bytes of a lexicon that goes to every task; of a block of documents.
LEAST_COUNT, LEXICON_BYTES, BLOCK_BYTES = 3, 64 << 20, 4 << 20
#: What a scanner reads, and what stood there.
CONFUSIONS = (
    ("ii", "u"), ("c", "e"), ("@", "a"), ("l", "i"), ("0", "o"), ("5", "s"), ("†", "t"), ("ri", "n"), ("cl", "d"), ("d", "cl"), ("1", "l"), ("1", "i"), ("rn", "m"), ("y", "v"), ("9", "g"), ("6", "b"), ("li", "h"),
    ("vv", "w"), ("$", "s"), ("h", "b"), ("2", "z"), ("8", "b"), ("4", "a"), ("3", "e"), ("|", "l"), ("|", "i"), ("!", "i"), ("€", "e"), ("i", "l"), ("7", "t"), ("nn", "m"), ("in", "m"), ("6", "ó"), ("g", "q"), ("fi", "ñ"), ("m", "rn"), ("ﬁ", "fi"), ("ﬂ", "fl"),
    ("ì", "í"), ("ë", "é"), ("è", "é"), ("à", "á"), ("ò", "ó"), ("ù", "ú"), ("ï", "í"), ("ä", "á"), ("ö", "ó"), ("ü", "ú"), ("é", "è"), ("á", "à"), ("ê", "é"), ("â", "á"), ("ã", "á"), ("õ", "ó"), ("ô", "ó"), ("î", "í"),
)
HYPHENS = "-¬\xad‐"
_SOFT = "¬\xad"
_WORD = re.compile(r"[^\W\d_]+")
_STRIP = ".,;:!?()[]«»“”\"'’‘…„¿¡–—•*%<>/"
_CODE = re.compile(r"[A-Z]l?[-‐]?l?\d[\dl]*(?:-[A-Z])?$|.*[._/\\].*\w$|.*\d[.,]\d.*$|[-+]?[\d.,:/%-]+[a-zº°]{0,3}$", re.S)
_NUMBER = r"(?:[lIOoSZB]{1,3}(?![^\W_])|\d[\dSsOolIiBZzgq|]{0,4}|[SsOolIiBZzgq|]\d[\dSsOolI]{0,3}|[ivxlcIVXLC]{1,7})"
_PLACE = "p|pp|pg|pag|pagina|page|seite|s|hoja|folha|folio|feuille|blatt|no|n|num|стр|страница"
_PAGE = re.compile(rf"[\s\-–—_\[(|·*~.<«]*(?:(?:{_PLACE})\.?\s*)?({_NUMBER})(?:\s*(?:/|of|de|von|di|do|da|sur|из|\|)\s*({_NUMBER}))?[\s\-–—_\])|·*~.>»]*$", re.I)
_ROMAN = re.compile(r"(?=.)m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$", re.I)
_SIDE = re.compile(rf"^({_NUMBER})\s{{2,}}(\S.*)$|^(\S.*?)\s{{2,}}({_NUMBER})$|^(\S.*?)\s+[·|–—]\s+({_NUMBER})$|^({_NUMBER})\s+[·|–—]\s+(\S.*)$")
_FOLD = (("rn", "m"), ("nn", "m"), ("vv", "w"), ("ii", "u"), ("li", "h"), ("ri", "n"), ("cl", "d"))
_ONE = str.maketrans({"0": "o", "1": "i", "l": "i", "|": "i", "!": "i", "5": "s", "$": "s", "@": "a", "4": "a", "†": "t", "7": "t", "9": "g", "6": "b", "8": "b", "h": "b", "2": "z", "3": "e", "c": "e", "€": "e", "y": "v"})


class Lexicon:
    """Known words with their counts, and the search among their beginnings."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.counts = counts
        self.total = max(1, sum(counts.values()) if total is None else total)
        self._sorted: list[str] = []

    def __getstate__(self):
        return {"counts": self.counts, "total": self.total}

    def __setstate__(self, s):
        self.__init__(s["counts"], s["total"])

    def begins(self, w: str) -> bool:
        """Whether a known word begins so."""
        if not self._sorted:
            self._sorted = sorted(self.counts)
        k = bisect.bisect_left(self._sorted, w)
        return k < len(self._sorted) and self._sorted[k].startswith(w)

    def cost(self, w: str) -> float:
        return math.log(self.total / (self.counts.get(w, 0) + 0.5))


def _plain(s: str) -> str:
    """s without accents."""
    return s if s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


@lru_cache(maxsize=200_000)
def canon(s: str) -> str:
    """A line's letters, with those that scanners confuse made alike."""
    s = _plain(s).casefold()
    for a, b in _FOLD:
        s = s.replace(a, b)
    return re.sub(r"[\W_]+", "", s.translate(_ONE))


@lru_cache(maxsize=64)
def _pairs(s: str) -> frozenset[tuple[str, str]]:
    return frozenset(zip(s, s[1:]))


def _alike(a: str, b: str) -> bool:
    if a == b:
        return bool(a)
    if not a or not b or abs(len(a) - len(b)) > 0.15 * max(len(a), len(b)) or len(a) < 6:
        return False
    # two texts of that ratio share at least 0.72 of their pairs of letters
    pairs = _pairs(b)
    if sum(x in pairs for x in zip(a, a[1:])) < 0.6 * (len(a) - 1):
        return False
    m = difflib.SequenceMatcher(None, a, b, autojunk=False)
    return m.quick_ratio() >= 0.86 and m.ratio() >= 0.86


def is_page_number(line: str) -> bool:
    """Whether a line has only a page number: digits in any script, misread or not, roman, with a word for page, of how many, in brackets or dashes."""
    s = line.strip()
    if len(s.split()) > 12:
        return False  # such a line has four words and their marks at most
    s = _plain(s)
    if not s or s[-1] in ".,;:" or re.fullmatch(r"\(?\d{4}\)?[.,;:]?|\(?\d+\)[.,;:]", s):
        return False
    if s.isalpha() and s.islower() is False and len(s) > 1 and not _ROMAN.match(s):
        return False
    for t in (s, s.replace("@", "a").replace("3 ", "e ").replace("€", "e"), re.sub(r"(?<=[a-z])9|9(?=[a-z])", "g", s.replace("@", "a")), re.sub(r"\b0(?=f\b)", "o", s.replace("@", "a")), re.sub(r"(?i)^p(?:a|@)[g9q][ce]", "Page", s), re.sub(r"(?i)^p(?:a|@)[g9q](?:[il1][nr]|iri)[a@o]", "Pagina", s)):
        if m := _PAGE.match(t):
            numbers = [x for x in m.groups() if x]
            if all(any(c.isdigit() for c in x) or _ROMAN.match(x) or x != s and re.fullmatch("[lIOoSZB]{1,3}", x) for x in numbers) and not re.search(r"\d[.,]\d|%", s):
                return True
    return False


def _title_start(s: str, title: str) -> bool:
    """Whether s is a title cut short, with an ellipsis."""
    if not s.endswith(("…", "...")):
        return False
    a = canon(s)
    return len(a) >= 4 and len(a) < len(title) and (title.startswith(a[:-1]) or _alike(a, title[: len(a)]))


def header_kind(line: str, title: str, source: str) -> str | None:
    """`encabezado`, `pagina` or None for a line of a document whose title and source's name are given in canonical form."""
    s = line.strip()
    if not s:
        return None
    if is_page_number(s):
        return "pagina"
    m = _SIDE.match(s)
    core = next((g for g in (m.group(2), m.group(3), m.group(5), m.group(8)) if g), s) if m else s
    if len(core) > 3 * max(len(title), len(source)) + 40:
        return None  # far longer than any header of this document
    a = canon(core)
    for whole in (title, source, source + title, title + source):
        if whole and (_alike(a, whole) or _title_start(core, whole)):
            return "encabezado"
    return None


class Line:
    __slots__ = ("number", "raw", "text", "kind", "classes", "tokens", "changed")

    def __init__(self, number: int, raw: str):
        self.number, self.raw, self.text = number, raw, raw.strip()
        self.kind: str | None = None  # encabezado, pagina or None
        self.classes: set[str] = set()
        self.tokens: list[str] = self.text.split()
        self.changed: dict[int, str] = {}  # tokens that are read otherwise than they stand


def source_name(source: str | None) -> str:
    return re.sub(r"[_\s]+", " ", re.sub(r"[\\/]+$", "", (source or "").strip()).replace("\\", "/").rpartition("/")[2])


def _core(token: str) -> tuple[str, str, str]:
    """What stands before the word of a token, the word, and what stands after it."""
    left = len(token) - len(token.lstrip(_STRIP + "-–—|+"))
    right = len(token.rstrip(_STRIP + "-–—|+"))
    return token[:left], token[left:right], token[max(right, left) :]


def _recover(w: str, new: str) -> str:
    """new in the letter case of w."""
    return new.upper() if w.isupper() and len(w) > 2 else new[:1].upper() + new[1:] if w[:1].isupper() else new


#: What it costs that a word goes on over a space, a line's end, and a hyphen at a line's end; that words stand together without a gap; that a hyphen at a line's end parts no word; an unknown word, and each of its letters.
_GAPS = {" ": 6.0, "\n": 6.0, "-": 1.0, "~": 1.0}
_GLUED, _KEPT, _UNKNOWN, _LETTER = 15.0, 9.0, 14.0, 1.5
#: What misread characters cost, by their number.
_FIXES = (0.0, 4.0, 12.0, 20.0)
#: How many units on either side of an unknown word or a hyphen are decoded with it, and over how many words known shares are taken.
_AROUND, _CONTEXT = 2, 12
_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _a, _b in CONFUSIONS:
    _BY_FIRST.setdefault(_a[0], []).append((_a, _b))
_BROKEN = re.compile(r"[\d@†$|!€]")
_TIE, _LETTERS = re.compile(r"([-‐'’·])"), re.compile(r"[^\W\d_]")


@lru_cache(maxsize=200_000)
def _parts(token: str, last: bool) -> tuple[tuple[str, ...], tuple[tuple[int, str, str, bool], ...]]:
    """A token in pieces (signs before, units and the ties between them, signs behind), and of its units the piece, the text, the same in lower case, and whether it is a code or a number. The last token of a line may end with a hyphen."""
    bare = token.rstrip(HYPHENS) if last else token
    before, core, after = _core(bare)
    code = _CODE.match(core) is not None
    parts, units = [before], []
    for n, part in enumerate(_TIE.split(core)):
        if part and n % 2 == 0:
            low = part.lower()
            units.append((len(parts), part, low if len(low) == len(part) else part, code or not _LETTERS.search(part)))
        parts.append(part)
    return (*parts, after + token[len(bare) :]), tuple(units)


class Arc:
    """A word over a piece of the stream: from place a to b, with so many misread characters, over the gaps behind these units."""

    __slots__ = ("word", "a", "b", "fixes", "gaps", "cost")

    def __init__(self, word: str, a: int, b: int, fixes: int, gaps: tuple, cost: float):
        self.word, self.a, self.b, self.fixes, self.gaps, self.cost = word, a, b, fixes, gaps, cost


class Stream:
    """The letters of a document's lines without their gaps: units (words, or the parts of one between hyphens and apostrophes), and what stands behind each: a space, a line's end, a hyphen or a soft hyphen at a line's end, or None, over which no word goes on."""

    def __init__(self, body: list[Line], lex: Lexicon):
        self.body, self.lex = body, lex
        self.unit: list[tuple[int, int, int]] = []  # line, token, piece of the token
        self.part: list[str] = []
        self.low: list[str] = []
        self.code: list[bool] = []
        for n, x in enumerate(body):
            last = len(x.tokens) - 1
            for k, t in enumerate(x.tokens):
                for place, part, low, code in _parts(t, k == last)[1]:
                    self.unit.append((n, k, place))
                    self.part.append(part)
                    self.low.append(low)
                    self.code.append(code)
        self.start = [0, *accumulate(map(len, self.low))]
        self.text = "".join(self.low)
        counts = lex.counts
        self.known = [w in counts for w in self.low]
        self._gaps: dict[int, str | None] = {}
        self.hyphens = set()
        ends = {n for n, x in enumerate(body) if x.text[-1] in HYPHENS}
        if ends:
            self.hyphens = {i for i, (u, v) in enumerate(zip(self.unit, self.unit[1:])) if u[0] in ends and u[0] != v[0] and self.gap(i) in ("-", "~")}

    def pieces(self, n: int, k: int) -> tuple[str, ...]:
        tokens = self.body[n].tokens
        return _parts(tokens[k], k == len(tokens) - 1)[0]

    def gap(self, i: int) -> str | None:
        if i not in self._gaps:
            self._gaps[i] = self._gap(i) if i + 1 < len(self.unit) else None
        return self._gaps[i]

    def _gap(self, i: int) -> str | None:
        (n, k, p), (m, l, q), a, b = self.unit[i], self.unit[i + 1], self.part[i], self.part[i + 1]
        if n == m and k == l or q > 1 or self.pieces(m, l)[0]:
            return None  # a hyphen or an apostrophe within a word, or a sign before the next
        after = "".join(self.pieces(n, k)[p + 1 :])
        if n != m and after and after in HYPHENS:
            goes_on = b[0].islower() or b[0] in "0123456789@†$" or a.isupper() and len(a) > 1 or not b[0].isupper() and b[0].isalpha()
            return ("~" if after in _SOFT else "-") if goes_on and (a[-1].isalpha() or a[-1] in "0123456789@†$") else None
        if after or self.code[i] and not a.isalpha() or not (b[0].islower() or b[0] in "0123456789@†$"):
            return None
        if any(w in self.lex.counts and len(w) < 3 for w in (self.low[i], self.low[i + 1])):
            return None  # a short word of its own, such as an article, is no part of another
        return " " if n == m else "\n"

    def zones(self) -> list[tuple[int, int]]:
        """The runs of units that are decoded: unknown words, hyphens at line ends, and their neighbours. The others stand as they are, one arc from each zone to the next."""
        n = len(self.unit)
        odd = self.hyphens.union(i for i, k in enumerate(self.known) if not k and not self.code[i] and len(self.low[i]) > 1)
        out: list[tuple[int, int]] = []
        for i in sorted(odd):
            lo, hi = max(0, i - _AROUND), min(n, i + _AROUND + 1)
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], hi)
            else:
                out.append((lo, hi))
        return out

    def readings(self, i: int, at: int, stop: int) -> Iterator[tuple[str, int, int, tuple]]:
        """The known words that the stream may be read as from a place in unit i: (word, end, misread characters, gaps gone over), by a search among the beginnings of known words."""
        lex, text, start = self.lex, self.text, self.start
        todo = [("", at, i, 0, ())]
        while todo:
            word, p, u, fixes, gaps = todo.pop()
            if word and word in lex.counts:
                yield word, p, fixes, gaps
            if p == start[u + 1]:
                if not word or u + 1 == stop or self.gap(u) is None:
                    continue
                gaps, u = (*gaps, u), u + 1
            c, end = text[p], start[u + 1]
            if lex.begins(word + c):
                todo.append((word + c, p + 1, u, fixes, gaps))
            if fixes < 3:
                for a, b in _BY_FIRST.get(c, ()):
                    if text.startswith(a, p) and p + len(a) <= end and lex.begins(word + b):
                        todo.append((word + b, p + len(a), u, fixes + 1, gaps))

    def allowed(self, i: int, at: int, word: str, end: int, fixes: int, gaps: tuple, trust: float) -> float | None:
        """What it costs to read the stream so, or None if it may not be read so."""
        lex, j = self.lex, gaps[-1] + 1 if gaps else i
        kinds = {self.gap(g) for g in gaps}
        hyphen, cut = bool(kinds & {"-", "~"}), at != self.start[i] or end != self.start[j + 1]
        read = self.text[at:end]
        n, broken, count = len(read), _BROKEN.search(read) is not None, lex.counts[word]
        if not cut and not gaps and (self.known[i] or self.code[i]):
            return None  # it stands as it is
        if fixes and not hyphen:
            # a short word, or a name, must look broken or have a far more frequent reading
            if n < 2 or not broken and (n < 4 or self.part[i][0].isupper() and fixes > 1 or count < 5) or n < 4 and count < 1e-4 * lex.total:
                return None
            if broken and fixes > 1 and sum(c.isalpha() for c in read) < fixes + 2 or fixes > 2 and sum(c in "@0159†$|" for c in read) < 3:
                return None
        elif fixes > 2:
            return None
        if fixes > 1 and n < 5:
            return None
        if kinds - {"-", "~"}:
            if len(word) <= (5 if "\n" in kinds else 3) or not cut and not hyphen and all(self.known[i : j + 1]):
                return None
            if fixes and (len(word) < 5 or count < 5 or n < (5 if fixes == 1 else 8)):
                return None
        if cut:
            if len(word) < 3 and (len(word) < 2 or count < 5e-3 * lex.total) or max(len(self.low[i]), len(self.low[j])) < 8 or fixes and (len(word) < 5 or count < 5 or fixes > 1):
                return None
        if fixes and not broken and self.code[i]:
            return None
        # among unknown words a misread one is less likely; one that looks broken, less so
        doubt = (1 - trust) * (8.0 if broken else 14.0) if fixes or cut or kinds - {"-", "~"} else 0.0
        return lex.cost(word) + _FIXES[fixes] + sum(_GAPS[self.gap(g)] for g in gaps) + doubt

    def path(self, lo: int, hi: int) -> list[Arc]:
        """The arcs of least cost over the units lo to hi of a zone."""
        lex, start = self.lex, self.start
        best: dict[int, tuple[float, Arc | None]] = {start[lo]: (0.0, None)}

        def put(arc: Arc, base: float) -> None:
            if (old := best.get(arc.b)) is None or base + arc.cost < old[0]:
                best[arc.b] = (base + arc.cost, arc)

        for i in range(lo, hi):
            a, b, w = start[i], start[i + 1], self.low[i]
            kept = _KEPT if i in self.hyphens else 0.0
            alone = lex.cost(w) if self.known[i] else 1.0 if self.code[i] else _UNKNOWN + _LETTER * len(w)
            near = range(max(0, i - _CONTEXT), min(len(self.unit), i + _CONTEXT + 1))
            trust = sum(self.known[k] or self.code[k] for k in near) / len(near)
            for at in range(a, b):
                if at not in best:
                    continue
                base = best[at][0] + (_GLUED if at > a else 0.0)
                put(Arc(self.text[at:b], at, b, 0, (), kept + (alone if at == a else _UNKNOWN + _LETTER * (b - at))), base)
                if self.code[i] and not self.gap(i):
                    continue
                for word, end, fixes, gaps in self.readings(i, at, hi):
                    if (cost := self.allowed(i, at, word, end, fixes, gaps, trust)) is not None:
                        last = gaps[-1] + 1 if gaps else i
                        put(Arc(word, at, end, fixes, gaps, cost + (_KEPT if last in self.hyphens and end == start[last + 1] else 0.0)), base)
                if at == a and i + 1 < hi and self.gap(i) == "~":
                    # an unknown word parted by a soft hyphen; another hyphen between unknown parts may belong to a compound
                    word = w + self.low[i + 1]
                    put(Arc(word, a, start[i + 2], 0, (i,), (_UNKNOWN + _LETTER * len(word)) * 0.5 + _GAPS["~"]), base)
        out, at = [], start[hi]
        while at > start[lo]:
            out.append(best[at][1])
            at = best[at][1].a
        return out[::-1]

    def read(self) -> None:
        """Puts the words of the best path into the lines' tokens, and reads from its arcs which lines are noisy and how."""
        start, body = self.start, self.body
        for lo, hi in self.zones():
            arcs = self.path(lo, hi)
            if all(not x.fixes and not x.gaps and x.b in start[lo + 1 : hi + 1] and x.a in start[lo:hi] for x in arcs):
                continue
            words: dict[int, list[str]] = {i: [] for i in range(lo, hi)}
            for arc in arcs:
                i = bisect.bisect_right(start, arc.a) - 1
                j = arc.gaps[-1] + 1 if arc.gaps else i
                whole = arc.a == start[i] and arc.b == start[j + 1]
                words[i].append(self.part[i] if whole and i == j and not arc.fixes else _recover(self.part[i], arc.word) if arc.a == start[i] else arc.word)
                for g in arc.gaps:
                    if self.gap(g) in ("-", "~"):
                        body[self.unit[g][0]].classes.add("guion")
                    elif self.gap(g) == " ":
                        body[self.unit[g][0]].classes.add("ocr")
                if not whole:
                    body[self.unit[i][0]].classes.add("ocr")
                if arc.fixes:
                    read = self.text[arc.a : arc.b]
                    same = next((m for m, (x, y) in enumerate(zip(read, arc.word)) if x != y), min(len(read), len(arc.word)) - 1)
                    body[self.unit[bisect.bisect_right(start, min(arc.a + same, arc.b - 1)) - 1][0]].classes.add("ocr")
            # the pieces of the zone's tokens, of which those that a word goes over are put into its first
            tokens = {u[:2]: list(self.pieces(*u[:2])) for u in self.unit[lo:hi]}
            for i in range(lo, hi):
                tokens[self.unit[i][:2]][self.unit[i][2]] = " ".join(words[i])
            for arc in reversed(arcs):
                for g in reversed(arc.gaps):
                    (n, k, p), (m, l, q) = self.unit[g], self.unit[g + 1]
                    tokens[n, k][p + 1 :] = tokens[m, l][q:]
                    tokens[m, l] = []
            for (n, k), t in tokens.items():
                body[n].changed[k] = "".join(t)
        for x in body:
            if x.changed:
                x.tokens = [x.changed.get(k, t) for k, t in enumerate(x.tokens)]


def layout(text: str, source: str | None) -> tuple[list[Line], list[Line]]:
    """The lines of a document with their kinds, and those with text that are neither headers nor page numbers."""
    lines = [Line(k, x) for k, x in enumerate(unicodedata.normalize("NFC", text).split("\n"), 1)]
    filled = [x for x in lines if x.text]
    if not filled:
        return lines, []
    title, name = canon(_SIDE.sub(lambda m: next(g for g in (m.group(2), m.group(3), m.group(5), m.group(8)) if g), filled[0].text)), canon(source_name(source))
    for x in filled[1:]:
        x.kind = header_kind(x.raw, title, name)
    if is_page_number(filled[0].text):
        filled[0].kind = "pagina"
    # with page numbers there are pages; else a line that repeats the title is a header if it breaks into a sentence
    if not any(x.kind == "pagina" or x.kind and _SIDE.match(x.text) for x in filled):
        for a, x, b in zip([filled[0], *filled], filled, [*filled[1:], filled[-1]]):
            own = set(x.tokens)
            apart = all(sum(t in own for t in y.tokens) < 0.5 * len(y.tokens) for y in (a, b))
            if x.kind and not (apart and (a.text[-1].isalnum() or a.text[-1] in HYPHENS + ",;") and b.text[0].islower()):
                x.kind = None
    for x in filled:
        if x.kind:
            x.classes = {x.kind}
    return lines, [x for x in filled if x.kind is None and x.tokens]


def analyse(text: str, source: str | None, lex: Lexicon) -> list[Line]:
    """The lines of a document with their kinds and classes; the tokens of noisy lines are repaired, the words parted by line ends put together on the first line."""
    lines, body = layout(text, source)
    if body:
        Stream(body, lex).read()
    return lines


def paragraphs_of(lines: list[Line]) -> list[str]:
    """The paragraphs of least cost: between each two lines left, a boundary or none, by dynamic programming over the lines."""
    body: list[tuple[Line, int, bool]] = []
    blanks, paged = 0, False
    for x in lines:
        if x.kind:
            paged = True
        elif not x.text:
            blanks += 1
        elif x.tokens:
            body.append((x, blanks, paged))
            blanks, paged = 0, False
    if not body:
        return []
    width = max(len(x.text) for x, _, _ in body)

    def boundary(k: int) -> float:
        """What it costs more to begin a paragraph at line k than not to."""
        (a, _, _), (b, gap, page) = body[k - 1], body[k]
        c = 2.5
        c -= 0 if not gap else 1.0 if page else 4.5
        c -= 1.2 if a.text[-1] in ".!?…:»”\"" else -1.8
        c -= 0.8 if len(a.text) < 0.7 * width else -0.3
        first = b.text.lstrip("«“\"¿¡(-•*– ")[:1]
        c -= -2.5 if first.islower() else 0.4
        if "guion" in a.classes:
            c += 6
        if re.match(r"\s*(?:[•*\-–]|\d{1,2}[.)])\s", b.text):
            c -= 3
        return c

    costs = [0.0] + [boundary(k) for k in range(1, len(body))]
    # state: whether the line before begins a paragraph; one of a single short line costs a little, so that no word is torn off
    now: dict[bool, tuple[float, tuple]] = {True: (0.0, (0, ()))}
    for k in range(1, len(body)):
        stay = min(now.values())
        begin = min((v[0] + costs[k] + (0.6 if alone and len(body[k - 1][0].text) < 12 else 0.0), v[1]) for alone, v in now.items())
        now = {False: stay, True: (begin[0], (k, begin[1]))}
    chain = min(now.values())[1]
    starts: list[int] = []
    while chain:
        starts.append(chain[0])
        chain = chain[1]
    starts.reverse()
    return [" ".join(t for x, _, _ in body[a:b] for t in x.tokens if t) for a, b in zip(starts, [*starts[1:], len(body)])]


_COUNTS = pa.schema([("palabra", pa.string()), ("n", pa.int64())])


def word_counts(df: DataFrame, text_col: str = "texto", format_col: str = "formato") -> DataFrame:
    """palabra, n: the words of all texts but those of pdf and images, read LEAST_COUNT times or more, counted over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for b in batches:
            for t in b["texto"].to_pylist():
                c.update(_WORD.findall(unicodedata.normalize("NFC", t.lower())))
            if len(c) > 200_000:
                yield emit(list(c.items()), _COUNTS)
                c = Counter()
        yield emit(list(c.items()), _COUNTS)

    docs = df.select(F.col(text_col).alias("texto"), format_of(format_col).alias("formato")).filter((F.length("texto") > 0) & ~F.coalesce(F.col("formato"), F.lit("")).isin("pdf", "imagen"))
    return map_arrow(spread(docs.select("texto")), count, _COUNTS).groupBy("palabra").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


class Sieve:
    """Which words a lexicon may have and how they may begin. It never denies one that is there, so it only saves looking up."""

    def __init__(self, bits: BitFilter):
        self.bits, self.counts = bits, self

    def __contains__(self, w: str) -> bool:
        return self.bits.has(w)

    begins = __contains__


def sieve(words: DataFrame) -> Sieve:
    return Sieve(bit_filter(words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("palabra")), lambda k: F.left("palabra", k))).alias("p")), "p"))


def candidates(text: str, source: str | None, known: Lexicon, may: Sieve) -> set[str]:
    """Every word that decoding a document may look up, by what the sieve lets through."""
    stream, out = Stream(layout(text, source)[1], known), set()
    stream.lex = may
    for lo, hi in stream.zones():
        for i in range(lo, hi):
            for at in range(stream.start[i], stream.start[i + 1]):
                out.update(word for word, *_ in stream.readings(i, at, hi))
    return out


_FOUND = pa.schema([("doc_id", pa.string()), ("linea", pa.int32()), ("clase", pa.string())])
_REPAIRED = pa.schema([("doc_id", pa.string()), ("parrafo", pa.int32()), ("texto", pa.string())])
_USED = pa.schema([("bloque", pa.int32()), ("palabra", pa.string())])


def _decoded(df: DataFrame, rows, schema: pa.Schema, id_col: str, text_col: str, source_col: str, format_col: str, lexicon_bytes: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """rows(doc_id, text, source, lexicon) of every distinct pdf document with a text that isn't blank.

    A lexicon of at most lexicon_bytes goes to every task. A larger one is never brought together: documents go in
    blocks of some MB, and each block gets by joins first the known ones of its own words, then, around the others, those that
    its stretches may be read as; with these it is decoded exactly as with the whole lexicon.
    """
    words = word_counts(df, text_col, format_col)
    docs = df.filter((format_of(format_col) == "pdf") & F.col(text_col).rlike(r"\S")).select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("texto"), F.col(source_col).alias("fuente"))
    words = cut_lineage(words)
    size = words.agg(F.sum(F.octet_length("palabra") + 100).alias("bytes"), F.sum("n").alias("total")).first()
    total = int(size["total"] or 0)
    if (size["bytes"] or 0) <= lexicon_bytes:
        lex = Lexicon({r[0]: int(r[1]) for r in words.collect()}, total)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield emit([r for x in zip(*(b[c].to_pylist() for c in ("doc_id", "texto", "fuente"))) for r in rows(*x, lex)], schema)

        return map_arrow(spread(docs), run, schema).distinct()
    may = sieve(words)
    blocks = parts_for(docs.agg(F.sum(F.octet_length("texto"))).first()[0] or 0, block_bytes)
    docs = docs.withColumn("bloque", F.pmod(F.xxhash64("doc_id", "texto"), F.lit(blocks)).cast("int"))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, str]] = set()
        for b in batches:
            for n, t, s in zip(*(b[c].to_pylist() for c in ("bloque", "texto", "fuente"))):
                seen.update((n, w) for w in Stream(layout(t, s)[1], Lexicon({})).low)
            if len(seen) > 200_000:
                yield emit(list(seen), _USED)
                seen.clear()
        yield emit(list(seen), _USED)

    def lexicon_of(table: pa.Table) -> Lexicon:
        return Lexicon(dict(zip(table["palabra"].to_pylist(), table["n"].to_pylist())), total)

    def each(a: pa.Table) -> Iterator[tuple]:
        return zip(*(a[c].to_pylist() for c in ("doc_id", "texto", "fuente")))

    def ask(a: pa.Table, b: pa.Table) -> pa.Table:
        known = lexicon_of(b)
        found = set(known.counts).union(*(candidates(t, s, known, may) for _, t, s in each(a)))
        n = a["bloque"][0].as_py() if a.num_rows else 0
        return pa.Table.from_batches([emit([(n, w) for w in sorted(found)], _USED)])

    def answer(a: pa.Table, b: pa.Table) -> pa.Table:
        lex = lexicon_of(b)
        return pa.Table.from_batches([emit([r for x in each(a) for r in rows(*x, lex)], schema)])

    known = map_arrow(docs, own, _USED).distinct().join(words, "palabra").groupBy("bloque")
    used = docs.groupBy("bloque").cogroup(known).applyInArrow(ask, from_arrow_schema(_USED)).distinct().join(words, "palabra")
    return docs.groupBy("bloque").cogroup(used.groupBy("bloque")).applyInArrow(answer, from_arrow_schema(schema)).distinct()


def noisy_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", source_col: str = "fuente", format_col: str = "formato", lexicon_bytes: int = LEXICON_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, linea, clase (guion, ocr, encabezado, pagina) of the noisy lines of pdf documents. Null and blank texts have none; repeated rows give theirs once."""
    rows = lambda i, t, s, lex: [(i, x.number, c) for x in analyse(t, s, lex) for c in sorted(x.classes)]
    return _decoded(df, rows, _FOUND, id_col, text_col, source_col, format_col, lexicon_bytes, block_bytes)


def repaired(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", source_col: str = "fuente", format_col: str = "formato", lexicon_bytes: int = LEXICON_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, parrafo (from 1), texto: the continuous paragraphs of pdf documents, without running headers and page numbers, words whole and read right."""
    rows = lambda i, t, s, lex: [(i, k, p) for k, p in enumerate(paragraphs_of(analyse(t, s, lex)), 1)]
    return _decoded(df, rows, _REPAIRED, id_col, text_col, source_col, format_col, lexicon_bytes, block_bytes)


_MEASURED = pa.schema([("doc_id", pa.string()), ("palabras", pa.int32()), ("desconocidas_antes", pa.int32()), ("desconocidas_despues", pa.int32()), ("renglones", pa.int32()), ("parrafos", pa.int32())])


def measure(text: str, source: str | None, lex: Lexicon) -> tuple[int, int, int, int, int]:
    """Of the lines left without headers: words, how many of them aren't known before and after the repair, lines before and paragraphs after."""
    body = layout(text, source)[1]
    before = [w for x in body for w in _WORD.findall(x.text.lower())]
    after = paragraphs_of(analyse(text, source, lex))
    unknown = lambda words: sum(w not in lex.counts for w in words)
    return len(before), unknown(before), unknown(w for p in after for w in _WORD.findall(p.lower())), len(body), len(after)


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", source_col: str = "fuente", format_col: str = "formato", lexicon_bytes: int = LEXICON_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, palabras, desconocidas_antes, desconocidas_despues, renglones, parrafos: what the repair of each pdf document did."""
    return _decoded(df, lambda i, t, s, lex: [(i, *measure(t, s, lex))], _MEASURED, id_col, text_col, source_col, format_col, lexicon_bytes, block_bytes)
