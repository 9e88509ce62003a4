"""Problem 3: sentence boundaries in any language and script.

Candidates are runs of sentence marks of any script with their closing marks, also within quotations, and in Thai the
spaces between letters. A maximum-entropy classifier (logistic regression over indicator features: neighbouring
tokens, case, length, digits, script, mark, whether a quotation is open and how the text goes on after it, and how the
tokens behave in the corpus) decides each. It is trained on boundaries that are sure by themselves, such as a mark
between a common word and one that begins paragraphs, an ideographic mark outside quotations, or a space between Thai
clauses, and on sure non-boundaries, such as a full stop before a small letter, a mark within a quotation after which a
comma or a small letter follows, or a space beside a number. Of a kind of candidate that training hasn't met, what is
sure decides. Nothing is sampled: tokens are counted over all documents, and sure cases, of which many are alike, come to
the driver as how often each set of features occurs.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, format_of, map_arrow, paragraphs, per_row, spread

#: How far before a mark its token may begin, and the token before that one.
REACH = 64
_CANDIDATE = re.compile(r"(?:[.!?…؟]+(?:\s?[»›]|[\"'”’)\]」』])*(?=\s|$)|[.!?…؟]+[”」』](?=[^\W\d_])|[。！？।॥｡]+(?:\s?[»›]|[\"'”’)\]」』）])*)")
_PREV = re.compile(r"[^\s«»“”\"„()\[\]¿¡「」『』]*$")
_NEXT = re.compile(r"\s*[«“\"„(\[¿¡「『‘'—–\-]*\s?([^\W_][\w.]*)?")
_QUOTE = re.compile(r"[«»“”„\"「」『』‹›]")
_CLOSE = {"«": "»", "“": "”", "„": "“", '"': '"', "「": "」", "『": "』", "‹": "›"}
_THAI = re.compile(r"[฀-๿]")
_GAP = re.compile(r"(?<=\S)[^\S\n\r]+(?=\S)")
_INK = re.compile(r"\S")
_WORD = re.compile(r"[^\W\d_]+(?:\.[^\W\d_]+)*")
#: Abbreviations after which a sentence goes on.
NEVER = frozenset("dr dra sr sra srta mr mrs ms prof profa fr art arts núm num nº no fig figs sec pág p pp vol ed eds cap e.g i.e p.ej ej vs cf z ca bzw abs abb nr vgl st ste mme m mm mlle dott sig sen gen lic ing arq d.h v см рис стр проф напр т р ул د م أ प्रो डॉ श्री".split())


def _cased(w: str) -> str:
    c = w[0]
    return "U" if c.isupper() or c.istitle() else "l" if c.islower() else "d" if c.isdigit() else "x"


def _bucket(part: float | None) -> str:
    return "?" if part is None else "0" if part <= 0.02 else "1" if part <= 0.25 else "2" if part <= 0.75 else "3" if part < 0.98 else "4"


#: What stands before a word that begins a sentence: a mark, and if it is a full stop, no abbreviation before it.
_AFTER = re.compile(r"(?:[!?…]|\.\.\.|[^\W\d_]{4,}\.|(?<![^\W\d_])(?!(?:dra?|sra?|mrs?|art|fig|sec|abs|núm|fr|pr|st|см|рис|стр|роф)\.)[a-zà-ÿа-я]{2,3}\.)[\"”»’)]*\s+[\"«“„¿¡—]*\s?$")


#: What stands for a rate: each threshold of _bucket(), features() and _sure() has it on the same side as the rate.
LEVELS = (0.0, 0.02, 0.25, 0.75, 0.9, 0.95, 0.97, 1.0)
#: An abbreviation of the corpus is followed by a full stop more often than this; other tokens are as good as never dotted.
DOTTED = 0.9


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))


class Rates:
    """The rate of each of any number of tokens, found by their 64-bit hashes: nine bytes a token."""

    def __init__(self, hashes: np.ndarray, rates: np.ndarray):
        order, p = np.argsort(hashes), rates
        self.hashes = array("Q", hashes[order].astype(np.uint64).tobytes())
        self.levels = np.sum([p >= 0.02, p > 0.02, p > 0.25, p > 0.75, p > 0.9, p > 0.95, p >= 0.98], axis=0, dtype=np.uint8)[order].tobytes()

    def get(self, token: str, default: float | None = None) -> float | None:
        h = _hash(token)
        k = bisect_left(self.hashes, h)
        return LEVELS[self.levels[k]] if k < len(self.hashes) and self.hashes[k] == h else default


class Model:
    def __init__(self, dotted: Rates, starts: Rates, weights: dict[str, float]):
        self.dotted, self.starts, self.weights = dotted, starts, weights

    def ends(self, c: dict) -> bool:
        """Whether a candidate ends a sentence."""
        return self.score(c) > 0 if f"K{c['kind']}" in self.weights or c["kind"] == "mark" and self.weights else _sure(self, c) != 0

    def features(self, c: dict) -> list[str]:
        prev, low, nxt = c["prev"], c["prev"].lower(), c["next"]
        kind = "d" if prev.replace(",", "").isdigit() else "1" if len(prev) == 1 else "i" if "." in prev else "s" if len(prev) <= 4 else "w"
        start = _bucket(self.starts.get(nxt)) if nxt else "E"
        abbr = "n" if low in NEVER else "a" if kind in "1is" and self.dotted.get(low, 0) > 0.9 else "-"
        case = _cased(nxt) if nxt else "E"
        letter = bool(nxt) and len(nxt.rstrip(".")) == 1 and nxt.endswith(".")
        mark = "." if set(c["mark"]) == {"."} and len(c["mark"]) == 1 else "…" if "…" in c["mark"] or ".." in c["mark"] else "!"
        if c["kind"] != "mark":
            return ["b", f"K{c['kind']}", f"K{c['kind']}{c['open']}", f"K{c['kind']}{case}", f"K{c['kind']}d{prev[-1:].isdigit()}{nxt[:1].isdigit()}", *[f"K{c['kind']}{c['script']}"] * 7]
        return ["b", f"m{mark}", f"k{kind}", f"k{kind}{abbr}", f"a{abbr}{case}", f"c{mark}{case}", f"s{case}{start}", f"s{abbr}{start}", f"l{letter}", f"q{c['closed']}{case}", f"p2{c['before'].lower().rstrip('.') in NEVER}{kind}", f"u{prev[:1].isupper()}{kind}{start}"]

    def score(self, c: dict) -> float:
        w = self.weights
        return sum(w.get(f, 0.0) for f in self.features(c))


def _candidates(s: str) -> list[dict]:
    """The candidates of a paragraph; those at its end are left out."""
    spans, opened = [], None
    for m in _QUOTE.finditer(s):
        q = m.group()
        if opened is None:
            opened = (m.start(), _CLOSE[q]) if q in _CLOSE else None
        elif q == opened[1]:
            spans.append((opened[0], m.start()))
            opened = None
    begins = [a for a, _ in spans]
    out = []
    for m in _CANDIDATE.finditer(s):
        i, j = m.start(), m.end()
        if j >= len(s):
            continue
        closed = any(ch in "»›\"”」』“" for ch in m.group())
        k = bisect_right(begins, i) - 1
        goes_on = k >= 0 and i < spans[k][1] and _goes_on(s, spans[k][1] + 1 if not closed or j <= spans[k][1] else j)
        prev = _PREV.search(s, max(0, i - REACH), i).group()
        whole, prev = prev, re.split(r"['’]", prev)[-1]
        before = s[max(0, i - len(whole) - REACH) : i - len(whole)].split()
        nxt = _NEXT.match(s, j).group(1) or ""
        out.append({"end": j, "mark": m.group().rstrip("\"'»›”’)]」』） \n"), "closed": closed, "prev": prev, "before": before[-1] if before else "", "next": nxt, "kind": "quote" if goes_on else "wide" if m.group()[0] in "。！？।॥｡" else "mark", "open": goes_on, "script": _script(s[max(0, i - 1)])})
    if len(_THAI.findall(s)) * 2 > len(s):
        for m in _GAP.finditer(s):
            a, b = s[m.start() - 1 : m.start()], s[m.end() : m.end() + 1]
            if _THAI.match(a) or _THAI.match(b):
                k = bisect_right(begins, m.start()) - 1
                out.append({"end": m.start(), "mark": " ", "closed": False, "prev": a, "before": "", "next": b, "kind": "space", "open": k >= 0 and m.start() < spans[k][1], "script": "THAI" if _THAI.match(a) and _THAI.match(b) else "other"})
    return out


def _goes_on(s: str, at: int) -> bool:
    """Whether a sentence goes on at this place, after a quotation."""
    m = _INK.search(s, at)
    c = m.group() if m else "."
    return c in ",;:—–-，、；：،)" or c.isalpha() and not c.isupper()


@lru_cache(maxsize=10_000)
def _script(c: str) -> str:
    return unicodedata.name(c, "?").partition(" ")[0]


def _sure(model: Model, c: dict) -> int | None:
    if c["kind"] == "quote":
        return 0
    if c["kind"] == "wide":
        return 1
    if c["kind"] == "space":
        return int(c["script"] == "THAI")
    prev, nxt, low = c["prev"], c["next"], c["prev"].lower()
    if not nxt:
        return None
    case, dot = _cased(nxt), c["mark"] == "."
    if dot and (case == "l" or low in NEVER or case == "d" and len(prev) <= 4):
        return 0
    if dot and len(prev) == 1 and prev.isupper() and len(nxt) == 2 and nxt[1] == ".":
        return 0
    if dot and len(prev) <= 4 and prev[:1].isupper() and model.dotted.get(low, 0) > 0.95 and model.starts.get(nxt, 1) < 0.02:
        return 0
    if case == "U" and model.starts.get(nxt, 0) > 0.75 and len(prev) > 1 and "." not in prev:
        return 1
    if dot and prev.isdigit() and len(prev) <= 2 and case == "U" and model.starts.get(nxt, 1) < 0.02:
        return 0
    if case == "U" and (not dot or len(prev) >= 3 and prev.isalpha() and prev.islower()) and model.starts.get(nxt, 0) > 0.25:
        return 1
    # tokens are counted without the full stop behind them: "! M. Rivera", but not "etc. M. Rivera"
    if case == "U" and not dot and model.starts.get(nxt.rstrip("."), 0) > 0.25:
        return 1
    if case == "x" and len(prev) >= 3 and prev.isalpha() and dot:
        return 1
    return None


class _Tokens:
    """How often each short token occurs and has a full stop behind it, how often each capitalised one occurs and begins a sentence."""

    def __init__(self) -> None:
        self.every, self.dot, self.cased, self.first = Counter(), Counter(), Counter(), Counter()

    def add(self, text: str) -> None:
        for _, a, b in paragraphs(text):
            s = text[a:b]
            for m in _WORD.finditer(s):
                w = m.group()
                low = w.lower()
                if len(low) <= 6:
                    self.every[low] += 1
                    self.dot[low] += s[m.end() : m.end() + 1] == "."
                if w[0].isupper():
                    self.cased[w] += 1
                    self.first[w] += m.start() < 3 or _AFTER.search(s, max(0, m.start() - 30), m.start()) is not None

    def __len__(self) -> int:
        return len(self.every) + len(self.cased)

    def rows(self) -> list[tuple[bool, int, int, int]]:
        """Dotted or start, hash as a signed number, times, times that it was so."""
        return [(kind, h - 2**64 if (h := _hash(w)) >= 2**63 else h, n, part[w]) for kind, whole, part in ((True, self.every, self.dot), (False, self.cased, self.first)) for w, n in whole.items()]


def _counted(kind: np.ndarray, hashes: np.ndarray, rates: np.ndarray) -> Model:
    """A model without weights from the rows of _Tokens, added up."""
    hashes = hashes.view(np.uint64)
    return Model(Rates(hashes[kind], rates[kind]), Rates(hashes[~kind], rates[~kind]), {})


def _cases(texts: Iterable[str], model: Model) -> Counter:
    """How often each set of features is a sure boundary (1) or none (0)."""
    out: Counter = Counter()
    for text in texts:
        for _, a, b in paragraphs(text):
            for c in _candidates(text[a:b]):
                if (y := _sure(model, c)) is not None:
                    out["\n".join(model.features(c)), y] += 1
    return out


def _fit(cases: dict[tuple[str, int], int], rounds: int = 300) -> dict[str, float]:
    """Weights of the features, from how often each set of them is a boundary and none."""
    if not cases:
        return {}
    index: dict[str, int] = {}
    known = sorted(cases.items())
    x = np.array([[index.setdefault(f, len(index)) for f in features.split("\n")] for (features, _), _ in known])
    y, n = np.array([y for (_, y), _ in known], float), np.array([n for _, n in known], float)
    mean = (n * y).sum() / n.sum()
    w, speed = np.zeros(len(index)), np.zeros(len(index))
    balance = np.where(y == 1, 0.5 / max(mean, 1e-6), 0.5 / max(1 - mean, 1e-6)) * n / n.sum()
    for _ in range(rounds):
        g = (1 / (1 + np.exp(-w[x].sum(1))) - y) * balance
        grad = np.bincount(x.ravel(), np.repeat(g, x.shape[1]), len(index)) + 1e-4 * w
        speed = 0.9 * speed + grad
        w = w - 0.3 * speed
    return {f: round(float(w[k]), 6) for f, k in index.items()}


def train(texts: list[str], rounds: int = 300) -> Model:
    """The classifier from the sure cases of some texts."""
    tokens = _Tokens()
    for t in texts:
        tokens.add(t)
    rows = [(kind, h, k / n) for kind, h, n, k in tokens.rows() if not kind or k / n > DOTTED]
    model = _counted(*(np.array([r[k] for r in rows], t) for k, t in enumerate((bool, np.int64, float))))
    model.weights = _fit(_cases(texts, model), rounds)
    return model


_TOKENS = pa.schema([("punto", pa.bool_()), ("ficha", pa.int64()), ("n", pa.int64()), ("k", pa.int64())])
_CASES = pa.schema([("rasgos", pa.string()), ("fin", pa.int32()), ("n", pa.int64())])


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> Model:
    """The model of train() over all distinct documents of format txt (of any, if there is none).

    Tokens and cases are counted in the tasks. The driver and each task get nine bytes for every capitalised token and
    every abbreviation of the corpus; sets of features are as many as they can be, whatever the size of the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens()
        for b in batches:
            for t in b["texto"].to_pylist():
                tokens.add(t)
                if len(tokens) > 200_000:
                    yield emit(tokens.rows(), _TOKENS)
                    tokens = _Tokens()
        yield emit(tokens.rows(), _TOKENS)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cases = _cases((t for b in batches for t in b["texto"].to_pylist()), model)
        yield emit([(*k, n) for k, n in cases.items()], _CASES)

    docs = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("texto"), format_of(format_col).alias("formato")).filter(F.col("texto").rlike(r"\S"))
    txt = docs.filter("formato = 'txt'")
    # rows that repeat a document count once; distinct rows are spread by the shuffle
    docs = (docs if txt.isEmpty() else txt).select("doc_id", "texto").distinct()
    counts = map_arrow(docs, count, _TOKENS).groupBy("punto", "ficha").agg((F.sum("k") / F.sum("n")).alias("parte"))
    rates = counts.filter(~F.col("punto") | (F.col("parte") > DOTTED)).toArrow()
    model = _counted(*(rates[c].to_numpy() for c in ("punto", "ficha", "parte")))
    cases = map_arrow(docs, judge, _CASES).groupBy("rasgos", "fin").agg(F.sum("n")).collect()
    model.weights = _fit({(f, y): n for f, y, n in cases})
    return model


def split_sentences(text: str, model: Model) -> list[tuple[int, int]]:
    """(start, end) of the sentences of text in code points."""
    out = []
    for _, a, b in paragraphs(text):
        s = text[a:b]
        ends = {c["end"] for c in _candidates(s) if model.ends(c)}
        start = 0
        for e in [*sorted(ends), len(s)]:
            piece = s[start:e]
            if piece.strip():
                out.append((a + start + len(piece) - len(piece.lstrip()), a + start + len(piece.rstrip())))
            start = e
    return out


_FOUND = pa.schema([("doc_id", pa.string()), ("char_start", pa.int32()), ("char_end", pa.int32())])


def sentences(df: DataFrame, model: Model, formats: tuple[str, ...] | None = None, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> DataFrame:
    """doc_id, char_start, char_end of the sentences of every document, offsets in code points, end exclusive.

    Null and blank texts have none; repeated rows give their sentences once; a text without any mark is one sentence
    per paragraph. No shuffle but that of the result's distinct rows.
    """
    docs = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("texto"), format_of(format_col).alias("formato")).filter(F.col("texto").rlike(r"\S"))
    if formats:
        docs = docs.filter(F.col("formato").isin(*formats))
    return map_arrow(spread(docs.select("doc_id", "texto")), per_row(lambda i, t: [(i, a, b) for a, b in split_sentences(t, model)], ["doc_id", "texto"], _FOUND), _FOUND).distinct()
