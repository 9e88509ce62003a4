"""Problem 7: the main body of a page, told from menus, notices and links.

The text of a page keeps the order of its lines; its nodes are put back into a tree: the root, its zones (what
stands before the article, the article, what stands after it), blocks of lines under a zone or under the heading
they follow, and lines. Every node is content or not. A line's own features and a potential for each kind of
parent and child decide, by messages passed up to the root and down again (sum-product), which gives each line's
marginal of being content. Weights and potentials are trained on labelled pages: a bounded sample of the corpus,
labelled by what is sure of them, namely prose, cue words, lines that many pages have, and the order of headings,
prose and lists. How many pages have a line is counted over all of them, and held as a rate: in a large corpus
lines of articles are alike by chance in a few pages.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, format_of, map_arrow, sample_rows, spread
from .shape import MARK

SAMPLE, ROUNDS = 2500, 200
#: A line is frequent in OFTEN of PER pages; of fewer pages than PER, in OFTEN of them. Lines under LEAST of PER are not kept, so no more are than 1,250 times the lines of a page.
OFTEN, LEAST, PER = 4, 2, 2500
#: Openings of words and phrases of notices, menus, share lines, licences, bylines, editorial lines, advertisements and links.
CUES = (
    "cookie", "rastreador", "tracker", "traceur", "balizas", "beacons", "balises", "identificadores desde", "preferencias de", "preferências de", "preferences",
    "privacidad", "privacy", "privacidade", "confidentialité", "boletines", "newsletter", "suscríb", "suscriptor", "subscri", "assin", "abonne",
    "compartir esta", "compartilhe", "share this", "partager", "partagez", "condividi", "comparteix", "comentar", "comentario", "comentário", "comments on", "commentaire", "to comment",
    "©", "licencia abierta", "open licence", "licença aberta", "licence ouverte", "por redacción de", "da redação de", "par la rédaction", "by the",
    "etiquetas:", "tags:", "marcadores:", "mots-clés", "contacto:", "contact:", "contato:", "contact :", "lectura de", "minute read", "minutos", "lecture :", "leitura",
    "resumen semanal", "weekly digest", "resumo semanal", "résumé hebdo", "no compromete la posición", "views expressed here", "não representa a posição", "n'engage pas", "enlaces externos", "external links", "links externos", "liens externes",
    "publicidad", "advertisement", "publicidade", "publicité", "anuncio", "anúncio", "annonce", "patrocinado", "sponsored", "sponsorisé",
    "vea además", "vea también", "see also", "veja também", "veja ainda", "voir aussi", "à lire aussi", "lea también", "read also", "leia também",
    "inicie sesión", "log in", "connectez-vous", "me gusta", "j'aime", "síganos", "siga-nos", "suivez-nous", "follow us", "trabaje con", "trabalhe con", "work with us", "nous rejoindre",
    "términos de uso", "terms of use", "termos de uso", "conditions d'utilisation", "aviso legal", "legal notice", "mentions légales", "accesibilidad", "accessib", "acessib",
    "volver arriba", "back to top", "voltar ao topo", "mapa del sitio", "site map", "mapa do site", "plan du site", "texto traducido", "translated from", "texto traduzido", "traduit de", "texte traduit",
    "corregida", "corrected", "corrigida", "corrigée", "actualizado con", "updated with", "atualizado com", "mis à jour", "continuará", "to be continued", "continua na", "à suivre",
    "primera de tres", "first of three", "primeira de três", "premier de trois", "première de trois", "versión ampliada", "longer version", "versão ampliada", "version longue",
)
#: Phrases that also tell a notice when it is a whole sentence; other cues may stand in an article's sentence.
SURE_CUES = (
    "de este sitio y de terceros", "own and third-party", "deste site e de terceiros", "internes et tiers", "acepta el uso", "accept the use", "aceita o uso", "acceptez l'usage",
    "preferencias de", "preferências de", "preferences", "vos choix de", "no compromete la posición", "views expressed here", "não representa a posição", "n'engage pas",
    "enlaces externos", "external links", "links externos", "liens externes", "©", "reproducción permitida", "no reproduction", "reprodução somente", "reproduction interdite", "licencia abierta", "open licence", "licença aberta", "licence ouverte",
    "resumen semanal", "weekly digest", "resumo semanal", "résumé hebdo", "etiquetas:", "tags:", "marcadores:", "mots-clés", "contacto:", "contact:", "contato:", "contact :",
    "vea además", "vea también", "see also", "veja também", "veja ainda", "voir aussi", "à lire aussi", "lea también", "read also", "leia também", "recomendado", "recomendamos", "le recomendamos", "recommended", "recommandé", "voir encore", "à découvrir", "lire aussi",
)
CUES += tuple(c for c in SURE_CUES if c not in CUES)
_BY_START: dict[str, list[str]] = {}
for _c in CUES:
    _BY_START.setdefault(_c[:3], []).append(_c)
_SURE = frozenset(SURE_CUES)
_START = re.compile(r"(?<![^\W\d_])[^\W\d_]|©")
_TITLE = re.compile(r"\S( — | – | / | \| |\s?: )\S|\d{4}$")
#: A link to another page: a few words, a colon, and a title.
_LINK = re.compile(r"[^:]{3,25}\s?: (?:.* (?:—|–|/|\|) |[^:]+: .*\d{4}$)")
_MENU = re.compile(r"[|/·•›>»]")
_ITEM = re.compile(r"\s*[•·▪◦‣*+\-–—]\s+\S")
_NUMBERED = re.compile(r"\s*\(?\d{1,3}[.)]\s+\S")
_CAPTION = re.compile(r"^[^\W\d_][^|/·›:—]*, [^|/·›:—A-ZÀ-Þ]*$")
_FOUR = re.compile(r"\d{4}\b")
_WORD = re.compile(r"[^\W\d_]+")
#: Buckets of hashed words, and how strongly their weights are held down.
WORDS, HOLD = 1 << 14, 3e-4
ZONES = ("before", "article", "after", "none")
SHAPES = ("prose", "title", "item", "numbered", "header", "caption", "menu", "cue", "short", "blank")


def key(line: str) -> int:
    """A hash of a line but for numbers, letter case and white space."""
    return xxhash.xxh3_64_intdigest(re.sub(r"\d+", "#", " ".join(unicodedata.normalize("NFKC", line).casefold().split())).encode())


def has_cue(low: str, sure: bool = False) -> bool:
    """Whether a cue (one of the sure ones) begins at the beginning of a word."""
    for m in _START.finditer(low):
        at = m.start()
        for c in _BY_START.get(low[at : at + 3]) or _BY_START.get(low[at : at + 1], ()):
            if low.startswith(c, at) and (not sure or c in _SURE):
                return True
    return False


@lru_cache(maxsize=100_000)
def shape(line: str, often: bool = False) -> str:
    s = " ".join(line.split())
    if not s:
        return "blank"
    low = s.lower()
    if len(s) < 200 and has_cue(low, len(s) >= 45 and MARK.search(s[-2:]) is not None):
        return "cue"
    if _LINK.match(s) and len(s) < 140:
        return "cue"
    if _ITEM.match(line):
        return "item"
    if _NUMBERED.match(s):
        return "numbered"
    if MARK.search(s) and len(s) >= 25 and not s.endswith(("...", "…")) or len(s) > 130:
        return "cue" if often and len(s) < 120 else "prose"
    if s[-1] in ":»›" and len(s) < 60:
        return "header"
    marks = len(_MENU.findall(s))
    if marks == 1 and _TITLE.search(s) and "›" not in s or not marks and _TITLE.search(s) and (_FOUR.search(s) or " — " in s):
        return "short" if often and not _FOUR.search(s) and "—" not in s and " / " not in s and " | " not in s else "title"
    if marks:
        return "menu"
    if _CAPTION.match(s) and not often:
        return "caption"
    return "short"


@lru_cache(maxsize=100_000)
def _hashed(line: str) -> tuple[str, ...]:
    """Hashed words of a line that is no prose, and its first and last word."""
    words = _WORD.findall(line.casefold())
    return tuple(f"w:{zlib.crc32(w.encode()) % WORDS}" for w in sorted({*words, *(f"^{w}" for w in words[:1]), *(f"{w}$" for w in words[-1:])}))


#: Lines that say nothing about what stands before and after them.
_THROUGH = ("cue", "blank", "menu", "header", "short")


class Page:
    """The lines of a page with their shapes, zones, parents and features."""

    def __init__(self, text: str, often: dict[int, float]):
        self.lines = text.split("\n")
        self.often = [often.get(key(x), 0) if x.strip() else 0 for x in self.lines]
        self.shapes = [shape(x, n >= OFTEN) for x, n in zip(self.lines, self.often)]
        self.seen = [k for k, s in enumerate(self.shapes) if s != "blank"]
        prose = [k for k, s in enumerate(self.shapes) if s == "prose"]
        if not prose:  # an article may be a title with a list or a caption
            prose = [k for k, s in enumerate(self.shapes) if s == "title" and (a := self._next(k, 1)) is not None and self.shapes[a] in ("item", "caption")][:1]
        self.first = prose[0] if prose else None
        self.last = prose[-1] if prose else None
        self._anchor()

    def _next(self, k: int, step: int) -> int | None:
        """The next line on this side whose shape says something."""
        k += step
        while 0 <= k < len(self.shapes):
            if self.shapes[k] not in _THROUGH:
                return k
            k += step
        return None

    def _anchor(self) -> None:
        """From the article's title to the end of its last list."""
        if self.first is None:
            self.begin = self.end = None
            return
        begin, k = self.first, self._next(self.first, -1)
        while k is not None and self.shapes[k] in ("title", "caption", "item"):
            if self.shapes[k] == "title":
                begin = k  # of titles above the first prose the uppermost is the article's own
            k = self._next(k, -1)
        self.begin, end = begin, self.last
        k = self._next(self.last, 1)
        while k is not None and self.shapes[k] in ("item", "caption", "numbered", "title"):
            s = self.shapes[k]
            if s == "title":
                after = self._next(k, 1)
                # a heading with only a list or a caption under it; links have none
                if after is None or self.shapes[after] not in ("item", "caption") or self._header_before(k):
                    break
            elif s == "numbered" and _TITLE.search(" ".join(self.lines[k].split())[3:]) or self._header_before(k):
                break
            else:
                end = k
            k = self._next(k, 1)
        self.end = end

    def _header_before(self, k: int) -> bool:
        """Whether a heading of links stands between line k and the line before it that says something."""
        j = k - 1
        while j >= 0 and self.shapes[j] in _THROUGH:
            if self.shapes[j] in ("header", "short"):
                return True
            j -= 1
        return False

    def zone(self, k: int) -> str:
        return "none" if self.begin is None else "before" if k < self.begin else "after" if k > self.end else "article"

    def labels(self) -> list[int | None]:
        """What is sure: 1 content, 0 not, None not sure."""
        out: list[int | None] = [None] * len(self.lines)
        for k in self.seen:
            s, zone = self.shapes[k], self.zone(k)
            if s in ("cue", "menu", "header") or zone in ("before", "after"):
                out[k] = 0
            elif zone == "none":
                out[k] = None
            elif s in ("prose", "item", "caption") or k == self.begin:
                out[k] = 1
            elif s == "title":
                after = self._next(k, 1)
                out[k] = 1 if after is not None and self.shapes[after] in ("prose", "item", "caption") and after <= self.end else 0
            elif s == "numbered":
                out[k] = 0 if _TITLE.search(" ".join(self.lines[k].split())[3:]) else 1
            else:
                out[k] = 0 if self.often[k] >= OFTEN else None
        return out

    def features(self, k: int) -> list[str]:
        s, zone, line = self.shapes[k], self.zone(k), " ".join(self.lines[k].split())
        up, down = self._next(k, -1), self._next(k, 1)
        a, b = (self.shapes[up] if up is not None else "none"), (self.shapes[down] if down is not None else "none")
        many = "0" if self.often[k] < LEAST else "1" if self.often[k] < OFTEN else "2" if self.often[k] < 20 else "3"
        size = str(min(len(line) // 20, 6))
        return ["bias", f"s:{s}", f"s:{s} z:{zone}", f"s:{s} b:{b} z:{zone}", f"s:{s} a:{a} z:{zone}", f"s:{s} o:{many}", f"l:{size} s:{s}", f"first:{k == self.begin}", f"up:{line.isupper()}", f"end:{MARK.search(line[-2:]) is not None}", *(_hashed(line) if s != "prose" else ())]

    def tree(self) -> list[tuple[int, str]]:
        """Of each seen line its parent (the place of another in `seen`, or -1 - zone for a zone) and the kind of the edge."""
        zones = {z: -k for k, z in enumerate(ZONES, 1)}
        out, head = [], None
        for place, k in enumerate(self.seen):
            s, zone = self.shapes[k], self.zone(k)
            if s in ("title", "header"):
                out.append((zones[zone], f"{zone}>{s}"))
                head = place
            elif head is not None and self.zone(self.seen[head]) == zone and s not in ("cue", "menu"):
                out.append((head, f"{self.shapes[self.seen[head]]}>{s}"))
            else:
                out.append((zones[zone], f"{zone}>{s}"))
        return out


_FLAT = ((0.5, 0.5), (0.5, 0.5))


class Model:
    def __init__(self, often: dict[int, float], weights: dict[str, float], edges: dict[str, tuple], zones: dict[str, tuple[float, float]]):
        self.often, self.weights, self.edges, self.zones = often, weights, edges, zones

    def marginals(self, page: Page) -> list[float]:
        """Of each seen line the probability of being content: sum-product over the page's tree."""
        tree, get = page.tree(), self.weights.get
        n = len(tree)
        inside = []
        for k in page.seen:
            w = min(max(sum(get(f, 0.0) for f in page.features(k)), -30.0), 30.0)
            p = 1 / (1 + math.exp(-w))
            inside.append([1 - p, p])
        # zones hang on the root, whose message to them is learned
        zones = {-k: [*self.zones[z]] for k, z in enumerate(ZONES, 1)}
        up = [(0.5, 0.5)] * n
        psi = [self.edges.get(kind, _FLAT) for _, kind in tree]  # parent's state, child's state
        for i in range(n - 1, -1, -1):  # a parent always stands before its children
            (a, b), (c, d) = psi[i]
            x, y = inside[i]
            m0, m1 = a * x + b * y, c * x + d * y
            up[i] = (m0 / (m0 + m1), m1 / (m0 + m1))
            p = tree[i][0]
            own = inside[p] if p >= 0 else zones[p]
            own[0] *= up[i][0]
            own[1] *= up[i][1]
            total = own[0] + own[1]
            own[0], own[1] = own[0] / total, own[1] / total
        belief: list[tuple[float, float]] = []
        for i in range(n):
            p = tree[i][0]
            own = belief[p] if p >= 0 else zones[p]
            u0, u1 = own[0] / max(up[i][0], 1e-12), own[1] / max(up[i][1], 1e-12)
            (a, b), (c, d) = psi[i]
            b0, b1 = inside[i][0] * (u0 * a + u1 * c), inside[i][1] * (u0 * b + u1 * d)
            belief.append((b0 / (b0 + b1), b1 / (b0 + b1)))
        return [b for _, b in belief]


def keys(text: str) -> set[int]:
    return {key(x) for x in text.split("\n") if x.strip()}


def train(texts: list[str], often: dict[int, float] | None = None) -> Model:
    """The model from sampled pages, labelled by what is sure of them; often: of each frequent line how many of PER pages have it, by default counted on these pages."""
    if often is None:
        count, share = Counter(h for t in texts for h in keys(t)), min(1.0, PER / max(1, len(texts)))
        often = {h: n * share for h, n in count.items() if n * share >= LEAST}
    pages = [Page(t, often) for t in texts]
    index: dict[str, int] = {}
    rows, y, edges = [], [], {}
    tally = {z: [0, 0] for z in ZONES}
    for page in pages:
        labels = page.labels()
        states = {-1: 0, -2: 1, -3: 0}
        for k, (parent, kind) in zip(page.seen, page.tree()):
            if labels[k] is None:
                continue
            rows.append([index.setdefault(f, len(index)) for f in page.features(k)])
            y.append(labels[k])
            tally[page.zone(k)][labels[k]] += 1
            above = labels[page.seen[parent]] if parent >= 0 else states.get(parent)
            if above is not None:
                edges.setdefault(kind, np.ones((2, 2)))[above, labels[k]] += 1
    weights: dict[str, float] = {}
    if rows:
        flat, counts = np.fromiter((f for x in rows for f in x), np.int64), np.array([len(x) for x in rows])
        first, own, t = np.cumsum(counts) - counts, np.repeat(np.arange(len(rows)), counts), np.array(y, float)
        hold = np.array([HOLD if f.startswith("w:") else 1e-5 for f in index])
        w, speed = np.zeros(len(index)), np.zeros(len(index))
        for _ in range(ROUNDS):
            g = (1 / (1 + np.exp(-np.add.reduceat(w[flat], first))) - t) / len(t)
            speed = 0.9 * speed + np.bincount(flat, g[own], len(index)) + hold * w
            w = w - 0.4 * speed
        weights = {f: float(w[k]) for f, k in index.items()}
    # what the root says of its zones: how many of their lines are content
    zones = {z: (1.0 + tally[z][0], 1.0 + tally[z][1]) for z in ZONES}
    zones = {z: (a / (a + b), b / (a + b)) for z, (a, b) in zones.items()}
    # potentials, tempered so that a line's own features are not counted twice
    return Model(often, weights, {k: tuple(map(tuple, np.sqrt(v / v.sum(1, keepdims=True)).tolist())) for k, v in edges.items()}, zones)


_LINES = pa.schema([("doc", pa.int64()), ("linea", pa.int64())])


def frequent_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> dict[int, float]:
    """The keys of lines of all html documents, long ones too, and in how many of PER documents each stands (of fewer documents, in how many), from LEAST up. Rows that repeat a document count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(d, h) for d, t in zip(b["doc"].to_pylist(), b["texto"].to_pylist()) for h in keys(t)]
            hashes = np.array([h for _, h in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array(hashes)], schema=_LINES)

    docs = _pages(df, id_col, text_col, format_col).select(F.when(F.col("doc_id").isNull(), F.xxhash64("texto")).otherwise(F.xxhash64("doc_id")).alias("doc"), "texto")
    share = min(1.0, PER / max(1, docs.select("doc").distinct().count()))
    counts = map_arrow(docs, run, _LINES).distinct().groupBy("linea").agg(F.count("*").alias("n")).filter(F.col("n") * share >= LEAST)
    return {r[0] % 2**64: r[1] * share for r in counts.collect()}


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato", most: int = SAMPLE) -> Model:
    docs = df.filter((format_of(format_col) == "html") & F.col(text_col).rlike(r"\S"))
    return train([r[0] for r in sample_rows(docs, id_col, text_col, [text_col], most)], frequent_lines(df, id_col, text_col, format_col))


def content_lines(text: str, model: Model) -> list[tuple[int, bool, float]]:
    """(line from 1, content or not, marginal) of the lines that aren't blank."""
    page = Page(text, model.often)
    return [(k + 1, p >= 0.5, p) for k, p in zip(page.seen, model.marginals(page))] if page.seen else []


_FOUND = pa.schema([("doc_id", pa.string()), ("linea", pa.int32())])
_BODY = pa.schema([("doc_id", pa.string()), ("texto", pa.string())])


def _pages(df: DataFrame, id_col: str, text_col: str, format_col: str) -> DataFrame:
    docs = df.filter((format_of(format_col) == "html") & F.col(text_col).rlike(r"\S"))
    return spread(docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("texto")))


def boilerplate_lines(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> DataFrame:
    """doc_id, linea: the lines of html documents that aren't of the article. Blank lines are no lines of anything; null and blank texts have none; repeated rows give their lines once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield emit([(i, k) for i, t in zip(b["doc_id"].to_pylist(), b["texto"].to_pylist()) for k, yes, _ in content_lines(t, model) if not yes], _FOUND)

    return map_arrow(_pages(df, id_col, text_col, format_col), run, _FOUND).distinct()


def main_bodies(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> DataFrame:
    """doc_id, texto: the article of every distinct html document, line by line; empty if the page has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield emit([(i, "\n".join(t.split("\n")[k - 1] for k, yes, _ in content_lines(t, model) if yes)) for i, t in zip(b["doc_id"].to_pylist(), b["texto"].to_pylist())], _BODY)

    return map_arrow(_pages(df, id_col, text_col, format_col), run, _BODY).distinct()
