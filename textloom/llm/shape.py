"""Problem 2: statistics of a text, and its structure: prose, list, table or junk.

A text is described by distributions: of its characters over classes, of its words over kinds, of its lines
over shapes, and of its words over a language's function words. Each is held against profiles by Jensen-Shannon
divergence; the nearest profile names the structure. Profiles of prose are learned for each language from all texts of
format txt; those of the other structures, and of prose for languages without texts, are those of short samples below,
written for this.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import emit, format_of, language_of, map_arrow, per_row, spread

WORD = re.compile(r"[^\W\d_]+(?:['’·][^\W\d_]+)*")
END = re.compile(r"[.!?…。！？؟।]+[\"'”’»)\]」』]*$")
MARK = re.compile(r"[.!?…](?=[\"'”’»)\]]*(?:\s|$))|[。！？؟।]")
ITEM = re.compile(r"\s*(?:[•·▪▫◦‣●○■□➢➤✓*+\-–—]|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,5})[.)])\s+\S")
#: An entry of a table of contents: leaders of dots up to a page.
LEADER = re.compile(r"\S\s*(?:[.·…_]\s?){4,}\s*[\divxlcIVXLC]{1,6}$")
CELL = re.compile(r"\t|\s*\|\s*|;|\S {2,}(?=\S)|, (?=[^\W\d]\w{0,24}: )")
NUMBER = re.compile(r"[-+$€]?\d[\d.,:/%]*")
WIDE = re.compile(r"[฀-๿぀-ヿ㐀-鿿]")
TOP_WORDS = 40
#: From how many texts of a language at least its profile of prose is learned, and how many characters such a text has at least.
LEAST_TEXTS, LEAST_CHARS = 5, 80
#: Shares are added up as whole numbers of this part, so that sums are the same in any order.
PART = 1 << 30
SEEDS = {"es": "de la el en y los con que un se por las una para no es".split(), "en": "the of and in to a is for that on by with it as at".split(), "pt": "de o a e do da em os um para com no na que as se".split(), "fr": "le la de les et des en un du une à dans pour que est".split()}
STRUCTURES = ("prosa", "lista", "tabla", "basura")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits, along the last axis."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = np.where(p > 0, p * np.log2(p / m), 0), np.where(q > 0, q * np.log2(q / m), 0)
    return (a.sum(-1) + b.sum(-1)) / 2


_CHARS = ("lower", "upper", "digit", "end", "punct", "cell", "symbol", "broken")


@lru_cache(maxsize=65536)
def _char_class(c: str) -> int:
    if c in "©¡€™œ\x80\x81\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8d\x8e\x8f\x90\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9d\x9e\x9fÃâÂ�":
        return 7
    if c.isdigit():
        return 2
    if c.isalpha():
        return 1 if c.isupper() else 0
    if c in ".!?…。！？؟।":
        return 3
    if c in "|;\t":
        return 5
    if c in ",:()'\"«»“”„‘’-–—¿¡/·•、，：；（）「」『』،؛°%ºª&" or c == "\xad":
        return 4
    return 0 if "̀" <= c <= "ͯ" or "ऀ" <= c <= "๿" or "ً" <= c <= "ٟ" else 6


def _chars(text: str) -> np.ndarray:
    out = np.zeros(len(_CHARS))
    for c, n in Counter(text).items():
        if not c.isspace() or c == "\t":
            out[_char_class(c)] += n
    # a few signs that belong to broken encodings also belong to notices and Spanish questions
    if out[7] < 0.03 * out.sum():
        out[4] += out[7]
        out[7] = 0
    return out


def _words(tokens: list[str], functions: frozenset[str]) -> np.ndarray:
    """function word, other word, number, mixed, oddly spelled (no vowel, or far too long), repeated beyond measure."""
    out = np.zeros(6)
    n = len(tokens)
    for w, k in Counter(tokens).items():
        if k > 4 and k > 0.08 * n and w not in functions:
            out[5] += k
        elif w in functions:
            out[0] += k
        elif NUMBER.fullmatch(w):
            out[2] += k
        elif len(w) > 28 and not WIDE.search(w):
            out[4] += k
        elif WORD.fullmatch(w):
            out[4 if _odd(w) else 1] += k
        elif re.search(r"[^\W\d_]", w) or len(w) > 2:
            out[1 if re.fullmatch(r"[\w'’.·\-‐/@:]*", w) and not re.search(r"\d[^\W\d_]|[^\W\d_]\d", w) else 3] += k
    return out


@lru_cache(maxsize=200_000)
def _odd(w: str) -> bool:
    """A Latin word of which no language would have the letters in this order: long runs of consonants, or none but them."""
    if not re.match(r"[a-zà-ÿ]", w):
        return False
    return bool(re.search(r"[bcdfghjklmnpqrstvwxz]{5}|[bcdfgjkmpqtvwxz]{4}|q[^u]|[jkvwxz]{2}[bcdfgjkmpqtvwxz]|^[bcdfgjkmpqtvwxz]{2}[bcdfghjkmpqtvwxz]|[vjxqz][bcdfghjkmnpqtwxz]", w)) and w not in ("http", "https", "www")


def _lines(text: str) -> np.ndarray:
    """Characters of items, rows of cells or numbers, lines of paragraphs that have sentences, other lines, lines that repeat others."""
    out = np.zeros(5)
    seen: Counter = Counter()
    block: list[tuple[bool, int, bool]] = []

    def close() -> None:
        ended, widest = any(m for m, _, _ in block), max((n for _, n, _ in block), default=0)
        # lines that all begin anew, with hardly a sentence: a list; the sentences are notices between its items
        anew = len(block) >= 4 and sum(u for _, _, u in block) > 0.8 * len(block) and sum(m for m, _, _ in block) < 0.34 * len(block)
        for marked, n, _ in block:
            if anew:
                out[3] += 0 if marked else n
                continue
            # of a wrapped paragraph nearly all lines are as wide as the others
            out[2 if marked or ended and n > 0.55 * widest else 3] += n
        block.clear()

    for raw in [*text.split("\n"), ""]:
        line = raw.strip()
        if not line:
            close()
            continue
        seen[line] += 1
        tokens = line.split()
        numbers = sum(NUMBER.fullmatch(t) is not None for t in tokens)
        if seen[line] > 2 and len(line) > 12:
            out[4] += len(line)
        elif (cells := len(CELL.findall(line))) >= 2 and len(line) < 45 * (cells + 1) or numbers >= 3 and numbers > 0.6 * len(tokens):
            out[1] += len(line)
        elif LEADER.search(line) or ITEM.match(line) and not (len(line) > 200 and MARK.search(line[:-1])):
            close()
            out[0] += len(line)
        else:
            block.append((MARK.search(line) is not None, len(line), line[0].isupper() or line[0] in "©¿¡«"))
    return out


def _norm(v: np.ndarray) -> np.ndarray:
    s = v.sum()
    return v / s if s else np.full(len(v), 1 / len(v))


#: Samples of the structures, written for this: name of the structure, text.
SAMPLES: list[tuple[str, str]] = [
    ("prosa", "The river rose again in spring, and the two villages had to share one bridge. Nobody was surprised. In the end the council paid for the repair; it took seven weeks.\nA second flood came in May. The engineers, who had expected it, were ready this time."),
    ("prosa", "El río volvió a crecer en primavera y los dos pueblos compartieron un puente. Nadie se\nsorprendió. Al final el municipio pagó la obra, que duró siete semanas. La segunda\ncrecida llegó en mayo.\n\nLos ingenieros, que la esperaban, estaban listos esta vez."),
    ("prosa", "Notas del puente\n\nEl río volvió a crecer en primavera. Nadie se sorprendió. Al final el municipio pagó la obra.\n\n- el puente viejo\n- la obra nueva\n\nLa segunda crecida llegó en mayo."),
    ("prosa", "河水在春天再次上涨，两个村庄只好共用一座桥。没有人感到惊讶。最后由镇上出钱修桥，一共用了七个星期。"),
    ("lista", "• Iron bridge\n• Old mill with two wheels\n• Market in the upper town\n• Ferry\n• School for the river villages"),
    ("lista", "1. Puente de hierro\n2. Molino viejo con dos ruedas\n3. Mercado de la villa alta\n4. Balsa\n5. Escuela de los pueblos"),
    ("lista", "Puente de hierro\nMolino viejo con dos ruedas\nMercado de la villa alta\nBalsa\nEscuela de los pueblos del río\nCamino de la sierra"),
    ("lista", "a) puente de hierro;\nb) molino viejo con dos ruedas;\nc) mercado de la villa alta;\nd) balsa;"),
    ("lista", "Rivera, Puente de hierro (1998)\nSalas, Molino viejo con dos ruedas (2004)\nMora, Mercado de la villa alta (2011)\nLuna, Escuela de los pueblos (1987)"),
    ("tabla", "Alto Norte\tpuente\tRivera Salas\tabierto\t14.2\t880\nBajo Sur\tmolino\tMora Luna\tcerrado\t9.1\t1200\nVilla Alta\tbalsa\tSalas Mora\tabierto\t3.3\t95"),
    ("tabla", "| place | kind | owner |\n|---|---|---|\n| Alto Norte | bridge | Rivera Salas |\n| Bajo Sur | mill | Mora Luna |\n| Villa Alta | ferry | Salas Mora |"),
    ("tabla", "14.2 880.1 3.55 9.1\n7.7 112.4 8.20 6.3\n3.9 95.0 1.75 2.2\n5.1 340.6 4.40 7.8"),
    ("tabla", "Alto Norte;puente;Rivera Salas;abierto\nBajo Sur;molino;Mora Luna;cerrado\nVilla Alta;balsa;Salas Mora;abierto"),
    ("tabla", "lugar: Alto Norte, largo_m: 14.2, costo: 880\nlugar: Bajo Sur, largo_m: 9.1, costo: 1200\nlugar: Villa Alta, largo_m: 3.3, costo: 95"),
    ("basura", "}{~#%&/ |<>^* [_]=+ @@#!? <{&%/>} ~^|*#\n_=+][ #%&{}~ <>|/\\*^ !?@#% }{[]=+"),
    ("basura", "xkqv zzrpt mwgf bnnhcd qjvx tplkr wxzzg hjdfk vbqm rrtgx pwqzk\nkjhgf dxcvb nmqzw pptrx vwgkj"),
    ("basura", "x1%k z0$w Qq!7 k%%z0 W$1x 0zz! J!0w %xk1 Zq$0 w1!x\nK0$z 1wq% X!z0 q$%1 Jk0!"),
    ("basura", "puente puente puente puente puente puente puente puente puente puente puente puente\npuente puente puente puente puente puente puente puente"),
    ("basura", "The bridge was closed for two days.\nThe bridge was closed for two days.\nThe bridge was closed for two days.\nThe bridge was closed for two days.\nThe bridge was closed for two days.\nThe bridge was closed for two days."),
    ("basura", "rÃ©gimÃ©n dÃ© lÃ¡s â€œbrÃ¡s Ã©n Ã©l puÃ©ntÃ© viÃ©jâ€œ dÃ©l rÃ­â€œ y lÃ¡ bÃ¡lsÃ¡ dÃ© lâ€œs puÃ©blâ€œs"),
    ("basura", "aG9sYSBxdWUgdGFsIGVzdG8gZXMgdW5hIGNhZGVuYSBzaW4gZXNwYWNpb3M3Hk29dLpQ0mZx8RtVb1NcW4yJ6uKfE5sAhOiGTgUeXvYwDl"),
]


def describe(text: str, functions: frozenset[str]) -> np.ndarray:
    """The three distributions side by side."""
    letters = Counter(text)
    if sum(n for c, n in letters.items() if c.isupper()) > 3 * sum(n for c, n in letters.items() if c.islower()):
        text = text.lower()  # in capitals throughout: they say nothing
    tokens = [t.strip(".,;:!?()[]«»“”\"'…¿¡") for t in text.lower().split()]
    return np.concatenate([_norm(_chars(text)), _norm(_words([t for t in tokens if t], functions)), _norm(_lines(text))])


_PARTS = (slice(0, 8), slice(8, 14), slice(14, 19))
_WEIGHTS = (1.0, 1.2, 1.5)


def _salad(text: str, tokens: list[str]) -> bool:
    """Words in no order, over and over: few different ones, and none of the marks, capitals and rows of the other structures."""
    n = len(tokens)
    if n < 30 or MARK.search(text):
        return False
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    low = sum(x[0].islower() and not ITEM.match(x) for x in lines)
    return low > 0.7 * len(lines) and len(set(tokens)) < 0.62 * n**0.95


class Profiles:
    """What structure() needs: function words by language, and the structural profiles."""

    def __init__(self, functions: dict[str, list[str]], prose: dict[str, tuple[np.ndarray, np.ndarray]] | None = None):
        self.by_language = {k: {w: i for i, w in enumerate(v)} for k, v in functions.items()}
        self.functions = frozenset(w for v in functions.values() for w in v)
        self.names = [s for s, _ in SAMPLES]
        own = self.functions | frozenset("the a in and to of el la los de y con en".split())
        self.profiles = np.stack([describe(t, own) for _, t in SAMPLES])
        # of each language the mean profile of its prose, and how its words fall on its function words
        self.zipf: dict[str, np.ndarray] = {}
        for lang, (profile, usual) in sorted((prose or {}).items()):
            self.names.append("prosa")
            self.profiles = np.vstack([self.profiles, profile])
            self.zipf[lang] = usual

    def distances(self, text: str) -> np.ndarray:
        d = describe(text, self.functions)
        return sum(w * divergence(d[p], self.profiles[:, p]) for w, p in zip(_WEIGHTS, _PARTS))

    def structure(self, text: str) -> str:
        return self.names[int(np.argmin(self.distances(text)))]

    def classify(self, text: str) -> str:
        """The nearest structure; but words in no order and broken encodings are junk, whatever their lines look like."""
        chars = _norm(_chars(text))
        if chars[7] > 0.05:
            return "basura"
        name = self.structure(text)
        if name in ("lista", "prosa") and _salad(text, text.lower().split()):
            return "basura"
        return name


_WORDS = pa.schema([("idioma", pa.string()), ("palabra", pa.string()), ("n", pa.int64())])
_SUMS = pa.schema([("idioma", pa.string()), ("lugar", pa.int32()), ("n", pa.int64())])


def _word_counts(words: Callable[[str], Iterable[str]]) -> Callable:
    """For mapInArrow over idioma, texto: how many texts of each language have each of the words that words(text) gives."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for b in batches:
            for label, text in zip(b["idioma"].to_pylist(), b["texto"].to_pylist()):
                if lang := language_of(label):
                    c.update((lang, w) for w in set(words(text)))
            if len(c) > 200_000:
                yield emit([(*k, n) for k, n in c.items()], _WORDS)
                c = Counter()
        yield emit([(*k, n) for k, n in c.items()], _WORDS)

    return count


def _top_words(docs: DataFrame, words: Callable[[str], Iterable[str]], least: int) -> dict[str, list[str]]:
    """Of each language the TOP_WORDS words that most texts have, of those that at least so many have."""
    counts = map_arrow(docs, _word_counts(words), _WORDS).groupBy("idioma", "palabra").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    first = Window.partitionBy("idioma").orderBy(F.desc("n"), "palabra")
    out: dict[str, list[str]] = {}
    for r in counts.withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= TOP_WORDS).orderBy("idioma", "_k").collect():
        out.setdefault(r["idioma"], []).append(r["palabra"])
    return out


def _prose(docs: DataFrame, functions: dict[str, list[str]]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Of each language with enough texts the mean of their profiles, and of how their words fall on its function words."""
    every = frozenset(w for v in functions.values() for w in v)
    places = {k: {w: i for i, w in enumerate(v)} for k, v in functions.items()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for label, text in zip(b["idioma"].to_pylist(), b["texto"].to_pylist()):
                if lang := language_of(label):
                    v = np.concatenate([[1.0], describe(text, every), _norm(_on_functions(text, places.get(lang, {})))])
                    sums[lang] = sums.get(lang, 0) + np.rint(v * PART).astype(np.int64)
        yield emit([(lang, k, int(n)) for lang, v in sums.items() for k, n in enumerate(v)], _SUMS)

    found: dict[str, dict[int, int]] = {}
    for lang, k, n in map_arrow(docs, add, _SUMS).groupBy("idioma", "lugar").agg(F.sum("n")).collect():
        found.setdefault(lang, {})[k] = n
    means = {lang: np.array([v[k] / v[0] for k in range(1, len(v))]) for lang, v in found.items() if v[0] >= LEAST_TEXTS * PART}
    size = _PARTS[-1].stop
    return {lang: (v[:size], v[size:]) for lang, v in means.items()}


def learn_profiles(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato", language_col: str = "idioma") -> Profiles:
    """Function words and prose of each labelled language, over all distinct documents of format txt (of any, if there is none).

    Function words are the TOP_WORDS words of up to five letters that most of its texts have, with the seeds; its prose is
    the mean profile of its texts of LEAST_CHARS characters and more, if it has LEAST_TEXTS of these. Tables of both are
    added up in the tasks: the driver gets TOP_WORDS words and one profile a language, whatever the size of the corpus.
    """
    docs = _docs(df, id_col, text_col, format_col, F.col(language_col).alias("idioma")).filter(F.col("texto").rlike(r"\S"))
    txt = docs.filter("formato = 'txt'")
    # rows that repeat a document count once; distinct rows are spread by the shuffle
    docs = (docs if txt.isEmpty() else txt).select("doc_id", "idioma", "texto").distinct()
    tops = _top_words(docs, lambda text: (w for w in map(str.lower, WORD.findall(text)) if len(w) <= 5), 1)
    functions = {k: list(dict.fromkeys([*tops.get(k, []), *SEEDS.get(k, [])])) for k in sorted({*tops, *SEEDS})}
    return Profiles(functions, _prose(docs.filter(F.length("texto") >= LEAST_CHARS), functions))


_FOUND = pa.schema([("doc_id", pa.string()), ("clase", pa.string())])
_SHAPES = pa.schema([("doc_id", pa.string()), ("estructura", pa.string()), ("distancia", pa.float64()), ("idioma_cercano", pa.string()), ("div_funcion", pa.float64())])


def _docs(df: DataFrame, id_col: str, text_col: str, format_col: str, *more: Column) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("texto"), format_of(format_col).alias("formato"), *more)


def structures(df: DataFrame, profiles: Profiles, formats: tuple[str, ...] | None = None, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> DataFrame:
    """doc_id, clase of every distinct document of the formats; null and blank texts have none."""
    docs = _docs(df, id_col, text_col, format_col).filter(F.col("texto").rlike(r"\S"))
    if formats:
        docs = docs.filter(F.col("formato").isin(*formats))
    return map_arrow(spread(docs.select("doc_id", "texto")), per_row(lambda i, t: [(i, profiles.classify(t))], ["doc_id", "texto"], _FOUND), _FOUND).distinct()


def not_prose(df: DataFrame) -> DataFrame:
    return structures(df, learn_profiles(df), ("pdf", "json")).filter("clase <> 'prosa'")


def _on_functions(text: str, known: dict[str, int]) -> np.ndarray:
    """How often a text has each function word, and other words."""
    p = np.zeros(len(known) + 1)
    for w, n in Counter(w.lower() for w in WORD.findall(text)).items():
        p[known.get(w, len(known))] += n
    return p


def function_divergence(text: str, profiles: Profiles) -> tuple[str | None, float]:
    """The language whose function words the text has most of, and the divergence of its words from how that language's prose falls on them."""
    words = Counter(w.lower() for w in WORD.findall(text))
    best = max(profiles.by_language, key=lambda k: (sum(words[w] for w in profiles.by_language[k]), k), default=None)
    if best is None or not words:
        return None, 1.0
    known = profiles.by_language[best]
    usual = profiles.zipf.get(best)
    if usual is None:  # no prose of the language: as words fall by rank
        usual = np.append(1 / np.arange(2, len(known) + 2), 0.0)
        usual = np.append(usual[:-1] / usual.sum() * 0.4, 0.6)
    return best, float(divergence(_norm(_on_functions(text, known)), usual))


def shapes(df: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> DataFrame:
    """doc_id, estructura, distancia, idioma_cercano, div_funcion of each row with a text that isn't blank."""
    docs = _docs(df, id_col, text_col, format_col).filter(F.col("texto").rlike(r"\S"))

    def one(i, t):
        lang, x = function_divergence(t, profiles)
        return [(i, profiles.classify(t), round(float(profiles.distances(t).min()), 6), lang, round(x, 6))]

    return map_arrow(spread(docs.select("doc_id", "texto")), per_row(one, ["doc_id", "texto"], _SHAPES), _SHAPES)


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto") -> DataFrame:
    """doc_id and basic counts of each row's text, in the JVM: chars, palabras, largo_medio, simbolos, digitos, lineas, fin_punto, distintas.

    Words are runs of letters, marks and digits; symbols are what is no letter, mark, digit or white space; fin_punto is
    the share of lines that aren't blank and end in . ! ? … 。 ! ? or with one of these and a closing mark. A null and an
    empty text have zeros.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_extract_all(F.lower(t), F.lit(r"([\p{L}\p{M}\p{N}]+)"), 1)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\s\x{a0}]"))
    per = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 6)
    x = df.select(F.col(id_col).cast("string").alias("doc_id"), F.length(t).alias("chars"), words.alias("w"), lines.alias("l"), F.regexp_count(t, F.lit(r"[^\p{L}\p{M}\p{N}\s\x{a0}]")).alias("s"), F.regexp_count(t, F.lit(r"\p{Nd}")).alias("d"))
    ends = F.size(F.filter("l", lambda v: v.rlike(r"[.!?…。！？؟।][\"'”’»)\]」』]*[\s\x{a0}]*$")))
    return x.select(
        "doc_id", "chars", F.size("w").alias("palabras"), per(F.aggregate("w", F.lit(0), lambda a, v: a + F.length(v)), F.size("w")).alias("largo_medio"),
        per(F.col("s"), F.col("chars")).alias("simbolos"), per(F.col("d"), F.col("chars")).alias("digitos"), F.size("l").alias("lineas"),
        per(ends, F.size("l")).alias("fin_punto"), per(F.size(F.array_distinct("w")), F.size("w")).alias("distintas"),
    )


_MARKS = "".join(c for c in map(chr, range(0x10000)) if unicodedata.category(c)[0] == "M")
_TOKEN = re.compile(f"{WIDE.pattern}|(?:(?!{WIDE.pattern})[\\w{re.escape(_MARKS)}])+")
_RUN = re.compile(f"[\\w{re.escape(_MARKS)}]+")
_COMMON = pa.schema([("doc_id", pa.string()), ("idioma", pa.string()), ("comunes", pa.float64())])


def words_of(text: str) -> list[str]:
    """The words that statistics() counts, in lower case; but each letter of a script without spaces is a word."""
    text = unicodedata.normalize("NFC", text.lower().replace("_", " "))
    return (_TOKEN if WIDE.search(text) else _RUN).findall(text)


def common_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato", language_col: str = "idioma") -> dict[str, frozenset[str]]:
    """The TOP_WORDS words of each labelled language that most documents have (two at least), numbers left out, with the seeds; counted over all distinct documents of format txt (of any, if there is none)."""
    docs = _docs(df, id_col, text_col, format_col, F.col(language_col).alias("idioma")).filter(F.col("texto").rlike(r"\S"))
    out = {k: set(v) for k, v in SEEDS.items()}
    for part in (docs.filter("formato = 'txt'"), docs):
        # rows that repeat a document count once; distinct rows are spread by the shuffle
        if tops := _top_words(part.select("doc_id", "idioma", "texto").distinct(), lambda text: (w for w in words_of(text) if not w.isnumeric()), 2):
            for lang, words in tops.items():
                out.setdefault(lang, set()).update(words)
            break
    return {k: frozenset(v) for k, v in out.items()}


def common_share(text: str | None, common: dict[str, frozenset[str]]) -> tuple[str | None, float]:
    """The language of whose common words the text has most (the first by code of equals; None if it has none), and the share of its words that are these."""
    words = Counter(words_of(text or ""))
    hits = {k: sum(n for w, n in words.items() if w in v) for k, v in common.items()}
    best = min(hits, key=lambda k: (-hits[k], k), default=None)
    return (best, round(hits[best] / words.total(), 6)) if best is not None and hits[best] else (None, 0.0)


def common_shares(df: DataFrame, common: dict[str, frozenset[str]], id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> DataFrame:
    """doc_id, idioma, comunes of each row: the share of common words in its text, of the language the text itself shows, as labels may be wrong. Null and blank texts have no language and 0."""
    docs = _docs(df, id_col, text_col, format_col).select("doc_id", "texto")
    return map_arrow(spread(docs), per_row(lambda i, t: [(i, *common_share(t, common))], ["doc_id", "texto"], _COMMON), _COMMON)
