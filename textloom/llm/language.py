"""Problem 4: the language of documents and of their segments, with a confidence.

A text is the average of the embeddings of its hashed subwords and of the scripts of its words; a linear softmax gives
the languages. Embeddings and softmax are trained by stochastic gradient descent in numpy on a bounded sample of
labelled texts, twice: the second time without the texts whose label the first model finds out of the question. A
temperature fitted on held-out texts calibrates the confidence, below which a text is left undecided (`und`). So is
one of a language that training hasn't seen: it has too few of the subwords of the language it looks like, measured
on held-out texts of that language, or letters that aren't among that language's. As all is linear, each subword's
contribution to the logits is one row of a table, and a word's is the sum of some rows, kept in a cache.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, format_of, language_of, map_arrow, paragraphs, sample_rows, softmax, spread
from .shape import MARK, Profiles, learn_profiles

#: Sampled texts and their paragraphs at most; words of a stretch of one; characters of short ones.
SAMPLE, PARTS, STRETCH, SHORT = 4000, 8000, 25, 50
BUCKETS, DIM, EPOCHS, LEAST_CHARS = 1 << 15, 16, 4, 20
#: The longest step of an embedding; of the least share of known subwords among held-out texts the part that is enough, and what is enough where there are fewer than FEW of them.
MOST_STEP, ENOUGH, FEW = 0.5, 0.65, 8
#: How much less than its language's share of known subwords a text of one subword may have (of n, by the root of n); share of letters that may be strange to the language.
SLACK, STRANGE = 1.0, 0.025
#: Scripts of thousands of signs, or of syllables.
_MANY_SIGNS = ("CJK", "HIRAGANA", "KATAKANA", "HANGUL", "ETHIOPIC", "YI")
#: How many times likelier than the main language another one must be for a paragraph of SURE_CHARS; a shorter one needs more.
ODDS, SURE_CHARS = 20, 80
PROSE = ("txt", "html", "pdf", "json")
#: Texts of which each line has a language by itself, written for this, so that none is missing when the sample lacks it.
SEEDS = {
    "es": "El barco salió del puerto antes de que amaneciera, y nadie supo por qué no volvió. Los vecinos lo esperaban con una luz encendida en la ventana, según cuentan las abuelas del pueblo.",
    "en": "The boat left the harbour before dawn, and nobody knew why it did not come back. The neighbours were waiting for it with a light in the window, as the grandmothers of the village tell.",
    "pt": "O barco saiu do porto antes do amanhecer, e ninguém soube por que não voltou. Os vizinhos esperavam com uma luz acesa na janela, segundo contam as avós da aldeia, e são muitas.",
    "fr": "Le bateau a quitté le port avant l'aube, et personne n'a su pourquoi il n'était pas revenu. Les voisins l'attendaient avec une lumière à la fenêtre, selon les grands-mères du village.",
    "it": "La barca lasciò il porto prima dell'alba, e nessuno seppe perché non era tornata. I vicini la aspettavano con una luce accesa alla finestra, secondo quanto raccontano le nonne del paese.",
    "ca": "El vaixell va sortir del port abans de l'alba, i ningú no va saber per què no va tornar. Els veïns l'esperaven amb un llum encès a la finestra, segons expliquen les àvies del poble.",
    "de": "Das Boot verließ den Hafen vor der Morgendämmerung, und niemand wusste, warum es nicht zurückkam. Die Nachbarn warteten mit einem Licht im Fenster, wie die Großmütter des Dorfes erzählen.",
    "ru": "Лодка вышла из гавани до рассвета, и никто не знал, почему она не вернулась. Соседи ждали её со светом в окне, как рассказывают бабушки этой деревни.",
    "ar": "غادر القارب الميناء قبل الفجر ولم يعرف أحد لماذا لم يعد. كان الجيران ينتظرونه بضوء في النافذة كما تروي جدات القرية.",
    "hi": "नाव भोर से पहले बंदरगाह से निकल गई और किसी को पता नहीं चला कि वह वापस क्यों नहीं आई। पड़ोसी खिड़की में दीपक जलाकर उसकी प्रतीक्षा करते रहे।",
    "th": "เรือออกจากท่าก่อนรุ่งสาง และไม่มีใครรู้ว่าทำไมมันจึงไม่กลับมา เพื่อนบ้านรอคอยโดยจุดไฟไว้ที่หน้าต่าง ตามที่คุณยายในหมู่บ้านเล่า",
    "zh": "船在天亮之前离开了港口，没有人知道它为什么没有回来。邻居们在窗边点着灯等着它，村里的老奶奶们这样说。",
    "ja": "船は夜明け前に港を出たが、なぜ戻らなかったのかは誰も知らない。隣人たちは窓に明かりをともして待っていたと、村のおばあさんたちは語っている。",
}
#: Single characters of scripts without spaces; else runs of letters with their marks.
TOKEN = re.compile(r"[฀-๿]|[぀-ヿ]|[㐀-鿿]|[가-힣]|(?:(?![฀-๿぀-ヿ㐀-鿿가-힣])[^\W\d_][̀-ًͯ-ٟऀ-ॿ]*)+")


@lru_cache(maxsize=65_536)
def script_of(c: str) -> str:
    """The script of a letter, by the first word of its name."""
    return unicodedata.name(c, "?").partition(" ")[0]


def subwords(word: str) -> list[int]:
    """Buckets of the word itself, of its pieces of two to four characters with its edges, and of its script."""
    w = f"<{word}>"
    grams = {w} | {w[i : i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1)}
    return [zlib.crc32(g.encode()) % BUCKETS for g in sorted(grams)] + [zlib.crc32(f"script:{script_of(word[0])}".encode()) % BUCKETS]


class Model:
    MOST_WORDS = 150_000

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, known: np.ndarray, temperature: float, reject: float, least: np.ndarray, letters: list[str]):
        self.languages, self.table, self.bias, self.known = languages, table, bias, known  # known: of each bucket and language, whether training has seen it so
        self.temperature, self.reject, self.least, self.letters = temperature, reject, least, letters
        self._words: dict[str, int] = {}
        self._rows = np.zeros((0, 2 * len(languages) + 1), np.float32)
        self._new: list[np.ndarray] = []
        self._drop = [dict.fromkeys(map(ord, x)) for x in letters]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__init__(**state)

    def _word(self, w: str) -> int:
        ids = np.array(subwords(w))
        self._new.append(np.concatenate([self.table[ids].sum(0), self.known[ids].sum(0), [len(ids)]]).astype(np.float32))
        k = self._words[w] = len(self._words)
        return k

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The probabilities of the languages for each text, and whether it may be of its likeliest one: it has enough of that language's subwords, and only its letters."""
        if len(self._words) > self.MOST_WORDS:
            self._words, self._rows, self._new = {}, self._rows[:0], []
        get = self._words.get
        at, counts = [], []
        for t in texts:
            n = len(at)
            for w in TOKEN.findall(t.lower()):
                k = get(w)
                at.append(self._word(w) if k is None else k)
            counts.append(len(at) - n)
        if self._new:
            self._rows = np.vstack([self._rows, *self._new])
            self._new = []
        m = len(self.languages)
        total = np.zeros((len(texts), 2 * m + 1))
        counts = np.array(counts)
        full = np.flatnonzero(counts)
        if len(full):
            total[full] = np.add.reduceat(self._rows[np.array(at)], (np.cumsum(counts) - counts)[full], axis=0)
        n = np.maximum(total[:, -1:], 1)
        p = softmax((total[:, :m] / n + self.bias) / self.temperature)
        best = p.argmax(1)
        seen = total[np.arange(len(texts)), m + best] / n[:, 0]
        own = (counts > 0) & (seen >= self.least[best] - SLACK / np.sqrt(n[:, 0]))
        for k in np.flatnonzero(own):
            if not texts[k].isascii() and self._drop[best[k]]:
                own[k] = self._letters(texts[k], int(best[k]))
        return p, own

    def _letters(self, text: str, k: int) -> bool:
        """Whether a text has hardly any letters that language k hasn't."""
        rest = sum(c.isalpha() for c in text.lower().translate(self._drop[k]))
        return rest <= 1 or rest <= STRANGE * sum(c.isalpha() for c in text)

    def name(self, p: np.ndarray, own: bool) -> tuple[str, float]:
        k = int(p.argmax())
        return (self.languages[k], float(p[k])) if own and p[k] >= self.reject else ("und", float(p[k]) if own else 0.0)


def _fit(ids: list[np.ndarray], y: np.ndarray, weight: np.ndarray, classes: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w, b = np.zeros((DIM, classes), np.float32), np.zeros(classes, np.float32)
    order = np.arange(len(ids))
    epochs = max(EPOCHS, min(80, 32_000 // len(ids)))  # few texts are gone through more often
    for epoch in range(epochs):
        rng.shuffle(order)
        rate = 1.0 * (1 - epoch / epochs) + 0.05
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            flat = np.concatenate([ids[k] for k in part])
            counts = np.array([len(ids[k]) for k in part])
            mean = np.add.reduceat(emb[flat], np.cumsum(counts) - counts, axis=0) / counts[:, None]
            err = softmax(mean @ w + b)
            err[np.arange(len(part)), y[part]] -= 1
            err *= (weight[part] / len(part))[:, None]
            back = (err @ w.T / counts[:, None]).astype(np.float32)
            w -= rate * 10 * (mean.T @ err).astype(np.float32)
            b -= rate * err.sum(0).astype(np.float32)
            turned = np.argsort(flat, kind="stable")  # 16 bits: by radix
            by_bucket = flat[turned]
            first = np.flatnonzero(np.concatenate([[True], by_bucket[1:] != by_bucket[:-1]]))
            which = by_bucket[first]
            step = np.add.reduceat(np.repeat(back, counts, axis=0)[turned], first, axis=0)
            step *= rate * 400
            # what stands in nearly every text, such as a script, must not run away
            step /= np.maximum(np.linalg.norm(step, axis=1, keepdims=True) / MOST_STEP, 1)
            emb[which] -= step.astype(np.float32)
    return emb, w, b


def train(examples: list[tuple[str, str]]) -> Model:
    """A model from (language, text); labels may be wrong in part."""
    rare = Counter(lang for lang, _ in examples)
    examples = [(x, t) for x, t in examples if rare[x] >= 3 or x in SEEDS]
    # the seeds weigh little where the sample has a language, and are all there is where it has not
    examples = examples + [(lang, piece) for lang, t in SEEDS.items() for piece in (t, t[: len(t) // 2], t[len(t) // 2 :]) for _ in range(2)]
    languages = sorted({x for x, _ in examples})
    index = {x: k for k, x in enumerate(languages)}
    cache: dict[str, list[int]] = {}
    ids, y, texts = [], [], []
    for lang, t in examples:
        flat = [k for w in TOKEN.findall(t.lower()) for k in (cache.get(w) or cache.setdefault(w, subwords(w)))]
        if flat:
            ids.append(np.array(flat, np.uint16))
            y.append(index[lang])
            texts.append(t)
    y = np.array(y)
    held = np.arange(len(y)) % 6 == 5
    model, keep = None, np.ones(len(y), bool)
    for last in (False, True):
        use = np.flatnonzero(keep & ~held)
        share = np.bincount(y[use], minlength=len(languages))
        weight = np.sqrt(len(use) / len(languages) / np.maximum(share, 1))
        # unweighted at first: labels wrong by chance must not outweigh the right ones of a rare language
        emb, w, b = _fit([ids[k] for k in use], y[use], np.clip(weight[y[use]], 0.3, 3) if last else np.ones(len(use)), len(languages))
        table = (emb @ w).astype(np.float32)
        known = np.zeros((BUCKETS, len(languages)), np.float32)
        for k in use:
            known[ids[k], y[k]] = 1
        logits = np.stack([table[i].mean(0) for i in ids]) + b
        if not last:
            keep = logits.argmax(1) == y
            keep[len(y) - 6 * len(SEEDS) :] = True
            continue
        test = np.flatnonzero(held & keep)
        spread_ = [(-np.log(np.maximum(softmax(logits[test] / t)[np.arange(len(test)), y[test]], 1e-9)).mean(), t) for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0)]
        temperature = min(spread_)[1]
        p = softmax(logits[test] / temperature)
        top, right = p.max(1), p.argmax(1) == y[test]
        # the lowest confidence from which on held-out texts are right 99 times in 100
        reject = next((float(c) for c in np.linspace(0.3, 0.9, 13) if (top >= c).any() and right[top >= c].mean() >= 0.99), 0.5) if len(test) else 0.5
        least, letters = np.full(len(languages), 0.2), []
        fit = np.array([known[ids[k], y[k]].mean() for k in test])
        for k in range(len(languages)):
            if (mine := fit[y[test] == k]).size:
                least[k] = ENOUGH * float(np.quantile(mine, 0.02)) if mine.size >= FEW else 0.3
            # what is a letter of the language: of alphabets, not of scripts with thousands of signs
            count = Counter(c for i in np.flatnonzero(keep & (y == k)) for c in texts[i].lower() if c.isalpha())
            signs = sum(n for c, n in count.items() if script_of(c) in _MANY_SIGNS)
            letters.append("".join(sorted(c for c, n in count.items() if n >= 2e-4 * count.total())) if 2 * signs < count.total() else "")
        model = Model(languages, table, b, known, temperature, reject, least, letters)
    return model


def sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato", language_col: str = "idioma", most: int = SAMPLE) -> list[tuple[str, str, str]]:
    """(label, text, format) of at most `most` texts of the prose formats."""
    docs = df.filter(format_of(format_col).isin(*PROSE) & (F.length(text_col) >= 60))
    return [tuple(r) for r in sample_rows(docs, id_col, text_col, [F.col(language_col).cast("string"), F.col(text_col), format_of(format_col)], most)]


def examples_of(rows: list[tuple[str, str, str]], most: int = PARTS) -> list[tuple[str, str]]:
    """(language, stretch) of the paragraphs of sampled texts with a label, at most `most`, picked by a hash: STRETCH words from a place that the hash says; of every third one only SHORT characters, so that short ones are learned too."""
    parts = [(zlib.crc32(f"{k} {a} {text[a:b]}".encode("utf-8", "surrogatepass")), lang, text[a:b]) for label, text, _ in rows if (lang := language_of(label)) for k, a, b in paragraphs(text) if b - a >= LEAST_CHARS]
    out = []
    for h, lang, t in sorted(parts)[:most]:
        words = t.split()
        at = h // 3 % max(1, len(words) - STRETCH + 1)
        t = " ".join(words[at : at + STRETCH])
        out.append((lang, t if h % 3 else t[:SHORT]))
    return out


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato", language_col: str = "idioma", most: int = SAMPLE) -> Model:
    """A model from the paragraphs of at most `most` sampled labelled texts of the prose formats."""
    return train(examples_of(sample(df, id_col, text_col, format_col, language_col, most)))


def segments(text: str, formato: str) -> list[tuple[int, int, int]]:
    """The parts by which a document's language is told: (paragraph or 0, start, end). In txt its paragraphs, else its lines with sentences (all lines if it has none)."""
    if formato == "txt":
        return [(k, a, b) for k, a, b in paragraphs(text) if b - a >= LEAST_CHARS]
    lines, at = [], 0
    for line in text.split("\n"):
        if line.strip():
            lines.append((0, at, at + len(line)))
        at += len(line) + 1
    return [x for x in lines if x[2] - x[1] >= 40 and MARK.search(text, x[1], x[2])] or lines


def decide(model: Model, batch: list[tuple[str, str]]) -> list[tuple[str, float, list[tuple[int, str, float]]]]:
    """For each (text, format): the main language, its confidence, and of each paragraph of a txt another language its number, language, confidence."""
    parts = [segments(t, f) for t, f in batch]
    p, own_ = model.predict([t[a:b] for (t, _), seg in zip(batch, parts) for _, a, b in seg])
    out, at = [], 0
    for (text, formato), seg in zip(batch, parts):
        n = len(seg)
        names = [model.name(p[at + k], own_[at + k]) for k in range(n)]
        size = np.array([b - a for _, a, b in seg], float)
        votes: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
        for (lang, conf), chars in zip(names, size):
            if lang != "und":
                # most paragraphs in txt, else most of the text; the other breaks ties
                votes[lang][0] += 1 if formato == "txt" else chars * conf
                votes[lang][1] += chars
        main = max(votes, key=lambda x: (votes[x], x), default="und")
        mean = (p[at : at + n] * size[:, None]).sum(0) / max(size.sum(), 1) if n else np.zeros(len(model.languages))
        conf = float(mean[model.languages.index(main)]) if main != "und" else float(mean.max(initial=0))
        foreign = []
        if formato == "txt" and main != "und":
            own = p[at : at + n, model.languages.index(main)]
            foreign = [(k, *x) for (k, a, b), x, o in zip(seg, names, own) if x[0] not in (main, "und") and x[1] > ODDS * max(1.0, SURE_CHARS / (b - a)) ** 4 * o]
        out.append((main, conf, foreign))
        at += n
    return out


_LANG = pa.schema([("doc_id", pa.string()), ("parrafo", pa.int32()), ("idioma_real", pa.string()), ("confianza", pa.float64())])
_FOUND = pa.schema(list(_LANG)[:3])


def _docs(df: DataFrame, id_col: str, text_col: str, format_col: str, language_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("texto"), format_of(format_col).alias("formato"), F.col(language_col).cast("string").alias("idioma"))


def _batches(batches: Iterator[pa.RecordBatch], each: int = 256):
    for whole in batches:
        for at in range(0, whole.num_rows, each):
            b = whole.slice(at, each)
            yield [b[c].to_pylist() for c in ("doc_id", "texto", "formato", "idioma")]


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato", language_col: str = "idioma") -> DataFrame:
    """doc_id, parrafo, idioma_real, confianza: for every distinct document its main language (parrafo 0), and that of each txt paragraph in another.

    A text that is null, blank or shorter than 20 characters is `und` with confidence 0. Repeated rows give their result once.
    """

    def run(batches):
        for ids, texts, formats, _ in _batches(batches):
            rows = []
            long = [k for k, t in enumerate(texts) if t and len(t.strip()) >= LEAST_CHARS]
            done = dict(zip(long, decide(model, [(texts[k], formats[k] or "") for k in long])))
            for k, i in enumerate(ids):
                main, conf, parts = done.get(k, ("und", 0.0, []))
                rows.append((i, 0, main, round(conf, 6)))
                rows += [(i, n, lang, round(c, 6)) for n, lang, c in parts]
            yield emit(rows, _LANG)

    return map_arrow(spread(_docs(df, id_col, text_col, format_col, language_col)), run, _LANG).distinct()


def wrong_labels(df: DataFrame, model: Model, profiles: Profiles, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato", language_col: str = "idioma") -> DataFrame:
    """doc_id, parrafo, idioma_real: prose documents whose label is missing or names another language (parrafo 0), and txt paragraphs in another language than the main one."""
    docs = _docs(df, id_col, text_col, format_col, language_col).filter(F.col("formato").isin(*PROSE) & (F.length(F.trim("texto")) >= LEAST_CHARS))

    def run(batches):
        for ids, texts, formats, labels in _batches(batches):
            rows = []
            for i, t, f, label, (main, _, parts) in zip(ids, texts, formats, labels, decide(model, list(zip(texts, formats)))):
                if main == "und" or len(t.strip()) < LEAST_CHARS:
                    continue
                if language_of(label) != main and (f not in ("pdf", "json") or profiles.classify(t) == "prosa"):
                    rows.append((i, 0, main))
                rows += [(i, n, lang) for n, lang, _ in parts]
            yield emit(rows, _FOUND)

    return map_arrow(spread(docs), run, _FOUND).distinct()


def mislabelled(df: DataFrame) -> DataFrame:
    return wrong_labels(df, learn(df), learn_profiles(df))
