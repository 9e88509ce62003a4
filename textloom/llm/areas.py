"""Problem 10: the subject areas of each document.

One linear classifier per area over hashed word unigrams and bigrams scores every sentence; a document has the
areas that enough of its sentences are about. The labelled examples hold few of an area's terms, so further
labels come from where a sentence stands: in the same paragraph and document as sentences of a sure area (its
section). Such weak labels, from a bounded sample of documents, retrain the classifiers in a few rounds; wording
that stands in the sections of all areas alike gets no weight. Then a threshold for each area is set by F1 on a fifth
of the examples and of the sampled documents' sections, by a further fit without them.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import checked_rows, emit, map_arrow, sample_rows, spread

SAMPLE, MOST_EXAMPLES, BUCKETS, ROUNDS, SHARE = 1600, 20_000, 1 << 18, 4, 0.25
#: How far the logit of a sentence's area must lead when it is not likely by itself.
MARGIN = 0.7
#: How far behind the best area another one that is likelier than not may be; one in how many is held out.
BESIDE, HELD = 1.5, 5
#: How far under the best F1 a threshold's may be.
NEAR = 0.005
_END = re.compile(r"(?:[.!?…]+[\"'”’»)\]]*\s+(?=[^\W\d_a-zß-öø-ÿ]|[\"'“„«(¿¡\d])|[。！？।]+[”」』»]?\s*|\n\s*\n)")
_WORD = re.compile(r"[^\W\d_]+")
_INVISIBLE = re.compile("[​-‏⁠﻿\xad]")
_A = np.uint64(0x9E3779B97F4A7C15)


def sections(text: str) -> list[list[str]]:
    """The sentences of each paragraph, folded."""
    text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    out = []
    for para in re.split(r"\n[^\S\n]*\n", text):
        if found := [s.lower() for s in _END.split(para) if s and _WORD.search(s)]:
            out.append(found)
    return out


class Grams:
    """Buckets of the unigrams and bigrams of sentences, with the hashes of words kept."""

    def __init__(self):
        self.words: dict[str, int] = {}

    def of(self, sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The buckets one after the other, and their sentences."""
        if len(self.words) > 300_000:
            self.words = {}
        flat, counts = [], []
        for s in sentences:
            n = len(flat)
            for w in _WORD.findall(s):
                h = self.words.get(w)
                if h is None:
                    h = self.words[w] = zlib.crc32(w.encode())
                flat.append(h)
            counts.append(len(flat) - n)
        h, own = np.array(flat, np.uint64), np.repeat(np.arange(len(sentences)), counts)
        with np.errstate(over="ignore"):
            one = (h * _A) >> np.uint64(46)
            pair = own[1:] == own[:-1]
            two = ((h[:-1][pair] * np.uint64(31) + h[1:][pair]) * _A + np.uint64(7)) * _A >> np.uint64(46)
        return np.concatenate([one, two]).astype(np.int64), np.concatenate([own, own[1:][pair]])


def _fit(ids: np.ndarray, own: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, start: np.ndarray | None = None) -> np.ndarray:
    """Weights (buckets and a bias x areas) of logistic regressions, one versus the rest, by gradient steps scaled by each feature's past gradients."""
    # what stands once among so many sentences tells nothing; dropped here, it has no weight
    n, k = y.shape
    often = np.bincount(ids, minlength=BUCKETS)[ids] > (1 if n > 2000 else 0)
    ids, own = ids[often], own[often]
    used, at = np.unique(ids, return_inverse=True)
    length = np.sqrt(np.maximum(np.bincount(own, minlength=n), 1))
    w, past, b = np.zeros((len(used), k), np.float32), np.full((len(used), k), 1e-3, np.float32), np.full(k, -2.0)
    if start is not None:
        w, b = start[used].copy(), start[BUCKETS].astype(float)
    y = y.astype(np.float32)
    order = np.argsort(own, kind="stable")
    at, own = at[order], own[order]
    starts = np.searchsorted(own, np.arange(n))
    full = np.diff(np.append(starts, len(own))) > 0
    turned = np.argsort(at, kind="stable")
    by_word, word_starts = own[turned], np.searchsorted(at[turned], np.arange(len(used)))
    for _ in range(rounds):
        z = np.zeros((n, k), np.float32)
        z[full] = np.add.reduceat(w[at], starts[full], axis=0) / length[full, None]
        err = (1 / (1 + np.exp(-(z + b))) - y) * weight[:, None] / weight.sum() * 100
        back = err / length[:, None]
        grad = np.add.reduceat(back.astype(np.float32)[by_word], word_starts, axis=0) + 2e-4 * w
        past += grad**2
        w -= 0.5 * grad / np.sqrt(past)
        b -= 0.05 * err.sum(0)
    table = np.zeros((BUCKETS + 1, k), np.float32)
    table[used], table[BUCKETS] = w, b
    return table


class Model:
    def __init__(self, areas: list[str], table: np.ndarray, least: np.ndarray):
        # rounded as it is sent, so that driver and executors score alike
        self.areas, self.table, self.least = areas, table.astype(np.float16).astype(np.float32), least
        self._grams = Grams()

    def __getstate__(self):
        return {"areas": self.areas, "table": self.table.astype(np.float16), "least": self.least}

    def __setstate__(self, s):
        self.__init__(s["areas"], s["table"].astype(np.float32), s["least"])

    def scores(self, sentences: list[str]) -> np.ndarray:
        """The logits of the areas for each sentence."""
        ids, own = self._grams.of(sentences)
        n = len(sentences)
        z = np.zeros((n, len(self.areas)), np.float32)
        order = np.argsort(own, kind="stable")
        ids, own = ids[order], own[order]
        count = np.bincount(own, minlength=n)
        full = np.flatnonzero(count)
        if len(full):
            z[full] = np.add.reduceat(self.table[ids], (np.cumsum(count) - count)[full], axis=0) / np.sqrt(count[full])[:, None]
        return z + self.table[BUCKETS]

    def about(self, sentences: list[str]) -> np.ndarray:
        """Whether each sentence is about each area: likelier than not, or leading all others by MARGIN from the area's threshold on."""
        z = self.scores(sentences)
        return (z > 0) & (z > z.max(1, keepdims=True) - BESIDE) | self.leads(z) & (z >= self.least)

    def leads(self, z: np.ndarray) -> np.ndarray:
        """Whether each area leads all others by MARGIN."""
        best = np.sort(z, axis=1)
        return (z == best[:, -1:]) & (best[:, -1:] - best[:, -2:-1] >= MARGIN) if z.shape[1] > 1 else np.ones_like(z, bool)


def train(examples: list[tuple[str, str]], texts: list[str], areas: list[str]) -> Model:
    index = {a: k for k, a in enumerate(areas)}
    labelled = [(s, index[a]) for a, t in examples if a in index for p in sections(t or "") for s in p]
    docs = [sections(t) for t in texts]
    place = [(d, p) for d, doc in enumerate(docs) for p, para in enumerate(doc) for _ in para]
    free = [s for doc in docs for para in doc for s in para]
    ids, own = Grams().of([s for s, _ in labelled] + free)
    n, m, k = len(labelled), len(free), len(areas)
    y = np.zeros((n + m, k))
    y[np.arange(n), [a for _, a in labelled]] = 1
    weight = np.concatenate([np.full(n, 10.0), np.zeros(m)])
    para_of = np.unique(np.array(place, np.int64).reshape(-1, 2), axis=0, return_inverse=True)[1].ravel() if m else np.zeros(0, np.int64)
    doc_of = np.array([d for d, _ in place], np.int64)
    first = own < n
    table = _fit(ids[first], own[first], y[:n], weight[:n])
    for _ in range(ROUNDS if m else 0):
        z = Model(areas, table, np.zeros(k)).scores(free)
        p = 1 / (1 + np.exp(-z))
        sure = np.where((p > 0.5) & (p >= p.max(1, keepdims=True)), p, 0)
        own_area = sure.max(1) > 0

        def around(group: np.ndarray) -> np.ndarray:
            out = np.zeros((group.max() + 1, k))
            np.add.at(out, group, sure)
            return out[group]

        # what the paragraph and the document say besides the sentence itself
        near, far = around(para_of) - sure, around(doc_of) - sure
        votes = 2 * near + far + 3 * sure
        total = votes.sum(1)
        share = votes / np.maximum(total, 1e-9)[:, None]
        best = share.max(1)
        take = (best > 0.75) & (total > 2.0)
        y[n:] = share > 0.75
        weight[n:] = np.where(take, np.where(own_area, 1.0, 0.6), 0)
        table = _fit(ids, own, y, weight, 30, table)
    model = Model(areas, table, np.zeros(k))
    # a threshold for each area: of those that tell best its sentences in one example and one document in HELD, by a model fitted without them
    held = np.concatenate([np.arange(n) % HELD == HELD - 1, np.array([d % HELD == HELD - 1 for d, _ in place], bool)])
    if (use := held & (weight > 0)).any() and (weight[:n][~held[:n]] > 0).any():
        z = Model(areas, _fit(ids, own, y, np.where(held, 0.0, weight)), model.least).scores([x for x, keep in zip([s for s, _ in labelled] + free, use) if keep])
        for a in range(k):
            model.least[a] = _threshold(model.leads(z)[:, a], z[:, a], y[use, a] == 1)
    return model


def _threshold(leads: np.ndarray, z: np.ndarray, truth: np.ndarray) -> float:
    """The least of the thresholds from -2.5 to 0 with nearly the best F1, for sentences that lead; 0 without any of the area."""
    if not truth.any():
        return 0.0
    grid = np.arange(0.0, -2.55, -0.1)
    f1 = np.array([2 * (leads & (z >= t) & truth).sum() / max(1, (leads & (z >= t)).sum() + truth.sum()) for t in grid])
    return float(grid[np.flatnonzero(f1 >= f1.max() - NEAR)[-1]])


def learn(df: DataFrame, examples: DataFrame, areas: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE) -> Model:
    """Classifiers from the labelled examples and from at most about `most` sampled documents without labels."""
    names = sorted({r[0] for r in checked_rows(areas.select("area").dropna(), 1000, "areas")})
    rows = checked_rows(examples.select("area", "texto").dropna(), MOST_EXAMPLES, "examples")
    docs = df.filter(F.length(text_col) >= 60)
    return train([(r[0], r[1]) for r in rows], [r[0] for r in sample_rows(docs, id_col, text_col, [text_col], most)], names)


def document_areas(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """doc_id, area: the areas that at least `share` of a document's sentences are about.

    Null and blank texts and texts without words have none; equal rows give their areas once.
    """
    schema = pa.schema([("doc_id", to_arrow_type(df.schema[id_col].dataType)), ("area", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                per = [[s for p in sections(t) for s in p] for t in b["texto"].to_pylist()]
                hit = model.about([s for x in per for s in x])
                rows, start = [], 0
                for i, x in zip(b["doc_id"].to_pylist(), per):
                    if x:
                        part = hit[start : start + len(x)].mean(0)
                        rows += [(i, model.areas[k]) for k in np.flatnonzero(part >= share - 1e-9)]
                    start += len(x)
                yield emit(rows, schema)

    return map_arrow(spread(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("texto")).filter(F.col("texto").rlike(r"\S"))), run, schema).distinct()
