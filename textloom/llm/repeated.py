"""Problem 6: lines repeated across the documents of one source.

Every line is folded (Unicode form, letter case, white space), and its numbers, dates and names are masked. Minimum
hashes over the five-word shingles of the masked line (over the whole line if it is shorter) put the lines of a source
into clusters, one for each band. Clusters that stand in enough documents propose; the text decides: for
`repeated_lines` equal lines are counted exactly, for `without_repeated` a line goes if it shares at least 0.8 of the
shingles with a frequent line of its cluster.

What is shuffled first is a count for each source and cluster, added up before the shuffle, so no source or line is a
hot key; only the lines of frequent clusters come further. The few frequent clusters of a source are one row, which is
joined to the source's documents: broadcast if all are small, else a join of which AQE splits a hot source's documents.
Sources and documents are told apart by 64-bit hashes, lines by 128-bit ones.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import code_points, cut_lineage, emit, map_arrow, spread

LEAST_DOCS, SHARE, LETTERS, SHINGLE, ALIKE = 4, 0.14, 4, 5, 0.8
#: Bands of one minimum hash each: lines of similarity 0.8 share one of them 24 times in 25.
BANDS = 2
#: Bytes of the frequent clusters of all sources up to which they go to every task.
BROADCAST_BYTES = 64 << 20
_NUMBER = re.compile(r"\d+")
_FOUR = re.compile(r"(?:[^\W\d_][\W\d_]*){4}")
#: Dates in folded lines: numeric, with the month as a word between or before numbers, in ideographs.
_DATE = re.compile(r"# ?[/.\-] ?# ?[/.\-] ?#|#(?:\.|st|nd|rd|th|er|º|ª)? (?:de |of |do )?[^\W\d_]{3,}\.?,? (?:de |of |do |del )?#|[^\W\d_]{3,}\.? #(?:st|nd|rd|th)?, #|#年#月#日")
#: A run of words with capitals that doesn't begin a line or a sentence.
_NAME = re.compile(r"(?<=[^\s.!?¡¿(«“\"][ \t])[A-ZÀ-ÖØ-ÞΑ-ΩА-Я][\w'’-]*(?:[ \t]+(?:(?:de|del|la|of|da|do|du|von|van|di)[ \t]+)?[A-ZÀ-ÖØ-ÞΑ-ΩА-Я][\w'’-]*)*")
#: Lines of a cluster with masked names that its documents have on average at most; rows of a table have more.
OWN_LINES = 1.5
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))

_A_INVERSE = np.uint64(pow(int(_A), -1, 2**64))


def source_key(c: str | Column) -> Column:
    """A source whatever its letter case, slash direction, final slash or leading ./"""
    c = F.col(c) if isinstance(c, str) else c
    c = F.regexp_replace(F.lower(F.trim(c)), r"[\\/]+", "/")
    return F.regexp_replace(F.regexp_replace(c, r"^(\./)+", ""), r"/+$", "")


def fold(text: str) -> list[str]:
    """The lines of text, folded, with # for each number."""
    text = _NUMBER.sub("#", unicodedata.normalize("NFKC", text).casefold())
    return [" ".join(line.split()) for line in text.split("\n")]


def mask(lines: list[str], name: str) -> list[str]:
    """Folded lines without dates and the source's own name (folded): alike for lines that are alike when folded."""
    lines = [_DATE.sub("#", x) if x.count("#") > 1 else x for x in lines]
    return [x.replace(name, "@") for x in lines] if name else lines


def without_names(text: str) -> str:
    return _NAME.sub("@", text)


_WORDS = re.compile(r"[^\W\d_]+")


def own_name(source: str) -> str:
    """The name of a source as it stands in its lines, from its folded path."""
    return source.rpartition("/")[2].replace("_", " ")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _B
    return (h ^ (h >> np.uint64(29))) * _C


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumprod(np.full(n, _A)), np.cumprod(np.full(n, _A_INVERSE))


def sketch(lines: list[str], bands: int = BANDS) -> np.ndarray:
    """For each band the minimum hash of each line (none may be empty) over its shingles of five words, or a hash of the whole line; all at once, without a loop over words."""
    if not lines:
        return np.zeros((bands, 0), np.uint64)
    codes = code_points(" ".join(lines) + " ")
    n = len(codes)
    up, down = _powers(1 << (n - 1).bit_length())
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_mix(codes.astype(np.uint64)) * up[:n], out=total[1:])
        stop = np.flatnonzero(codes == 32)
        begin = np.concatenate([[0], stop[:-1] + 1])
        # a hash of a word: the difference of sums, moved to its first power by the inverse
        word = _mix((total[stop] - total[begin]) * down[begin])
        count = np.fromiter((x.count(" ") + 1 for x in lines), np.int64, len(lines))
        last = np.cumsum(count)
        first = last - count
        left = np.repeat(last, count) - np.arange(len(word))  # words from this one to the line's end
        gram = word.copy()
        for k in range(1, SHINGLE):
            moved = np.zeros_like(word)
            moved[:-k or None] = word[k:]
            gram = np.where(left > k, _mix(gram * _A + moved), gram)
        none = (left < SHINGLE) & np.repeat(count >= SHINGLE, count)
        out = np.empty((bands, len(lines)), np.uint64)
        for band in range(bands):
            seen = _mix(gram ^ (np.uint64(band) * _C)) if band else gram
            out[band] = np.where(count < SHINGLE, gram[first], np.minimum.reduceat(np.where(none, np.uint64(2**64 - 1), seen), first))
        return out


def _enough(line: str) -> bool:
    return _FOUR.search(line) is not None


def _parts(batches: Iterator[pa.RecordBatch], bands: int, names: Callable[[pa.RecordBatch], list[bool]] | None = None):
    """Of some documents at a time (2,048, or 2 MB of text): the batch, and of each line with enough letters its document's place in it, its number, its folded and its masked text, its clusters' keys.

    In documents for which `names` holds, a line that has names, but more other words, comes a second time with its names masked, in clusters of its own, whose keys are odd.
    """
    for whole in batches:
        size = pc.binary_length(whole["texto"]).to_numpy(zero_copy_only=False)
        at = 0
        while at < whole.num_rows:
            n = max(1, min(2048, int(np.searchsorted(np.cumsum(size[at : at + 2048]), 2 << 20))))
            b = whole.slice(at, n)
            at += n
            row, number, folded, masked = [], [], [], []
            twice: list[tuple[int, int, str, str]] = []
            named = names(b) if names else [False] * n
            for r, (t, source) in enumerate(zip(b["texto"].to_pylist(), b["fuente"].to_pylist())):
                name, lines = own_name(source), fold(t)
                own = mask(lines, name)
                for k, (line, m) in enumerate(zip(lines, own), 1):
                    if _enough(line):
                        row.append(r)
                        number.append(k)
                        folded.append(line)
                        masked.append(m)
                if named[r] and (bare := without_names(t)) != t:
                    changed = [(k, x) for k, (x, y) in enumerate(zip(bare.split("\n"), t.split("\n")), 1) if x != y]
                    for (k, _), x in zip(changed, mask(fold("\n".join(x for _, x in changed)), name)):
                        m = own[k - 1]
                        if x != m and _enough(x) and 3 * len(_WORDS.findall(x)) >= 2 * len(_WORDS.findall(m)) >= 8:
                            twice.append((r, k, lines[k - 1], x))
            plain = len(row)
            for rest, column in zip(zip(*twice), (row, number, folded, masked)):
                column += rest
            keys = sketch(masked, bands)
            keys[:, :plain] &= ~np.uint64(1)
            keys[:, plain:] |= np.uint64(1)
            yield b, np.array(row, np.int64), np.array(number, np.int32), folded, masked, keys.view(np.int64), plain


_COUNTED = pa.schema([("origen", pa.int64()), ("grupo", pa.int64()), ("n", pa.int64())])
_PLACES = pa.schema([("origen", pa.int64()), ("doc", pa.int64()), ("doc_id", pa.string()), ("linea", pa.int32()), ("igual", pa.binary())])
_FORMS = pa.schema([("origen", pa.int64()), ("grupo", pa.int64()), ("doc", pa.int64()), ("forma", pa.binary()), ("molde", pa.string()), ("nombres", pa.bool_())])
_CLEAN = pa.schema([("doc_id", pa.string()), ("texto", pa.string()), ("quitadas", pa.int32())])


def _counted(bands: int, names: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, row, _, _, masked, keys, _ in _parts(batches, bands, (lambda b: [True] * b.num_rows) if names else None):
            origin = b["origen"].to_numpy()[row]
            short = np.fromiter((m.count(" ") + 1 < SHINGLE for m in masked), bool, len(masked))
            # of a short line all bands are the same
            x = pd.concat([pd.DataFrame({"o": origin[use], "g": keys[k][use], "r": row[use]}) for k in range(bands) for use in [slice(None) if k == 0 else ~short]])
            n = x.drop_duplicates().groupby(["o", "g"]).size().reset_index()
            yield pa.RecordBatch.from_arrays([pa.array(n[c].to_numpy(np.int64)) for c in n.columns], schema=_COUNTED)

    return run


@lru_cache(maxsize=4096)
def _wanted(packed: bytes) -> frozenset[int]:
    return frozenset(np.frombuffer(packed, np.int64).tolist())


@lru_cache(maxsize=4096)
def _odd(packed: bytes) -> bool:
    return bool((np.frombuffer(packed, np.int64) & 1).any())


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b, row, number, folded, _, keys, _ in _parts(batches, 1):
        wanted = [_wanted(x) for x in b["grupos"].to_pylist()]
        use = np.fromiter((k in wanted[r] for k, r in zip(keys[0].tolist(), row.tolist())), bool, len(row))
        at = pa.array(row[use])
        same = pa.array([xxhash.xxh3_128_digest(folded[k].encode("utf-8", "surrogatepass")) for k in np.flatnonzero(use)], pa.binary())
        yield pa.RecordBatch.from_arrays([b["origen"].take(at), b["doc"].take(at), b["doc_id"].take(at), pa.array(number[use]), same], schema=_PLACES)


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sent: set = set()
    for b, row, _, _, masked, keys, plain in _parts(batches, BANDS, lambda b: [_odd(x) for x in b["grupos"].to_pylist()]):
        wanted, origin, doc = [_wanted(x) for x in b["grupos"].to_pylist()], b["origen"].to_pylist(), b["doc"].to_pylist()
        out = []
        for k, (r, m) in enumerate(zip(row.tolist(), masked)):
            for key in {int(x) for x in keys[:, k]} & wanted[r]:
                form = xxhash.xxh3_128_digest(m.encode("utf-8", "surrogatepass"))
                first = (origin[r], key, form) not in sent
                if len(sent) > 300_000:  # only saves sending a text again
                    sent.clear()
                sent.add((origin[r], key, form))
                out.append((origin[r], key, doc[r], form, m if first else None, k >= plain))
        yield emit(out, _FORMS)


def _docs(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    docs = df.select(source_key(source_col).alias("fuente"), F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("texto"))
    return docs.filter("fuente is not null and doc_id is not null").withColumns({"origen": F.xxhash64("fuente"), "doc": F.xxhash64("doc_id")})


def _many(n: str) -> Column:
    return (F.col(n) >= LEAST_DOCS) & (F.col(n) >= SHARE * F.col("de"))


def _clusters(docs: DataFrame, sizes: DataFrame, bands: int, names: bool = False) -> DataFrame:
    """origen, grupo, de: clusters that may stand in many of their source's `de` documents. Repeated rows of a document may count more than once here, so none is missed."""
    counted = map_arrow(spread(docs.filter("texto is not null")).select("origen", "fuente", "texto"), _counted(bands, names), _COUNTED)
    return counted.groupBy("origen", "grupo").agg(F.sum("n").alias("_n")).join(sizes, "origen").filter(_many("_n")).select("origen", "grupo", "de")


def _sizes(docs: DataFrame) -> DataFrame:
    return docs.select("origen", "doc").distinct().groupBy("origen").agg(F.count("*").alias("de"))


def _beside(docs: DataFrame, packed: DataFrame, how: str) -> DataFrame:
    """The documents with their source's row of a small table (origen and one packed value), which is broadcast if it has BROADCAST_BYTES at most; else a join, of which AQE splits a hot source's documents."""
    packed = cut_lineage(packed)
    size = packed.agg(F.sum(F.octet_length(packed.columns[1]) + 16)).first()[0] or 0
    return docs.join(F.broadcast(packed) if size <= BROADCAST_BYTES else packed, "origen", how)


def _with_clusters(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """The documents with their source's frequent clusters, packed in one value; those of sources without any are left out. A source has at most its lines of a document / SHARE of them."""
    each = clusters.groupBy("origen").agg(F.sort_array(F.collect_set("grupo")).alias("_g"))
    packed = map_arrow(each, lambda batches: (pa.RecordBatch.from_arrays([b["origen"], pa.array([np.array(g, np.int64).tobytes() for g in b["_g"].to_pylist()], pa.binary())], names=["origen", "grupos"]) for b in batches), pa.schema([("origen", pa.int64()), ("grupos", pa.binary())]))
    return _beside(spread(docs.filter("texto is not null")), packed, "inner")


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", source_col: str = "fuente") -> DataFrame:
    """doc_id, linea: lines that stand, but for case, white space, Unicode form and digits, in many documents of their source.

    The candidates are the lines of the frequent clusters (equal lines share every band, so one band proposes them
    all); which of them are the same, and in how many documents, is then counted exactly. A null source or id names
    nothing to repeat within and gives no rows; repeated rows of a document count once.
    """
    docs = _docs(df, id_col, text_col, source_col)
    sizes = _sizes(docs)
    lines = cut_lineage(map_arrow(_with_clusters(docs, _clusters(docs, sizes, 1)), _places, _PLACES))
    same = lines.select("origen", "igual", "doc").distinct().groupBy("origen", "igual").agg(F.count("*").alias("_n")).join(sizes, "origen").filter(_many("_n")).select("origen", "igual")
    return lines.join(same, ["origen", "igual"]).select("doc_id", "linea").distinct()


@lru_cache(maxsize=20_000)
def shingles(line: str) -> frozenset[str]:
    words = line.split()
    return frozenset(" ".join(words[k : k + SHINGLE]) for k in range(len(words) - SHINGLE + 1)) or frozenset([line])


def alike(a: str, b: str) -> bool:
    """Whether two masked lines share at least ALIKE of their shingles."""
    if a == b:
        return True
    x, y = shingles(a), shingles(b)
    return len(x & y) >= ALIKE * len(x | y)


@lru_cache(maxsize=1024)
def _moulds(packed: str) -> dict[int, list[str]]:
    return {int(k): v for k, v in json.loads(packed).items()}


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b, row, number, _, masked, keys, _ in _parts(batches, BANDS, lambda b: [any(k & 1 for k in _moulds(x)) for x in b["moldes"].to_pylist()]):
        moulds = [_moulds(x) for x in b["moldes"].to_pylist()]
        gone: dict[int, set[int]] = {}
        for k, (r, n, m) in enumerate(zip(row.tolist(), number.tolist(), masked)):
            if (own := moulds[r]) and any(alike(m, c) for key in {int(x) for x in keys[:, k]} for c in own.get(key, ())):
                gone.setdefault(r, set()).add(n)
        texts = b["texto"].to_pylist()
        for r, lines in gone.items():
            texts[r] = "\n".join(x for k, x in enumerate(texts[r].split("\n"), 1) if k not in lines)
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(texts, pa.string()), pa.array([len(gone.get(r, ())) for r in range(b.num_rows)], pa.int32())], schema=_CLEAN)


def without_repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "texto", source_col: str = "fuente") -> DataFrame:
    """doc_id, texto, quitadas: every row's text without the lines of its source's frequent clusters, and how many went.

    A cluster is frequent if many documents have a line of it, counted once each; one of lines with masked names, if
    they also have few such lines each, as notices are and rows of a table aren't. A line goes if it shares at least
    0.8 of its masked shingles with the cluster's most frequent line, or with one that is frequent by itself. Rows with
    a null text, source or id stay as they are. Texts aren't shuffled where the frequent clusters of all sources are
    small enough to be broadcast; a source with a third of all rows is split by AQE where they aren't.
    """
    docs = _docs(df, id_col, text_col, source_col)
    sizes = _sizes(docs)
    forms = cut_lineage(map_arrow(_with_clusters(docs, _clusters(docs, sizes, BANDS, True)), _forms, _FORMS))
    per_doc = forms.groupBy("origen", "grupo", "nombres", "doc").agg(F.count("*").alias("_l")).groupBy("origen", "grupo", "nombres").agg(F.count("*").alias("_n"), F.sum("_l").alias("_l"))
    many = per_doc.filter(~F.col("nombres") | (F.col("_l") <= OWN_LINES * F.col("_n"))).join(sizes, "origen").filter(_many("_n")).select("origen", "grupo", "de")
    each = forms.groupBy("origen", "grupo", "forma").agg(F.count("*").alias("_f"), F.max("molde").alias("molde"))
    # at most 1 / SHARE of a cluster's lines are frequent by themselves
    kept = each.join(many, ["origen", "grupo"]).groupBy("origen", "grupo").agg(F.max_by("molde", F.struct("_f", "molde")).alias("_c"), F.collect_set(F.when(_many("_f"), F.col("molde"))).alias("_m"))
    kept = kept.select("origen", F.struct(F.col("grupo").cast("string"), F.array_union(F.array("_c"), "_m").alias("m")).alias("_e"))
    moulds = kept.groupBy("origen").agg(F.to_json(F.map_from_entries(F.collect_list("_e"))).alias("moldes"))
    texts = _beside(spread(docs.filter("texto is not null")), moulds, "left").select("doc_id", "fuente", "texto", "moldes")
    whole = texts.filter("moldes is null").select("doc_id", "texto", F.lit(0).alias("quitadas"))
    rest = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("texto"), F.lit(0).alias("quitadas")).filter(F.col("texto").isNull() | F.col("doc_id").isNull() | source_key(source_col).isNull())
    return map_arrow(texts.filter("moldes is not null"), _cleaned, _CLEAN).unionByName(whole).unionByName(rest)
