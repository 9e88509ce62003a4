"""Problem 5: cutting oversized texts at natural boundaries, with an exact overlap.

Sizes and overlaps are in code points. A text's natural boundaries form a sorted array of offsets with a
rank: 3 paragraph, 2 sentence mark, 1 white space. A piece ends at the last boundary of the best rank in
the second half of its reach, else at the last boundary of any rank, else by a hard cut that avoids
parting a base character from its combining marks. The next piece begins exactly `overlap` earlier.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, code_points, format_of, map_arrow, per_row, spread

#: The marks that count as natural places.
MARKS = ".!?…。！？؟।"
KINDS = {0: "duro", 1: "espacio", 2: "oracion", 3: "parrafo"}
_TOKEN = regex.compile(r"\s+|[^\s.!?…。！？؟।]+|[.!?…。！？؟।]+[)\]}»”’\"']*")
_BLANK = regex.compile(r"\n[^\S\n]*\n")
_NATURAL = np.array(sorted({*SPACES, *map(ord, MARKS)}), dtype=np.uint32)


def boundaries(text: str) -> tuple[list[int], list[int]]:
    """Sorted offsets at which a piece may end, and their ranks: the ends of the tokens (prefix sums of their lengths) that a mark or white space follows."""
    tokens = _TOKEN.findall(text)
    offsets = list(accumulate(map(len, tokens)))
    places, ranks = [], []
    start = 0
    for token, end in zip(tokens, offsets):
        if token[0].isspace():
            if start:
                rank = 3 if _BLANK.search(token) else 1
                if places and places[-1] == start:
                    ranks[-1] = max(ranks[-1], rank)
                else:
                    places.append(start)
                    ranks.append(rank)
            if end - start > 1 and end < len(text):  # long white space is a place at its end, too
                places.append(end)
                ranks.append(1)
        elif token[0] in MARKS:
            places.append(end)
            ranks.append(2)
        start = end
    return places, ranks


def longest_stretch(text: str) -> int:
    """Length of the longest stretch without white space and marks."""
    at = np.flatnonzero(np.isin(code_points(text), _NATURAL))
    return int(np.diff(np.concatenate([[-1], at, [len(text)]])).max()) - 1


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """(start, end, kind of the cut at the end) of the pieces of text; the last one's kind is `fin`. Every piece has at most `limit` code points and begins `overlap` before the end of the one before."""
    if limit <= 0 or not 0 <= overlap < limit:
        raise ValueError("limit must be positive and overlap at least 0 and less than limit")
    n = len(text)
    if n <= limit:
        return [(0, n, "fin")]
    places, ranks = boundaries(text)
    out, start, done = [], 0, 0
    while n - start > limit:
        reach = start + limit
        lo, hi = bisect_right(places, done), bisect_right(places, reach)
        half = max(lo, bisect_right(places, start + limit // 2))
        if half < hi:
            best = max(ranks[half:hi])
            k = next(i for i in range(hi - 1, half - 1, -1) if ranks[i] == best)
            end, kind = places[k], KINDS[best]
        elif lo < hi:
            end, kind = places[hi - 1], KINDS[ranks[hi - 1]]
        else:
            end, kind = reach, "duro"
            for back in range(end, max(done + 1, end - 16), -1):
                if not regex.match(r"\p{M}|‍", text[back]):
                    end = back
                    break
        out.append((start, end, kind))
        start, done = end - overlap, end
    return [*out, (start, n, "fin")]


_PIECES = pa.schema([("doc_id", pa.string()), ("pieza", pa.int32()), ("ini", pa.int32()), ("fin", pa.int32()), ("corte", pa.string()), ("texto", pa.string())])
_CASES = pa.schema([("doc_id", pa.string()), ("clase", pa.string())])


def _limited(df: DataFrame, limits: DataFrame, id_col: str, text_col: str, format_col: str) -> DataFrame:
    docs = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("texto"), format_of(format_col).alias("_f"))
    lim = limits.select(format_of("formato").alias("_f"), "max_chars", "solape_chars").dropna().dropDuplicates(["_f"])
    return docs.join(lim, "_f", "left").drop("_f")


def split_documents(df: DataFrame, limits: DataFrame, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> DataFrame:
    """doc_id, pieza (from 0), ini, fin, corte, texto: the pieces of each row's text.

    A text within the limit, or of a format without one, is one piece; null and empty texts have none. Repeated
    rows give repeated pieces. Only the oversized texts leave the JVM; there is no shuffle.
    """
    docs = _limited(spread(df), limits, id_col, text_col, format_col).filter(F.length("texto") > 0)
    over = F.coalesce(F.length("texto") > F.col("max_chars"), F.lit(False))

    def cut(doc_id, text, limit, overlap):
        return [(doc_id, k, a, b, kind, text[a:b]) for k, (a, b, kind) in enumerate(split_text(text, limit, overlap))]

    whole = docs.filter(~over).select("doc_id", F.lit(0).alias("pieza"), F.lit(0).alias("ini"), F.length("texto").alias("fin"), F.lit("fin").alias("corte"), "texto")
    return map_arrow(docs.filter(over), per_row(cut, ["doc_id", "texto", "max_chars", "solape_chars"], _PIECES), _PIECES).unionByName(whole)


def oversized(df: DataFrame, limits: DataFrame, id_col: str = "doc_id", text_col: str = "texto", format_col: str = "formato") -> DataFrame:
    """doc_id, clase: the documents over their format's limit. `sin_corte` if the operator must cut some stretch hard whatever it does."""
    docs = _limited(spread(df), limits, id_col, text_col, format_col).filter(F.length("texto") > F.col("max_chars"))

    def classify(doc_id, text, limit, overlap):
        kinds = {kind for _, _, kind in split_text(text, limit, overlap)}
        # a hard cut also comes where less than a whole limit is left beside the overlap; the exact check decides
        return [(doc_id, "sin_corte" if "duro" in kinds and longest_stretch(text) > limit else "natural")]

    return map_arrow(docs, per_row(classify, ["doc_id", "texto", "max_chars", "solape_chars"], _CASES), _CASES).distinct()
