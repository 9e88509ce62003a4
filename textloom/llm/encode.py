"""Problem 8: encoding of a corpus with a public tokenizer, each shared piece of text once.

A text is cut where a rolling hash of its last characters says so, so equal passages of
different texts give equal pieces. Pieces are counted by their hashes first. A text all of whose
pieces stand in it alone has nothing to share and is encoded where it is. Of the others each
distinct piece is encoded once; where two pieces meet, the stretch between the last sure token
boundary of the left one and the first of the right one is encoded again.

A sure boundary is a place that the tokenizer's pattern never has inside a pre-token, whatever
stands around it: before white space that follows something else, and between a letter or a digit
and a sign that is neither (the pattern has no alternative in which they follow each other in this
order). The text between two sure boundaries gives the same ids alone as in the whole text, so the
result equals that of encoding the whole text.
"""

from __future__ import annotations

import base64
import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import bit_filter, code_points, cut_lineage, emit, map_arrow, spread

#: Fixed value: the pattern that comes with the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SURE = regex.compile(r"(?<=\S)(?=\s)|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}])")
SURE_BACK = regex.compile(r"(?r)(?<=\S)(?=\s)|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}])")
WINDOW, BITS, LEAST, MOST = 16, 10, 256, 8192
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def tokenizer_dir() -> str:
    return os.environ.get("TEXTLOOM_TOKENIZERS", "/opt/tokenizers")


@lru_cache(maxsize=4)
def encoder(path: str):
    """A tiktoken encoding from a file of ranks; no special tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=64)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumprod(np.full(n, _BASE)), np.cumprod(np.full(n, _INVERSE))


def cuts(text: str) -> list[int]:
    """Ends of the pieces of text: where the hash of the last WINDOW characters has BITS zero bits, not before LEAST and at MOST at the latest."""
    n = len(text)
    if n <= LEAST:
        return [n]
    up, down = _powers(1 << (n - 1).bit_length())
    with np.errstate(over="ignore"):
        mixed = (code_points(text).astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        total = np.cumsum(mixed * up[:n])
        rolled = total.copy()
        rolled[WINDOW:] -= total[:-WINDOW]
        rolled *= down[:n]
    places = np.flatnonzero(rolled >> np.uint64(64 - BITS) == 0) + 1
    ends, start = [], 0
    for p in places.tolist():
        while p - start > MOST:
            start += MOST
            ends.append(start)
        if p - start >= LEAST and p < n:
            ends.append(p)
            start = p
    while n - start > MOST:
        start += MOST
        ends.append(start)
    return [*ends, n]


def pieces(text: str) -> list[str]:
    ends = cuts(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def encode_piece(enc, text: str) -> tuple[list[int], int, int]:
    """The ids of a piece, and how many of them lie before its first and after its last sure boundary; -1, -1 if it has none."""
    first = SURE.search(text)
    if first is None:
        return enc.encode_ordinary(text), -1, -1
    p = SURE_BACK.search(text).start()
    head, middle, tail = (enc.encode_ordinary(x) for x in (text[: first.start()], text[first.start() : p], text[p:]))
    return head + middle + tail, len(head), len(tail)


def join_pieces(enc, parts: list[tuple[list[int], int, int]]) -> list[int]:
    """The ids of the whole text from those of its pieces in order."""
    out: list[int] = []
    open_ids: list[int] = []  # ids from the last sure boundary on; not final
    began = False
    for ids, head, tail in parts:
        if not began:
            began = True
            k = len(ids) - tail if head >= 0 else 0
            out, open_ids = list(ids[:k]), list(ids[k:])
            continue
        if head < 0:
            open_ids = enc.encode_ordinary(enc.decode_bytes(open_ids + ids).decode("utf-8"))
            continue
        # the head may hold signs that end an open stretch without any sure boundary before
        out += enc.encode_ordinary((enc.decode_bytes(open_ids) + enc.decode_bytes(ids[:head])).decode("utf-8"))
        k = len(ids) - tail
        out += ids[head:k]
        open_ids = list(ids[k:])
    return out + open_ids


_HASHES = pa.schema([("h", pa.binary()), ("n", pa.int64())])
_CODED = pa.schema([("h", pa.binary()), ("ids", pa.list_(pa.int32())), ("head", pa.int32()), ("tail", pa.int32())])


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, ids: the ids of each distinct pair of id and text, without special tokens; strings that look like special tokens are ordinary text.

    An empty and a null text have an empty list. A row that repeats another's id and text gives no further row; one
    id with two texts gives two; a null id is treated as any other. Other columns of df are not looked at.
    Shuffled are a hash and a count for each piece, and of texts that share pieces each distinct piece once per task
    and its ids; a piece that a third of all texts have is joined by many tasks (AQE splits the side of the documents).
    Which pieces are shared goes to every task as a filter of at most SIEVE_BITS bits, which may take an unshared one
    for shared, never the other way.
    """
    path = path or f"{tokenizer_dir()}/byte_bpe_50k.tiktoken"
    id_type = to_arrow_type(df.schema[id_col].dataType)
    docs = spread(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    parts_schema = pa.schema([("doc_id", id_type), ("whole", pa.int64()), ("seq", pa.int32()), ("h", pa.binary()), ("piece", pa.string())])
    out_schema = pa.schema([("doc_id", id_type), ("ids", pa.list_(pa.int32()))])
    filled = docs.filter(F.length("text") > 0)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield emit(list(Counter(xxhash.xxh3_128_digest(p.encode()) for t in b["text"].to_pylist() for p in pieces(t)).items()), _HASHES)

    shared = bit_filter(map_arrow(filled.select("text"), hashes, _HASHES).groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h"), "h")

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            yield emit([(i, enc.encode_ordinary(t)) for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()) if not shares(t)], out_schema)

    def shares(text: str) -> bool:
        return any(shared.has(xxhash.xxh3_128_digest(p.encode())) for p in pieces(text))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            rows = []
            for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                cut = [(p, xxhash.xxh3_128_digest(p.encode())) for p in pieces(t)]
                if not any(shared.has(h) for _, h in cut):
                    continue
                whole = xxhash.xxh3_64_intdigest(t.encode()) - 2**63
                for k, (p, h) in enumerate(cut):
                    rows.append((i, whole, k, h, None if h in seen else p))
                    if len(seen) >= 500_000:  # only saves keeping a piece again; the next stage takes one of each anyway
                        seen.clear()
                    seen.add(h)
            yield emit(rows, parts_schema)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, last = encoder(path), None
        for b in batches:
            rows = []
            for h, p in zip(b["h"].to_pylist(), b["piece"].to_pylist()):
                if h != last:  # sorted: equal pieces follow each other
                    last = h
                    rows.append((h, *encode_piece(enc, p)))
            yield emit(rows, _CODED)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, now, held = encoder(path), None, []
        for b in batches:
            rows = []
            for i, whole, k, ids, head, tail in zip(*(b[c].to_pylist() for c in ("doc_id", "whole", "seq", "ids", "head", "tail"))):
                if held and (i, whole) != now:
                    rows.append((now[0], join_pieces(enc, held)))
                    held = []
                now = (i, whole)
                if k == len(held):  # a repeated row brings its pieces again
                    held.append((ids, head, tail))
            yield emit(rows, out_schema)
        if held:
            yield emit([(now[0], join_pieces(enc, held))], out_schema)

    kept = cut_lineage(map_arrow(filled, parts, parts_schema))
    coded = map_arrow(kept.filter("piece is not null").select("h", "piece").repartition("h").sortWithinPartitions("h"), code, _CODED)
    joined = kept.drop("piece").distinct().join(coded, "h").select("doc_id", "whole", "seq", "ids", "head", "tail")
    whole = map_arrow(joined.repartition("doc_id", "whole").sortWithinPartitions("doc_id", "whole", "seq"), join, out_schema)
    empty = docs.filter(F.coalesce(F.length("text"), F.lit(0)) == 0).select("doc_id").distinct().select("doc_id", F.array().cast("array<int>").alias("ids"))
    return map_arrow(filled, alone, out_schema).unionByName(whole).unionByName(empty)


def token_counts(df: DataFrame, keep: list[str], text_col: str, path: str | None = None) -> DataFrame:
    """The columns `keep` and tokens, the number of each text's ids (0 for null and empty)."""
    path = path or f"{tokenizer_dir()}/byte_bpe_50k.tiktoken"
    schema = pa.schema([*((c, to_arrow_type(df.schema[c].dataType)) for c in keep), ("tokens", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b[c].cast(schema.field(c).type) for c in keep), pa.array(n, pa.int32())], schema=schema)

    return map_arrow(spread(df.select(*keep, F.col(text_col).cast("string").alias("_text"))), run, schema)
