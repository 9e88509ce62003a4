"""What the operators of this subpackage share: reading, spreading, text positions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ..session import cut_lineage  # noqa: F401

SPACES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores; unchanged (no shuffle) if it has them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: pa.Schema) -> DataFrame:
    return df.mapInArrow(fn, from_arrow_schema(schema))


def emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of rows given as tuples."""
    cols = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


def per_row(fn: Callable[..., list[tuple]], columns: list[str], schema: pa.Schema, flush: int = 20_000) -> Callable:
    """For mapInArrow: fn(*values of the columns) gives the rows that come out of one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in columns)):
                out += fn(*values)
                if len(out) >= flush:
                    yield emit(out, schema)
                    out = []
        if out:
            yield emit(out, schema)

    return run


def each_of(df: DataFrame, settings: list[tuple], names: list[str]) -> DataFrame:
    """Every row once for each of a few settings, given as tuples of equal types."""
    one = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in settings]
    return df.withColumn("_s", F.explode(F.array(*one))).select("*", *(F.col(f"_s.{n}").alias(n) for n in names)).drop("_s") if one else df.limit(0).select("*", *(F.lit(None).alias(n) for n in names))


def format_of(c: str | Column) -> Column:
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def checked_rows(df: DataFrame, most: int, what: str) -> list:
    """The rows of a small table, such as settings; an error if it has more than `most`."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what} has more than {most} rows")
    return rows


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def parts_for(rows: int, each: int) -> int:
    return max(1, math.ceil(rows / each))


#: Bytes of a sample at most; longer texts than a hundredth of it aren't sampled.
SAMPLE_BYTES = 64 << 20


def sample_rows(df: DataFrame, id_col: str, text_col: str, columns: list, most: int, most_bytes: int = SAMPLE_BYTES) -> list:
    """Rows for fitting a model: the `most` of the least hashes of their id and text, as far as their texts have no more than most_bytes together; alike on every run, all rows if there are no more. Repeated rows count once."""
    picked = df.withColumns({"_h": F.xxhash64(F.lit(41), id_col, text_col), "_b": F.octet_length(text_col)}).filter(F.col("_b") <= most_bytes // 100)
    least = picked.select("_h", "_b").distinct().orderBy("_h").limit(most).collect()
    last, room = None, most_bytes
    for h, size in least:
        if (room := room - size) < 0:
            break
        last = h
    if last is None:
        return []
    return picked.filter(F.col("_h") <= last).dropDuplicates(["_h"]).orderBy("_h").select(*columns).collect()


#: Bits of a filter at most.
SIEVE_BITS = 1 << 28


class BitFilter:
    """Which values a column may have, by a hash: it never denies one that is there."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, value: str | bytes) -> bool:
        h = xxhash.xxh64_intdigest(value, 42) % (64 * len(self.bits))
        return bool(int(self.bits[h >> 6]) >> (h & 63) & 1)


def bit_filter(df: DataFrame, column: str, most_bits: int = SIEVE_BITS) -> BitFilter:
    """A filter of the values of a column (string or binary), made in parallel; 16 bits a row, but most_bits at most."""
    bits = min(most_bits, 1 << max(6, (16 * df.count()).bit_length()))
    place = df.select(F.pmod(F.xxhash64(column), F.lit(bits)).alias("p")).select(F.shiftright("p", 6).alias("k"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
    out = np.zeros(bits // 64, np.int64)
    for r in place.groupBy("k").agg(F.bit_or("b").alias("b")).collect():
        out[r["k"]] = r["b"]
    return BitFilter(out.view(np.uint64))


#: Two-letter codes of the languages whose three-letter codes occur as labels.
CODES3 = {
    "spa": "es", "eng": "en", "por": "pt", "fra": "fr", "fre": "fr", "ita": "it", "cat": "ca", "deu": "de", "ger": "de", "zho": "zh", "chi": "zh", "jpn": "ja", "rus": "ru",
    "ara": "ar", "tha": "th", "hin": "hi", "nld": "nl", "dut": "nl", "ron": "ro", "rum": "ro", "pol": "pl", "ukr": "uk", "kor": "ko", "tur": "tr", "heb": "he", "ell": "el", "gre": "el",
    "eus": "eu", "baq": "eu", "glg": "gl", "vie": "vi", "ind": "id", "ben": "bn", "fas": "fa", "per": "fa", "urd": "ur", "swe": "sv", "dan": "da", "fin": "fi", "nor": "no", "ces": "cs", "hun": "hu",
}
NO_LANGUAGE = ("und", "xx", "xxx", "unk", "unknown", "na", "n/a", "none", "null", "mul", "zxx", "mis")


def language_of(label: str | None) -> str | None:
    """The two-letter code a label names, in any letter case, with or without a region; None if it names none."""
    text = (label or "").strip().lower()
    if text in NO_LANGUAGE:
        return None
    code = text.replace("_", "-").split("-")[0]
    if code in NO_LANGUAGE or not code.isascii() or not code.isalpha():
        return None
    return code if len(code) == 2 else CODES3.get(code)


def paragraphs(text: str) -> list[tuple[int, int, int]]:
    """(number, start, end) of the pieces between lines with at most white space, without white space at their ends, numbered from 1."""
    out, start, number, at = [], None, 0, 0
    for line in text.split("\n"):
        if line.strip():
            if start is None:
                start = at
            end = at + len(line)
        elif start is not None:
            number += 1
            out.append((number, start, end))
            start = None
        at += len(line) + 1
    if start is not None:
        out.append((number + 1, start, end))
    return [(k, a + len(s) - len(s.lstrip()), a + len(s.rstrip())) for k, a, b in out for s in [text[a:b]]]
