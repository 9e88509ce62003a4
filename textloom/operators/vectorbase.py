"""A vector base: one table of chunks with their vectors, its ordinals and manifest; building, extending, encoding again, verifying."""

from __future__ import annotations

import hashlib
import json
import platform
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names, text, vectors
from ..session import cut_lineage
from .checks import ConstraintError, base_violations, duplicate_keys, missing_columns, not_unit, require

BLOCK = 2048
Encoder = Callable[[list[str]], np.ndarray]


class HashEncoder:
    """A deterministic stand-in for a model: a text's hash seeds a normal vector of length 1."""

    def __init__(self, dim: int = 8):
        self.dim = dim

    def __call__(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros((0, self.dim), np.float32)
        seeds = [int.from_bytes(hashlib.blake2b(t.encode(), digest_size=4).digest(), "big") for t in texts]
        return normalize(np.stack([np.random.default_rng(s).standard_normal(self.dim) for s in seeds]))


def normalize(m: np.ndarray) -> np.ndarray:
    if m.ndim != 2:
        raise ValueError("vectors must be a matrix")
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.ascontiguousarray(m / np.where(n == 0, 1, n), dtype=np.float32)


def make_encoder(name: str, dim: int = 8) -> Encoder:
    """`fake` or `fake/...`: the stand-in; another name is an importable `module:attribute` that makes an encoder."""
    if name == "fake" or name.startswith("fake/"):
        return HashEncoder(dim)
    module, _, attribute = name.partition(":")
    return getattr(__import__(module, fromlist=[attribute]), attribute)()


def encode(df: DataFrame, text: str, encoder: Encoder, prefix: str = "", out: str = "embedding") -> DataFrame:
    """df with a vector of each text; the encoder is made once per worker."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            m = encoder([prefix + t for t in s])
            yield pd.Series([row.tolist() for row in m], dtype=object)

    return df.withColumn(out, run(F.col(text)))


def split_fragments(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chunks with a text, and those without as doc_id, chunk_id, motivo."""
    blank = F.regexp_replace(F.coalesce(F.col("texto"), F.lit("")), r"[\s\x{a0}]+", "") == ""
    return chunks.filter(~blank), chunks.filter(blank).select("doc_id", "chunk_id", F.lit("texto_vacio").alias("motivo"))


def with_ordinals(df: DataFrame, order: list[str], start: int = 0) -> DataFrame:
    """df with ordinals start, start + 1, ... by an order, without bringing all rows into one task: positions within ranges, and the ranges' offsets.

    The ranged rows are kept in the shared folder (spark.checkpoint.dir) with their range and place, so that sizes and
    rows come from the same ranges however the plan is cut or run again. The table of sizes has a row for each range.
    Rows of equal order get the ordinals of their places in the range; nulls come first.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    kept = cut_lineage(placed.withColumn("_p", F.shiftright("_m", 33)).withColumn("_l", F.col("_m").bitwiseAND(2**33 - 1)).drop("_m"))
    sizes = kept.groupBy("_p").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_p", (F.sum("_n").over(W.orderBy("_p")) - F.col("_n")).alias("_o"))
    return kept.join(F.broadcast(offsets), "_p").withColumn("ordinal", F.col("_o") + F.col("_l") + start).drop("_p", "_l", "_o")


def block_of(ordinal: str = "ordinal", size: int = BLOCK) -> F.Column:
    return F.floor(F.col(ordinal) / size).cast("int")


def metadata_order(columns: list[str]) -> list[str]:
    """The required columns first, the others as they came."""
    first = ["doc_id", "chunk_id", "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto"]
    return [*first, *(c for c in columns if c not in first)]


def build(chunks: DataFrame, encoder: Encoder, model: str = "fake") -> DataFrame:
    """The base of chunks: ordinal, metadata, embedding; in the order of document and position."""
    if lacking := missing_columns(chunks):
        raise ConstraintError(f"missing columns: {lacking}")
    kept, _ = split_fragments(chunks)
    require(duplicate_keys(kept, "chunk_id"), "chunk_id twice")
    ordered = with_ordinals(kept.select(*metadata_order(chunks.columns)), ["doc_id", "posicion", "chunk_id"])
    return encode(ordered, "texto", encoder, names.prefixes_for(model)[1])


def extend(base: DataFrame, new: DataFrame, encoder: Encoder, model: str = "fake") -> DataFrame:
    """The base with further chunks behind it, in the order of document and position; an error if a document or a chunk is in both, or a chunk comes twice. The ordinals of the base stay."""
    kept, _ = split_fragments(new)
    require(new.join(base.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id"), "document already in the base")
    require(kept.join(base.select("chunk_id"), "chunk_id", "left_semi").select("chunk_id"), "chunk already in the base")
    require(duplicate_keys(kept, "chunk_id"), "chunk_id twice")
    last = base.agg(F.max("ordinal")).first()[0]
    more = encode(with_ordinals(kept, ["doc_id", "posicion", "chunk_id"], 0 if last is None else last + 1), "texto", encoder, names.prefixes_for(model)[1])
    return base.unionByName(more, allowMissingColumns=True)


def replace_vectors(base: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The base with new vectors where `new` (key, embedding) has one; an error if a key is unknown or twice."""
    require(new.join(base.select(key), key, "left_anti").select(key), "unknown chunk")
    require(duplicate_keys(new, key), "chunk twice")
    return base.join(new.select(key, F.col("embedding").alias("_e")), key, "left").withColumn("embedding", F.coalesce("_e", "embedding")).drop("_e")


def encode_blocks(base: DataFrame, path: str, encoder: Encoder, signature: dict) -> DataFrame:
    """The base's vectors, block by block in a folder: blocks that a former run with the same signature wrote are not made again."""
    spark = base.sparkSession
    state, done = _state(spark, path), None
    if state is not None and state != signature:
        raise ConstraintError(f"{path} belongs to another input: {state}")
    if state is not None:
        try:
            done = spark.read.parquet(f"{path}/vectors").select("bloque").distinct()
        except Exception:  # nothing written yet
            done = None
    else:
        _write_state(spark, path, signature)
    todo = base.withColumn("bloque", block_of())
    if done is not None:
        todo = todo.join(done, "bloque", "left_anti")
    encode(todo, "texto", encoder).write.mode("append").partitionBy("bloque").parquet(f"{path}/vectors")
    return spark.read.parquet(f"{path}/vectors")


def _state(spark: SparkSession, path: str) -> dict | None:
    try:
        return json.loads(spark.read.text(f"{path}/state", wholetext=True).first()[0])
    except Exception:  # no state, or one that can't be read: start anew
        return None


def _write_state(spark: SparkSession, path: str, signature: dict) -> None:
    spark.createDataFrame([(json.dumps(signature, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")


def verify(base: DataFrame, max_words: int = 250) -> DataFrame:
    """One row: rows, documents, sources, chunks twice, mean and largest tokens, chunks over the word limit, ordinals and lengths that are wrong."""
    length = vectors.norm(F.col("embedding"))
    return base.agg(
        F.count("*").alias("filas"), F.count_distinct("doc_id").alias("documentos"), F.count_distinct("fuente").alias("fuentes"), (F.count("chunk_id") - F.count_distinct("chunk_id")).alias("repetidos"),
        F.round(F.avg("num_tokens"), 1).alias("media_tokens"), F.max("num_tokens").alias("max_tokens"), F.count_if(F.size(F.split(F.trim("texto"), r"\s+")) > max_words).alias("largos"),
        (F.max("ordinal") + 1 - F.count_distinct("ordinal")).alias("huecos"), F.count_if(F.abs(length - 1) > 1e-3 + 1e-5).alias("sin_norma"),
    )


def check(base: DataFrame) -> None:
    """An error if the base breaks a constraint."""
    require(duplicate_keys(base, "chunk_id"), "chunk_id twice")
    require(duplicate_keys(base, "ordinal"), "ordinal twice")
    require(not_unit(base).select("chunk_id"), "length isn't 1")


def truncated(chunks: DataFrame, limit: int, most: int = 200) -> DataFrame:
    """Of the `most` longest chunks those with more words than an encoder takes (a report)."""
    n = text.word_count(F.col("texto"))
    return chunks.orderBy(F.desc(F.length("texto")), "chunk_id").limit(most).select("chunk_id", F.length("texto").alias("largo"), n.alias("unidades")).filter(F.col("unidades") > limit)


def manifest(base: DataFrame, model: str, dim: int, **more) -> dict:
    q, p = names.prefixes_for(model)
    return {"modelo": model, "dimension": dim, "prefijo_consulta": q, "prefijo_pasaje": p, "tipo_indice": "plano", "metrica": "producto interior", "vectores_normalizados": True, "num_vectores": base.count(), "versiones": versions(), **more}


def load(spark: SparkSession, path: str) -> DataFrame:
    """A stored base, checked against the manifest beside it; an error if it isn't what that says."""
    base = spark.read.parquet(path)
    require(base_violations(base, json.loads(spark.read.text(f"{path.rstrip('/')}.manifest", wholetext=True).first()[0])), "base and manifest differ")
    return base


def versions() -> dict[str, str]:
    """The versions of what a base was built with."""
    from importlib.metadata import PackageNotFoundError, version

    out = {"python": platform.python_version()}
    for name in ("pyspark", "pyarrow", "numpy", "pandas"):
        try:
            out[name] = version(name)
        except PackageNotFoundError:
            continue
    return out
