"""Constraints on documents, chunks, vectors and results, each as the rows that break it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.vectors import is_unit

DOCUMENT_FIELDS = ("doc_id", "fuente", "formato", "idioma", "texto")
CHUNK_FIELDS = ("doc_id", "chunk_id", "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto")


class ConstraintError(ValueError):
    """A constraint that must hold is broken."""


def require(broken: DataFrame, what: str) -> None:
    """An error with an example if there are rows that break a constraint."""
    if rows := broken.limit(1).collect():
        raise ConstraintError(f"{what}: {rows[0].asDict()}")


def document_violations(docs: DataFrame) -> DataFrame:
    """doc_id, motivo: null or blank fields, and a phenomenon that is none of 1, 2, 3."""
    blank = [F.when(F.coalesce(F.regexp_replace(F.col(c), r"[\s\x{a0}]+", ""), F.lit("")) == "", F.lit(f"vacio:{c}")) for c in DOCUMENT_FIELDS]
    wrong = F.when(F.col("fenomeno").isNull() | ~F.col("fenomeno").isin(1, 2, 3), F.lit("fenomeno"))
    return docs.select("doc_id", F.explode(F.array_compact(F.array(*blank, wrong))).alias("motivo"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def missing_columns(df: DataFrame, needed: tuple[str, ...] = CHUNK_FIELDS) -> list[str]:
    return [c for c in needed if c not in df.columns]


def ordinal_gaps(df: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """One row if ordinals aren't 0..n-1, each once; no row if they are."""
    x = df.agg(F.count("*").alias("n"), F.count_distinct(ordinal).alias("distintos"), F.min(ordinal).alias("primero"), F.max(ordinal).alias("ultimo"))
    return x.filter("n > 0 and (n <> distintos or primero <> 0 or ultimo <> n - 1)")


def not_unit(vectors: DataFrame) -> DataFrame:
    return vectors.filter(F.col("embedding").isNull() | ~is_unit(F.col("embedding")))


def chunk_violations(chunks: DataFrame, docs: DataFrame, max_tokens: int = 450, max_words: int = 250) -> DataFrame:
    """doc_id, chunk_id, motivo: chunks that aren't their slice, are over a limit, or leave a gap with more than white space before them."""
    w = W.partitionBy("doc_id").orderBy("posicion")
    x = chunks.join(docs.select("doc_id", F.col("texto").alias("_t")), "doc_id")
    x = x.withColumn("_before", F.coalesce(F.max("char_end").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("_row", F.row_number().over(w) - 1)
    slice_ = F.col("_t").substr(F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    gap = F.when(F.col("char_start") > F.col("_before"), F.col("_t").substr(F.col("_before") + 1, F.col("char_start") - F.col("_before"))).otherwise("")
    reasons = [
        F.when(F.coalesce(F.length("texto"), F.lit(0)) == 0, "vacio"), F.when(~slice_.eqNullSafe(F.col("texto")), "no es su tramo"), F.when(F.col("_row") != F.col("posicion"), "posicion"),
        F.when((F.col("num_tokens") > max_tokens) | (F.col("num_palabras") > max_words), "limite"), F.when(F.regexp_replace(gap, r"[\s\x{a0}]+", "") != "", "hueco"),
    ]
    return x.select("doc_id", "chunk_id", F.explode(F.array_compact(F.array(*reasons))).alias("motivo"))


def untraceable(fragments: DataFrame, chunks: DataFrame) -> DataFrame:
    """chunk_id, motivo: fragments whose chunk is unknown, of another document, or doesn't contain their text."""
    c = chunks.select("chunk_id", F.col("doc_id").alias("_d"), F.col("texto").alias("_t"))
    x = fragments.join(c, "chunk_id", "left")
    why = F.when(F.col("_d").isNull(), "desconocido").when(F.col("_d") != F.col("doc_id"), "otro documento").when(~F.col("_t").contains(F.col("text")), "texto ajeno")
    return x.withColumn("motivo", why).filter("motivo is not null").select("chunk_id", "motivo")


def delivery_violations(lines: DataFrame, queries: int = 50) -> DataFrame:
    """linea, motivo: raw results (linea from 1, value as JSON) that aren't q001, q002, ... in order, have other keys than theirs at any level, or empty or mistyped ids; and a row with linea 0 if there aren't as many as queries."""
    v = F.col("value")
    keys = lambda j, *names: F.array_sort(F.coalesce(F.json_object_keys(j), F.array().cast("array<string>"))) != F.array(*(F.lit(n) for n in sorted(names)))
    items = lambda path: F.coalesce(F.from_json(F.get_json_object(v, path), "array<string>"), F.array().cast("array<string>"))
    text = lambda j, n: F.coalesce(F.length(F.get_json_object(j, f"$.{n}")), F.lit(0)) == 0
    number = lambda a: F.exists(F.transform(a, lambda j, k: ~F.get_json_object(j, "$.rank").eqNullSafe((k + 1).cast("string"))), lambda x: x)
    d, f = items("$.documents"), items("$.fragments")
    reasons = [
        F.when(F.get_json_object(v, "$.query_id").isNull() | (F.get_json_object(v, "$.query_id") != F.format_string("q%03d", "linea")), "orden"),
        F.when(keys(v, "query_id", "documents", "fragments"), "claves"),
        F.when(F.exists(d, lambda j: keys(j, "rank", "doc_id")) | F.exists(f, lambda j: keys(j, "rank", "chunk_id", "doc_id", "text")), "claves de elementos"),
        F.when(F.exists(d, lambda j: text(j, "doc_id")) | F.exists(f, lambda j: text(j, "chunk_id") | text(j, "doc_id") | text(j, "text")), "vacio"),
        F.when(number(d) | number(f), "rank"),
    ]
    broken = lines.select(F.col("linea").cast("int").alias("linea"), F.explode(F.array_compact(F.array(*reasons))).alias("motivo"))
    count = lines.agg(F.count("*").alias("n")).filter(F.col("n") != queries).select(F.lit(0).alias("linea"), F.concat(F.lit("consultas: "), F.col("n").cast("string")).alias("motivo"))
    return broken.unionByName(count)


def base_violations(base: DataFrame, manifest: dict) -> DataFrame:
    """motivo, n: a base that isn't what its manifest says: its dimension, its number of vectors, that it is whole, each chunk once, lengths of 1."""
    x = base.agg(
        F.count_if(~F.size("embedding").eqNullSafe(F.lit(manifest.get("dimension")))).alias("dimension"), F.count_if(~is_unit(F.col("embedding"))).alias("norma"),
        (F.count("*") - F.count_distinct("chunk_id")).alias("repetidos"), (F.count("*") - F.lit(manifest.get("num_vectores"))).alias("num_vectores"),
    )
    names = ("dimension", "norma", "repetidos", "num_vectores")
    rows = x.select(F.inline(F.array(*(F.struct(F.lit(n).alias("motivo"), F.col(n).cast("long").alias("n")) for n in names), F.struct(F.lit("parcial").alias("motivo"), F.lit(int(bool(manifest.get("parcial")))).cast("long").alias("n")))))
    return rows.filter("n <> 0")


def result_violations(results: DataFrame, documents: int = 3, fragments: int = 10, max_words: int = 250) -> DataFrame:
    """query_id, motivo: results without the right numbers of distinct documents and fragments, ranks from 1, or fragments too long or not ending a sentence."""
    d, f = F.col("documents"), F.col("fragments")
    ranks = lambda a: F.transform(a, lambda x: x["rank"]) == F.when(F.size(a) > 0, F.sequence(F.lit(1), F.size(a))).otherwise(F.array().cast("array<int>"))
    reasons = [
        F.when(F.size(d) != documents, "documentos"), F.when(F.size(F.array_distinct(F.transform(d, lambda x: x["doc_id"]))) != F.size(d), "documento repetido"),
        F.when(F.size(f) != fragments, "fragmentos"), F.when(F.size(F.array_distinct(F.transform(f, lambda x: x["chunk_id"]))) != F.size(f), "fragmento repetido"),
        F.when(~ranks(d) | ~ranks(f), "orden"), F.when(F.exists(f, lambda x: F.regexp_count(x["text"], F.lit(r"\S+")) > max_words), "palabras"),
        F.when(F.exists(f, lambda x: ~x["text"].rlike(r"[.!?…][\])}\"'»”’]*\s*$")), "oracion"),
    ]
    return results.select("query_id", F.explode(F.array_compact(F.array(*reasons))).alias("motivo"))
