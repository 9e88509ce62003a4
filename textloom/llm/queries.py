"""The queries pN_... over the test tables, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import areas, body, encode, language, packing, pieces, repeated, scans, sentences, shape
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.noisy_lines(table(spark, d, "mini_corpus"))


def p1_joined(spark: SparkSession, d: str) -> DataFrame:
    """The rows of p1_found, as they are found where the lexicon is too large to go to every task."""
    return scans.noisy_lines(table(spark, d, "mini_corpus"), lexicon_bytes=0)


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scans.repaired(table(spark, d, "mini_corpus"))


def p1_measured(spark: SparkSession, d: str) -> DataFrame:
    """What the repair did to each document: unknown words before and after, lines before and paragraphs after."""
    return scans.measured(table(spark, d, "mini_corpus"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return shape.not_prose(table(spark, d, "mini_corpus"))


def p2_stats(spark: SparkSession, d: str) -> DataFrame:
    return shape.statistics(table(spark, d, "mini_corpus")).distinct()


def p2_common(spark: SparkSession, d: str) -> DataFrame:
    """The fifth statistic of a text, the share of common words; the others are p2_stats'."""
    docs = table(spark, d, "mini_corpus")
    return shape.common_shares(docs, shape.common_words(docs)).distinct()


def p2_shapes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "mini_corpus")
    return shape.shapes(docs, shape.learn_profiles(docs)).distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "mini_corpus")
    return sentences.sentences(docs, sentences.learn(docs), ("txt",))


def p3_sentences(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "mini_corpus")
    return sentences.sentences(docs, sentences.learn(docs))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return language.mislabelled(table(spark, d, "mini_corpus"))


def p4_languages(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "mini_corpus")
    return language.identify(docs, language.learn(docs))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pieces.oversized(table(spark, d, "mini_corpus"), table(spark, d, "limites"))


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.split_documents(table(spark, d, "mini_corpus"), table(spark, d, "limites"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated.repeated_lines(table(spark, d, "mini_corpus"))


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return repeated.without_repeated(table(spark, d, "mini_corpus"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "mini_corpus")
    return body.boilerplate_lines(docs, body.learn(docs))


def p7_body(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "mini_corpus")
    return body.main_bodies(docs, body.learn(docs))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_corpus(table(spark, d, "documents"))


def p9_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), table(spark, d, "contenedores"))


def p9_usage(spark: SparkSession, d: str) -> DataFrame:
    """Per class: containers, tokens and the share of room unused."""
    boxes = p9_packing(spark, d).filter("contenedor is not null").groupBy("clase", "contenedor").agg(F.sum("tokens").alias("n"))
    per = boxes.groupBy("clase").agg(F.count("*").alias("contenedores"), F.sum("n").alias("tokens")).join(table(spark, d, "contenedores"), "clase")
    return per.select("clase", "contenedores", "tokens", F.round(1 - F.col("tokens") / (F.col("contenedores") * F.col("capacidad")), 6).alias("libre"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Per class: windows, and how far the shares of sources in a full window are from those of all tokens: median, of nine in ten at most, largest."""
    docs, boxes = table(spark, d, "documents"), table(spark, d, "contenedores")
    x = packing.deviations(packing.pack(docs, boxes), docs).join(boxes, "clase")
    full = x.filter(F.col("tokens") >= 0.9 * packing.window_tokens(F.col("capacidad")))
    return full.groupBy("clase").agg(F.count("*").alias("ventanas"), *(F.round(F.percentile("desviacion", p), 4).alias(n) for n, p in (("mediana", 0.5), ("nueve_de_diez", 0.9), ("maxima", 1.0))))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return areas.document_areas(docs, areas.learn(docs, table(spark, d, "area_ejemplos"), table(spark, d, "areas")))


def queries() -> dict[str, Query]:
    return {name: fn for name, fn in globals().items() if name.startswith("p") and name[1].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


#: The same rows in SQL, where SQL can express them on whole tables.
ORACLE: dict[str, str] = {
    "p5_found": """
WITH d AS (SELECT DISTINCT doc_id, texto, max_chars FROM mini_corpus JOIN limites ON lower(trim(mini_corpus.formato)) = limites.formato WHERE length(texto) > max_chars)
SELECT doc_id, CASE WHEN list_max(list_transform(regexp_split_to_array(texto, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}.!?…。！？؟।]'), lambda x: length(x))) > max_chars THEN 'sin_corte' ELSE 'natural' END AS clase FROM d
""",
    "p2_stats": r"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(texto, '') AS t FROM mini_corpus),
w AS (SELECT doc_id, length(t) AS chars, regexp_extract_all(lower(t), '[\p{L}\p{M}\p{N}]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\s\x{a0}\x{0b}]')) AS l,
  len(regexp_extract_all(t, '[^\p{L}\p{M}\p{N}\s\x{a0}\x{0b}]')) AS s, len(regexp_extract_all(t, '\p{Nd}')) AS n FROM d)
SELECT doc_id, chars::int AS chars, len(w)::int AS palabras, round(CASE WHEN len(w) > 0 THEN list_sum(list_transform(w, lambda x: length(x))) / len(w) ELSE 0 END, 6) AS largo_medio,
  round(CASE WHEN chars > 0 THEN s / chars ELSE 0 END, 6) AS simbolos, round(CASE WHEN chars > 0 THEN n / chars ELSE 0 END, 6) AS digitos, len(l)::int AS lineas,
  round(CASE WHEN len(l) > 0 THEN len(list_filter(l, lambda x: regexp_matches(x, '[.!?…。！？؟।]["''”’»)\]」』]*[\s\x{a0}\x{0b}]*$'))) / len(l) ELSE 0 END, 6) AS fin_punto,
  round(CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) ELSE 0 END, 6) AS distintas FROM w
""",
}
