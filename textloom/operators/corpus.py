"""Aggregates over a corpus: reports, duplicates, repeated lines of pages, checks of what was read, tiles, profiles of JSON."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonx, names, text
from ..functions.pages import drop_repeated

#: States that failed, for which a report shows an error.
FAILED = ("BATCH_RUNNER_ERROR", "PDF_CORRUPTO", "PDF_CIFRADO")
HISTOGRAMS = ("format", "strategy", "institution", "language", "status", "quality", "error")


def quality_bucket(score: Column) -> Column:
    return F.when(score.isNull(), "sin_calcular").otherwise(text.quality_label(score))


def report_histograms(records: DataFrame) -> DataFrame:
    """dimension, valor, n: counts by each of seven columns in one pass over the records; null and empty values are left out."""
    x = records.withColumn("quality", quality_bucket(F.col("quality_score")))
    pairs = F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("valor")) for c in HISTOGRAMS))
    return x.select(F.inline(pairs)).filter("valor is not null and valor <> ''").groupBy("dimension", "valor").agg(F.count("*").alias("n"))


def report_totals(records: DataFrame) -> DataFrame:
    """Sums, and least and largest sizes, of which zeros don't count."""
    some = lambda c: F.nullif(F.col(c), F.lit(0))
    return records.agg(
        F.count("*").alias("registros"), F.coalesce(F.sum("characters"), F.lit(0)).alias("caracteres"), F.min(some("characters")).alias("min_caracteres"), F.max(some("characters")).alias("max_caracteres"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"), F.min(some("size_bytes")).alias("min_bytes"), F.max(some("size_bytes")).alias("max_bytes"),
    )


def status_summary(log: DataFrame, status: str = "status", path: str = "path", order: str = "registrado") -> DataFrame:
    """Per status: rows, their share in percent of all, and the first row's path as an example."""
    by = log.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"), F.min_by(F.col(path), F.struct(order, path)).alias("ejemplo"))
    return by.withColumn("porcentaje", F.round(F.col("n") * 100 / F.sum("n").over(W.partitionBy()), 2))


def error_column(status: Column, reason: Column, error: Column) -> Column:
    """The error of a report's row: only for failed states, the reason before the message."""
    return F.when(status.isin(*FAILED), F.coalesce(F.nullif(reason, F.lit("")), error))


def duplicates(df: DataFrame, key: Column, item: str) -> DataFrame:
    """clave, n, primero: groups of more than one row by a key; null keys are no group."""
    return df.withColumn("clave", key).filter("clave is not null").groupBy("clave").agg(F.count("*").alias("n"), F.min(item).alias("primero")).filter("n > 1")


def duplicate_members(df: DataFrame, key: Column, item: str) -> DataFrame:
    """clave, n, item: one row for each member of a group of duplicates, so that no group is gathered, however large."""
    x = df.withColumn("clave", key)
    return x.join(duplicates(df, key, item).select("clave", "n"), "clave").select("clave", "n", item)


def repeated_page_lines(pages: DataFrame, doc: str, text_col: str, share: float = 0.6, least_pages: int = 3) -> DataFrame:
    """doc, linea, paginas: lines that stand on at least `share` of a document's pages, if it has `least_pages`."""
    x = pages.select(F.col(doc).alias("doc"), F.col(text_col).alias("t"))
    count = x.groupBy("doc").agg(F.count("*").alias("de"))
    lines = x.select("doc", F.explode(F.array_distinct(F.transform(text.lines_of(F.col("t")), text.strip))).alias("linea")).filter("linea <> ''")
    return lines.groupBy("doc", "linea").agg(F.count("*").alias("paginas")).join(count, "doc").filter((F.col("de") >= least_pages) & (F.col("paginas") >= share * F.col("de"))).select("doc", "linea", "paginas")


def without_repeated_lines(pages: Column, share: float = 0.6, least_pages: int = 3) -> Column:
    """An array of page texts without the lines that stand on at least `share` of them; within the row, without a shuffle, in time linear in the lines."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda p: None if p is None else drop_repeated([x or "" for x in p], share, least_pages))

    return run(pages)


def deepest_zooms(files: DataFrame, path: str = "path") -> DataFrame:
    """_r, _m: each tile pyramid and its largest zoom; a small table, where a window would bring a whole pyramid into one task."""
    x = files.select(names.tile_root(F.col(path)).alias("_r"), names.tile_zoom(F.col(path)).alias("_z"))
    return x.filter("_r is not null and _z is not null").groupBy("_r").agg(F.max("_z").alias("_m"))


def deepest_tiles(files: DataFrame, path: str = "path", zooms: DataFrame | None = None) -> DataFrame:
    """Of each tile pyramid the files of the largest zoom; files outside of any stay."""
    x = files.withColumns({"_r": names.tile_root(F.col(path)), "_z": names.tile_zoom(F.col(path))})
    y = x.join(deepest_zooms(files, path) if zooms is None else zooms, "_r", "left").filter("_r is null or _z is null or _z = _m")
    return y.drop("_r", "_z", "_m")


def pending(files: DataFrame, done: DataFrame, key: str = "sha256") -> DataFrame:
    """The files whose content isn't in the log yet. A failed file has no hash there and comes again."""
    return files.join(done.filter(F.coalesce(F.length(key), F.lit(0)) > 0).select(key).distinct(), key, "left_anti")


def latest(log: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, *(c for c in rest if c != order and not log.schema[c].dataType.typeName() == "map"))).alias("_x")).select(key, "_x.*")


def field_profile(docs: DataFrame, json_col: str, doc: str) -> DataFrame:
    """Per path of the JSON documents: documents, occurrences, characters of text (sum, least, largest), addresses, PDFs, and up to three samples of its text: the first and the last by order, and the first document's."""
    flat = docs.select(F.col(doc).alias("doc"), F.inline(jsonx.flatten(F.col(json_col))))
    n = F.when(F.length("text") > 0, F.length("text"))
    return flat.groupBy("path").agg(
        F.count_distinct("doc").alias("documentos"), F.count("*").alias("apariciones"), F.coalesce(F.sum(n), F.lit(0)).alias("caracteres"), F.min(n).alias("min_caracteres"), F.max(n).alias("max_caracteres"),
        F.count_if(F.col("kind") == "url").alias("urls"), F.count_if((F.col("kind") == "pdf_url") | (F.col("kind") == "url") & names.is_pdf_reference(F.col("text"))).alias("pdfs"),
        F.array_compact(F.array_distinct(F.array(F.min(F.nullif("text", F.lit(""))), F.max(F.nullif("text", F.lit(""))), F.min_by(F.nullif("text", F.lit("")), "doc")))).alias("muestras"),
    )


def ranked_fields(profile: DataFrame, kinds: DataFrame, which: str, most: int = 20, only_text: bool = False) -> DataFrame:
    """The first fields of a profile (a report): `texto` by documents and characters (only_text: without those that hold addresses), `url` and `pdf` by how many they hold, `mixto` those of several kinds."""
    n = kinds.groupBy("path").agg(F.count_distinct("kind").alias("tipos"))
    x = profile.join(n, "path")
    plain = (F.col("urls") == 0) & (F.col("pdfs") == 0) if only_text else F.lit(True)
    keep, by = {
        "texto": ((F.col("caracteres") > 0) & plain, ("documentos", "caracteres")),
        "url": (F.col("urls") > 0, ("urls", "documentos")),
        "pdf": ((F.col("pdfs") > 0) | F.lower("path").contains("pdf") if only_text else F.col("pdfs") > 0, ("pdfs", "documentos")),
        "mixto": (F.col("tipos") > 1, ("documentos", "tipos")),
    }[which]
    return x.filter(keep).orderBy(*(F.desc(c) for c in by), "path").limit(most)


def field_kinds(docs: DataFrame, json_col: str) -> DataFrame:
    """path, kind, n."""
    return docs.select(F.inline(jsonx.flatten(F.col(json_col)))).groupBy("path", "kind").agg(F.count("*").alias("n"))


def schema_clusters(docs: DataFrame, json_col: str, doc: str, with_length: bool = True) -> DataFrame:
    """huella, documentos, ejemplo: documents by the fingerprint of their structure."""
    return docs.select(F.col(doc).alias("doc"), jsonx.fingerprint(F.col(json_col), with_length).alias("huella")).filter("huella is not null").groupBy("huella").agg(F.count("*").alias("documentos"), F.min("doc").alias("ejemplo"))


def schema_report(docs: DataFrame, json_col: str, doc: str, with_length: bool = True) -> DataFrame:
    """huella, raiz, documentos, rutas: the clusters of documents by structure, with the kind of their root and the first five documents by order (kept five at a time, so no cluster is gathered)."""
    x = docs.select(F.col(doc).alias("doc"), F.col(json_col).alias("_j"), jsonx.fingerprint(F.col(json_col), with_length).alias("huella")).filter("huella is not null").withColumn("raiz", jsonx.root_kind(F.col("_j")))
    # five of each of many parts of a cluster, then five of these
    part = F.pmod(F.xxhash64("doc"), F.lit(256))
    w = W.partitionBy("huella", "_p").orderBy("doc")
    few = x.withColumn("_p", part).withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= 5).groupBy("huella").agg(F.slice(F.array_sort(F.collect_list("doc")), 1, 5).alias("rutas"))
    return x.groupBy("huella", "raiz").agg(F.count("*").alias("documentos")).join(few, "huella")


def schema_keys(docs: DataFrame, json_col: str, with_length: bool = True) -> DataFrame:
    """huella, clave, n: how many documents of each cluster have each top-level key."""
    x = docs.select(jsonx.fingerprint(F.col(json_col), with_length).alias("huella"), F.explode(F.json_object_keys(json_col)).alias("clave"))
    return x.groupBy("huella", "clave").agg(F.count("*").alias("n"))


def root_kinds(docs: DataFrame, json_col: str) -> DataFrame:
    """raiz, documentos: documents by the kind of their root; `error` for those that aren't JSON."""
    return docs.groupBy(F.coalesce(jsonx.root_kind(F.col(json_col)), F.lit("error")).alias("raiz")).agg(F.count("*").alias("documentos"))


def parse_errors(docs: DataFrame, json_col: str, doc: str) -> DataFrame:
    """doc, comienzo: the documents that aren't JSON."""
    return docs.filter(F.col(json_col).isNotNull() & jsonx.root_kind(F.col(json_col)).isNull()).select(F.col(doc).alias("doc"), F.left(json_col, F.lit(80)).alias("comienzo"))


def pdf_status(pages: Column, with_text: Column, with_images: Column, characters: Column, errors: Column) -> Column:
    """The state of a PDF from what its pages gave."""
    return (
        F.when(pages == 0, "PDF_VACIO")
        .when((characters == 0) & (with_images > 0), "PDF_ESCANEADO")
        .when(characters == 0, "PDF_VACIO")
        .when(errors > 0, "PDF_INCOMPLETO")
        .when((with_text < pages) & (with_images > 0) & (characters < 500), "PDF_SIN_OCR")
        .when((with_text < F.greatest(F.lit(1), F.floor(pages / 3))) & (characters < 1000), "PDF_INCOMPLETO")
        .otherwise("PDF_OK")
    )


def diagnose(t: Column, formato: Column, least: int = 200, letters: float = 0.40) -> Column:
    """valido, vacio, corto or ruido: whether an extracted text is usable."""
    n, s = F.length(text.strip(F.coalesce(t, F.lit("")))), text.letter_ratio(F.coalesce(t, F.lit("")))
    return F.when(n == 0, "vacio").when(n < least, "corto").when(formato.isin("pdf", "imagen") & (s < letters), "ruido").otherwise("valido")
