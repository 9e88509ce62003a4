"""Reports of a corpus as files, and statistics of diagnoses."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names, text
from . import corpus

#: A report in Markdown or HTML lists so many records; JSON and CSV have all.
LISTED = {"md": 200, "html": 500}
COLUMNS = ("path", "format", "strategy", "institution", "language", "status", "quality_score", "characters", "size_bytes", "error")


def write_report(records: DataFrame, path: str, formato: str = "json") -> None:
    """Writes the records: json and csv in parallel, md and html as one page with the histograms and the first records by path."""
    kind = {"markdown": "md"}.get(formato, formato)
    if kind == "json":
        records.write.mode("overwrite").json(path)
    elif kind == "csv":
        records.select(*COLUMNS).write.mode("overwrite").option("header", "true").csv(path)
    elif kind in LISTED:
        page = render(records, kind)
        records.sparkSession.createDataFrame([(page,)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path)
    else:
        raise ValueError(f"unknown format of report: {formato}")


def render(records: DataFrame, kind: str) -> str:
    totals = corpus.report_totals(records).first().asDict()
    bars = corpus.report_histograms(records).groupBy("dimension").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "valor"))), 1, 50).alias("v")).orderBy("dimension").collect()
    rows = records.select(*COLUMNS).orderBy("path").limit(LISTED[kind]).collect()
    show = lambda v: "" if v is None else str(v)
    if kind == "md":
        out = ["# Corpus", "", *(f"- {k}: {show(v)}" for k, v in totals.items())]
        for b in bars:
            out += ["", f"## {b['dimension']}", "", *(f"- {x['valor']}: {-x['m']}" for x in b["v"])]
        out += ["", "| " + " | ".join(COLUMNS) + " |", "|" + "---|" * len(COLUMNS), *("| " + " | ".join(show(r[c]).replace("|", "\\|").replace("\n", " ") for c in COLUMNS) + " |" for r in rows)]
        return "\n".join(out)
    cells = lambda r: "".join(f"<td>{html.escape(show(r[c]))}</td>" for c in COLUMNS)
    lists = "".join(f"<h2>{html.escape(b['dimension'])}</h2><ul>" + "".join(f"<li>{html.escape(x['valor'])}: {-x['m']}</li>" for x in b["v"]) + "</ul>" for b in bars)
    head = "".join(f"<li>{k}: {show(v)}</li>" for k, v in totals.items())
    return f"<!doctype html><meta charset=utf-8><title>Corpus</title><ul>{head}</ul>{lists}<table><tr>" + "".join(f"<th>{c}</th>" for c in COLUMNS) + "</tr>" + "".join(f"<tr>{cells(r)}</tr>" for r in rows) + "</table>"


def diagnosis_statistics(diagnoses: DataFrame) -> DataFrame:
    """One row of counters from diagnoses (categoria, valido, motivo, estrategia, caracteres), in one pass."""
    c, why = F.col("categoria"), F.lower(F.coalesce(F.col("motivo"), F.lit("")))
    kinds = ("JSON", "PDF", "HTML", "IMAGEN", "EXCEL", "TXT", "ERROR", "DESCONOCIDO")
    return diagnoses.agg(
        F.count("*").alias("total"), F.count_if("valido").alias("validos"), F.count_if(~F.col("valido")).alias("invalidos"), *(F.count_if(c == k).alias(k.lower()) for k in kinds),
        F.count_if(why.contains("manifiesto")).alias("manifiestos"), (F.count_if(why.contains("catálogo")) + F.count_if(why.contains("catalogo"))).alias("catalogos"), F.count_if(why.contains("ocr")).alias("pdf_ocr"),
        F.count_if(why.contains("corrupto")).alias("pdf_corruptos"), F.count_if((c == "PDF") & (F.col("caracteres") == 0)).alias("pdf_vacios"), F.count_if((c == "JSON") & (F.col("estrategia") == "desconocida")).alias("json_desconocidos"),
    )


def diagnose_documents(docs: DataFrame) -> DataFrame:
    """doc_id, categoria, valido, motivo, estrategia, caracteres of documents (doc_id, formato, texto)."""
    category = F.create_map(*(F.lit(x) for pair in {"json": "JSON", "pdf": "PDF", "html": "HTML", "imagen": "IMAGEN", "xlsx": "EXCEL", "csv": "EXCEL", "txt": "TXT", "texto": "TXT"}.items() for x in pair))
    state = corpus.diagnose(F.col("texto"), F.lower("formato"))
    why = F.when(state == "vacio", "sin texto").when(state == "corto", "texto corto").when(state == "ruido", "posible OCR deficiente").otherwise("texto válido")
    return docs.select("doc_id", F.coalesce(category[F.lower("formato")], F.lit("DESCONOCIDO")).alias("categoria"), (state == "valido").alias("valido"), why.alias("motivo"), F.lit("local").alias("estrategia"), F.coalesce(F.length("texto"), F.lit(0)).alias("caracteres"))


def page_diagnosis(pages: F.Column, least_page: int = 30, least: int = 200, letters: float = 0.40) -> F.Column:
    """A struct from the cleaned pages of a document (array<string>): paginas, vacias, con_texto, ruido (fewer than least_page characters), caracteres, letras, motivo."""
    filled = F.filter(pages, lambda p: F.length(p) > 0)
    whole = F.array_join(filled, "\n\n")

    def judge(w: F.Column) -> F.Column:
        noise = F.size(F.filter(pages, lambda p: (F.length(p) > 0) & (F.length(p) < least_page)))
        ratio = F.round(text.letter_ratio(w), 6)
        why = (
            F.when(F.length(w) == 0, "sin texto: necesita OCR").when(F.length(w) < least, "texto corto").when(text.letter_ratio(w) < letters, "posible OCR deficiente")
            .when(2 * noise > F.size(filled), "páginas casi vacías").otherwise("texto válido")
        )
        return F.struct(F.size(pages).alias("paginas"), (F.size(pages) - F.size(filled)).alias("vacias"), F.size(filled).alias("con_texto"), noise.alias("ruido"), F.length(w).alias("caracteres"), ratio.alias("letras"), why.alias("motivo"))

    return text.bind(whole, judge)


def by_characters(diagnoses: DataFrame, most: int = 200) -> DataFrame:
    """The documents with most characters (a report)."""
    return diagnoses.orderBy(F.desc("caracteres"), "doc_id").limit(most)


def as_row(df: DataFrame, out: str = "registro") -> DataFrame:
    """Every row as one JSON object, as a log keeps it."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(out))


def image_status(width: F.Column, height: F.Column, brightness: F.Column, spread: F.Column, edges: F.Column, characters: F.Column) -> F.Column:
    """The state of a scanned image from its measures and what OCR read; the first that holds."""
    return (
        F.when((width * height < 50_000) | (F.least(width, height) < 160), "IMAGEN_PEQUENA")
        .when((brightness >= 245) & (spread < 5), "IMAGEN_BLANCA")
        .when((characters == 0) & (edges < 4), "IMAGEN_BORROSA")
        .when(characters == 0, "SIN_TEXTO")
        .when(characters < 20, "OCR_POBRE")
        .otherwise("OCR_CORRECTO")
    )


def key_frequency(docs: DataFrame, json_col: str, most: int = 20) -> DataFrame:
    """clave, n: the most frequent keys of JSON objects (a report)."""
    return docs.select(F.explode(F.json_object_keys(json_col)).alias("clave")).groupBy("clave").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "clave").limit(most)


def validate_extraction(files: DataFrame, least: int = 200) -> DataFrame:
    """path, formato, valido, caracteres, motivo of files (path, texto): manifests and short texts aren't valid."""
    clean = text.clean_text(F.coalesce(F.col("texto"), F.lit("")))
    x = files.select("path", names.suffix(F.col("path")).alias("formato"), names.is_manifest(F.col("path")).alias("_m"), F.length(clean).alias("caracteres"))
    why = F.when(F.col("_m"), "manifiesto").when(F.col("caracteres") == 0, "sin texto").when(F.col("caracteres") < least, "texto corto").otherwise("texto válido")
    return x.select("path", "formato", why.alias("motivo"), "caracteres").withColumn("valido", F.col("motivo") == "texto válido")
