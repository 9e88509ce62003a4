"""The stages put together: files to documents, documents to chunks, chunks to a base, questions to ranked documents and fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, text
from ..operators import chunker, search, vectorbase
from ..sources import extract, listing


def documents_from_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The documents of a folder (doc_id, fuente, formato, fenomeno, idioma, texto), and the files that gave none with the reason."""
    got = extract.extract(listing.read_content(spark, folder))
    fuente = listing.relative(F.col("path"), folder)
    joined = F.array_join("paginas", "\n\n")
    clean = text.clean_text(F.when(F.col("formato") == "pdf", text.unwrap_lines(joined)).otherwise(joined), composed=True)
    x = got.select(names.doc_id(fuente).alias("doc_id"), fuente.alias("fuente"), "formato", names.phenomenon(fuente).alias("fenomeno"), clean.alias("texto"), "motivo")
    x = x.withColumn("motivo", F.coalesce("motivo", F.when(F.coalesce(F.length("texto"), F.lit(0)) == 0, "texto vacio"), F.when(F.col("fenomeno").isNull(), "sin fenomeno")))
    docs = x.filter("motivo is null").select("doc_id", "fuente", "formato", "fenomeno", text.guess_language(F.col("texto")).alias("idioma"), "texto")
    return docs, x.filter("motivo is not null").select("fuente", "formato", "motivo")


def answer(base: DataFrame, queries: DataFrame, encoder: vectorbase.Encoder, model: str = "fake", first: int = 60, documents: int = 3, fragments: int = 10, within: bool = False) -> DataFrame:
    """query_id, documents, fragments for questions (query_id string, pregunta): the depth grows by tiers until enough documents and whole-sentence fragments are found; with `within`, until the best documents have enough hits, of which fragments are then taken."""
    n = base.count()
    vec = base.select(F.col("ordinal").alias("vec_id"), "embedding")
    q = vectorbase.encode(queries.select("query_id", "pregunta"), "pregunta", encoder, names.prefixes_for(model)[0])
    q = vectorbase.with_ordinals(q, ["query_id"]).withColumnRenamed("query_id", "nombre").withColumnRenamed("ordinal", "query_id")
    meta = base.select(F.col("ordinal").alias("vec_id"), "doc_id", "chunk_id", text.complete_sentences(F.col("texto")).alias("text"))
    usable = F.col("text").isNotNull()
    hits = search.adaptive_hits(q.select("query_id", "embedding"), vec, meta, max(n, 1), usable, documents=documents, fragments=fragments, first=first, within=within)
    top = search.rank_documents(hits, documents)
    frags = search.fragments(hits, top if within else None, fragments, usable=usable)
    return search.results(top, frags).join(q.select("query_id", "nombre"), "query_id").select(F.col("nombre").alias("query_id"), "documents", "fragments")


def chunk_and_build(docs: DataFrame, cfg: chunker.ChunkConfig, encoder: vectorbase.Encoder) -> DataFrame:
    return vectorbase.build(chunker.chunk_documents(docs, cfg), encoder)
