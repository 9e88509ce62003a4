"""Every query of the engine's own operators over the test tables, with the SQL that gives the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import jsonx, names, text, vectors
from ..operators import checks, chunker, corpus, reports, search, vectorbase
from ..session import cut_lineage
from ..sources import lines
from . import pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    """One row for each chunk: of repeated rows, which differ in null counts, the one with most."""
    c = t(spark, d, "chunks")
    rest = [x for x in c.columns if x != "chunk_id"]
    return c.groupBy("chunk_id").agg(F.max_by(F.struct(*rest), F.struct(*(F.col(x).isNotNull().cast("int") for x in rest), *rest)).alias("_x")).select("chunk_id", "_x.*")


#: White space, and what is none, as RE2 classes.
_SP = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NSP = _SP.replace("[", "[^", 1)


# --- vectors and search -------------------------------------------------------------------------------------------


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The queries, which are the rows whose id is divisible by 100, and all rows."""
    v = t(spark, d, "embeddings")
    return v.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), v


def _hits(spark: SparkSession, d: str, k: int) -> DataFrame:
    q, v = _vectors(spark, d)
    return search.knn(q, v, k).join(v.select("vec_id", F.col("label").alias("doc_id")), "vec_id")


_KNN = """
WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, v.label AS doc_id, round(list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0),
h AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM s)"""


@query(_KNN + " SELECT query_id, vec_id, score, rank FROM h WHERE rank <= 10")
def knn_topk(spark, d):
    return search.knn(*_vectors(spark, d), 10)


@query(_KNN + " SELECT query_id, vec_id, score, rank FROM h WHERE rank <= 5")
def knn_blocks(spark, d):
    """The same search where the queries are too many to go to every task."""
    return search.knn(*_vectors(spark, d), 5, broadcast_bytes=0)


@query(_KNN + " SELECT vec_id, score FROM h WHERE query_id = 0 AND rank <= 10")
def knn_single_query(spark, d):
    v = t(spark, d, "embeddings")
    one = v.filter("vec_id = 0").first()
    return search.knn_one(v, list(one["embedding"]) if one else [0.0], 10)


_DOCS = """, g AS (SELECT query_id, doc_id, round(sum(score), 4) AS score, count(*) AS chunks, min(rank) AS primero FROM h WHERE rank <= 60 GROUP BY query_id, doc_id)"""


@query(_KNN + _DOCS + " SELECT * EXCLUDE primero FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::int AS rank FROM g) WHERE rank <= 3")
def doc_rank_sum_score(spark, d):
    return search.rank_documents(_hits(spark, d, 60), 3)


@query(_KNN + _DOCS + " SELECT query_id, doc_id, score, rank, primero, chunks AS n_trozos FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, primero)::int AS rank FROM g) WHERE rank <= 3")
def doc_rank_with_chunks(spark, d):
    x = search.documents_with_chunks(_hits(spark, d, 60), 3)
    return x.select("query_id", "doc_id", "score", "rank", "primero", F.size("trozos").cast("long").alias("n_trozos"))


_TIERS = """, n AS (SELECT count(*) AS n FROM embeddings), lv AS (SELECT DISTINCT least(t, n) AS tier FROM n, (VALUES (60), (240), (960), (3840), (15360), (61440)) x(t)),
ok AS (SELECT query_id, tier, count(DISTINCT doc_id) AS docs, count(*) FILTER (WHERE vec_id % 3 = 0) AS frags FROM h, lv WHERE rank <= tier GROUP BY query_id, tier)"""


@query(_KNN + _TIERS + " SELECT query_id, coalesce(min(tier) FILTER (WHERE docs >= 3 AND frags >= 10), max(tier))::int AS depth FROM ok GROUP BY query_id")
def adaptive_k_results(spark, d):
    q, v = _vectors(spark, d)
    meta = v.select("vec_id", F.col("label").alias("doc_id"))
    hits = search.adaptive_hits(q, v, meta, max(v.count(), 1), F.col("vec_id") % 3 == 0)
    return hits.groupBy("query_id").agg(F.max("rank").alias("depth"))


@query(_KNN + """, n AS (SELECT count(*) AS n FROM embeddings), lv AS (SELECT DISTINCT least(t, n) AS tier FROM n, (VALUES (12), (48), (192), (768), (3072), (12288), (49152), (196608)) x(t)),
g AS (SELECT query_id, tier, doc_id, round(sum(score), 4) AS s, count(*) AS c FROM h, lv WHERE rank <= tier GROUP BY ALL), ok AS (SELECT query_id, tier, sum(c) AS c FROM (SELECT *, row_number() OVER (PARTITION BY query_id, tier ORDER BY s DESC, doc_id) AS k FROM g) WHERE k <= 3 GROUP BY ALL)
SELECT query_id, coalesce(min(tier) FILTER (WHERE c >= 10), max(tier))::int AS depth FROM ok GROUP BY query_id""")
def adaptive_k_within_documents(spark, d):
    """The depth from which the three best documents have ten hits."""
    q, v = _vectors(spark, d)
    hits = search.adaptive_hits(q, v, v.select("vec_id", F.col("label").alias("doc_id")), max(v.count(), 1), F.lit(True), first=12, within=True)
    return hits.groupBy("query_id").agg(F.max("rank").alias("depth"))


@query(_KNN + " SELECT query_id, vec_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM h WHERE rank <= 60 QUALIFY rank <= 10")
def fragments_global(spark, d):
    return search.fragments(_hits(spark, d, 60), most=10).select("query_id", "vec_id", "doc_id", "score", "rank")


@query(_KNN + _DOCS + """, top AS (SELECT query_id, doc_id FROM g QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 3)
SELECT h.query_id, vec_id, h.doc_id, score, row_number() OVER (PARTITION BY h.query_id ORDER BY score DESC, vec_id)::int AS rank FROM h JOIN top USING (query_id, doc_id) WHERE h.rank <= 60
QUALIFY row_number() OVER (PARTITION BY h.query_id ORDER BY score DESC, vec_id) <= 10""")
def fragments_within_docs(spark, d):
    hits = _hits(spark, d, 60)
    return search.fragments(hits, search.rank_documents(hits, 3), 10).select("query_id", "vec_id", "doc_id", "score", "rank")


@query("SELECT vec_id, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS largo, abs(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) <= 0.00101 AS unitario FROM embeddings")
def vector_norm_check(spark, d):
    return t(spark, d, "embeddings").select("vec_id", F.round(vectors.norm(F.col("embedding")), 6).alias("largo"), vectors.is_unit(F.col("embedding")).alias("unitario"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: (3 * x::DOUBLE / (3 * sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))))::FLOAT::DOUBLE)), 3) AS suma FROM embeddings")
def vector_normalize(spark, d):
    tripled = F.transform("embedding", lambda x: (x * 3).cast("float"))
    return t(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(vectors.normalize(tripled), F.lit(0.0), lambda a, x: a + x.cast("double")), 3).alias("suma"))


@query("SELECT vec_id, CASE WHEN vec_id % 11 <> 0 THEN 2.0::DOUBLE END AS largo FROM embeddings WHERE vec_id % 7 = 0 OR vec_id % 11 = 0")
def vector_unit_violations(spark, d):
    """Every seventh vector twice as long, every eleventh missing."""
    v = t(spark, d, "embeddings")
    planted = F.when(F.col("vec_id") % 11 == 0, None).when(F.col("vec_id") % 7 == 0, F.transform("embedding", lambda x: x * 2)).otherwise(F.col("embedding"))
    return checks.not_unit(v.withColumn("embedding", planted)).select("vec_id", F.round(vectors.norm(F.col("embedding")), 3).alias("largo"))


@query("SELECT chunk_id, row_number() OVER (ORDER BY d, doc_id, posicion, chunk_id) - 1 AS ordinal FROM (SELECT DISTINCT chunk_id, doc_id, posicion, sha256(doc_id) >= '8' AS d FROM chunks WHERE trim(texto) <> '')")
def index_extend(spark, d):
    """The chunks of half of the documents as a base, those of the others appended behind them."""
    c, late = _chunks(spark, d), F.sha2("doc_id", 256) >= "8"
    base = vectorbase.build(c.filter(~late), vectorbase.HashEncoder(16))
    return vectorbase.extend(base, c.filter(late), vectorbase.HashEncoder(16)).select("chunk_id", "ordinal")


@query("SELECT vec_id AS chunk_id, round(CASE WHEN vec_id % 5 = 0 THEN -embedding[1]::DOUBLE ELSE embedding[1]::DOUBLE END, 6) AS primero FROM embeddings")
def index_reencode(spark, d):
    """Every fifth vector replaced by its opposite."""
    v = t(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    new = v.filter("chunk_id % 5 = 0").withColumn("embedding", F.transform("embedding", lambda x: -x))
    return vectorbase.replace_vectors(v, new).select("chunk_id", F.round(F.element_at("embedding", 1).cast("double"), 6).alias("primero"))


@query("SELECT doc_id, floor((row_number() OVER (ORDER BY doc_id) - 1) / 2048)::int AS bloque FROM documents")
def block_assignment(spark, d):
    return vectorbase.with_ordinals(t(spark, d, "documents").select("doc_id"), ["doc_id"]).select("doc_id", vectorbase.block_of().alias("bloque"))


@query("""WITH c AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id, num_tokens NULLS LAST)
SELECT count(*) AS filas, count(DISTINCT doc_id) AS documentos, count(DISTINCT fuente) AS fuentes, count(chunk_id) - count(DISTINCT chunk_id) AS repetidos, round(avg(num_palabras), 1) AS media_palabras, max(num_palabras) AS max_palabras, count(*) FILTER (WHERE num_palabras > 250) AS largos FROM c""")
def index_verify_stats(spark, d):
    c = _chunks(spark, d)
    return c.agg(
        F.count("*").alias("filas"), F.count_distinct("doc_id").alias("documentos"), F.count_distinct("fuente").alias("fuentes"), (F.count("chunk_id") - F.count_distinct("chunk_id")).alias("repetidos"),
        F.round(F.avg("num_palabras"), 1).alias("media_palabras"), F.max("num_palabras").alias("max_palabras"), F.count_if(F.col("num_palabras") > 250).alias("largos"),
    )


@query("SELECT dimension, valor, count(*) AS n FROM (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id, num_tokens NULLS LAST) c, LATERAL (VALUES ('fenomeno', fenomeno::varchar), ('idioma', idioma), ('formato', lower(formato))) x(dimension, valor) WHERE valor IS NOT NULL GROUP BY ALL")
def index_verify_counts(spark, d):
    c = _chunks(spark, d)
    pairs = F.array(*(F.struct(F.lit(n).alias("dimension"), e.cast("string").alias("valor")) for n, e in (("fenomeno", F.col("fenomeno")), ("idioma", F.col("idioma")), ("formato", F.lower("formato")))))
    return c.select(F.inline(pairs)).filter("valor is not null").groupBy("dimension", "valor").agg(F.count("*").alias("n"))


@query(rf"SELECT chunk_id, largo, unidades FROM (SELECT DISTINCT chunk_id, length(texto)::int AS largo, len(regexp_extract_all(texto, '{_NSP}+'))::int AS unidades FROM chunks ORDER BY largo DESC, chunk_id LIMIT 200) WHERE unidades > 150")
def truncation_candidates(spark, d):
    return vectorbase.truncated(_chunks(spark, d), 150)


@query(r"SELECT row_number() OVER (ORDER BY doc_id, posicion, chunk_id) - 1 AS ordinal, chunk_id, doc_id, posicion, sha256(texto) AS huella FROM (SELECT DISTINCT chunk_id, doc_id, posicion, texto FROM chunks WHERE trim(texto) <> '')")
def vector_base(spark, d):
    """The chunks of the whole corpus as a base with vectors of the stand-in encoder: its ordinals, and that each row is its chunk's."""
    base = vectorbase.build(_chunks(spark, d), vectorbase.HashEncoder(16))
    return base.filter(vectors.is_unit(F.col("embedding"))).select("ordinal", "chunk_id", "doc_id", "posicion", F.sha2("texto", 256).alias("huella"))


@query("""WITH o AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS o, count(*) OVER () AS n FROM documents), p AS (SELECT 'hueco' AS caso, CASE WHEN o = n - 1 THEN o + 1 ELSE o END AS o FROM o UNION ALL SELECT 'repetido', o // 2 * 2 FROM o UNION ALL SELECT 'desde uno', o + 1 FROM o)
SELECT caso, count(*) AS n, count(DISTINCT o) AS distintos, min(o) AS primero, max(o) AS ultimo FROM p GROUP BY caso""")
def ordinal_violations(spark, d):
    """The ordinals of a base as they are, which break nothing, and with a gap, repeated, and from 1."""
    v = vectorbase.with_ordinals(t(spark, d, "documents").select("doc_id"), ["doc_id"])
    last, o = v.agg(F.max("ordinal")).first()[0], F.col("ordinal")
    cases = {"entero": o, "hueco": F.when(o == last, o + 1).otherwise(o), "repetido": o - o % 2, "desde uno": o + 1}
    out = [checks.ordinal_gaps(v.select(e.alias("ordinal"))).withColumn("caso", F.lit(name)) for name, e in cases.items()]
    return reduce(DataFrame.unionByName, out).select("caso", "n", "distintos", "primero", "ultimo")


@query()
def text_search_end_to_end(spark, d):
    """The questions answered over the corpus's chunks: three documents and ten whole-sentence fragments each."""
    base = cut_lineage(vectorbase.build(_chunks(spark, d), vectorbase.HashEncoder(16)))  # a stored table in earnest
    return pipeline.answer(base, t(spark, d, "consultas"), vectorbase.HashEncoder(16))


@query("""SELECT chunk_id || CASE WHEN h >= 'c' THEN '-x' ELSE '' END AS chunk_id, CASE WHEN h < '4' THEN 'otro documento' WHEN h < '8' THEN 'texto ajeno' ELSE 'desconocido' END AS motivo
FROM (SELECT DISTINCT chunk_id, sha256(chunk_id)[1] AS h FROM chunks) WHERE h < '8' OR h >= 'c'""")
def traceability_violations(spark, d):
    """Fragments of chunks, of which by a hash some name another document, some have another text, some an unknown chunk; the others break nothing."""
    c, h = _chunks(spark, d), F.substring(F.sha2("chunk_id", 256), 1, 1)
    wrong_doc, wrong_text, wrong_id = F.when(h < "4", F.concat("doc_id", F.lit("-x"))).otherwise(F.col("doc_id")), F.when((h >= "4") & (h < "8"), F.concat(F.lit("\x01"), "texto")).otherwise(F.col("texto")), F.when(h >= "c", F.concat("chunk_id", F.lit("-x"))).otherwise(F.col("chunk_id"))
    return checks.untraceable(c.select(wrong_id.alias("chunk_id"), wrong_doc.alias("doc_id"), wrong_text.alias("text")), c)


# --- text -----------------------------------------------------------------------------------------------------------

_CLEAN = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(texto), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$', '', 'g')"
_D = "(SELECT DISTINCT doc_id, texto, lower(formato) AS formato FROM mini_corpus WHERE texto IS NOT NULL)"


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    """The distinct texts of the corpus."""
    return t(spark, d, "mini_corpus").filter("texto is not null").select("doc_id", "texto", F.lower("formato").alias("formato")).distinct()


@query(f"SELECT doc_id, length(c)::int AS largo, sha256(c) AS huella FROM (SELECT doc_id, {_CLEAN} AS c FROM {_D})")
def clean_text(spark, d):
    return _corpus(spark, d).select("doc_id", text.clean_text(F.col("texto")).alias("c")).select("doc_id", F.length("c").alias("largo"), F.sha2("c", 256).alias("huella"))


@query(rf"""WITH a AS (SELECT doc_id, regexp_replace(texto, '([\p{{L}}\p{{N}}_])-\n([\p{{L}}\p{{N}}_])', '\1\2', 'g') AS x FROM {_D} WHERE formato = 'pdf'),
b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '^\n([^\n])', ' \1'), '([^\n])\n$', '\1 '), '([^\n])\n([^\n])', '\1 \2', 'g'), '([^\n])\n([^\n])', '\1 \2', 'g') AS x FROM a)
SELECT doc_id, sha256(regexp_replace(x, '(?:\.\s?){{4,}}', ' ', 'g')) AS huella FROM b""")
def pdf_line_unwrap(spark, d):
    return _corpus(spark, d).filter("formato = 'pdf'").select("doc_id", F.sha2(text.unwrap_lines(F.col("texto")), 256).alias("huella"))


_LN = r"list_filter(string_split_regex(texto, '\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]'), lambda x, i: i < len(string_split_regex(texto, '\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]')) OR x <> '')"
_QUALITY = rf"""
WITH a AS (SELECT doc_id, texto, CASE WHEN texto = '' THEN [] ELSE {_LN} END AS ls, length(texto) AS ch, len(regexp_extract_all(texto, '[\p{{L}}\p{{N}}_]+')) AS w,
  len(regexp_extract_all(texto, '[^\p{{L}}\p{{N}}\s\x0b\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]')) AS sy, len(regexp_extract_all(texto, '\p{{Nd}}')) AS nu FROM {_D}),
b AS (SELECT *, list_filter(list_transform(ls, lambda x: regexp_replace(x, '^{_SP}+|{_SP}+$', '', 'g')), lambda x: x <> '') AS f FROM a),
c AS (SELECT *, len(list_filter(f, lambda x: length(x) >= 20 AND len(regexp_extract_all(x, '\p{{L}}')) / length(x) >= 0.35)) AS us,
  CASE WHEN len(f) > 0 THEN 1 - len(list_distinct(f)) / len(f) WHEN ch > 0 THEN 1 ELSE 0 END AS rp FROM b),
q AS (SELECT doc_id, ch AS characters, w AS words, len(ls) AS lines, us AS useful_lines, len(ls) - us AS garbage_lines, round(CASE WHEN ch > 0 THEN sy / ch ELSE 0 END, 6) AS symbol_ratio, round(CASE WHEN ch > 0 THEN nu / ch ELSE 0 END, 6) AS number_ratio,
  round(rp, 6) AS repetition_ratio, CASE WHEN ch > 0 THEN 1.0::DOUBLE ELSE 0 END AS cleaning_ratio,
  round(CASE WHEN ch > 0 THEN least(1, greatest(0, 0.45::DOUBLE * (CASE WHEN len(ls) > 0 THEN us / len(ls) ELSE 0 END) + 0.20::DOUBLE * (1 - sy / ch) + 0.15::DOUBLE * (1 - nu / ch) + 0.20::DOUBLE * (1 - rp))) ELSE 0 END, 6) AS quality_score FROM c)"""


@query(_QUALITY + " SELECT * REPLACE (characters::int AS characters, words::int AS words, lines::int AS lines, useful_lines::int AS useful_lines, garbage_lines::int AS garbage_lines), CASE WHEN quality_score >= 0.75 THEN 'alta' WHEN quality_score >= 0.45 THEN 'media' ELSE 'baja' END AS quality_label FROM q")
def text_quality(spark, d):
    return _corpus(spark, d).select("doc_id", text.text_quality(F.col("texto")).alias("q")).select("doc_id", "q.*")


@query(_QUALITY + " SELECT CASE WHEN quality_score >= 0.75 THEN 'alta' WHEN quality_score >= 0.45 THEN 'media' ELSE 'baja' END AS etiqueta, count(*) AS n FROM q GROUP BY 1")
def quality_buckets(spark, d):
    return _corpus(spark, d).select(text.text_quality(F.col("texto"))["quality_label"].alias("etiqueta")).groupBy("etiqueta").agg(F.count("*").alias("n"))


@query(rf"""SELECT doc_id, round(r, 6) AS letras, CASE WHEN n = 0 THEN 'vacio' WHEN n < 200 THEN 'corto' WHEN formato IN ('pdf', 'imagen') AND r < 0.40 THEN 'ruido' ELSE 'valido' END AS diagnostico FROM (
SELECT doc_id, formato, CASE WHEN texto = '' THEN 0 ELSE len(regexp_extract_all(texto, '\p{{L}}')) / length(texto) END AS r, length(regexp_replace(texto, '^{_SP}+|{_SP}+$', '', 'g')) AS n FROM {_D})""")
def letter_ratio_diagnosis(spark, d):
    c = F.col("texto")
    return _corpus(spark, d).select("doc_id", F.round(text.letter_ratio(c), 6).alias("letras"), corpus.diagnose(c, F.col("formato")).alias("diagnostico"))


@query(rf"SELECT doc_id, len(regexp_extract_all(texto, '{_NSP}+'))::int AS palabras FROM {_D}")
def word_count(spark, d):
    return _corpus(spark, d).select("doc_id", text.word_count(F.col("texto")).alias("palabras"))


@query(rf"""WITH l AS (SELECT doc_id, generate_subscripts(string_split(texto, chr(10)), 1)::int AS linea, unnest(string_split(texto, chr(10))) AS x FROM {_D}), s AS (SELECT doc_id, linea, regexp_replace(x, '^{_SP}+|{_SP}+$', '', 'g') AS x FROM l)
SELECT doc_id, linea FROM s WHERE x <> '' AND NOT regexp_matches(x, '^\s*(?:[-*•]|\d+[.)])\s+') AND NOT regexp_matches(x, '[.?!…]$') AND len(regexp_extract_all(x, '{_NSP}+')) <= 10 AND length(x) <= 120""")
def heading_lines(spark, d):
    x = _corpus(spark, d).select("doc_id", F.posexplode(F.split("texto", "\n")).alias("linea", "x"))
    return x.filter(text.is_heading_line(F.col("x"))).select("doc_id", (F.col("linea") + 1).alias("linea"))


def _score_sql(lang: str, k: int) -> str:
    words = ", ".join(f"'{w}'" for w in text.FUNCTION_WORDS[lang])
    return f"{{'n': len(list_filter(w, lambda x: list_contains([{words}], x))), 'k': {-k}, 'lang': '{lang}'}}"


@query(rf"""WITH w AS (SELECT doc_id, texto, regexp_extract_all(lower(texto), '\p{{L}}+') AS w FROM {_D}), s AS (SELECT doc_id, texto, list_max([{', '.join(_score_sql(x, k) for k, x in enumerate(sorted(text.FUNCTION_WORDS)))}]) AS b FROM w)
SELECT doc_id, CASE WHEN length(regexp_replace(texto, '^{_SP}+|{_SP}+$', '', 'g')) < 20 OR b.n = 0 THEN 'und' ELSE b.lang END AS idioma FROM s""")
def language_guess(spark, d):
    return _corpus(spark, d).select("doc_id", text.guess_language(F.col("texto")).alias("idioma"))


@query(rf"""WITH s AS (SELECT doc_id, texto, regexp_replace(texto, '^{_SP}+|{_SP}+$', '', 'g') AS x FROM {_D}), p AS (SELECT *, string_split(regexp_replace(x, '([.!?]){_SP}+', '\1' || chr(1), 'g'), chr(1)) AS p FROM s),
w AS (SELECT *, list_transform(p, lambda y: len(regexp_extract_all(y, '{_NSP}+'))) AS w FROM p), n AS (SELECT *, len(list_filter(range(1, len(w) + 1), lambda i: list_sum(w[1:i]) <= 250)) AS n FROM w),
r AS (SELECT doc_id, CASE WHEN len(regexp_extract_all(texto, '{_NSP}+')) <= 250 THEN texto WHEN n > 0 THEN array_to_string(p[1:n], ' ') ELSE array_to_string(regexp_extract_all(x, '{_NSP}+')[1:250], ' ') END AS x FROM n)
SELECT doc_id, len(regexp_extract_all(x, '{_NSP}+'))::int AS palabras, sha256(x) AS huella FROM r""")
def truncate_to_sentences(spark, d):
    return _corpus(spark, d).select("doc_id", text.truncate_to_sentences(F.col("texto")).alias("x")).select("doc_id", text.word_count(F.col("x")).alias("palabras"), F.sha2("x", 256).alias("huella"))


@query()
def complete_sentence_prefix(spark, d):
    return _corpus(spark, d).select("doc_id", text.complete_sentences(F.col("texto")).alias("x"))


@query("""WITH p AS (SELECT doc_id, source, text FROM documents WHERE source IS NOT NULL AND text IS NOT NULL), n AS (SELECT source, count(*) AS de FROM p GROUP BY source),
l AS (SELECT DISTINCT doc_id, source, regexp_replace(unnest(string_split_regex(text, '\\r\\n|[\\n\\x0b\\f\\r\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]')), 'S+|Z+$', '', 'g') AS linea FROM p)
SELECT source AS doc, linea, count(*) AS paginas FROM l JOIN n USING (source) WHERE linea <> '' GROUP BY source, linea, de HAVING de >= 3 AND count(*) >= 0.02 * de""".replace("'S+|Z+$'", f"'^{_SP}+|{_SP}+$'").replace("\\\\", "\\"))
def boilerplate_lines(spark, d):
    """Lines on 2 % of the pages or more, a source taken as a document and its rows as pages."""
    pages = t(spark, d, "documents").filter("source is not null and text is not null")
    return corpus.repeated_page_lines(pages, "source", "text", 0.02)


@query(rf"""WITH r AS (SELECT row_number() OVER () AS id, doc_id, string_split_regex(texto, '\n[ \t]*\n') AS ps FROM mini_corpus WHERE lower(trim(formato)) = 'pdf' AND texto IS NOT NULL),
p AS (SELECT id, doc_id, len(ps) AS np, unnest(range(1, len(ps) + 1)) AS p, unnest(ps) AS x FROM r), l AS (SELECT id, np, p, unnest(range(1, len(string_split(x, chr(10))) + 1)) AS k, unnest(string_split(x, chr(10))) AS x FROM p),
m AS (SELECT *, regexp_replace(x, '^{_SP}+|{_SP}+$', '', 'g') AS y FROM l), g AS (SELECT id, y FROM m WHERE y <> '' AND np >= 3 GROUP BY id, np, y HAVING count(DISTINCT p) >= ceil(0.6 * np - 1e-9)),
k AS (SELECT id, p, string_agg(x, chr(10) ORDER BY k) AS x FROM m WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.id = m.id AND g.y = m.y) GROUP BY id, p)
SELECT doc_id, np::int AS paginas, sha256(string_agg(coalesce(k.x, ''), chr(10) || chr(10) ORDER BY p.p)) AS huella FROM p LEFT JOIN k USING (id, p) GROUP BY p.id, doc_id, np""")
def boilerplate_removed(spark, d):
    pages = t(spark, d, "mini_corpus").filter("lower(trim(formato)) = 'pdf' and texto is not null").select("doc_id", F.split("texto", r"\n[ \t]*\n").alias("p"))
    return pages.select("doc_id", corpus.without_repeated_lines(F.col("p"), 0.6).alias("q")).select("doc_id", F.size("q").alias("paginas"), F.sha2(F.array_join("q", "\n\n"), 256).alias("huella"))


# --- names, hashes, predicates ----------------------------------------------------------------------------------------


@query("SELECT DISTINCT path, 'DOC-' || left(sha1(path), 10) AS id, nullif(regexp_extract(path, '(?i)^(?:.*/)?F([1-3])[_-]', 1), '')::int AS fenomeno FROM corpus_report")
def doc_id_hash(spark, d):
    p = F.col("path")
    return t(spark, d, "corpus_report").select("path", names.doc_id(p).alias("id"), names.phenomenon(p).alias("fenomeno")).distinct()


@query("SELECT doc_id, sha256(text) AS huella FROM documents WHERE text IS NOT NULL")
def content_hash(spark, d):
    return t(spark, d, "documents").filter("text is not null").select("doc_id", F.sha2("text", 256).alias("huella"))


@query("SELECT sha256(text) AS clave, count(*) OVER (PARTITION BY text) AS n, doc_id FROM documents WHERE text IS NOT NULL QUALIFY count(*) OVER (PARTITION BY text) > 1")
def duplicate_members(spark, d):
    return corpus.duplicate_members(t(spark, d, "documents"), F.sha2("text", 256), "doc_id")


@query("SELECT sha256(text) AS clave, count(*) AS n, min(doc_id) AS primero FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark, d):
    return corpus.duplicates(t(spark, d, "documents"), F.sha2("text", 256), "doc_id")


@query(r"""SELECT DISTINCT path, lower(regexp_extract(path, '(\.[^./]+)$', 1)) AS sufijo, CASE lower(regexp_extract(path, '(\.[^./]+)$', 1)) WHEN '.pdf' THEN 'pdf' WHEN '.html' THEN 'html' WHEN '.htm' THEN 'html' WHEN '.json' THEN 'json' WHEN '.csv' THEN 'csv' WHEN '.xlsx' THEN 'xlsx' WHEN '.txt' THEN 'texto' WHEN '.pbf' THEN 'pbf' END AS formato,
regexp_matches(regexp_replace(regexp_extract(path, '([^/]+)$', 1), '\.[^.]*$', ''), '(?i)(catalog|registro|tiles-index)') AS manifiesto FROM corpus_report""")
def format_dispatch(spark, d):
    p = F.col("path")
    return t(spark, d, "corpus_report").select("path", names.suffix(p).alias("sufijo"), names.format_of(p).alias("formato"), names.is_manifest(p).alias("manifiesto")).distinct()


@query(r"""WITH x AS (SELECT doc_id, chunk_id, trim(texto) AS v FROM (SELECT DISTINCT doc_id, chunk_id, texto FROM chunks) UNION ALL SELECT 'nota', query_id, CASE query_id[-1] WHEN '1' THEN 'https://x.org/a' WHEN '2' THEN 'b.PDF' WHEN '3' THEN '' WHEN '4' THEN 'http://y.org/c.pdf?d' ELSE pregunta END FROM consultas)
SELECT doc_id, chunk_id, CASE WHEN v = '' THEN 'empty_string' WHEN regexp_matches(v, '(?i)^https?://[^/?#\s]+') THEN 'url' WHEN lower(v) LIKE '%.pdf' OR lower(v) LIKE '%.pdf?%' OR lower(v) LIKE '%.pdf#%' THEN 'pdf_url' WHEN length(v) >= 160 THEN 'long_text' WHEN length(v) >= 40 THEN 'text' ELSE 'short_text' END AS tipo FROM x""")
def value_kinds(spark, d):
    c = t(spark, d, "chunks").select("doc_id", "chunk_id", "texto").distinct()
    last = F.substring("query_id", -1, 1)
    q = t(spark, d, "consultas").select(F.lit("nota").alias("doc_id"), F.col("query_id").alias("chunk_id"), F.when(last == "1", "https://x.org/a").when(last == "2", "b.PDF").when(last == "3", "").when(last == "4", "http://y.org/c.pdf?d").otherwise(F.col("pregunta")).alias("texto"))
    return c.unionByName(q).select("doc_id", "chunk_id", names.string_kind(F.col("texto")).alias("tipo"))


@query(r"SELECT DISTINCT source, regexp_replace(regexp_replace(string_split(source || '/' || upper(source) || ' v2.0', '/')[-1], '[^A-Za-z0-9._-]+', '-', 'g'), '^[-._]+|[-._]+$', '', 'g') AS nombre FROM documents WHERE source IS NOT NULL")
def model_slugs(spark, d):
    s = t(spark, d, "documents").filter("source is not null").select("source").distinct()
    return s.select("source", names.slug(F.concat("source", F.lit("/"), F.upper("source"), F.lit(" v2.0"))).alias("nombre"))


# --- reports and logs -------------------------------------------------------------------------------------------------

_BUCKET = "CASE WHEN quality_score IS NULL THEN 'sin_calcular' WHEN quality_score >= 0.75 THEN 'alta' WHEN quality_score >= 0.45 THEN 'media' ELSE 'baja' END"


@query(f"SELECT dimension, valor, count(*) AS n FROM corpus_report, LATERAL (VALUES ('format', format), ('strategy', strategy), ('institution', institution), ('language', language), ('status', status), ('quality', {_BUCKET}), ('error', error)) x(dimension, valor) WHERE valor IS NOT NULL AND valor <> '' GROUP BY ALL")
def corpus_report(spark, d):
    return corpus.report_histograms(t(spark, d, "corpus_report"))


@query("SELECT count(*) AS registros, coalesce(sum(characters), 0)::bigint AS caracteres, min(nullif(characters, 0)) AS min_caracteres, max(nullif(characters, 0)) AS max_caracteres, coalesce(sum(size_bytes), 0)::bigint AS bytes, min(nullif(size_bytes, 0)) AS min_bytes, max(nullif(size_bytes, 0)) AS max_bytes FROM corpus_report")
def corpus_report_totals(spark, d):
    return corpus.report_totals(t(spark, d, "corpus_report"))


@query("SELECT format, status, count(*) AS n, sum(characters)::bigint AS caracteres FROM corpus_report GROUP BY GROUPING SETS ((format, status), (format), ())")
def report_grouping_sets(spark, d):
    t(spark, d, "corpus_report").createOrReplaceTempView("_report")
    return spark.sql("select format, status, count(*) as n, sum(characters) as caracteres from _report group by grouping sets ((format, status), (format), ())")


@query("SELECT status, count(*) AS n, arg_min(path, {'a': registrado, 'b': path}) AS ejemplo, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::double AS porcentaje FROM checkpoint_pdf GROUP BY status")
def status_summary_pct(spark, d):
    return corpus.status_summary(t(spark, d, "checkpoint_pdf"))


@query("SELECT path, status, registrado FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY registrado DESC, status DESC, pages DESC NULLS LAST) AS k FROM checkpoint_pdf) WHERE k = 1")
def latest_validation(spark, d):
    return corpus.latest(t(spark, d, "checkpoint_pdf").select("path", "registrado", "status", "pages"), "path", "registrado").select("path", "status", "registrado")


@query("SELECT path, status, CASE WHEN status IN ('BATCH_RUNNER_ERROR', 'PDF_CORRUPTO', 'PDF_CIFRADO') THEN coalesce(nullif(reason, ''), errors[1]) END AS error FROM checkpoint_pdf")
def report_errors(spark, d):
    return t(spark, d, "checkpoint_pdf").select("path", "status", corpus.error_column(F.col("status"), F.col("reason"), F.try_element_at("errors", F.lit(1))).alias("error"))


@query("WITH f AS (SELECT DISTINCT fuente || '/' || substr(doc_id, 5) || '.pdf' AS path FROM mini_corpus WHERE lower(formato) = 'pdf') SELECT path FROM f WHERE path NOT IN (SELECT path FROM checkpoint_pdf WHERE sha256 IS NOT NULL AND sha256 <> '')")
def pending_files_anti_join(spark, d):
    files = t(spark, d, "mini_corpus").filter("lower(formato) = 'pdf'").select(F.concat("fuente", F.lit("/"), F.expr("substring(doc_id, 5)"), F.lit(".pdf")).alias("path")).distinct().filter("path is not null")
    done = t(spark, d, "checkpoint_pdf").filter("coalesce(sha256, '') <> ''").select("path").distinct()
    return corpus.pending(files, done, "path")


@query("""SELECT path, CASE WHEN pages = 0 THEN 'PDF_VACIO' WHEN characters = 0 AND pages_with_images > 0 THEN 'PDF_ESCANEADO' WHEN characters = 0 THEN 'PDF_VACIO' WHEN len(errors) > 0 THEN 'PDF_INCOMPLETO' WHEN pages_with_text < pages AND pages_with_images > 0 AND characters < 500 THEN 'PDF_SIN_OCR'
WHEN pages_with_text < greatest(1, pages // 3) AND characters < 1000 THEN 'PDF_INCOMPLETO' ELSE 'PDF_OK' END AS estado, count(*) AS n FROM checkpoint_pdf WHERE pages IS NOT NULL AND characters IS NOT NULL GROUP BY ALL""")
def pdf_decision(spark, d):
    c = [F.col(x) for x in ("pages", "pages_with_text", "pages_with_images", "characters")]
    x = t(spark, d, "checkpoint_pdf").filter("pages is not null and characters is not null")
    return x.select("path", corpus.pdf_status(*c, F.coalesce(F.size("errors"), F.lit(0))).alias("estado")).groupBy("path", "estado").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT DISTINCT path, 'capas/' || institution || '/tiles/' || (characters % 4) || '/' || path AS tesela FROM corpus_report WHERE format = 'pbf' UNION ALL SELECT DISTINCT path, path FROM corpus_report WHERE format = 'csv'),
z AS (SELECT *, nullif(regexp_extract(tesela, '^(.*?(?:^|/)tiles)(?:/|$)', 1), '') AS r, try_cast(nullif(regexp_extract(tesela, '(?:^|/)tiles/(-?\\d+)(?:/|$)', 1), '') AS int) AS z FROM p)
SELECT path, tesela FROM (SELECT *, max(z) OVER (PARTITION BY r) AS m FROM z) WHERE r IS NULL OR z IS NULL OR z = m""".replace("\\\\", "\\"))
def max_zoom_pruning(spark, d):
    r = t(spark, d, "corpus_report")
    tiles = r.filter("format = 'pbf'").select("path", F.concat(F.lit("capas/"), "institution", F.lit("/tiles/"), (F.col("characters") % 4).cast("string"), F.lit("/"), "path").alias("tesela")).distinct()
    return corpus.deepest_tiles(tiles.unionByName(r.filter("format = 'csv'").select("path", F.col("path").alias("tesela")).distinct()), "tesela")


# --- constraints ------------------------------------------------------------------------------------------------------


@query(r"""SELECT doc_id, unnest(list_filter([CASE WHEN v(doc_id) THEN 'vacio:doc_id' END, CASE WHEN v(fuente) THEN 'vacio:fuente' END, CASE WHEN v(formato) THEN 'vacio:formato' END, CASE WHEN v(idioma) THEN 'vacio:idioma' END, CASE WHEN v(texto) THEN 'vacio:texto' END,
CASE WHEN fenomeno IS NULL OR fenomeno NOT IN (1, 2, 3) THEN 'fenomeno' END], lambda x: x IS NOT NULL)) AS motivo FROM mini_corpus""".replace("v(doc_id)", "V<doc_id>").replace("v(fuente)", "V<fuente>").replace("v(formato)", "V<formato>").replace("v(idioma)", "V<idioma>").replace("v(texto)", "V<texto>").replace("V<", "regexp_replace(coalesce(").replace(">", r", ''), '[\s\x0b\x{a0}]+', '', 'g') = ''", 5))
def required_field_violations(spark, d):
    return checks.document_violations(t(spark, d, "mini_corpus"))


@query("SELECT doc_id, count(*) AS n FROM mini_corpus GROUP BY doc_id HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return checks.duplicate_keys(t(spark, d, "mini_corpus"), "doc_id")


@query("SELECT DISTINCT path FROM corpus_report WHERE NOT regexp_matches(regexp_replace(regexp_extract(path, '([^/]+)$', 1), '\\.[^.]*$', ''), '(?i)(catalog|registro|tiles-index)')".replace("\\\\", "\\"))
def manifest_exclusion(spark, d):
    return t(spark, d, "corpus_report").select("path").distinct().filter(~names.is_manifest(F.col("path")))


@query(r"""WITH m AS (SELECT DISTINCT doc_id, texto FROM mini_corpus), c AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id, num_tokens NULLS LAST),
p AS (SELECT * REPLACE (CASE WHEN sha256(chunk_id) < '4' THEN char_start + 1 ELSE char_start END AS char_start, CASE WHEN sha256(chunk_id) >= 'e' THEN posicion + 7 ELSE posicion END AS posicion) FROM c),
x AS (SELECT p.*, m.texto AS t, coalesce(max(char_end) OVER w, 0) AS antes, row_number() OVER (PARTITION BY p.doc_id ORDER BY posicion) - 1 AS fila FROM p JOIN m USING (doc_id) WINDOW w AS (PARTITION BY p.doc_id ORDER BY posicion ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id, chunk_id, unnest(list_filter([CASE WHEN coalesce(length(texto), 0) = 0 THEN 'vacio' END, CASE WHEN substr(t, char_start + 1, char_end - char_start) IS DISTINCT FROM texto THEN 'no es su tramo' END, CASE WHEN fila <> posicion THEN 'posicion' END,
  CASE WHEN num_tokens > 200 OR num_palabras > 120 THEN 'limite' END, CASE WHEN char_start > antes AND regexp_replace(substr(t, antes + 1, char_start - antes), '[\s\x0b\x{a0}]+', '', 'g') <> '' THEN 'hueco' END], lambda y: y IS NOT NULL)) AS motivo FROM x""".replace("\\\\", "\\"))
def chunk_slice_violations(spark, d):
    """The chunks of the table, of which by a hash some begin a character later and some have another position, against their documents and tighter limits."""
    c, m, h = _chunks(spark, d), t(spark, d, "mini_corpus").select("doc_id", "texto").distinct(), F.sha2("chunk_id", 256)
    planted = c.withColumns({"char_start": F.when(h < "4", F.col("char_start") + 1).otherwise(F.col("char_start")), "posicion": F.when(h >= "e", F.col("posicion") + 7).otherwise(F.col("posicion"))})
    return checks.chunk_violations(planted, m, 200, 120)


@query("SELECT doc_id, chunk_id, 'texto_vacio' AS motivo FROM chunks WHERE regexp_replace(coalesce(texto, ''), '[\\s\\x0b\\x{a0}]+', '', 'g') = ''".replace("\\\\", "\\"))
def discarded_fragments(spark, d):
    return vectorbase.split_fragments(t(spark, d, "chunks"))[1]


# --- chunking ---------------------------------------------------------------------------------------------------------


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """One row for each document with a text, the latest; labels may differ between its rows, texts don't."""
    x = t(spark, d, "mini_corpus").filter("texto is not null").select("doc_id", "fuente", F.lower("formato").alias("formato"), "fenomeno", "idioma", "texto", "ingresado")
    return corpus.latest(x, "doc_id", "ingresado").drop("ingresado")


@query()
def sentences(spark, d):
    @F.pandas_udf("array<struct<ini:int,fin:int,bloque:int,titulo:boolean>>")
    def run(s):
        return s.map(lambda x: [{"ini": p.start, "fin": p.end, "bloque": p.block, "titulo": p.heading} for p in chunker.pieces_of(x or "")])

    return _documents(spark, d).select("doc_id", F.inline(run(F.col("texto"))))


_BLOCKS = rf"""WITH d AS (SELECT DISTINCT doc_id, texto FROM mini_corpus WHERE texto IS NOT NULL), p AS (SELECT doc_id, string_split_regex(texto, '\n[ \t]*\n+') AS ps, regexp_extract_all(texto, '\n[ \t]*\n+') AS gs FROM d),
b AS (SELECT doc_id, unnest(range(1, len(ps) + 1)) AS i, unnest(ps) AS x, unnest(list_transform(range(1, len(ps) + 1), lambda i: coalesce(list_sum(list_transform(ps[1:i - 1], lambda y: length(y))), 0) + coalesce(list_sum(list_transform(gs[1:i - 1], lambda y: length(y))), 0))) AS a FROM p),
l AS (SELECT doc_id, i, a, length(x) AS largo, x, string_split_regex(x, '\r\n|[\n\x0b\f\r\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]') AS ls FROM b WHERE x <> ''),
h AS (SELECT *, len(ls) - (ls[-1] = '')::int AS n, regexp_replace(ls[1], '^{_SP}+|{_SP}+$', '', 'g') AS s FROM l),
t AS (SELECT *, s <> '' AND NOT regexp_matches(s, '^(?:[-*•]|\d+[.)]){_SP}+') AND NOT regexp_matches(s, '[.?!…]$') AND len(regexp_extract_all(s, '{_NSP}+')) <= 10 AND length(s) <= 120 AS cabeza FROM h),
u AS (SELECT *, cabeza AND n = 1 AS sola, lead(i) OVER w IS NOT NULL AS sigue, sum((NOT (cabeza AND n = 1))::int) OVER (PARTITION BY doc_id ORDER BY i) AS tramo FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
v AS (SELECT *, sum(sola::int) OVER (PARTITION BY doc_id, tramo ORDER BY i) AS turno FROM u),
x AS (SELECT *, coalesce(lag(sola AND turno % 2 = 1) OVER (PARTITION BY doc_id ORDER BY i), false) AS dentro, lead(a + largo) OVER (PARTITION BY doc_id ORDER BY i) AS fin_sig, lead(x) OVER (PARTITION BY doc_id ORDER BY i) AS x_sig FROM v),
blk AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS bloque, a AS inicio, CASE WHEN sola AND sigue THEN fin_sig ELSE a + largo END AS fin, CASE WHEN sola THEN sigue ELSE cabeza AND n > 1 END AS titulo, regexp_matches(x || CASE WHEN sola AND sigue THEN x_sig ELSE '' END, '{_NSP}') AS lleno FROM x WHERE NOT dentro)"""


@query(_BLOCKS + " SELECT doc_id, bloque::int AS bloque, inicio::int AS inicio, fin::int AS fin, titulo FROM blk")
def text_blocks(spark, d):
    return chunker.text_blocks(_documents(spark, d))


@query(_BLOCKS + f""", f AS (SELECT doc_id, count(*) FILTER (WHERE titulo) + (NOT arg_min(titulo, bloque))::int AS trozos FROM blk WHERE lleno GROUP BY doc_id)
SELECT doc_id, trozos::int AS trozos, len(regexp_extract_all(texto, '{_NSP}'))::int AS letras, true AS en_orden, true AS son_tramos FROM f JOIN d USING (doc_id)""")
def chunk_reconstruction(spark, d):
    """With limits that nothing reaches, chunks end where headings begin; together they are their documents: every character that is no white space once, in order, each its slice."""
    docs = _documents(spark, d)
    c = chunker.chunk_documents(docs, chunker.ChunkConfig(10**8, 10**8, 0)).join(docs.select("doc_id", F.col("texto").alias("_t")), "doc_id")
    slice_ = F.col("_t").substr(F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    return c.groupBy("doc_id").agg(
        F.count("*").cast("int").alias("trozos"), F.sum(F.regexp_count("texto", F.lit(rf"(?!{text.SPACE})(?s:.)"))).cast("int").alias("letras"),
        ((F.max("posicion") == F.count("*") - 1) & (F.count_distinct("posicion") == F.count("*"))).alias("en_orden"), F.bool_and(slice_ == F.col("texto")).alias("son_tramos"),
    )


@query("SELECT 'palabras' AS limite, 0::bigint AS pasados, true AS fichas UNION ALL SELECT 'fichas', 0, true")
def chunk_token_limits(spark, d):
    """Chunks under a limit of words, and of tokens of a byte-level vocabulary: how many are over it, and whether tokens are more than words, so that the two limits differ."""
    docs, counter = _documents(spark, d), chunker.bpe_counter(f"{os.environ.get('TEXTLOOM_TOKENIZERS', '/opt/tokenizers')}/byte_bpe_50k.tiktoken")
    cases = {"palabras": chunker.ChunkConfig(10**6, 120, 1), "fichas": chunker.ChunkConfig(160, 10**6, 1)}
    out = [chunker.chunk_documents(docs, cfg, counter).agg(F.count_if((F.col("num_tokens") > cfg.max_tokens) | (F.col("num_palabras") > cfg.max_words)).alias("pasados"), (F.sum("num_tokens") > F.sum("num_palabras")).alias("fichas")).withColumn("limite", F.lit(name)) for name, cfg in cases.items()]
    return reduce(DataFrame.unionByName, out).select("limite", "pasados", "fichas")


@query()
def chunks(spark, d):
    return chunker.chunk_documents(_documents(spark, d), chunker.ChunkConfig(120, 120, 1))


@query()
def chunk_errors(spark, d):
    return chunker.errors_of(chunker.chunked(_documents(spark, d), chunker.ChunkConfig(12, 12, 0)))


@query()
def chunk_warnings(spark, d):
    return chunker.warnings_of(chunker.chunked(_documents(spark, d), chunker.ChunkConfig(12, 12, 0)))


@query("SELECT ''::varchar AS doc_id, ''::varchar AS chunk_id, ''::varchar AS motivo WHERE false")
def chunk_coverage_violations(spark, d):
    docs = _documents(spark, d)
    return checks.chunk_violations(chunker.chunk_documents(docs, chunker.ChunkConfig(120, 120, 1)), docs, 120, 120)


@query("""WITH RECURSIVE c AS (SELECT DISTINCT ON (chunk_id) doc_id, posicion, num_palabras AS n FROM chunks), o AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY posicion) AS k, n FROM c),
r AS (SELECT doc_id, k, n AS s, 0 AS g FROM o WHERE k = 1 UNION ALL SELECT o.doc_id, o.k, CASE WHEN r.s + o.n <= 300 THEN r.s + o.n ELSE o.n END, CASE WHEN r.s + o.n <= 300 THEN r.g ELSE r.g + 1 END FROM r JOIN o ON o.doc_id = r.doc_id AND o.k = r.k + 1)
SELECT doc_id, g AS grupo, count(*) AS trozos, sum(o.n)::bigint AS palabras FROM r JOIN o USING (doc_id, k) GROUP BY doc_id, g""")
def greedy_word_packing(spark, d):
    """A document's chunks packed greedily into groups of at most 300 words, as one fold over an array."""
    c = _chunks(spark, d)
    seq = c.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("posicion", F.col("num_palabras").alias("n")))).alias("a"))
    start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("g"), F.array().cast("array<struct<grupo:int,n:int>>").alias("out"))

    def step(a, x):
        fits = (F.size(a["out"]) == 0) | (a["s"] + x["n"] <= 300)
        g = F.when(fits, a["g"]).otherwise(a["g"] + 1)
        return F.struct(F.when(fits, a["s"] + x["n"]).otherwise(x["n"]).alias("s"), g.alias("g"), F.concat(a["out"], F.array(F.struct(g.alias("grupo"), x["n"].alias("n")))).alias("out"))

    return seq.select("doc_id", F.inline(F.aggregate("a", start, step)["out"])).groupBy("doc_id", "grupo").agg(F.count("*").alias("trozos"), F.sum("n").alias("palabras"))


@query("SELECT doc_id, posicion, chunk_id, sum(num_palabras) OVER (PARTITION BY doc_id ORDER BY posicion)::bigint AS acumuladas, coalesce(lead(fenomeno) OVER (PARTITION BY doc_id ORDER BY posicion) IS NULL, true) AS ultimo FROM (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id, num_tokens NULLS LAST)")
def chunk_prefix_sums(spark, d):
    w = W.partitionBy("doc_id").orderBy("posicion")
    return _chunks(spark, d).select("doc_id", "posicion", "chunk_id", F.sum("num_palabras").over(w).alias("acumuladas"), F.lead("fenomeno").over(w).isNull().alias("ultimo"))


# --- JSON and tables --------------------------------------------------------------------------------------------------


@query("SELECT 'k' AS path, count(DISTINCT event_id) AS documentos, count(*) AS apariciones, 0::bigint AS caracteres, NULL::int AS min_caracteres, NULL::int AS max_caracteres, 0::bigint AS urls, 0::bigint AS pdfs FROM events WHERE props->>'$.k' IS NOT NULL")
def json_field_profile(spark, d):
    return corpus.field_profile(t(spark, d, "events"), "props", "event_id").drop("muestras")


@query("SELECT 'k' AS path, 'int' AS kind, count(*) AS n FROM events WHERE props->>'$.k' IS NOT NULL")
def json_field_kinds(spark, d):
    return corpus.field_kinds(t(spark, d, "events"), "props")


_ARTICLES = rf"""WITH m AS (SELECT DISTINCT doc_id, fenomeno, texto, string_split(texto, chr(10))[1] AS titulo, string_split_regex(texto, '\n\s*\n') AS ps FROM mini_corpus WHERE lower(formato) = 'json' AND texto IS NOT NULL),
f AS (SELECT doc_id, CASE WHEN fenomeno = 1 THEN 'title' WHEN fenomeno = 2 THEN 'headline' ELSE 'titulo' END AS path, titulo AS v FROM m UNION ALL SELECT doc_id, 'pdf_url', 'https://x.org/a.pdf' FROM m WHERE fenomeno = 2
  UNION ALL SELECT doc_id, 'resumen', texto FROM m WHERE coalesce(fenomeno, 0) NOT IN (1, 2) UNION ALL SELECT doc_id, 'body_paragraphs[]', unnest(ps) FROM m WHERE fenomeno = 1),
g AS (SELECT doc_id, path, row_number() OVER () AS o, regexp_replace(v, '^{_SP}+|{_SP}+$', '', 'g') AS v FROM f),
k AS (SELECT doc_id, path, v, o, CASE WHEN v = '' THEN 'empty_string' WHEN regexp_matches(v, '(?i)^https?://[^/?#\s]+') THEN 'url' WHEN lower(v) LIKE '%.pdf' OR lower(v) LIKE '%.pdf?%' OR lower(v) LIKE '%.pdf#%' THEN 'pdf_url' WHEN length(v) >= 160 THEN 'long_text' WHEN length(v) >= 40 THEN 'text' ELSE 'short_text' END AS kind FROM g
  UNION ALL SELECT doc_id, 'body_paragraphs', array_to_string(list_filter(list_transform(ps, lambda x: regexp_replace(x, '^{_SP}+|{_SP}+$', '', 'g')), lambda x: x <> ''), chr(10) || chr(10)), 0, 'list' FROM m WHERE fenomeno = 1)"""


@query(_ARTICLES + """ SELECT path, count(DISTINCT doc_id) AS documentos, count(*) AS apariciones, coalesce(sum(length(v)) FILTER (WHERE v <> ''), 0)::bigint AS caracteres, min(length(v)) FILTER (WHERE v <> '')::int AS min_caracteres, max(length(v)) FILTER (WHERE v <> '')::int AS max_caracteres,
count(*) FILTER (WHERE kind = 'url') AS urls, count(*) FILTER (WHERE kind = 'pdf_url' OR kind = 'url' AND regexp_matches(lower(v), '\\.pdf($|[?#])')) AS pdfs, sha256(min(v) FILTER (WHERE v <> '')) AS primera FROM k GROUP BY path""".replace("\\\\", "\\"))
def json_article_profile(spark, d):
    """The fields of nested documents: lists and their items, with a sample."""
    return corpus.field_profile(_articles(spark, d), "j", "doc_id").withColumn("primera", F.sha2(F.try_element_at("muestras", F.lit(1)), 256)).drop("muestras")


@query(_ARTICLES + " SELECT path, kind, count(*) AS n FROM k GROUP BY ALL")
def json_article_kinds(spark, d):
    return corpus.field_kinds(_articles(spark, d), "j")


@query(_ARTICLES + """, p AS (SELECT path, count(DISTINCT doc_id) AS documentos, coalesce(sum(length(v)), 0) AS caracteres, count(*) FILTER (WHERE kind = 'url') AS urls, count(DISTINCT kind) AS tipos FROM k GROUP BY path),
r AS (SELECT 'texto' AS lista, path, row_number() OVER (ORDER BY documentos DESC, caracteres DESC, path) AS puesto FROM p WHERE caracteres > 0 AND urls = 0 UNION ALL SELECT 'url', path, row_number() OVER (ORDER BY urls DESC, documentos DESC, path) FROM p WHERE urls > 0
UNION ALL SELECT 'mixto', path, row_number() OVER (ORDER BY documentos DESC, tipos DESC, path) FROM p WHERE tipos > 1) SELECT lista, path, puesto::int AS puesto FROM r""")
def json_field_rankings(spark, d):
    a = _articles(spark, d)
    profile, kinds = corpus.field_profile(a, "j", "doc_id"), corpus.field_kinds(a, "j")
    w = {"texto": ("documentos", "caracteres"), "url": ("urls", "documentos"), "mixto": ("documentos", "tipos")}
    out = [corpus.ranked_fields(profile, kinds, which, only_text=True).withColumn("puesto", F.row_number().over(W.orderBy(*(F.desc(c) for c in by), "path"))).select(F.lit(which).alias("lista"), "path", "puesto") for which, by in w.items()]
    return reduce(DataFrame.unionByName, out)


@query(_ARTICLES + """, c AS (SELECT doc_id, string_agg(path || '=' || kinds || coalesce('#' || n, ''), ';' ORDER BY path) AS forma FROM (
  SELECT doc_id, k.path, array_to_string(list(kind ORDER BY i)[1:12], ',') AS kinds, CASE WHEN k.path = 'body_paragraphs[]' THEN count(*) END AS n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, path ORDER BY o) AS i FROM k) k GROUP BY doc_id, k.path) GROUP BY doc_id)
SELECT 'dict' AS raiz, count(*) AS documentos, array_to_string(list_sort(list(doc_id))[1:5], ',') AS rutas FROM c GROUP BY forma""")
def json_schema_clusters(spark, d):
    return corpus.schema_report(_articles(spark, d), "j", "doc_id").select("raiz", "documentos", F.array_join("rutas", ",").alias("rutas"))


@query("SELECT CASE event_id % 5 WHEN 0 THEN 'list' WHEN 1 THEN 'error' WHEN 2 THEN 'int' WHEN 3 THEN 'str' ELSE 'dict' END AS raiz, count(*) AS documentos FROM events GROUP BY 1")
def json_root_kinds(spark, d):
    """Kinds of roots, of which a fifth isn't JSON."""
    n = F.col("event_id") % 5
    j = F.when(n == 0, "[1, 2]").when(n == 1, '{"k": ').when(n == 2, "7").when(n == 3, '"x"').otherwise(F.col("props"))
    return corpus.root_kinds(t(spark, d, "events").select(j.alias("j")), "j")


def _articles(spark: SparkSession, d: str) -> DataFrame:
    """The json documents of the corpus as articles with different fields."""
    x = t(spark, d, "mini_corpus").filter("lower(formato) = 'json' and texto is not null").select("doc_id", "fenomeno", "texto").dropDuplicates(["doc_id"])
    title = F.element_at(F.split("texto", "\n"), 1)
    forms = F.when(F.col("fenomeno") == 1, F.to_json(F.struct(title.alias("title"), F.split("texto", r"\n\s*\n").alias("body_paragraphs")))).when(F.col("fenomeno") == 2, F.to_json(F.struct(title.alias("headline"), F.lit("https://x.org/a.pdf").alias("pdf_url")))).otherwise(F.to_json(F.struct(title.alias("titulo"), F.col("texto").alias("resumen"))))
    return x.select("doc_id", forms.alias("j"))


@query("SELECT doc_id, CASE fenomeno WHEN 1 THEN CASE WHEN regexp_matches(texto, '[^\\s\\x{a0}]') THEN 'local' ELSE 'desconocida' END WHEN 2 THEN 'pdf' ELSE CASE WHEN regexp_matches(texto, '[^\\s\\x{a0}]') THEN 'abstract' ELSE 'desconocida' END END AS estrategia FROM (SELECT DISTINCT doc_id, fenomeno, texto FROM mini_corpus WHERE lower(formato) = 'json' AND texto IS NOT NULL)".replace("\\\\", "\\"))
def json_resolution(spark, d):
    return _articles(spark, d).select("doc_id", jsonx.resolution(F.col("j"))["strategy"].alias("estrategia"))


@query(rf"""WITH m AS (SELECT DISTINCT doc_id, fenomeno, texto, string_split(texto, chr(10))[1] AS titulo, string_split_regex(texto, '\n\s*\n') AS ps FROM mini_corpus WHERE lower(formato) = 'json' AND texto IS NOT NULL),
x AS (SELECT doc_id, regexp_replace(titulo, '^{_SP}+|{_SP}+$', '', 'g') AS a, array_to_string(list_filter(list_transform(ps, lambda x: regexp_replace(x, '^{_SP}+|{_SP}+$', '', 'g')), lambda x: x <> ''), chr(10) || chr(10)) AS b FROM m WHERE fenomeno = 1)
SELECT doc_id, sha256(regexp_replace(a || chr(10) || chr(10) || b, '^{_SP}+|{_SP}+$', '', 'g')) AS huella FROM x WHERE b <> ''""")
def json_article_text(spark, d):
    """Of the articles with paragraphs."""
    x = _articles(spark, d).filter(F.col("j").contains('"body_paragraphs"')).select("doc_id", "j", jsonx.resolution(F.col("j"))["strategy"].alias("e")).filter("e = 'local'")
    return x.select("doc_id", F.sha2(jsonx.json_text(F.col("j")), 256).alias("huella"))


@query("SELECT n_nationkey, 'n_nationkey: ' || n_nationkey || ' | n_name: ' || n_name || ' | n_regionkey: ' || n_regionkey AS linea FROM nation")
def rows_as_pairs_text(spark, d):
    return t(spark, d, "nation").select("n_nationkey", lines.pairs_text(["n_nationkey", "n_name", "n_regionkey"]).alias("linea"))


@query("SELECT event_type AS clave, date_trunc('hour', ts) AS inicio, count(*) AS n, round(sum(value), 4) AS suma FROM events GROUP BY ALL")
def event_windows(spark, d):
    from ..streaming.ingest import windowed_status

    return windowed_status(t(spark, d, "events")).withColumn("suma", F.round("suma", 4))


# --- diagnoses --------------------------------------------------------------------------------------------------------

_DIAG = rf"""WITH a AS (SELECT doc_id, lower(formato) AS f, coalesce(texto, '') AS x FROM (SELECT DISTINCT doc_id, formato, texto FROM mini_corpus)),
b AS (SELECT doc_id, f, length(x) AS n, length(regexp_replace(x, '^{_SP}+|{_SP}+$', '', 'g')) AS s, CASE WHEN x = '' THEN 0 ELSE len(regexp_extract_all(x, '\p{{L}}')) / length(x) END AS r FROM a),
c AS (SELECT doc_id, CASE f WHEN 'json' THEN 'JSON' WHEN 'pdf' THEN 'PDF' WHEN 'html' THEN 'HTML' WHEN 'imagen' THEN 'IMAGEN' WHEN 'xlsx' THEN 'EXCEL' WHEN 'csv' THEN 'EXCEL' WHEN 'txt' THEN 'TXT' ELSE 'DESCONOCIDO' END AS categoria,
  CASE WHEN s = 0 THEN 'sin texto' WHEN s < 200 THEN 'texto corto' WHEN f IN ('pdf', 'imagen') AND r < 0.40 THEN 'posible OCR deficiente' ELSE 'texto válido' END AS motivo, n::int AS caracteres FROM b)"""


@query(_DIAG + " SELECT doc_id, categoria, motivo, motivo = 'texto válido' AS valido, caracteres FROM c")
def corpus_diagnosis(spark, d):
    return reports.diagnose_documents(t(spark, d, "mini_corpus").select("doc_id", "formato", "texto").distinct()).drop("estrategia")


@query(_DIAG + " SELECT categoria, count(*) AS n, count(*) FILTER (WHERE motivo = 'texto válido') AS validos FROM c GROUP BY categoria")
def diagnosis_by_category(spark, d):
    x = reports.diagnose_documents(t(spark, d, "mini_corpus").select("doc_id", "formato", "texto").distinct())
    return x.groupBy("categoria").agg(F.count("*").alias("n"), F.count_if("valido").alias("validos"))


@query(_DIAG + """ SELECT count(*) AS total, count(*) FILTER (WHERE motivo = 'texto válido') AS validos, count(*) FILTER (WHERE motivo <> 'texto válido') AS invalidos, count(*) FILTER (WHERE categoria = 'JSON') AS json, count(*) FILTER (WHERE categoria = 'PDF') AS pdf, count(*) FILTER (WHERE categoria = 'HTML') AS html,
count(*) FILTER (WHERE categoria = 'IMAGEN') AS imagen, count(*) FILTER (WHERE categoria = 'EXCEL') AS excel, count(*) FILTER (WHERE categoria = 'TXT') AS txt, count(*) FILTER (WHERE categoria = 'ERROR') AS error, count(*) FILTER (WHERE categoria = 'DESCONOCIDO') AS desconocido, 0::bigint AS manifiestos, 0::bigint AS catalogos,
count(*) FILTER (WHERE contains(lower(motivo), 'ocr')) AS pdf_ocr, 0::bigint AS pdf_corruptos, count(*) FILTER (WHERE categoria = 'PDF' AND caracteres = 0) AS pdf_vacios, 0::bigint AS json_desconocidos FROM c""")
def diagnosis_statistics(spark, d):
    return reports.diagnosis_statistics(reports.diagnose_documents(t(spark, d, "mini_corpus").select("doc_id", "formato", "texto").distinct()))


@query(_DIAG + " SELECT doc_id, caracteres, row_number() OVER (ORDER BY caracteres DESC, doc_id)::int AS puesto FROM c QUALIFY puesto <= 200")
def documents_by_characters(spark, d):
    x = reports.by_characters(reports.diagnose_documents(t(spark, d, "mini_corpus").select("doc_id", "formato", "texto").distinct()))
    return x.select("doc_id", "caracteres", F.row_number().over(W.orderBy(F.desc("caracteres"), "doc_id")).alias("puesto"))


@query(rf"""WITH r AS (SELECT DISTINCT doc_id, list_transform(string_split_regex(texto, '\n[ \t]*\n'), lambda x: regexp_replace(x, '^{_SP}+|{_SP}+$', '', 'g')) AS ps FROM mini_corpus WHERE lower(trim(formato)) = 'pdf' AND texto IS NOT NULL),
a AS (SELECT doc_id, len(ps) AS n, list_filter(ps, lambda x: x <> '') AS f FROM r), b AS (SELECT doc_id, n, len(f) AS c, len(list_filter(f, lambda x: length(x) < 30)) AS q, array_to_string(f, chr(10) || chr(10)) AS w FROM a), e AS (SELECT *, CASE WHEN w = '' THEN 0 ELSE len(regexp_extract_all(w, '\p{{L}}')) / length(w) END AS l FROM b)
SELECT doc_id, n::int AS paginas, (n - c)::int AS vacias, c::int AS con_texto, q::int AS ruido, length(w)::int AS caracteres, round(l, 6) AS letras,
CASE WHEN w = '' THEN 'sin texto: necesita OCR' WHEN length(w) < 200 THEN 'texto corto' WHEN l < 0.40 THEN 'posible OCR deficiente' WHEN 2 * q > c THEN 'páginas casi vacías' ELSE 'texto válido' END AS motivo FROM e""")
def pdf_page_diagnosis(spark, d):
    """The pieces between blank lines taken as pages."""
    x = t(spark, d, "mini_corpus").filter("lower(trim(formato)) = 'pdf' and texto is not null").select("doc_id", "texto").distinct()
    return x.select("doc_id", reports.page_diagnosis(F.transform(F.split("texto", r"\n[ \t]*\n"), text.strip)).alias("q")).select("doc_id", "q.*")


@query("SELECT n_nationkey, '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || ',\"nada\":null}' AS registro FROM nation")
def rows_as_json(spark, d):
    """Rows as a log keeps them, nulls included."""
    x = t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey", F.lit(None).cast("string").alias("nada"))
    return reports.as_row(x).select(F.get_json_object("registro", "$.n_nationkey").cast(x.schema["n_nationkey"].dataType).alias("n_nationkey"), "registro")


@query("SELECT k AS clave, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY k ORDER BY n DESC, k LIMIT 20")
def json_top_keys(spark, d):
    return reports.key_frequency(t(spark, d, "events"), "props")


@query("SELECT vec_id, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS largo FROM embeddings, (SELECT count(*) AS n FROM embeddings) WHERE vec_id IN (SELECT round(i * (n - 1) / (least(n, 1000) - 1))::bigint FROM range(1000) r(i) WHERE i < n)")
def vector_norm_sample(spark, d):
    """A thousand evenly spaced vectors' lengths at most (a sample is what it reports)."""
    v = t(spark, d, "embeddings")
    n = v.count()
    at = sorted({int(i * (n - 1) / max(1, min(n, 1000) - 1) + 0.5) for i in range(min(n, 1000))}) if n else [-1]
    return v.filter(F.col("vec_id").isin(at)).select("vec_id", F.round(vectors.norm(F.col("embedding")), 6).alias("largo"))


@query("SELECT n_regionkey, string_agg('n_name: ' || n_name || ' | n_nationkey: ' || n_nationkey, chr(10) ORDER BY n_nationkey) AS texto FROM nation GROUP BY n_regionkey")
def table_as_text(spark, d):
    """The rows of a table as the text of one document per group."""
    x = t(spark, d, "nation").withColumn("linea", lines.pairs_text(["n_name", "n_nationkey"]))
    rows = x.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "linea"))).alias("r"))
    return rows.select("n_regionkey", F.array_join(F.col("r.linea"), "\n").alias("texto"))


@query("SELECT DISTINCT c.doc_id FROM chunks c JOIN (SELECT DISTINCT doc_id FROM mini_corpus WHERE lower(formato) = 'txt') m USING (doc_id)")
def documents_already_indexed(spark, d):
    """The semi-join that guards an extension: documents of a batch that the base has already."""
    new = t(spark, d, "mini_corpus").filter("lower(formato) = 'txt'").select("doc_id")
    return t(spark, d, "chunks").select("doc_id").distinct().join(new, "doc_id", "left_semi")


@query("SELECT DISTINCT chunk_id FROM chunks WHERE doc_id NOT IN (SELECT doc_id FROM mini_corpus WHERE doc_id IS NOT NULL AND lower(formato) = 'json')")
def chunks_without_document(spark, d):
    """The anti-join that guards an encoding again: chunks whose document isn't in a batch."""
    return t(spark, d, "chunks").select("doc_id", "chunk_id").distinct().join(t(spark, d, "mini_corpus").filter("lower(formato) = 'json'").select("doc_id"), "doc_id", "left_anti").select("chunk_id")


@query(rf"""WITH f AS (SELECT DISTINCT fuente || '/' || doc_id || '.' || lower(formato) AS path, coalesce(texto, '') AS texto FROM mini_corpus WHERE fuente IS NOT NULL AND formato IS NOT NULL), c AS (SELECT path, length({_CLEAN})::int AS n FROM f),
m AS (SELECT path, n, lower(regexp_extract(path, '(\.[^./\\]+)$', 1)) AS formato, CASE WHEN regexp_matches(regexp_replace(regexp_extract(path, '([^/\\]+)$', 1), '\.[^.]*$', ''), '(?i)(catalog|registro|tiles-index)') THEN 'manifiesto' WHEN n = 0 THEN 'sin texto' WHEN n < 200 THEN 'texto corto' ELSE 'texto válido' END AS motivo FROM c)
SELECT path, formato, motivo, n AS caracteres, motivo = 'texto válido' AS valido FROM m""")
def extraction_validation(spark, d):
    files = t(spark, d, "mini_corpus").filter("fuente is not null and formato is not null").select(F.concat("fuente", F.lit("/"), "doc_id", F.lit("."), F.lower("formato")).alias("path"), F.coalesce("texto", F.lit("")).alias("texto")).distinct()
    return reports.validate_extraction(files)


@query("SELECT doc_id, CASE fenomeno WHEN 1 THEN 'body_paragraphs,title' WHEN 2 THEN 'headline,pdf_url' ELSE 'resumen,titulo' END AS claves, CASE WHEN fenomeno = 1 THEN 1 ELSE 0 END AS listas, CASE WHEN fenomeno = 2 THEN 'https://x.org/a.pdf' END AS url FROM (SELECT DISTINCT doc_id, fenomeno FROM mini_corpus WHERE lower(formato) = 'json' AND texto IS NOT NULL)")
def json_unknown_analysis(spark, d):
    x = _articles(spark, d).select("doc_id", jsonx.unknown(F.col("j")).alias("u"))
    return x.select("doc_id", F.array_join("u.keys", ",").alias("claves"), F.size("u.lists").alias("listas"), F.try_element_at("u.urls", F.lit(1)).alias("url"))


@query("SELECT status, pages_with_images > 0 AS imagenes, count(*) AS n, sum(pages)::bigint AS paginas, sum(pages_with_text)::bigint AS con_texto, sum(characters)::bigint AS caracteres FROM checkpoint_pdf GROUP BY ALL")
def pdf_page_totals(spark, d):
    x = t(spark, d, "checkpoint_pdf").withColumn("imagenes", F.col("pages_with_images") > 0)
    return x.groupBy("status", "imagenes").agg(F.count("*").alias("n"), F.sum("pages").alias("paginas"), F.sum("pages_with_text").alias("con_texto"), F.sum("characters").alias("caracteres"))


@query(ORACLE["event_windows"])
def event_windows_stream(spark, d):
    """The same counts by a stream that takes what there is and ends."""
    import uuid

    from ..streaming.ingest import windowed_status

    name = "ventanas_" + uuid.uuid4().hex
    stream = spark.readStream.schema(t(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    windowed_status(stream).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).withColumn("suma", F.round("suma", 4))
