"""Every operator on awkward tables: nulls anywhere, empty and long texts, repeated rows, no rows, extra columns of any name."""

import pytest
from pyspark.sql import functions as F

from textloom.llm import areas, body, encode, language, packing, pieces, repeated, scans, sentences, shape

LONG = "Una frase bastante larga del documento con palabras comunes. " * 3000
SCHEMA = "doc_id string, fuente string, formato string, fenomeno int, idioma string, texto string, ingresado timestamp"
ROWS = [
    ("a", "F1/x", "pdf", 1, "es", "Título\n\nEl río vol-\nvió a crecer en prima1era.\n- 3 -\nFin del texto.", None),
    ("a", "F1/x", "pdf", 1, "es", "Título\n\nEl río vol-\nvió a crecer en prima1era.\n- 3 -\nFin del texto.", None),
    ("b", None, "html", None, None, "Inicio | Mapas | Contacto\nEl título de la página 2001 — la mesa\nUna frase de la página que es larga y termina aquí.\n© 2001 X", None),
    (None, "F1/x", "txt", 2, "", "Texto sin identificador. Otra frase.", None),
    ("c", "./F1\\X/", "TXT", 1, "xx", "", None),
    ("d", "F1/x", None, 1, "es", None, None),
    ("e", "F1/x", "json", 1, "en", " \n \r\n", None),
    ("f", "F1/x", "txt", 3, "ES-co", LONG, None),
    ("g", "F1/x", "csv", 3, "es", "x" * 5000, None),
    ("h", "F1/x", "pdf", 3, "es", "😀 ́ \x00 ​".encode("utf-16", "surrogatepass").decode("utf-16"), None),
]
NAMES = ("linea", "clase", "pieza", "n", "docs", "grupo", "igual", "seq", "h", "ids", "_f", "tokens", "area", "doc", "texto2")


@pytest.fixture(scope="module")
def limits(spark):
    return spark.createDataFrame([("txt", 100, 10), ("csv", 80, 0), (None, 5, 1), ("html", None, 3)], "formato string, max_chars int, solape_chars int")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def docs(awkward):
    return awkward.select(F.xxhash64("doc_id").alias("doc_id"), F.col("texto").alias("text"), F.col("idioma").alias("lang"), F.col("fuente").alias("source"))


@pytest.fixture(scope="module")
def small(spark):
    classes = spark.createDataFrame([("chico", 64), ("grande", 512), (None, 3)], "clase string, capacidad int")
    area = spark.createDataFrame([("agua",), ("fuego",), (None,)], "area string")
    examples = spark.createDataFrame([(1, "agua", "es", "El río y el lago llevan agua."), (2, "fuego", "es", "El incendio y la llama queman."), (3, None, None, None)], "ejemplo_id int, area string, idioma string, texto string")
    return classes, area, examples


OPERATORS = {
    "p1": lambda x, _: scans.noisy_lines(x),
    "p1_joined": lambda x, _: scans.noisy_lines(x, lexicon_bytes=0, block_bytes=1000),
    "p1_repaired": lambda x, _: scans.repaired(x),
    "p1_measured": lambda x, _: scans.measured(x),
    "p2": lambda x, _: shape.not_prose(x),
    "p2_shapes": lambda x, _: shape.shapes(x, shape.learn_profiles(x)),
    "p2_stats": lambda x, _: shape.statistics(x),
    "p2_common": lambda x, _: shape.common_shares(x, shape.common_words(x)).distinct(),
    "p3": lambda x, _: sentences.sentences(x, sentences.learn(x)),
    "p4": lambda x, _: language.mislabelled(x),
    "p4_all": lambda x, _: language.identify(x, language.learn(x)),
    "p5": pieces.oversized,
    "p5_pieces": pieces.split_documents,
    "p6": lambda x, _: repeated.repeated_lines(x),
    "p6_clean": lambda x, _: repeated.without_repeated(x),
    "p7": lambda x, _: body.boilerplate_lines(x, body.learn(x)),
    "p7_body": lambda x, _: body.main_bodies(x, body.learn(x)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward(awkward, limits, name):
    run = OPERATORS[name]
    plain = run(awkward, limits)
    rows = sorted(map(str, plain.collect()))
    wide = awkward
    for n in NAMES:
        wide = wide.withColumn(n, F.lit("otro"))
    assert sorted(map(str, run(wide, limits).collect())) == rows
    assert run(awkward.limit(0), limits).collect() == []
    once = run(awkward.dropDuplicates(["doc_id", "texto"]), limits).collect()
    if name not in ("p2_stats", "p2_shapes", "p5_pieces", "p6_clean", "p4_all"):  # these give a row for each row, or learn from repeated ones
        assert sorted(map(str, once)) == rows


def test_awkward_documents(docs, small, spark):
    classes, area, examples = small
    wide = docs
    for n in NAMES:
        wide = wide.withColumn(n, F.lit("otro"))
    enc = encode.encoder(f"{encode.tokenizer_dir()}/byte_bpe_50k.tiktoken")
    want = {(r.doc_id, tuple(enc.encode_ordinary(r.text or ""))) for r in docs.collect()}
    for x in (docs, wide):
        got = encode.encode_corpus(x).collect()
        assert {(r.doc_id, tuple(r.ids)) for r in got} == want and len(got) == len(want)
        packed = packing.pack(x, classes).collect()
        assert {r.clase for r in packed} == {"chico", "grande"}
        model = areas.learn(x, examples, area)
        areas.document_areas(x, model).collect()
    assert encode.encode_corpus(docs.limit(0)).collect() == [] and packing.pack(docs.limit(0), classes).collect() == []
    assert areas.document_areas(docs.limit(0), areas.learn(docs.limit(0), examples, area)).collect() == []
