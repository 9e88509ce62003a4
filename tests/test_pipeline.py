import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from textloom.operators import checks, chunker, corpus, vectorbase
from textloom.plans import pipeline
from textloom.sources import extract, lines, listing
from textloom.streaming import ingest


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, payload):
    return varint(number << 3 | 2) + varint(len(payload)) + payload


def tile():
    value = field(1, "río".encode())
    number = varint(3 << 3 | 1) + struct.pack("<d", 2.5)
    feature = field(2, varint(0) + varint(0) + varint(1) + varint(1))
    layer = field(1, b"agua") + field(2, feature) + field(2, b"") + field(3, b"nombre") + field(3, b"ancho") + field(4, value) + field(4, number)
    return field(3, layer)


def workbook():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>km</t></is></c></row><row r="2"><c r="B2"><v>3</v></c></row></sheetData></worksheet>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>ciudad</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return out.getvalue()


def test_extractors():
    assert extract.html_pages(b"<p>Hola <b>mundo</b></p><script>x()</script><p>fin</p>") == ["Hola\nmundo\nfin"]
    assert extract.csv_pages("a,b\n1,\n2,3\n4,5,6\n".encode()) == ["a: 1\na: 2 | b: 3"]
    assert extract.xlsx_pages(workbook()) == ["km: 3"]
    assert extract.tile_pages(tile()) == ["[agua] nombre: río; ancho: 2.5"]
    assert extract.json_pages(json.dumps({"title": "T", "text": "x"}).encode()) == ["T\n\nx"]
    assert extract.text_pages(b"a\xffb") == ["ab"]
    assert extract.drop_repeated(["T\nuno", "T \ndos", "tres"]) == ["uno", "dos", "tres"] and extract.drop_repeated(["a", "a"]) == ["a", "a"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    long = "Una frase del documento con varias palabras. " * 12
    for name, data in {
        "F1_IA/a.txt": long.encode(), "F2_LEO/b.html": f"<h1>Título</h1><p>{long}</p>".encode(), "F3_T/tiles/1/0/x.pbf": tile(), "F3_T/tiles/2/0/x.pbf": tile(),
        "F1_IA/catalog.json": b"{}", "F1_IA/c.json": b"{mal", "F1_IA/d.pdf": b"%PDF", "otro/e.txt": long.encode(), "F2_LEO/f.md": b"x", "F2_LEO/g.xlsx": workbook(), "F2_LEO/h.txt": b"  ",
    }.items():
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    return str(root)


def test_files_to_answers(spark, folder):
    docs, bad = pipeline.documents_from_files(spark, folder)
    got = {r.fuente: r for r in docs.collect()}
    assert set(got) == {"F1_IA/a.txt", "F2_LEO/b.html", "F3_T/tiles/2/0/x.pbf", "F2_LEO/g.xlsx"}
    assert got["F1_IA/a.txt"].idioma == "es" and got["F2_LEO/b.html"].fenomeno == 2
    why = {r.fuente: r.motivo for r in bad.collect()}
    assert set(why) == {"F1_IA/c.json", "F1_IA/d.pdf", "otro/e.txt", "F2_LEO/h.txt"} and why["otro/e.txt"] == "sin fenomeno"
    base = pipeline.chunk_and_build(docs, chunker.ChunkConfig(30, 30, 1), vectorbase.HashEncoder(8)).cache()
    queries = spark.createDataFrame([("q1", "Una frase del documento?"), ("q2", "Título")], "query_id string, pregunta string")
    res = pipeline.answer(base, queries, vectorbase.HashEncoder(8))
    rows = {r.query_id: r for r in res.collect()}
    assert set(rows) == {"q1", "q2"} and [x["rank"] for x in rows["q1"].fragments] == list(range(1, len(rows["q1"].fragments) + 1))
    assert checks.result_violations(res.withColumn("documents", F.slice("documents", 1, 1))).filter("motivo = 'documentos'").count() == 2
    frags = res.select(F.inline("fragments")).drop("rank")
    assert checks.untraceable(frags, base).count() == 0
    assert checks.untraceable(frags.withColumn("text", F.lit("otra cosa")), base).count() == frags.count()


def test_listing(spark, folder):
    assert listing.list_files(spark, folder).count() == 11
    assert listing.list_files(spark, folder, "*.txt").count() == 3


def test_stream_resumes(spark, folder, tmp_path):
    seen = lambda files: files.select("path", "sha256", F.when(F.col("path").endswith(".md"), "BATCH_RUNNER_ERROR").otherwise("OK").alias("status"))
    import os
    import shutil

    inbox = str(tmp_path / "in")
    os.makedirs(inbox)
    shutil.copy(f"{folder}/F1_IA/a.txt", f"{inbox}/a.txt")
    shutil.copy(f"{folder}/otro/e.txt", f"{inbox}/same.txt")
    args = (spark, inbox, str(tmp_path / "log"), str(tmp_path / "ck"), seen)
    assert ingest.run_available(*args) == 1  # both files have the same content
    assert ingest.run_available(*args) == 0
    shutil.copy(f"{folder}/F2_LEO/b.html", f"{inbox}/b.html")
    assert ingest.run_available(*args) == 1
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_lines(spark, tmp_path):
    p = tmp_path / "q.jsonl"
    p.write_text('{"query_id": "q1", "pregunta": "a"}\n\n{"query_id": "q2"}\n')
    assert {r.query_id for r in lines.read_queries(spark, str(p)).collect()} == {"q1", "q2"}
    p.write_text('{"query_id": "q1"}\n{mal\n')
    with pytest.raises(checks.ConstraintError):
        lines.read_queries(spark, str(p)).count()
    assert lines.read_log(spark, str(p), lines.QUERY).count() == 1


def test_corpus(spark):
    pages = spark.createDataFrame([(["Título\nuno", "Título\ndos", "tres\n\nTítulo "],), (["a", "a"],)], "p array<string>")
    assert [r.q for r in pages.select(corpus.without_repeated_lines(F.col("p")).alias("q")).collect()] == [["uno", "dos", "tres\n"], ["a", "a"]]
    tiles = spark.createDataFrame([("a/tiles/1/x",), ("a/tiles/2/x",), ("a/tiles/2/y",), ("b/tiles/0/x",), ("c/x",), ("a/tiles/z/x",)], "path string")
    assert {r.path for r in corpus.deepest_tiles(tiles).collect()} == {"a/tiles/2/x", "a/tiles/2/y", "b/tiles/0/x", "c/x", "a/tiles/z/x"}
    bad = spark.createDataFrame([("D", "f", "txt", 4, "es", " "), ("E", "f", "txt", 1, "es", "x")], "doc_id string, fuente string, formato string, fenomeno int, idioma string, texto string")
    assert {(r.doc_id, r.motivo) for r in checks.document_violations(bad).collect()} == {("D", "vacio:texto"), ("D", "fenomeno")}
    assert checks.ordinal_gaps(spark.range(3).toDF("ordinal")).count() == 0 and checks.ordinal_gaps(spark.range(1, 3).toDF("ordinal")).count() == 1
    sizes = spark.createDataFrame([("a", 0, 5), ("b", 3, 0)], "format string, characters long, size_bytes long")
    r = corpus.report_totals(sizes).first()
    assert (r.min_caracteres, r.max_caracteres, r.min_bytes) == (3, 3, 5)


def test_failures_are_rows_and_come_again(spark, folder, tmp_path):
    import shutil

    inbox, log = tmp_path / "in", str(tmp_path / "log")
    inbox.mkdir()
    shutil.copy(f"{folder}/F1_IA/a.txt", inbox / "a.txt")
    shutil.copy(f"{folder}/F2_LEO/f.md", inbox / "f.md")
    flag = str(tmp_path / "repaired")

    def state(path, content):
        import os

        if path.endswith(".md") and not os.path.exists(flag):
            raise ValueError("no reader")
        return "OK"

    assert ingest.run_available(spark, str(inbox), log, str(tmp_path / "ck"), ingest.per_file(state)) == 2
    rows = {r.path.rpartition("/")[2]: r for r in spark.read.parquet(log).collect()}
    assert rows["a.txt"].status == "OK" and rows["f.md"].status == ingest.FAILED and rows["f.md"].error == "ValueError: no reader"
    assert ingest.retry(spark, log, ingest.per_file(state)) == 1  # fails again
    open(flag, "w").close()
    assert ingest.retry(spark, log, ingest.per_file(state)) == 1 and ingest.retry(spark, log, ingest.per_file(state)) == 0
    assert spark.read.parquet(log).filter("status = 'OK'").count() == 2
    assert ingest.retry(spark, str(tmp_path / "none"), ingest.per_file(state)) == 0


def test_contents_of_selected_files(spark, folder):
    got = {r.path.partition("/corpus0/")[2]: r.length for r in listing.read_content(spark, folder).select("path", "length").collect()}
    assert any(p.endswith("tiles/2/0/x.pbf") for p in got) and not any(p.endswith(("tiles/1/0/x.pbf", "catalog.json", "f.md")) for p in got)
    assert set(got) == {r.path.partition("/corpus0/")[2] for r in listing.select_files(listing.list_files(spark, folder)).collect()}


def test_line_number_of_a_broken_line(spark, tmp_path):
    p = tmp_path / "q.jsonl"
    p.write_text('{"query_id": "q1"}\n\n{broken\n')
    with pytest.raises(checks.ConstraintError, match="line 3"):
        lines.read_queries(spark, str(p))


def test_delivery(spark):
    def row(k, **change):
        docs = [{"rank": i, "doc_id": f"d{i}"} for i in (1, 2, 3)]
        frags = [{"rank": i, "chunk_id": f"c{i}", "doc_id": "d1", "text": "Una frase."} for i in range(1, 11)]
        return (k, json.dumps({"query_id": f"q{k:03d}", "documents": docs, "fragments": frags} | change))

    bad = [row(1), row(2, query_id="q009"), row(3, extra=1), row(4, documents=[{"rank": 1, "doc_id": "d", "x": 1}]), row(5, fragments=[{"rank": 2, "chunk_id": "", "doc_id": "d", "text": "x"}])]
    got = {(r.linea, r.motivo) for r in checks.delivery_violations(spark.createDataFrame(bad, "linea int, value string"), 5).collect()}
    assert got == {(2, "orden"), (3, "claves"), (4, "claves de elementos"), (5, "vacio"), (5, "rank")}
    assert {r.linea for r in checks.delivery_violations(spark.createDataFrame(bad[:1], "linea int, value string"), 5).collect()} == {0}


def test_base_and_manifest(spark, tmp_path):
    chunk = spark.createDataFrame([("A", f"A-{k}", "f", "txt", 1, k, 2, "Dos palabras.") for k in range(3)], "doc_id string, chunk_id string, fuente string, formato string, fenomeno int, posicion int, num_tokens int, texto string")
    base = vectorbase.build(chunk, vectorbase.HashEncoder(4))
    told = vectorbase.manifest(base, "fake", 4)
    assert told["versiones"]["pyspark"] and checks.base_violations(base, told).count() == 0
    got = {(r.motivo, r.n) for r in checks.base_violations(base, told | {"dimension": 8, "num_vectores": 5, "parcial": True}).collect()}
    assert got == {("dimension", 3), ("num_vectores", -2), ("parcial", 1)}


def test_json_report(spark):
    docs = spark.createDataFrame([("a", '{"t": "x", "l": [1, 2]}'), ("b", '{"t": "y", "l": [1, 3]}'), ("c", "[1]"), ("d", "{x"), ("e", None), ("f", '{"t": 1}')], "doc string, j string")
    assert {(r.raiz, r.documentos) for r in corpus.root_kinds(docs, "j").collect()} == {("dict", 3), ("list", 1), ("error", 2)}
    assert [r.doc for r in corpus.parse_errors(docs, "j", "doc").collect()] == ["d"]
    assert {(r.raiz, r.documentos, tuple(r.rutas)) for r in corpus.schema_report(docs, "j", "doc").collect()} == {("dict", 2, ("a", "b")), ("list", 1, ("c",)), ("dict", 1, ("f",))}
    assert sorted((r.clave, r.n) for r in corpus.schema_keys(docs, "j").collect()) == [("l", 2), ("t", 1), ("t", 2)]
    profile = {r.path: r for r in corpus.field_profile(docs, "j", "doc").collect()}
    assert profile["t"].documentos == 3 and set(profile["t"].muestras) == {"x", "y"}
    assert [r.path for r in corpus.ranked_fields(corpus.field_profile(docs, "j", "doc"), corpus.field_kinds(docs, "j"), "mixto").collect()] == ["t"]


def test_tables_written_together(spark, tmp_path):
    from textloom.session import write_together

    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    write_together(spark, {a: spark.range(3), b: spark.range(4)})
    with pytest.raises(Exception):
        write_together(spark, {a: spark.range(9), b: spark.range(2).select(F.raise_error(F.lit("no")).alias("x"))})
    assert spark.read.parquet(a).count() == 3 and spark.read.parquet(b).count() == 4 and sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]


def test_tokens_of_a_vocabulary():
    import os

    count = chunker.bpe_counter(f"{os.environ.get('TEXTLOOM_TOKENIZERS', '/opt/tokenizers')}/byte_bpe_50k.tiktoken")
    assert count("") == 0 and count("a") == 1 and count("<|endoftext|>") > 1
    done = chunker.chunk_text("Una frase corta. Otra frase algo más larga que aquella. Fin.", "txt", chunker.ChunkConfig(18, 100, 0), count)
    assert len(done.chunks) > 1 and all(c["num_tokens"] <= 18 for c in done.chunks)
