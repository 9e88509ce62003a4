import glob
import json

from pyspark.sql import functions as F

from textloom.__main__ import main
from textloom.operators import reports


def test_commands(spark, tmp_path, capsys):
    corpus = tmp_path / "corpus"
    for name, text in {"F1_a/x.txt": "Una frase del texto que sigue. Otra frase del mismo texto.", "F2_b/y.html": "<p>El párrafo de la página que termina aquí.</p>"}.items():
        p = corpus / name
        p.parent.mkdir(parents=True)
        p.write_text(text)
    at = lambda n: str(tmp_path / n)
    assert main(["documents", "--corpus", str(corpus), "--out", at("docs"), "--rejected", at("bad")]) == 0
    assert main(["chunk", "--documents", at("docs"), "--out", at("chunks"), "--max-words", "8", "--max-tokens", "8", "--overlap-sentences", "0", "--warnings", at("w")]) == 0
    assert main(["index", "--chunks", at("chunks"), "--out", at("base")]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["num_vectores"] == 3
    assert main(["verify", "--base", at("base")]) == 0
    assert main(["search", "--base", at("base"), "--query", "frase", "-k", "2"]) == 0
    assert [json.loads(x)["rank"] for x in capsys.readouterr().out.strip().splitlines()[-2:]] == [1, 2]
    assert main(["reencode", "--base", at("base"), "--chunks", at("chunks"), "--out", at("again")]) == 0 and spark.read.parquet(at("again")).count() == 3
    (tmp_path / "q.jsonl").write_text('{"query_id": "q1", "pregunta": "frase"}\n')
    assert main(["answer", "--base", at("base"), "--queries", at("q.jsonl"), "--out", at("res")]) == 0
    res = json.loads(open(glob.glob(at("res") + "/*.json")[0]).readline())
    assert res["query_id"] == "q1" and len(res["documents"]) == 2 and len(res["fragments"]) == 3
    assert main(["ingest", "--corpus", str(corpus), "--log", at("log"), "--checkpoint", at("ck")]) == 0
    assert main(["summary", "--log", at("log")]) == 0
    # failures: code 1, nothing left behind
    assert main(["chunk", "--documents", at("docs"), "--out", at("none"), "--max-words", "2", "--max-tokens", "2"]) == 1 and not glob.glob(at("none"))
    assert main(["chunk", "--documents", at("docs"), "--out", at("none"), "--max-words", "0"]) == 1
    assert main(["extend", "--base", at("base"), "--chunks", at("chunks"), "--out", at("more")]) == 1
    assert "ERROR: " in capsys.readouterr().out


def test_reports(spark, sf, tmp_path):
    r = spark.read.parquet(f"{sf}/corpus_report.parquet")
    for kind in ("json", "csv", "md", "html", "markdown"):
        reports.write_report(r, str(tmp_path / kind), kind)
    assert spark.read.json(str(tmp_path / "json")).count() == r.count()
    page = spark.read.text(str(tmp_path / "md"), wholetext=True).first()[0]
    assert page.startswith("# Corpus") and page.count("\n| ") == r.count() + 1
    try:
        reports.write_report(r, str(tmp_path / "x"), "pdf")
        raise AssertionError
    except ValueError:
        pass
    docs = spark.createDataFrame([("a", "pdf", ""), ("b", "json", "x" * 300), ("c", "raro", None)], "doc_id string, formato string, texto string")
    s = reports.diagnosis_statistics(reports.diagnose_documents(docs)).first()
    assert (s.total, s.validos, s.pdf, s.pdf_vacios, s.desconocido) == (3, 1, 1, 1, 1)
    img = spark.createDataFrame([(100, 100, 128.0, 50.0, 20.0, 99), (900, 900, 250.0, 1.0, 20.0, 0), (900, 900, 128.0, 50.0, 1.0, 0), (900, 900, 128.0, 50.0, 20.0, 5), (900, 900, 128.0, 50.0, 20.0, 500)], "w int, h int, b double, s double, e double, c int")
    assert [x[0] for x in img.select(reports.image_status(*(F.col(c) for c in "whbsec"))).collect()] == ["IMAGEN_PEQUENA", "IMAGEN_BLANCA", "IMAGEN_BORROSA", "OCR_POBRE", "OCR_CORRECTO"]
