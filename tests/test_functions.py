import json

import pytest
from pyspark.sql import functions as F

from textloom.functions import jsonx, names, text, vectors


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "value, want",
    [("  a\t\tb \x07\n\n\n\nc ", "a b \n\nc"), ("é", "é"), ("", ""), (None, None), ("\r\n x", "x")],
)
def test_clean_text(spark, value, want):
    assert one(spark, text.clean_text, value) == want


def test_unwrap(spark):
    assert one(spark, text.unwrap_lines, "innovó-\nética uno\ndos\n\ntres ..... 4") == "innovóética uno dos\n\ntres  4"


def test_measures(spark):
    assert one(spark, text.word_count, " a  b c\n") == 3
    assert one(spark, text.letter_ratio, "") == 0.0
    assert one(spark, text.is_heading_line, "Un título") and not one(spark, text.is_heading_line, "- punto") and not one(spark, text.is_heading_line, "Fin.")
    q = one(spark, text.text_quality, "Una línea bastante larga de texto.\nUna línea bastante larga de texto.\nx")
    assert q["lines"] == 3 and q["useful_lines"] == 2 and q["repetition_ratio"] == round(1 - 2 / 3, 6)
    assert one(spark, text.text_quality, None) is None and one(spark, text.text_quality, "")["quality_score"] == 0


def test_language(spark):
    assert one(spark, text.guess_language, "El río volvió a crecer en la primavera y los pueblos") == "es"
    assert one(spark, text.guess_language, "The river rose again in the spring and nobody") == "en"
    assert one(spark, text.guess_language, "corto") == "und" and one(spark, text.guess_language, None) == "und"


def test_sentence_cuts(spark):
    s = "Uno dos tres. Cuatro cinco. Seis siete ocho nueve."
    assert one(spark, lambda c: text.truncate_to_sentences(c, 5), s) == "Uno dos tres. Cuatro cinco."
    assert one(spark, lambda c: text.truncate_to_sentences(c, 2), s) == "Uno dos"
    assert one(spark, text.truncate_to_sentences, s) == s
    assert text.whole_sentences("resto de frase. Frase entera. Otra sin fin", 10) == "Frase entera."
    assert text.whole_sentences("sin fin") is None and text.whole_sentences(None) is None


def test_names(spark):
    assert one(spark, names.doc_id, "a/b.txt") == "DOC-5f41b4e8c2" or len(one(spark, names.doc_id, "a/b.txt")) == 14
    assert one(spark, names.phenomenon, "x/F2_LEO/a.txt") == 2 and one(spark, names.phenomenon, "x/a.txt") is None
    assert one(spark, names.format_of, "a/B.HTM") == "html" and one(spark, names.format_of, "a.md") is None
    assert one(spark, names.is_manifest, "a/Mi-Catalog-2.json") and not one(spark, names.is_manifest, "catalog/a.json")
    assert one(spark, names.slug, "org/Modelo X!y") == "Modelo-X-y"
    assert one(spark, names.tile_root, "m/tiles/3/1/a.pbf") == "m/tiles" and one(spark, names.tile_zoom, "m/tiles/3/1/a.pbf") == 3
    assert one(spark, names.tile_zoom, "m/tiles/x/a.pbf") is None
    assert names.prefixes_for("multilingual-e5-base") == ("query: ", "passage: ") and names.prefixes_for("x") == ("", "")
    for v, k in {"": "empty_string", "http://x/a": "url", "a.pdf?b": "pdf_url", "x" * 160: "long_text", "x" * 40: "text", "x": "short_text"}.items():
        assert one(spark, names.string_kind, v) == k


def test_vectors(spark):
    assert one(spark, vectors.normalize, [3.0, 4.0], "array<float>") == pytest.approx([0.6, 0.8])
    assert one(spark, vectors.normalize, [0.0, 0.0], "array<float>") == [0.0, 0.0]
    assert one(spark, vectors.is_unit, [0.6, 0.8], "array<float>") and not one(spark, vectors.is_unit, [1.0, 1.0], "array<float>")


def test_json(spark):
    v = {"a": [{"b": "x" * 50}, {"b": None}], "url": "https://x.org/y.pdf", "n": 1, "f": 1.5, "t": True}
    flat = [(r["path"], r["kind"]) for r in one(spark, jsonx.flatten, json.dumps(v))]
    assert ("a", "list") in flat and ("a[].b", "text") in flat and ("a[].b", "null") in flat and ("url", "url") in flat and ("t", "bool") in flat
    assert jsonx.paths_of("s") == [("$", "s")] and jsonx.paths_of([]) == []
    assert one(spark, jsonx.flatten, "{mal") is None and one(spark, jsonx.flatten, None) is None
    assert jsonx.signature([1, 2]) != jsonx.signature([1]) and jsonx.signature([1, 1], with_length=False) != jsonx.signature([1], with_length=False)
    assert jsonx.signature({"a": 1, "b": 2}) == jsonx.signature({"b": 3, "a": 4})
    r = jsonx.resolve
    assert r({"body_text": "x", "url": "http://a/b"})[:3] == ("local", "body_text", "http://a/b")
    assert [r(x)[0] for x in ({"pdf": "http://a/b.pdf"}, {"web_url": "http://a/b"}, {"excerpt": "x"}, {"hashes": []}, {}, [{"text": " "}], "x")] == ["pdf", "html", "abstract", "manifiesto", "desconocida", "desconocida", "desconocida"]
    assert jsonx.document_text({"title": "T", "body_paragraphs": ["a", "b"], "body_text": " "}) == "T\n\na\n\nb"
    assert jsonx.document_text({"x": {"y": "z" * 40}}) == "z" * 40
    u = one(spark, jsonx.unknown, json.dumps({"a": {"u": "http://x/y"}, "b": [1], "c": "z" * 301}))
    assert (u["keys"], u["objects"], u["lists"], u["long_fields"], u["urls"]) == (["a", "b", "c"], ["a"], ["b"], ["c"], ["http://x/y"])
