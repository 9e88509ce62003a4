import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from textloom.llm import encode, packing
from textloom.llm.packing import fill

ENC = encode.encoder(f"{encode.tokenizer_dir()}/byte_bpe_50k.tiktoken")


def whole(text):
    return encode.join_pieces(ENC, [encode.encode_piece(ENC, p) for p in encode.pieces(text)])


def test_pieces_join_to_the_same_ids(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(encode, "LEAST", 3)
    monkeypatch.setattr(encode, "MOST", 9)
    monkeypatch.setattr(encode, "BITS", 2)
    alphabet = ["a", "b", "é", " ", "  ", "\n", "'", "'ll", "'s", "1", "23", ".", "...", "中", "文", "ก", "😀", "́", "​", "<|endoftext|>", "-", "\t", "Ñ", " "]
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
        assert whole(text) == ENC.encode_ordinary(text), repr(text)
    for text in ("a" * 500, " " * 500, "中" * 400, "a b" * 300, "'" * 99):
        assert whole(text) == ENC.encode_ordinary(text)


def test_pieces_are_content_defined():
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdefghij ") for _ in range(30_000))
    a, b = encode.pieces("uno " + shared), encode.pieces("otro comienzo " + shared)
    assert "".join(a) == "uno " + shared and len(set(a) & set(b)) > 0.7 * len(a)
    assert all(len(p) <= encode.MOST for p in encode.pieces("x" * 50_000))


def queues_of(rng, sizes, most):
    return {s: deque((rng.randint(1, most), k, 0, 0, s) for k in range(n)) for s, n in sizes.items()}


def test_windows_hold_the_mixture():
    rng = random.Random(4)
    queues = queues_of(rng, {"a": 6000, "b": 3000, "c": 1000, "d": 20}, 60)
    mark = sorted(x for q in queues.values() for x in q)
    total = {s: sum(x[0] for x in q) for s, q in queues.items()}
    shares = {s: n / sum(total.values()) for s, n in total.items()}
    windows = list(fill(queues, 200, 32))
    assert sorted(x for w in windows for c in w for x in c) == mark
    assert all(sum(x[0] for x in c) <= 200 for w in windows for c in w)
    full = [w for w in windows if len(w) == 32]
    assert len(full) >= len(windows) - 3
    for w in full:
        size = sum(x[0] for c in w for x in c)
        assert size >= 0.98 * 32 * 200
        for s in shares:
            assert abs(sum(x[0] for c in w for x in c if x[4] == s) / size - shares[s]) < 0.03
    assert sum(map(len, windows)) <= 1.02 * sum(total.values()) / 200 + 2


def test_windows_of_one_item_each():
    assert list(fill({"a": deque([(10, 0, 0, 0, "x")]), "b": deque([(10, 1, 0, 0, "y"), (7, 2, 0, 0, "z")])}, 10, 1)) != []
    assert sum(len(w) for w in fill({s: deque([(10, k, 0, 0, s)]) for k, s in enumerate("abc")}, 10, 1)) == 3
    assert list(fill({}, 10, 4)) == [] and list(fill({"a": deque()}, 10, 4)) == []


def test_targets(spark):
    """Half of each window from each of two sources though one has four times the tokens, as long as both have some; a source without a target comes last."""
    rows = [(k, " ".join(["puente"] * (3 + k % 9)), "ab"[k % 5 == 0]) for k in range(4000)] + [(k, "puente viejo", None) for k in range(4000, 4100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    classes = spark.createDataFrame([("chico", 64)], "clase string, capacidad int")
    goal = {"a": 1.0, "b": 1.0}
    packed = packing.pack(docs, classes, lot_items=1000, targets=goal).cache()
    assert packed.select("doc_id").distinct().count() == 4100
    far = packing.deviations(packed, docs, targets=goal).orderBy("ventana").collect()
    held = [r for r in far if r.desviacion < 0.03]
    # b has a fifth of the tokens: two fifths of all can be half and half
    assert sum(r.tokens for r in held) >= 0.36 * sum(r.tokens for r in far)
    last = packed.filter("doc_id >= 4000").select(F.split("contenedor", "-")[1].cast("long").alias("lote")).agg(F.min("lote")).first()[0]
    assert last >= 2**40
    for bad in ({}, {"a": -1.0}, {"a": 0.0}):
        with pytest.raises(ValueError):
            packing.pack(docs, classes, targets=bad)


@pytest.mark.parametrize("bucket", [50, 8000])
def test_packing(spark, sf, bucket):
    docs, classes = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/contenedores.parquet")
    sizes = {r.doc_id: len(ENC.encode_ordinary(r.text or "")) for r in docs.collect()}
    room = {r.clase: r.capacidad for r in classes.collect()}
    rows = packing.pack(docs, classes, lot_items=bucket).collect()
    per, boxes = defaultdict(list), defaultdict(int)
    for r in rows:
        per[r.clase, r.doc_id].append((r.parte, r.token_ini, r.tokens))
        if r.contenedor is None:
            assert r.tokens == 0
        boxes[r.clase, r.contenedor] += r.tokens
    assert set(per) == {(c, d) for c in room for d in sizes}
    for (c, d), parts in per.items():
        parts.sort()
        assert sum(p[2] for p in parts) == sizes[d] and (len(parts) == 1 or sizes[d] > room[c])
        assert [p[1] for p in parts] == [k * room[c] for k in range(len(parts))]
    assert all(n <= room[c] for (c, _), n in boxes.items())
    assert rows and sorted(map(str, rows)) == sorted(map(str, packing.pack(docs, classes, lot_items=bucket).collect()))
