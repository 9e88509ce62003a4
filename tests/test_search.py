import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import checks, search, vectorbase


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    m = vectorbase.normalize(rng.standard_normal((120, 8)))
    m[7] = m[3]  # a tie
    rows = [(k, [float(x) for x in v], k % 7) for k, v in enumerate(m)]
    return m, spark.createDataFrame(rows, "vec_id long, embedding array<float>, doc_id long")


def brute(m, queries, k):
    out = {}
    for q in queries:
        s = np.round(m[q].astype(float) @ m.T.astype(float), 6)
        out[q] = sorted(range(len(m)), key=lambda i: (-s[i], i))[:k]
    return out


@pytest.mark.parametrize("size", [search.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("k", [1, 9, 500])
def test_knn_is_exact(data, size, k):
    m, df = data
    q = df.filter("vec_id % 10 = 3").select(F.col("vec_id").alias("query_id"), "embedding")
    got = {}
    for r in search.knn(q, df, k, size).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute(m, range(3, 120, 10), k)


def test_knn_limits(data, spark):
    _, df = data
    q = df.select(F.col("vec_id").alias("query_id"), "embedding")
    with pytest.raises(ValueError):
        search.knn(q, df, 0)
    assert search.knn(q.limit(0), df, 3).count() == 0 and search.knn(q.limit(2), df.limit(0), 3).count() == 0
    assert search.knn(q.limit(2).unionByName(q.limit(1).withColumn("embedding", F.lit(None).cast("array<float>"))), df, 3).count() == 6


def test_documents_and_tiers(data):
    m, df = data
    q = df.filter("vec_id in (0, 3)").select(F.col("vec_id").alias("query_id"), "embedding")
    hits = search.knn(q, df, 120).join(df.select("vec_id", "doc_id"), "vec_id")
    top = {(r.query_id, r["rank"]): (r.doc_id, r.score) for r in search.rank_documents(hits.filter("rank <= 20"), 3).collect()}
    for query in (0, 3):
        s = np.round(m[query].astype(float) @ m.T.astype(float), 6)
        best = brute(m, [query], 20)[query]
        sums = {d: round(sum(s[i] for i in best if i % 7 == d), 4) for d in {i % 7 for i in best}}
        want = sorted(sums, key=lambda d: (-sums[d], d))[:3]
        assert [top[query, r][0] for r in (1, 2, 3)] == want
    assert search.tiers(1000) == [60, 240, 960, 1000] and search.tiers(10) == [10]
    meta = df.select("vec_id", "doc_id")
    deep = search.adaptive_hits(q, df, meta, 120, F.col("vec_id") % 40 == 0, fragments=3, first=30)
    assert {r[0]: r[1] for r in deep.groupBy("query_id").agg(F.max("rank")).collect()} == {0: 120, 3: 120}
    assert search.adaptive_hits(q, df, meta, 120, F.lit(True), first=30).count() == 60


def chunks_of(spark, n=30):
    rows = [(f"D{k % 5}", f"D{k % 5}-chunk-{k:04d}", f"f{k % 2}", "txt", 1, k, 3, f"Texto número {k}." if k != 4 else "  ") for k in range(n)]
    return spark.createDataFrame(rows, "doc_id string, chunk_id string, fuente string, formato string, fenomeno int, posicion int, num_tokens int, texto string")


def test_base(spark, tmp_path):
    c = chunks_of(spark)
    base = vectorbase.build(c, vectorbase.HashEncoder(8)).cache()
    assert base.count() == 29 and checks.ordinal_gaps(base).count() == 0
    vectorbase.check(base)
    assert vectorbase.verify(base).first()["repetidos"] == 0
    assert [r.motivo for r in vectorbase.split_fragments(c)[1].collect()] == ["texto_vacio"]
    new = c.limit(3).withColumn("doc_id", F.lit("Z")).withColumn("chunk_id", F.concat(F.lit("Z"), "chunk_id")).withColumn("texto", F.lit("Nuevo."))
    more = vectorbase.extend(base, new, vectorbase.HashEncoder(8))
    assert more.count() == 32 and checks.ordinal_gaps(more).count() == 0
    with pytest.raises(checks.ConstraintError):
        vectorbase.extend(base, c.limit(1), vectorbase.HashEncoder(8))
    one = base.filter("ordinal = 2").select("chunk_id", F.transform("embedding", lambda x: -x).alias("embedding"))
    swapped = vectorbase.replace_vectors(base, one)
    assert swapped.join(base.select("chunk_id", F.col("embedding").alias("e")), "chunk_id").filter("embedding <> e").count() == 1
    with pytest.raises(checks.ConstraintError):
        vectorbase.replace_vectors(base, one.withColumn("chunk_id", F.lit("no")))
    with pytest.raises(checks.ConstraintError):
        vectorbase.build(c.drop("posicion"), vectorbase.HashEncoder(8))
    direct = {r.ordinal: r.embedding for r in base.select("ordinal", "embedding").collect()}
    stored = vectorbase.encode_blocks(base.drop("embedding"), str(tmp_path / "b"), vectorbase.HashEncoder(8), {"n": 29})
    assert {r.ordinal: r.embedding for r in stored.collect()} == direct
    again = vectorbase.encode_blocks(base.drop("embedding"), str(tmp_path / "b"), vectorbase.HashEncoder(8), {"n": 29})
    assert again.count() == 29
    with pytest.raises(checks.ConstraintError):
        vectorbase.encode_blocks(base.drop("embedding"), str(tmp_path / "b"), vectorbase.HashEncoder(8), {"n": 30})


def test_hash_encoder():
    a = vectorbase.HashEncoder(8)
    assert np.allclose(a(["x", "y"])[0], a(["x"])[0]) and np.allclose(np.linalg.norm(a(["x", "y"]), axis=1), 1)
    assert a([]).shape == (0, 8) and isinstance(vectorbase.make_encoder("fake/x", 4), vectorbase.HashEncoder)
    assert (vectorbase.normalize(np.zeros((1, 3))) == 0).all()


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ordinals_of_many_rows(spark, adaptive):
    """0..n-1, each once and in order, also with other columns, whatever is selected afterwards."""
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        n = 1_000_000
        rows = spark.range(n, numPartitions=16).select(F.xxhash64("id").alias("k"), F.concat(F.lit("texto "), F.col("id")).alias("carga"), (F.col("id") % 3).alias("otra"))
        out = vectorbase.with_ordinals(rows, ["k"]).cache()
        assert out.agg(F.count_distinct("ordinal"), F.min("ordinal"), F.max("ordinal"), F.count("carga")).first()[:] == (n, 0, n - 1, n)
        edge = out.groupBy(F.floor(F.col("ordinal") / 50_000).alias("b")).agg(F.min("k").alias("a"), F.max("k").alias("z")).orderBy("b").collect()
        assert all(x.z < y.a for x, y in zip(edge, edge[1:]))
        out.unpersist()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_extension_of_a_base_of_one_row(spark):
    chunk = lambda d, c: (d, c, "f", "txt", 1, 0, 2, "Dos palabras.")
    make = lambda *r: spark.createDataFrame(list(r), "doc_id string, chunk_id string, fuente string, formato string, fenomeno int, posicion int, num_tokens int, texto string")
    enc = vectorbase.HashEncoder(4)
    base = vectorbase.build(make(chunk("A", "A-0")), enc)
    more = vectorbase.extend(base, make(chunk("C", "C-0"), chunk("B", "B-0")), enc)
    assert {(r.chunk_id, r.ordinal) for r in more.collect()} == {("A-0", 0), ("B-0", 1), ("C-0", 2)}
    for bad in (make(chunk("A", "A-9")), make(chunk("B", "A-0")), make(chunk("B", "B-0"), chunk("B", "B-0"))):
        with pytest.raises(checks.ConstraintError):
            vectorbase.extend(base, bad, enc)
    assert {r.ordinal for r in vectorbase.extend(base.limit(0), make(chunk("B", "B-0")), enc).collect()} == {0}
