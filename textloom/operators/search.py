"""Exact nearest vectors by inner product, documents from the scores of their chunks, and results with fragments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.vectors import dot
from ..session import cut_lineage

#: Bytes of query vectors up to which they go to every task; beyond, queries and vectors meet in blocks.
BROADCAST_BYTES = 32 << 20
QUERY_BLOCK, VECTOR_BLOCK = 2048, 65_536
_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.Array) -> np.ndarray:
    """Arrays of one length as the rows of a matrix, from their common buffer of values."""
    if not len(column):
        return np.zeros((0, 0))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _best(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best vectors of each query among v; by score rounded to 6 places, then by id."""
    scores = np.round(q @ v.T, 6) + 0.0
    out = []
    for row, s in zip(qids, scores):
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            pick = np.flatnonzero(s >= least)
        else:
            pick = np.arange(len(s))
        pick = pick[np.lexsort((ids[pick], -s[pick]))][:k]
        out.append((np.full(len(pick), row), ids[pick], s[pick]))
    cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, _HITS)], schema=_HITS)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn(queries: DataFrame, vectors: DataFrame, k: int = 10, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """query_id, vec_id, score, rank: for each query the k vectors of the largest inner product, rank from 1.

    queries: query_id, embedding; vectors: vec_id, embedding. Rows without a vector are left out; k is at most the
    number of vectors. Each task keeps k vectors a query, so the shuffle is k rows a query and task.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    q = queries.filter("query_id is not null and embedding is not null").select(F.col("query_id").cast("long").alias("query_id"), "embedding")
    v = vectors.filter("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    size = q.agg(F.sum(F.size("embedding") * 8 + 8)).first()[0] or 0
    if size <= broadcast_bytes:
        rows = q.orderBy("query_id").collect()
        qids, matrix = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(qids) and b.num_rows:
                    yield _best(qids, matrix, b["vec_id"].to_numpy(), _matrix(b["vector"]), k)

        return _ranked(v.mapInArrow(near, "query_id long, vec_id long, score double"), k)
    # more queries than go to every task: blocks of queries meet blocks of vectors, each pair in one task
    blocks_q = max(1, -(-q.count() // QUERY_BLOCK))
    blocks_v = max(1, -(-v.count() // VECTOR_BLOCK))
    left = q.withColumn("bq", F.pmod(F.xxhash64("query_id"), F.lit(blocks_q)).cast("int")).withColumn("bv", F.explode(F.sequence(F.lit(0), F.lit(blocks_v - 1))))
    right = v.withColumn("cv", F.pmod(F.xxhash64("vec_id"), F.lit(blocks_v)).cast("int")).withColumn("cq", F.explode(F.sequence(F.lit(0), F.lit(blocks_q - 1))))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.Table.from_batches([], schema=_HITS)
        return pa.Table.from_batches([_best(a["query_id"].to_numpy(), _matrix(a["embedding"]), b["vec_id"].to_numpy(), _matrix(b["vector"]), k)])

    hits = left.groupBy("bq", "bv").cogroup(right.groupBy("cq", "cv")).applyInArrow(meet, "query_id long, vec_id long, score double")
    return _ranked(hits, k)


def knn_one(vectors: DataFrame, query: list[float], k: int = 10) -> DataFrame:
    """vec_id, score: the k nearest vectors of one query, as built-in expressions."""
    if k <= 0:
        raise ValueError("k must be positive")
    q = F.array(*(F.lit(float(x)) for x in query))
    return vectors.select("vec_id", F.round(dot(F.col("embedding"), q), 6).alias("score")).orderBy(F.desc("score"), "vec_id").limit(k)


def rank_documents(hits: DataFrame, top: int = 3, doc: str = "doc_id") -> DataFrame:
    """query_id, doc, score, rank: documents by the sum of the scores of their hits (4 places), then by id."""
    scored = hits.groupBy("query_id", doc).agg(F.round(F.sum("score"), 4).alias("score"), F.count("*").alias("chunks"))
    w = W.partitionBy("query_id").orderBy(F.desc("score"), doc)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def documents_with_chunks(hits: DataFrame, top: int = 3, doc: str = "doc_id") -> DataFrame:
    """Like rank_documents, with the hits of each document, best first, as `trozos`, and the first rank it had."""
    own = F.array_sort(F.collect_list(F.struct(F.col("rank").alias("rank"), F.col("vec_id").alias("vec_id"), F.col("score").alias("score"))))
    scored = hits.groupBy("query_id", doc).agg(F.round(F.sum("score"), 4).alias("score"), F.min("rank").alias("primero"), own.alias("trozos"))
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "primero")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def tiers(n: int, first: int = 60, factor: int = 4) -> list[int]:
    """The depths tried one after the other: first, 4 x first, ... up to all n."""
    if first < 1:
        raise ValueError("the first depth must be at least 1")
    out = [min(first, n)]
    while out[-1] < n:
        out.append(min(out[-1] * factor, n))
    return out


def adaptive_hits(queries: DataFrame, vectors: DataFrame, meta: DataFrame, n: int, usable: Column, doc: str = "doc_id", documents: int = 3, fragments: int = 10, first: int = 60, within: bool = False) -> DataFrame:
    """The hits of each query at the first tier with enough documents and usable fragments: only queries that lack some are searched again, four times as deep.

    within: enough are so many hits of any kind within the best documents of the tier, whose sums of scores depend on
    its depth. meta has vec_id, doc and what `usable` names. One search per tier that any query needs; nearly always
    one. Hits are kept in the shared folder (spark.checkpoint.dir), so that no tier is searched twice.
    """
    levels, left, out = tiers(n, first), queries, None
    for t in levels:
        hits = cut_lineage(knn(left, vectors, t).join(meta, "vec_id"))
        if t != levels[-1]:
            if within:
                enough = rank_documents(hits, documents, doc).groupBy("query_id").agg(F.sum("chunks").alias("f")).filter(F.col("f") >= fragments).select("query_id")
            else:
                enough = hits.groupBy("query_id").agg(F.count_distinct(doc).alias("d"), F.count_if(usable).alias("f")).filter((F.col("d") >= documents) & (F.col("f") >= fragments)).select("query_id")
            lacking = left.join(enough, "query_id", "left_anti")
            more = not lacking.isEmpty()
            hits = hits.join(enough, "query_id", "left_semi") if more else hits
        else:
            more = False
        out = hits if out is None else out.unionByName(hits)
        if not more:
            break
        left = lacking
    return out


def fragments(hits: DataFrame, top: DataFrame | None = None, most: int = 10, doc: str = "doc_id", usable: Column | None = None) -> DataFrame:
    """The best hits of each query as fragments, rank from 1: of all documents, or within the documents of `top`."""
    x = hits.filter(usable) if usable is not None else hits
    if top is not None:
        x = x.join(top.select("query_id", doc), ["query_id", doc])
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return x.drop("rank").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def results(documents: DataFrame, frags: DataFrame, doc: str = "doc_id") -> DataFrame:
    """query_id, documents, fragments: nested, in order of rank."""
    d = documents.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", doc))).alias("documents"))
    f = frags.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", doc, "text"))).alias("fragments"))
    return d.join(f, "query_id", "left")
