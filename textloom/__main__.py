"""python -m textloom COMMAND: the stages on the command line. Errors are said on standard output, and the exit code is 1."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from .functions import names
from .operators import chunker, corpus, reports, search, vectorbase
from .plans import pipeline
from .session import build, ship, write_together
from .sources import lines
from .streaming import ingest


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="textloom")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple) -> None:
        c = sub.add_parser(name)
        for flag, kw in options:
            c.add_argument(flag, **kw)

    need = {"required": True}
    command("documents", ("--corpus", need), ("--out", need), ("--rejected", {}))
    command("chunk", ("--documents", need), ("--out", need), ("--errors", {}), ("--warnings", {}), ("--max-tokens", {"type": int, "default": 450}), ("--max-words", {"type": int, "default": 250}), ("--overlap-sentences", {"type": int, "default": 1}), ("--on-oversize", {"choices": ("fail", "skip-document"), "default": "fail"}))
    command("index", ("--chunks", need), ("--out", need), ("--model", {"default": "fake"}), ("--dim", {"type": int, "default": 8}))
    command("extend", ("--base", need), ("--chunks", need), ("--out", need), ("--model", {"default": "fake"}), ("--dim", {"type": int, "default": 8}))
    command("reencode", ("--base", need), ("--chunks", need), ("--out", need), ("--model", {"default": "fake"}), ("--dim", {"type": int, "default": 8}))
    command("search", ("--base", need), ("--query", need), ("-k", {"type": int, "default": 10}), ("--model", {"default": "fake"}), ("--dim", {"type": int, "default": 8}))
    command("verify", ("--base", need))
    command("answer", ("--base", need), ("--queries", need), ("--out", need), ("--model", {"default": "fake"}), ("--dim", {"type": int, "default": 8}), ("--first-k", {"type": int, "default": 60}), ("--within-documents", {"action": "store_true"}))
    command("ingest", ("--corpus", need), ("--log", need), ("--checkpoint", need), ("--retry", {"action": "store_true"}))
    command("report", ("--records", need), ("--out", need), ("--format", {"default": "json"}))
    command("summary", ("--log", need))
    return p


def run(a: argparse.Namespace) -> None:
    spark = ship(build("textloom", a.master))
    read = spark.read.parquet
    if a.command == "documents":
        docs, bad = pipeline.documents_from_files(spark, a.corpus)
        docs.write.mode("overwrite").parquet(a.out)
        if a.rejected:
            bad.write.mode("overwrite").parquet(a.rejected)
    elif a.command == "chunk":
        cfg = chunker.ChunkConfig(a.max_tokens, a.max_words, a.overlap_sentences, a.on_oversize)
        source = read(a.documents) if not a.documents.endswith(".jsonl") else lines.read_jsonl(spark, a.documents, lines.DOCUMENT)
        done = chunker.chunked(source, cfg).persist()
        errors = chunker.errors_of(done)
        if cfg.on_oversize == "fail" and (bad := errors.limit(1).collect()):
            raise chunker.OversizeError(f"{bad[0]['doc_id']}: {bad[0]['motivo']}")
        tables = {a.out: chunker.chunks_of(done), a.errors: errors, a.warnings: chunker.warnings_of(done)}
        write_together(spark, {path: df for path, df in tables.items() if path})
    elif a.command in ("index", "extend"):
        encoder = vectorbase.make_encoder(a.model, a.dim)
        base = vectorbase.build(read(a.chunks), encoder, a.model) if a.command == "index" else vectorbase.extend(read(a.base), read(a.chunks), encoder, a.model)
        base.write.mode("errorifexists").parquet(a.out)
        manifest = json.dumps(vectorbase.manifest(read(a.out), a.model, a.dim), ensure_ascii=False)
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.out.rstrip('/')}.manifest")
        print(manifest)
    elif a.command == "reencode":
        encoder = vectorbase.make_encoder(a.model, a.dim)
        new = vectorbase.encode(read(a.chunks).select("chunk_id", "texto"), "texto", encoder, names.prefixes_for(a.model)[1])
        vectorbase.replace_vectors(read(a.base), new).write.mode("errorifexists").parquet(a.out)
    elif a.command == "search":
        base, encoder = read(a.base), vectorbase.make_encoder(a.model, a.dim)
        q = [float(x) for x in encoder([names.prefixes_for(a.model)[0] + a.query])[0]]
        hits = search.knn_one(base.select(F.col("ordinal").alias("vec_id"), "embedding"), q, a.k)
        rows = hits.join(base.select(F.col("ordinal").alias("vec_id"), "doc_id", "chunk_id", "texto"), "vec_id").orderBy(F.desc("score"), "vec_id").collect()
        for rank, r in enumerate(rows, 1):
            print(json.dumps({"rank": rank, "score": r["score"], "doc_id": r["doc_id"], "chunk_id": r["chunk_id"], "texto": r["texto"]}, ensure_ascii=False))
    elif a.command == "verify":
        base = read(a.base)
        vectorbase.check(base)
        print(json.dumps(vectorbase.verify(base).first().asDict(), default=str))
    elif a.command == "answer":
        out = pipeline.answer(read(a.base), lines.read_queries(spark, a.queries), vectorbase.make_encoder(a.model, a.dim), a.model, a.first_k, within=a.within_documents)
        out.orderBy("query_id").coalesce(1).write.mode("overwrite").json(a.out)
    elif a.command == "ingest":
        state = lambda files: files.select("path", "sha256", F.when(F.length("content") > 0, "OK").otherwise("TEXTO_VACIO").alias("status"))
        print(ingest.retry(spark, a.log, state) if a.retry else ingest.run_available(spark, a.corpus, a.log, a.checkpoint, state))
    elif a.command == "report":
        reports.write_report(read(a.records), a.out, a.format)
    else:
        corpus.status_summary(read(a.log), order="path").orderBy(F.desc("n")).show(50, False)


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    try:
        run(a)
    except Exception as e:
        print(f"ERROR: {e}")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
