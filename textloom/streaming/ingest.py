"""Resumable ingestion: files that came since the last run, each content once, with failures in the log."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import pending

#: Fixed value: the state of a file whose processing failed.
FAILED = "BATCH_RUNNER_ERROR"
#: Failed files that one retry takes at most.
RETRIED = 10_000


def run_available(spark: SparkSession, folder: str, log: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], glob: str = "*") -> int:
    """Processes the files of a folder that no former run saw, then ends; the number of rows added to the log.

    The stream's checkpoint knows the files, the log the contents: a file whose sha256 is in the log as done is left
    out; one that failed comes again with `retry`. `process` gets path, sha256, content and gives rows with path, sha256
    and status; see per_file.
    """
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    added = [0]

    def one(batch: DataFrame, number: int) -> None:
        added[0] += append_new(spark, batch.select("path", F.sha2("content", 256).alias("sha256"), "content"), log, process)

    q = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return added[0]


def per_file(fn: Callable[[str, bytes], str]) -> Callable[[DataFrame], DataFrame]:
    """A `process` from a plain function of path and content that gives a status: what it raises becomes a row BATCH_RUNNER_ERROR with the error, and the others go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for path, sha, content in zip(*(b[c].to_pylist() for c in ("path", "sha256", "content"))):
                try:
                    rows.append((path, sha, fn(path, content), None))
                except Exception as e:  # a file that fails is a row, not the end of the run
                    rows.append((path, sha, FAILED, f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["path", "sha256", "status", "error"])

    return lambda files: files.select("path", "sha256", "content").mapInArrow(run, "path string, sha256 string, status string, error string")


def retry(spark: SparkSession, log: str, process: Callable[[DataFrame], DataFrame]) -> int:
    """Processes again the files whose contents the log has only as failed, read from where they are; the number of rows added to the log. The stream itself never offers a file twice."""
    done = _log(spark, log)
    if done is None:
        return 0
    failed = done.filter(F.col("status") == FAILED).select("path", "sha256").distinct().join(done.filter(F.col("status") != FAILED).select("sha256").distinct(), "sha256", "left_anti")
    paths = [r[0] for r in failed.select("path").distinct().limit(RETRIED + 1).collect()]
    if len(paths) > RETRIED:
        raise ValueError(f"more than {RETRIED} failed files: this is no failure of single files")
    if not paths:
        return 0
    files = spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"), "content")
    return append_new(spark, files, log, process)


def append_new(spark: SparkSession, files: DataFrame, log: str, process: Callable[[DataFrame], DataFrame]) -> int:
    """Appends the rows of the files whose content isn't in the log yet; one file of each content."""
    done = _log(spark, log)
    fresh = files.dropDuplicates(["sha256"])
    if done is not None:
        fresh = pending(fresh, done.filter(F.col("status") != FAILED))
    rows = process(fresh).cache()
    try:
        n = rows.count()
        if n:
            rows.write.mode("append").parquet(log)
        return n
    finally:
        rows.unpersist()


def _log(spark: SparkSession, log: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(log) if fs.exists(path) and fs.listStatus(path) else None


def windowed_status(events: DataFrame, time: str = "ts", key: str = "event_type", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and key, with a bound for late rows; for a stream or a table."""
    zoneless = events.schema[time].dataType.typeName() == "timestamp_ntz"
    if zoneless:  # event time must be a timestamp with a zone
        events = events.withColumn(time, F.col(time).cast("timestamp"))
    kind = "timestamp_ntz" if zoneless else "timestamp"
    return events.withWatermark(time, late).groupBy(F.window(time, window), F.col(key).alias("clave")).agg(F.count("*").alias("n"), F.sum("value").alias("suma")).select(F.col("window.start").cast(kind).alias("inicio"), "clave", "n", "suma")
