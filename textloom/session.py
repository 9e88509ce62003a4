"""Spark sessions for the engine, and shipping of the package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent
_SHIPPED: set[str] = set()


def build(app: str = "textloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; on a cluster the submitting side's settings win."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Makes the package importable on every executor, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        path = os.path.join(tempfile.mkdtemp(prefix="textloom-"), "textloom.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(ROOT.rglob("*.py")):
                z.write(p, p.relative_to(ROOT.parent))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder that spark.checkpoint.dir names. Only a local master gets a folder of its own where none is set; on a cluster that is an error, as executors would not see it."""
    sc = df.sparkSession.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return df.checkpoint()


def write_together(spark: SparkSession, outputs: dict[str, DataFrame]) -> None:
    """Writes tables to their paths, all or none: each beside its path first, and only when all are written they take their places."""
    path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = {p: path(p).getFileSystem(spark._jsc.hadoopConfiguration()) for p in outputs}
    staged = {p: f"{p.rstrip('/')}.part" for p in outputs}
    try:
        for p, df in outputs.items():
            df.write.mode("overwrite").parquet(staged[p])
        for p in outputs:
            fs[p].delete(path(p), True)
            if not fs[p].rename(path(staged[p]), path(p)):
                raise OSError(f"{p} could not be put in its place")
    finally:
        for p in outputs:
            fs[p].delete(path(staged[p]), True)
