"""JSON Lines with line numbers and strictness, rows of tables as text, whole JSON documents, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checks import ConstraintError

DOCUMENT = T.StructType([T.StructField(c, T.IntegerType() if c == "fenomeno" else T.StringType()) for c in ("doc_id", "fuente", "formato", "fenomeno", "idioma", "texto")])
QUERY = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("pregunta", T.StringType())])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """The records of JSON Lines; blank lines don't count. Strict: an error at a line that isn't JSON; else it is left out."""
    full = T.StructType([*schema.fields, T.StructField("_mal", T.StringType())])
    raw = spark.read.text(path).filter(F.trim("value") != "")
    rows = raw.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_mal"}).alias("r")).select("r.*")
    if not strict:
        return rows.filter("_mal is null").drop("_mal")
    if bad := rows.filter("_mal is not null").limit(1).collect():
        # only then are lines counted, blank ones included
        places = spark.read.text(path).rdd.zipWithIndex().filter(lambda x: x[0][0] == bad[0]["_mal"]).map(lambda x: x[1] + 1).take(1)
        raise ConstraintError(f"{path}, line {places[0] if places else '?'}: {bad[0]['_mal'][:200]}")
    return rows.drop("_mal")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, QUERY)


def read_log(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """A log of JSON Lines; by default broken lines are left out, as a run that was interrupted may leave one."""
    return read_jsonl(spark, path, schema, strict)


def pairs_text(columns: list[str], separator: str = " | ") -> Column:
    """`column: value` of the columns that aren't null."""
    return F.concat_ws(separator, *(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in columns))
