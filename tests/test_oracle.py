"""Every query against its SQL, on the smallest tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from textloom.plans import catalog


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if v is None or isinstance(v, str):
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return str(v)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, duck, name):
    df = catalog.queries()[name](spark, sf)
    cols = sorted(df.columns)
    rows = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    if sql := catalog.oracle_sql().get(name):
        rel = duck.sql(sql)
        assert sorted(rel.columns) == cols
        at = [rel.columns.index(c) for c in cols]
        assert rows == Counter(tuple(norm(r[k]) for k in at) for r in rel.fetchall())
    else:
        assert rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_boilerplate_removed_in_any_letter_case(spark, tmp_path):
    rows = [("a", "pdf", "Pie\n\nUno\nPie\n\nPie"), ("b", "PDF", "Pie\n\nDos\nPie\n\nPie"), ("c", " Pdf ", "Tres"), ("d", "html", "Pie")]
    spark.createDataFrame(rows, "doc_id string, formato string, texto string").write.parquet(f"{tmp_path}/mini_corpus.parquet")
    got = {r.doc_id: r for r in catalog.queries()["boilerplate_removed"](spark, str(tmp_path)).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"].paginas == got["b"].paginas == 3
