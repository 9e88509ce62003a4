"""Listing of files: recursive, by suffix, without manifests, tiles of the largest zoom."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators.corpus import deepest_tiles, deepest_zooms
from ..session import cut_lineage


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """path, length, modificationTime of all files below a folder; the content isn't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "length", "modificationTime")


def relative(path: Column, folder: str) -> Column:
    """The path below the folder."""
    inner = "/+".join(re.escape(x) for x in folder.strip("/").split("/"))
    return F.regexp_replace(path, rf"^.*?/+{inner}/+", "")


def known_files(files: DataFrame, path: str = "path") -> DataFrame:
    """The files of a known format that list no others."""
    return files.filter(names.suffix(F.col(path)).isin(*names.FORMATS) & ~names.is_manifest(F.col(path)))


def select_files(files: DataFrame, path: str = "path") -> DataFrame:
    """The known files; of tile pyramids only the deepest level."""
    return deepest_tiles(known_files(files, path), path)


#: Tile pyramids up to which their zooms go to every task.
MOST_PYRAMIDS = 100_000


def read_content(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, content of the selected files below a folder. What decides is taken from paths alone; contents aren't shuffled unless there are more than MOST_PYRAMIDS tile pyramids."""
    raw = known_files(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder))
    zooms = cut_lineage(deepest_zooms(raw.select("path")))
    return deepest_tiles(raw, zooms=F.broadcast(zooms) if zooms.count() <= MOST_PYRAMIDS else zooms).select("path", "length", "content")
