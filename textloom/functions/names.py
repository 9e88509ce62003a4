"""Column functions on paths, names, addresses and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a file's suffix says of its format.
FORMATS = {".pdf": "pdf", ".html": "html", ".htm": "html", ".json": "json", ".csv": "csv", ".xlsx": "xlsx", ".txt": "texto", ".png": "imagen", ".jpg": "imagen", ".jpeg": "imagen", ".pbf": "pbf"}
#: Stems of files that only list other files.
MANIFEST_STEM = r"(?i)(catalog|registro|tiles-index)"
#: An encoder's prefixes for queries and passages.
E5_PREFIXES = ("query: ", "passage: ")


def doc_id(path: Column) -> Column:
    return F.concat(F.lit("DOC-"), F.substring(F.sha1(path), 1, 10))


def chunk_id(doc: Column, position: Column) -> Column:
    return F.format_string("%s-chunk-%04d", doc, position)


def phenomenon(path: Column) -> Column:
    """The number in the first segment of the path that begins F1_, F2_ or F3_; null if none does."""
    hit = F.filter(F.split(path, r"[/\\]"), lambda s: s.rlike(r"(?i)^F[1-3][_-]"))
    return F.when(F.size(hit) > 0, F.regexp_extract(F.element_at(hit, 1), r"(?i)^F([1-3])", 1).cast("int"))


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]+)$", 1), r"\.[^.]*$", "")


def format_of(path: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in FORMATS.items() for x in pair])[suffix(path)]


def is_manifest(path: Column) -> Column:
    return stem(path).rlike(MANIFEST_STEM)


def slug(name: Column) -> Column:
    """The last segment of a model's name, safe as a file name."""
    return F.regexp_replace(F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"[^A-Za-z0-9._-]+", "-"), r"^[-._]+|[-._]+$", "")


def prefixes_for(model: str) -> tuple[str, str]:
    return E5_PREFIXES if "e5" in model.lower() else ("", "")


def is_url(c: Column) -> Column:
    return F.trim(c).rlike(r"(?i)^https?://[^/?#\s]+")


def is_pdf_reference(c: Column) -> Column:
    t = F.lower(F.trim(c))
    return t.endswith(".pdf") | t.contains(".pdf?") | t.contains(".pdf#")


def string_kind(c: Column) -> Column:
    """empty_string, url, pdf_url, long_text, text or short_text."""
    t = F.trim(c)
    return F.when(c.isNull(), "null").when(F.length(t) == 0, "empty_string").when(is_url(t), "url").when(is_pdf_reference(t), "pdf_url").when(F.length(t) >= 160, "long_text").when(F.length(t) >= 40, "text").otherwise("short_text")


def tile_root(path: Column) -> Column:
    """The path up to its segment `tiles`; null if it has none."""
    return F.nullif(F.regexp_extract(path, r"^(.*?(?:^|/)tiles)(?:/|$)", 1), F.lit(""))


def tile_zoom(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"(?:^|/)tiles/(-?\d+)(?:/|$)", 1), F.lit("")).cast("int")
