"""Text from the bytes of a file, by format. PDF and image engines are plugged in; without one the text is null, with a reason."""

from __future__ import annotations

import csv
import io
import json
import struct
import unicodedata
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsonx, names
from ..functions.pages import drop_repeated

Pages = list[str]
Extractor = Callable[[bytes], Pages]


def decode(data: bytes) -> str:
    return data.decode("utf-8", "ignore")


class _Visible(HTMLParser):
    HIDDEN = ("script", "style", "noscript")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.HIDDEN

    def handle_endtag(self, tag):
        self.depth -= tag in self.HIDDEN and self.depth > 0

    def handle_data(self, data):
        if not self.depth and data.strip():
            self.parts.append(data.strip())


def html_pages(data: bytes) -> Pages:
    """The visible text, a line for each text node."""
    p = _Visible()
    p.feed(decode(data))
    p.close()
    return ["\n".join(p.parts)]


def json_pages(data: bytes) -> Pages:
    return [jsonx.document_text(json.loads(decode(data)))]


def text_pages(data: bytes) -> Pages:
    return [decode(data)]


def rows_text(header: list[str], rows: Iterator[list]) -> str:
    """A line for each row: `column: value` of its cells that aren't empty, joined by bars."""
    lines = (" | ".join(f"{h}: {v}" for h, v in zip(header, row) if v is not None and str(v) != "") for row in rows)
    return "\n".join(x for x in lines if x)


def csv_pages(data: bytes) -> Pages:
    """Cells stay as written; rows with more cells than the header are left out, as are broken ones."""
    text = decode(data).lstrip("﻿")
    try:
        dialect = csv.Sniffer().sniff(text[:4096], delimiters=",;\t|")
    except csv.Error:
        dialect = csv.excel
    rows = csv.reader(io.StringIO(text), dialect)
    header = next(rows, [])
    return [rows_text(header, (r for r in rows if r and len(r) <= len(header)))]


_X = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def xlsx_pages(data: bytes) -> Pages:
    """The first sheet of a workbook."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_X}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        sheets = sorted(n for n in z.namelist() if n.startswith("xl/worksheets/sheet"))
        if not sheets:
            return [""]
        rows = []
        for row in ElementTree.fromstring(z.read(sheets[0])).iter(f"{_X}row"):
            cells: dict[int, str] = {}
            for c in row.iter(f"{_X}c"):
                column = 0
                for ch in c.get("r", "A"):
                    column = column * 26 + ord(ch) - 64 if ch.isalpha() else column
                value = c.find(f"{_X}v")
                if c.get("t") == "s" and value is not None:
                    cells[column] = shared[int(value.text)]
                elif c.get("t") == "inlineStr":
                    cells[column] = "".join(t.text or "" for t in c.iter(f"{_X}t"))
                elif value is not None:
                    cells[column] = value.text or ""
            rows.append([cells.get(k) for k in range(1, max(cells, default=0) + 1)])
    if not rows:
        return [""]
    header = [h or f"columna_{k}" for k, h in enumerate(rows[0], 1)]
    return [rows_text(header, iter(rows[1:]))]


def _fields(data: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(field, wire type, value) of a protobuf message."""
    at, n = 0, len(data)

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < n:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, kind, varint()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield tag >> 3, kind, data[at : at + size]
            at += size
        elif kind == 2:
            size = varint()
            yield tag >> 3, kind, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {kind}")


def _tile_value(data: bytes):
    for field, _, v in _fields(data):
        if field == 1:
            return v.decode("utf-8", "ignore")
        if field == 2:
            return struct.unpack("<f", v)[0]
        if field == 3:
            return struct.unpack("<d", v)[0]
        if field == 6:
            return (v >> 1) ^ -(v & 1)
        if field == 7:
            return bool(v)
        return v if v < 1 << 63 or field == 5 else v - (1 << 64)
    return None


def tile_pages(data: bytes) -> Pages:
    """A line for each feature with properties of a vector tile: [layer] key: value; key: value. Geometry is left out."""
    lines = []
    for field, _, layer in _fields(data):
        if field != 3:
            continue
        name, keys, values, features = "", [], [], []
        for f, _, v in _fields(layer):
            if f == 1:
                name = v.decode("utf-8", "ignore")
            elif f == 2:
                features.append(v)
            elif f == 3:
                keys.append(v.decode("utf-8", "ignore"))
            elif f == 4:
                values.append(_tile_value(v))
        for feature in features:
            tags: list[int] = []
            for f, kind, v in _fields(feature):
                if f == 2 and kind == 2:
                    tags += [x for _, _, x in _fields(b"".join(b"\x08" + p for p in _varints(v)))]
            if tags:
                lines.append(f"[{name}] " + "; ".join(f"{keys[a]}: {values[b]}" for a, b in zip(tags[::2], tags[1::2])))
    return ["\n".join(lines)]


def _varints(data: bytes) -> Iterator[bytes]:
    start = 0
    for k, b in enumerate(data):
        if b < 128:
            yield data[start : k + 1]
            start = k + 1


REGISTRY: dict[str, Extractor] = {"html": html_pages, "json": json_pages, "csv": csv_pages, "xlsx": xlsx_pages, "texto": text_pages, "pbf": tile_pages}


def register(formato: str, extractor: Extractor) -> None:
    """Plugs in an extractor, such as a PDF or an OCR engine, on this driver; it travels with the job."""
    REGISTRY[formato] = extractor


def extract(files: DataFrame) -> DataFrame:
    """path, formato, paginas (composed; those of a pdf without repeated lines), motivo from path and content. A file that can't be read has null pages and the reason."""
    registry = dict(REGISTRY)
    schema = "path string, formato string, paginas array<string>, motivo string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, formato, content in zip(frame["path"], frame["formato"], frame["content"]):
                pages, why = None, None
                if formato not in registry:
                    why = f"sin extractor: {formato}"
                else:
                    try:
                        got = registry[formato](bytes(content))
                        pages = [unicodedata.normalize("NFC", p) for p in (drop_repeated(got) if formato == "pdf" else got) if p.strip()]
                    except Exception as e:  # a broken file must not end the job
                        why = f"{type(e).__name__}: {e}"
                rows.append((path, formato, pages, why))
            yield pd.DataFrame(rows, columns=["path", "formato", "paginas", "motivo"])

    return files.select("path", names.format_of(F.col("path")).alias("formato"), "content").mapInPandas(run, schema)
