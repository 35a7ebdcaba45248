"""Spreadsheets, word-processor tables and HTML tables, read with the standard library alone.

Each function takes the bytes or text of one document, so a table of landed documents (binaryFile, or pages)
is decoded where its rows are. Cells come out as (table, row, cells).
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS = "table int, row int, cells array<string>"
_SS = "{urn:schemas-microsoft-com:office:spreadsheet}"
_XL = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_TABLE = "{urn:oasis:names:tc:opendocument:xmlns:table:1.0}"
_TEXT = "{urn:oasis:names:tc:opendocument:xmlns:text:1.0}"
Decoder = Callable[[bytes], Iterable[tuple[int, list[str]]]]


def _worth(cells: list[str]) -> bool:
    return len(cells) > 1 and any(cells)


def spreadsheet_xml(data: bytes) -> Iterator[tuple[int, list[str]]]:
    """SpreadsheetML 2003: 1-based Index attributes leave gaps of empty cells; rows of one cell or none, and rows
    without text, go."""
    for number, table in enumerate(ElementTree.fromstring(data).iter(f"{_SS}Table")):
        for row in table.iter(f"{_SS}Row"):
            cells: list[str] = []
            for cell in row.findall(f"{_SS}Cell"):
                at = cell.get(f"{_SS}Index")
                if at:
                    cells += [""] * (int(at) - 1 - len(cells))
                cells.append("".join("".join(d.itertext()) for d in cell.findall(f"{_SS}Data")))
            if _worth(cells):
                yield number, cells


def workbook(data: bytes) -> Iterator[tuple[int, list[str]]]:
    """XLSX: every sheet's rows, shared and inline strings, gaps as empty cells."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = book.namelist()
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_XL}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{_XL}si")]
        sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n)))
        for number, name in enumerate(sheets):
            for row in ElementTree.fromstring(book.read(name)).iter(f"{_XL}row"):
                cells: list[str] = []
                for cell in row.findall(f"{_XL}c"):
                    letters = re.sub(r"[^A-Z]", "", cell.get("r", ""))
                    if letters:
                        at = 0
                        for letter in letters:
                            at = at * 26 + ord(letter) - 64
                        cells += [""] * (at - 1 - len(cells))
                    value = cell.find(f"{_XL}v")
                    if cell.get("t") == "s" and value is not None:
                        cells.append(shared[int(value.text)])
                    elif cell.get("t") == "inlineStr":
                        cells.append("".join(t.text or "" for t in cell.iter(f"{_XL}t")))
                    else:
                        cells.append((value.text or "") if value is not None else "")
                yield number, cells


def text_document(data: bytes) -> Iterator[tuple[int, list[str]]]:
    """ODT tables: repeated cells are cloned, and spanning ones unless they say how often they repeat; covered cells aren't
    read. A cell's paragraphs are joined as they are, cells that begin with # are comments, empty rows go."""
    with zipfile.ZipFile(io.BytesIO(data)) as package:
        root = ElementTree.fromstring(package.read("content.xml"))
    for number, table in enumerate(root.iter(f"{_TABLE}table")):
        for row in table.iter(f"{_TABLE}table-row"):
            cells: list[str] = []
            for cell in row:
                if cell.tag != f"{_TABLE}table-cell":
                    continue
                text = "".join("".join(p.itertext()) for p in cell.iter(f"{_TEXT}p"))
                if text.startswith("#"):
                    continue
                times = cell.get(f"{_TABLE}number-columns-repeated") or cell.get(f"{_TABLE}number-columns-spanned") or 1
                cells += [text] * int(times)
            while cells and not cells[-1]:
                cells.pop()
            if any(cells):
                yield number, cells


class _Tables(HTMLParser):
    """All tables of a page: id, rows of (cells, id of the row, spans). Cells are lines of visible inner divs, or all text."""

    def __init__(self, divs: bool):
        super().__init__(convert_charrefs=True)
        self.divs, self.tables, self.open = divs, [], []
        self.cell: list[str] | None = None
        self.hidden: list[bool] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        have = dict(attrs)
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "table":
            self._end_cell()
            self.tables.append((have.get("id"), []))
            self.open.append(self.tables[-1][1])
        elif tag == "tr" and self.open:
            self._end_cell()
            self.open[-1].append((have.get("id"), []))
        elif tag in ("td", "th") and self.open and self.open[-1]:
            self._end_cell()
            self.cell, self.hidden = [], []
            self.span = (int(have.get("colspan") or 1), int(have.get("rowspan") or 1))
        elif tag == "div" and self.cell is not None:
            self.hidden.append("visibility:hidden" in (have.get("style") or "").replace(" ", "").lower())
            if self.cell:
                self.cell.append("\n")
        elif tag == "br" and self.cell is not None:
            self.cell.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in ("td", "th", "tr"):
            self._end_cell()
        elif tag == "table" and self.open:
            self._end_cell()
            self.open.pop()
        elif tag == "div" and self.hidden:
            self.hidden.pop()

    def handle_data(self, data):
        if self.cell is not None and not self.skip and not (self.divs and any(self.hidden)):
            self.cell.append(data)

    def _end_cell(self):
        if self.cell is not None:
            lines = [" ".join(x.split()) for x in "".join(self.cell).split("\n")]
            self.open[-1][-1][1].append(("\n".join(x for x in lines if x), *self.span))
            self.cell = None

    def close(self):
        super().close()
        self._end_cell()


def repair_html(html: Column) -> Column:
    """Header cells that a td closes, and data cells that a th closes, before parsing."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)(<th\b[^>]*>(?:(?!</?t[hdr]\b).)*)</td>", "$1</th>"), r"(?is)(<td\b[^>]*>(?:(?!</?t[hdr]\b).)*)</th>", "$1</td>")


def page_tables(html: str, table_id: str | None = None, divs: bool = True, drop_small: bool = True) -> Iterator[tuple[int, list[str]]]:
    """Rows of the tables of a page (of the one with the id, if given); rows of one cell or none and empty ones go."""
    parser = _Tables(divs)
    parser.feed(html or "")
    parser.close()
    for number, (own, rows) in enumerate(parser.tables):
        if table_id is None or own == table_id:
            for _, cells in rows:
                texts = [c[0] for c in cells]
                if not drop_small or _worth(texts):
                    yield number, texts


def two_level_table(html: str, head_rows: int = 2) -> list[dict[str, dict[str, str]]]:
    """Rows of a page's first table under a two-level header with spans: outer name -> inner name -> text. An outer header
    that spans rows has itself as inner name."""
    parser = _Tables(False)
    parser.feed(html or "")
    parser.close()
    if not parser.tables:
        return []
    rows = [cells for _, cells in parser.tables[0][1] if cells]
    grid: list[dict[int, str]] = [{} for _ in range(head_rows)]
    for r, cells in enumerate(rows[:head_rows]):
        at = 0
        for text, wide, high in cells:
            while at in grid[r]:
                at += 1
            for k in range(r, min(head_rows, r + high)):
                for c in range(at, at + wide):
                    grid[k][c] = text
            at += wide
    names = [(grid[0].get(c, ""), grid[-1].get(c, "")) for c in sorted(grid[0])]
    out = []
    for cells in rows[head_rows:]:
        row: dict[str, dict[str, str]] = {}
        for (outer, inner), cell in zip(names, cells, strict=False):
            row.setdefault(outer, {})[inner] = cell[0]
        out.append(row)
    return out


def profile(html: str, sections: dict[str, str], ignore: Iterable[str] = ()) -> dict[str, list[str]]:
    """Rows of a page by the id of their tr: section name -> its cells. Sections may be missing; a row that has text and an
    unknown id raises."""
    parser = _Tables(False)
    parser.feed(html or "")
    parser.close()
    out: dict[str, list[str]] = {}
    for _, rows in parser.tables:
        for row_id, cells in rows:
            texts = [c[0] for c in cells]
            if row_id in sections:
                out.setdefault(sections[row_id], []).extend(texts)
            elif row_id is not None and row_id not in ignore and any(texts):
                raise ValueError(f"unknown section {row_id}")
    return out


def labelled_value(html: str, label: str) -> str | None:
    """Text of the second cell of the first row that holds the label."""
    for _, cells in page_tables(html, drop_small=False):
        if any(label in c for c in cells):
            return cells[1] if len(cells) > 1 else None
    return None


def hidden_fields(html: str) -> dict[str, str]:
    """Names and values of the hidden inputs of a page."""

    class Inputs(HTMLParser):
        found: dict[str, str] = {}

        def handle_starttag(self, tag, attrs):
            have = dict(attrs)
            if tag == "input" and have.get("type", "").lower() == "hidden" and have.get("name"):
                self.found[have["name"]] = have.get("value") or ""

    parser = Inputs()
    parser.found = {}
    parser.feed(html or "")
    return parser.found


def single_member(data: bytes) -> bytes:
    """The only member of a zip; any other number raises."""
    with zipfile.ZipFile(io.BytesIO(data)) as package:
        names = package.namelist()
        if len(names) != 1:
            raise ValueError(f"one member is expected, not {len(names)}")
        return package.read(names[0])


def workbook_modified(data: bytes) -> str | None:
    """The modified time that a workbook says of itself."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        if "docProps/core.xml" not in book.namelist():
            return None
        found = ElementTree.fromstring(book.read("docProps/core.xml")).find("{http://purl.org/dc/terms/}modified")
        return found.text if found is not None else None


def decoded(documents: DataFrame, key: str, content: str, decoder: Decoder) -> DataFrame:
    """documents(key, content) -> key, table, row, cells: one row for each row of the documents' tables. Streams document
    by document, so memory is bounded by the largest."""
    fields = pa.schema([("k", pa.string()), ("table", pa.int32()), ("row", pa.int32()), ("cells", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if data is None:
                    continue
                rows = list(decoder(data))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array([t for t, _ in rows], pa.int32()), pa.array(range(len(rows)), pa.int32()), pa.array([c for _, c in rows], pa.list_(pa.string()))], schema=fields)

    kind = documents.schema[key].dataType.simpleString()
    made = documents.select(F.col(key).cast("string"), content).mapInArrow(run, f"k string, {CELLS}")
    return made.select(F.col("k").cast(kind).alias(key), "table", "row", "cells")


def read_documents(spark: SparkSession, path: str, decoder: Decoder) -> DataFrame:
    """Files -> file, table, row, cells."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    return decoded(files, "file", "content", decoder)


def tables_between(rows: DataFrame, key: str, front: int = 2, back: int = 0) -> DataFrame:
    """Without a document's first and last tables, and without the first row of all but its first table left."""
    from pyspark.sql.window import Window

    whole = Window.partitionBy(key)
    kept = rows.withColumn("__last", F.max("table").over(whole)).where((F.col("table") >= front) & (F.col("table") <= F.col("__last") - back))
    kept = kept.withColumn("__first", F.min("table").over(whole)).withColumn("__head", F.min("row").over(Window.partitionBy(key, "table")))
    return kept.where((F.col("table") == F.col("__first")) | (F.col("row") != F.col("__head"))).drop("__last", "__first", "__head")


def postback_triples(text: Column) -> Column:
    """map of the hiddenField, key, value triples of a pipe-separated postback."""
    parts = F.split(text, r"\|")
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.size(parts) - 2, F.lit(1))), lambda i: F.try_element_at(parts, i) == "hiddenField")
    pairs = F.transform(at, lambda i: F.struct(F.try_element_at(parts, i + 1).alias("k"), F.coalesce(F.try_element_at(parts, i + 2), F.lit("")).alias("v")))
    return F.map_from_entries(pairs)


def file_times(spark: SparkSession, path: str) -> DataFrame:
    """file, modified: what the store says of landed files."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"))
