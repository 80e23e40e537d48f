"""Tables in files: delimited text, spreadsheets, tables in text documents.

Files are read as binary and parsed whole, one task a file, because row numbers count records from the first (quoted
records may span lines, and blank ones count). Every cell is text; typing is the mapping's work.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
import zipfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Delimiters in order of preference, and suffixes of each kind of table.
DELIMITERS = (",", ";", "\t", "|")
DELIMITED, SHEETS, DOCUMENTS = (".csv", ".txt", ".tsv"), (".xlsx", ".xlsm"), (".docx",)
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def headers(cells: list[str | None]) -> list[str]:
    """Names for columns: blank ones by their place, repeated ones with a number."""
    seen: Counter = Counter()
    out = []
    for i, cell in enumerate(cells, 1):
        name = (cell or "").strip() or f"column_{i}"
        seen[name] += 1
        out.append(name if seen[name] == 1 else f"{name}__{seen[name]}")
    return out


def decode(raw: bytes) -> str:
    return raw.decode(encoding(pa.py_buffer(raw)))


def encoding(raw: pa.Buffer) -> str:
    """UTF-8, with or without a mark, or else Latin-1; told a piece at a time."""
    decoder, source = codecs.getincrementaldecoder("utf-8-sig")(), pa.BufferReader(raw)
    try:
        while piece := source.read(1 << 20):
            decoder.decode(piece)
        decoder.decode(b"", True)
    except UnicodeDecodeError:
        return "latin-1"
    return "utf-8-sig"


def delimiter(text: str) -> str:
    """The delimiter most frequent in the first line that is not blank; then a guess; then the comma."""
    line = next((x for x in text[:4096].splitlines() if x.strip()), "")
    best = max(DELIMITERS, key=line.count)
    if line.count(best):
        return best
    try:
        return csv.Sniffer().sniff(text[:4096]).delimiter
    except csv.Error:
        return ","


def delimited_records(raw: bytes | pa.Buffer) -> Iterator[list[str | None]]:
    """Records as they are read: neither the file's text nor its records are ever held as a whole."""
    raw = pa.py_buffer(raw)
    name = encoding(raw)

    def text() -> io.TextIOWrapper:
        return io.TextIOWrapper(pa.BufferReader(raw), name, newline="")

    yield from csv.reader(text(), delimiter=delimiter(text().read(4096)))


def parse_delimited(raw: bytes) -> list[list[str | None]]:
    return list(delimited_records(raw))


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


# Built-in number formats that show dates or times.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_DATE_LETTERS = re.compile(r'[dmyhs]', re.I)
_NOT_LETTERS = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Cell styles that show a number as a date."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")) for f in root.iter(f"{_MAIN}numFmt") if _DATE_LETTERS.search(_NOT_LETTERS.sub("", f.get("formatCode", "")))}
    styles = root.find(f"{_MAIN}cellXfs")
    return {i for i, x in enumerate(styles if styles is not None else ()) if int(x.get("numFmtId", 0)) in _DATE_FORMATS | own}


def _serial_date(value: str, from_1904: bool) -> str:
    """A day number as a date, with the time if there is one; days count from 1904, or from 1900 with a 29 February."""
    days = float(value) + (1462 if from_1904 else 0)
    at = datetime(1899, 12, 30 if days >= 60 else 31) + timedelta(days=days)
    at = at.replace(microsecond=0) + timedelta(seconds=round(at.microsecond / 1e6))
    return at.date().isoformat() if at.time() == datetime.min.time() else at.isoformat(sep=" ")


def parse_sheet(raw: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """The named sheet, or the active one; cached values of formulas, booleans as TRUE and FALSE, dates as such."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        dates = _date_styles(z)
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        setting, view = book.find(f"{_MAIN}workbookPr"), next(book.iter(f"{_MAIN}workbookView"), None)
        from_1904 = setting is not None and setting.get("date1904") in ("1", "true")
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        named = {s.get("name"): targets[s.get(_RELATION)] for s in book.iter(f"{_MAIN}sheet")}
        if sheet is not None and sheet not in named:
            raise ValueError(f"no sheet {sheet!r}")
        target = named[sheet] if sheet is not None else list(named.values())[int(view.get("activeTab", 0)) if view is not None else 0]
        root = ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"))

    def text(c: ElementTree.Element) -> str | None:
        value, kind = c.findtext(f"{_MAIN}v"), c.get("t")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
        if value is None or kind in ("str", "e"):
            return value
        if kind == "s":
            return shared[int(value)]
        if kind == "b":
            return "TRUE" if value == "1" else "FALSE"
        return _serial_date(value, from_1904) if int(c.get("s", -1)) in dates else value

    rows: list[list[str | None]] = []
    for row in root.iter(f"{_MAIN}row"):
        while len(rows) < int(row.get("r", len(rows) + 1)) - 1:
            rows.append([])
        cells: list[str | None] = []
        for c in row.iter(f"{_MAIN}c"):
            at = _column(c.get("r")) if c.get("r") else len(cells)
            cells += [None] * (at + 1 - len(cells))
            cells[at] = text(c)
        rows.append(cells)
    return rows


def parse_document(raw: bytes) -> list[list[str | None]]:
    """The first table: a cell is its paragraphs, a line each; fewer than two rows are an error."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    body = root.find(f"{_WORD}body")
    table = body.find(f"{_WORD}tbl") if body is not None else None
    table = table if table is not None else next(root.iter(f"{_WORD}tbl"), None)
    if table is None:
        raise ValueError("the document has no table")
    rows = [["\n".join("".join(t.text or "" for t in p.iter(f"{_WORD}t")) for p in c.findall(f"{_WORD}p")).strip() for c in r.findall(f"{_WORD}tc")] for r in table.findall(f"{_WORD}tr")]
    if len(rows) < 2:
        raise ValueError("the table has no rows")
    return rows


def parser(path: str, sheet: str | None = None) -> Callable[[pa.Buffer], Iterable[list[str | None]]]:
    """The parser for a file's suffix."""
    low = path.lower()
    if low.endswith(DELIMITED):
        return delimited_records
    if low.endswith(SHEETS):
        return lambda raw: parse_sheet(raw.to_pybytes(), sheet)
    if low.endswith(DOCUMENTS):
        return lambda raw: parse_document(raw.to_pybytes())
    raise ValueError(f"unsupported file: {path}")


#: Rows that one batch of a file's records has.
BATCH_ROWS = 10_000


def scan(spark: SparkSession, path: str, sheet: str | None = None, recursive: bool = False) -> DataFrame:
    """(source_file, row_number, cells) of every record but the first of each file, and that one as row 1.

    Recursively, files of other suffixes are passed over, and a folder without any table is an error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "content")
    if recursive:
        files = files.where(F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(*DELIMITED, *SHEETS, *DOCUMENTS))
        if files.limit(1).count() == 0:
            raise ValueError(f"no tables under {path}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, at = iter(parser(name, sheet)(raw.as_buffer())), 1
                while part := list(islice(rows, BATCH_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.array(range(at, at + len(part)), pa.int64()), pa.array(part, pa.list_(pa.string()))], names=["source_file", "row_number", "cells"])
                    at += len(part)

    return files.mapInArrow(run, "source_file string, row_number long, cells array<string>")


def read_evidence(spark: SparkSession, path: str | None, schema: str, expected: int) -> DataFrame:
    """Evidence by position (``_pos`` from 0): one record a row of a table; without a path, as many empty ones; another number is an error."""
    if path is None:
        return spark.range(expected).select(F.col("id").alias("_pos"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema).fields])
    files = spark.read.format("binaryFile").load(path)
    lines = files.select(F.posexplode(F.filter(F.split(F.decode("content", "UTF-8"), "\\r?\\n"), lambda x: x.rlike(r"^\s*\{"))).alias("_pos", "line"))
    records = lines.select(F.col("_pos").cast("long").alias("_pos"), F.from_json("line", schema).alias("r")).where("r is not null").select("_pos", "r.*")
    n = records.count()
    if n != expected:
        raise ValueError(f"{expected} rows against {n} records of evidence")
    return records


def read_table(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """One file as columns named by its first record, with source_file and row_number; rows are cut or filled to the header."""
    rows = scan(spark, path, sheet)
    first = rows.where("row_number = 1").select("cells").first()
    if first is None:
        raise ValueError(f"{path} is empty")
    names = headers(first.cells)
    return rows.where("row_number > 1").select("source_file", "row_number", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines by a declared schema; blank lines and lines that hold no object are skipped."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"^\s*\{"))
    return lines.select(F.from_json("value", schema).alias("r")).where("r is not null").select("r.*")


def price_list(table: DataFrame, brand: str) -> DataFrame:
    """A price list's rows: the cost column's header names price, unit and currency, the price column's the sale price."""
    from ..functions.parse import price_number
    from ..operators.mapping import header_key

    keys = {c: header_key(c) for c in table.columns}
    cost = next((c for c, k in keys.items() if all(x in k for x in ("precio", "unid", "bs"))), None)
    price = next((c for c, k in keys.items() if "precioventa" in k), None)
    name = next(c for c in table.columns if c not in ("source_file", "row_number"))
    if cost is None or price is None:
        raise ValueError("the cost or the price column is missing")
    rows = table.where(F.trim(F.coalesce(F.col(f"`{name}`"), F.lit(""))) != "")
    return rows.select("source_file", F.col("row_number").alias("source_row"), F.lit(brand).alias("brand"), F.col(f"`{name}`").alias("raw_name"), price_number(F.col(f"`{cost}`")).alias("cost"), price_number(F.col(f"`{price}`")).alias("price"))
