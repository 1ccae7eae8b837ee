"""Workbooks (xlsx) as tables, for dictionaries that people keep in them: a zip of XML, read and written without other libraries.

A workbook is small by nature (a sheet holds at most 1,048,576 rows). Each file is read by one task; many files are spread over tasks.
"""

from __future__ import annotations

import base64
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKED = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(reference: str) -> int:
    n = 0
    for letter in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _letters(n: int) -> str:
    out = ""
    while n >= 0:
        out, n = chr(65 + n % 26) + out, n // 26 - 1
    return out


def sheets(data: bytes) -> dict[str, list[list[str]]]:
    """The rows of each sheet as strings; empty cells are empty strings."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = set(book.namelist())
        texts = []
        if "xl/sharedStrings.xml" in names:
            texts = ["".join(t.text or "" for t in item.iter(f"{MAIN}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        found = {}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet"):
            path = targets[sheet.get(LINKED)].lstrip("/")
            rows = []
            for row in ElementTree.fromstring(book.read(path if path.startswith("xl/") else f"xl/{path}")).iter(f"{MAIN}row"):
                cells: list[str] = []
                for cell in row.iter(f"{MAIN}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(cells)
                    value = cell.find(f"{MAIN}v")
                    text = "".join(t.text or "" for t in cell.iter(f"{MAIN}t")) if cell.get("t") == "inlineStr" else (value.text or "") if value is not None else ""
                    cells += [""] * (at + 1 - len(cells))
                    cells[at] = texts[int(text)] if cell.get("t") == "s" else text
                rows.append(cells)
            found[sheet.get("name")] = rows
        return found


def workbook(tables: dict[str, tuple[list[str], list[tuple]]]) -> bytes:
    """A workbook with a sheet for each (columns, rows); texts are written inline, numbers as numbers."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        ids = range(1, len(tables) + 1)
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in ids)
        book.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        related = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        book.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{related}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(name[:31], {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, name in zip(ids, tables, strict=True))
        book.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{MAIN[1:-1]}" xmlns:r="{related}"><sheets>{listed}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(f"""<Relationship Id="rId{i}" Type="{related}/worksheet" Target="worksheets/sheet{i}.xml"/>""" for i in ids)}</Relationships>')
        for i, (columns, rows) in zip(ids, tables.values(), strict=True):
            lines = []
            for r, row in enumerate([tuple(columns), *rows], 1):
                cells = []
                for c, value in enumerate(row):
                    at = f"{_letters(c)}{r}"
                    if isinstance(value, (int, float)) and not isinstance(value, bool):
                        cells.append(f'<c r="{at}"><v>{value}</v></c>')
                    elif value is not None:
                        cells.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>')
                lines.append(f'<row r="{r}">{"".join(cells)}</row>')
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<?xml version="1.0"?><worksheet xmlns="{MAIN[1:-1]}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()


def read_workbooks(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Columns file, sheet, and `columns` as strings (empty where a sheet lacks one), of all sheets of the workbooks under a path. The first row names columns."""
    schema = ", ".join(["file string", "sheet string", *(f"`{c}` string" for c in columns)])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                for sheet, rows in sheets(content).items():
                    if len(rows) > 1:
                        places = [rows[0].index(c) if c in rows[0] else -1 for c in columns]
                        values = [[file, sheet, *(r[p] if 0 <= p < len(r) else "" for p in places)] for r in rows[1:]]
                        yield pd.DataFrame(values, columns=["file", "sheet", *columns])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInPandas(parse, schema)


def as_base64(data: bytes) -> str:
    return base64.b64encode(data).decode()


def report(tables: dict[str, DataFrame], most: int = 100_000) -> bytes:
    """A workbook of small result tables, a sheet for each. A table of more than `most` rows is refused, not cut."""
    collected = {}
    for name, df in tables.items():
        rows = df.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{name} has more than {most} rows: write it as Parquet or CSV")
        collected[name] = (df.columns, [tuple("; ".join(map(str, v)) if isinstance(v, list) else v for v in r) for r in rows])
    return workbook(collected)


def list_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns that hold lists as text between semicolons, as arrays."""
    parts = lambda c: F.filter(F.transform(F.split(F.col(c), ";"), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumns({c: parts(c) for c in names})
