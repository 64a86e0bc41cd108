"""Workbook scan: one file per task, rows as string cells."""

from __future__ import annotations

import io
import re
import zipfile
from array import array
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import bounded_batches, ship_with_tasks

ship_with_tasks(__name__)

# --- Fixed value: the sheet that holds the tickets ------------------------------
SHEET = "TOUS LES INCIDENTS"

# Workbooks in one batch.
BATCH_BYTES = 4 * 1024 * 1024
# A frame of parsed rows holds at most so many rows and about so many characters.
_FRAME_ROWS, _FRAME_CHARS = 10_000, 4_000_000

ROWS = "file string, row int, cells array<string>, error string"
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(reference: str) -> int:
    number = 0
    for letter in re.match("[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _texts(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _cell(cell, shared: SharedStrings) -> str | None:
    kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return _texts(cell)
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return str(value.text == "1")
    return value.text


def _elements(stream, tag: str) -> Iterator:
    """Elements with `tag` as they end, each gone from memory before the next."""
    path = []
    for event, element in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start":
            path.append(element)
            continue
        path.pop()
        if element.tag == f"{_MAIN}{tag}":
            yield element
            path[-1].clear()


class SharedStrings:
    """A workbook's table of texts as one run of bytes and the offsets of the texts."""

    def __init__(self, book: zipfile.ZipFile) -> None:
        self.bytes, self.ends = bytearray(), array("Q", [0])
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as stream:
                for item in _elements(stream, "si"):
                    self.bytes += _texts(item).encode()
                    self.ends.append(len(self.bytes))

    def __getitem__(self, number: int) -> str:
        if not 0 <= number < len(self.ends) - 1:
            raise IndexError(f"no shared string {number}")
        return self.bytes[self.ends[number] : self.ends[number + 1]].decode()


def sheet_rows(content: bytes, sheet: str, required: bool) -> Iterator[list[str | None]]:
    """Rows of the named sheet, else (unless required) of the first."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = SharedStrings(book)
        sheets = {
            s.get("name"): s.get(_REL)
            for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
        }
        if sheet not in sheets and required:
            raise ValueError(f"no sheet {sheet!r}")
        targets = {
            r.get("Id"): r.get("Target").lstrip("/")
            for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        }
        target = targets[sheets.get(sheet) or next(iter(sheets.values()))]
        part = target if target.startswith("xl/") else f"xl/{target}"
        with book.open(part) as stream:
            for row in _elements(stream, "row"):
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    place = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (place - len(cells)))
                    cells.append(_cell(cell, shared))
                yield cells


def workbook_rows(files: DataFrame, sheet: str = SHEET, required: bool = False) -> DataFrame:
    """(file, row, cells, error) of workbooks given as (file, content); row 0 is the header row.

    A sheet has at most about a million rows, so a file fits a task. A file that
    cannot be read gives one row with its error. Files reach a task in batches of
    `BATCH_BYTES` or one larger file.
    """
    bounded_batches(files.sparkSession, size=BATCH_BYTES)

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["file"], frame["content"]):
                rows, held, error = [], 0, None
                try:
                    for number, cells in enumerate(sheet_rows(content, sheet, required)):
                        rows.append((name, number, cells, None))
                        held += sum(map(len, filter(None, cells)))
                        if len(rows) == _FRAME_ROWS or held > _FRAME_CHARS:
                            yield pd.DataFrame(rows, columns=["file", "row", "cells", "error"])
                            rows, held = [], 0
                except Exception as problem:  # noqa: BLE001 - reported as a rejected file
                    error = f"{type(problem).__name__}: {problem}"
                    rows.append((name, -1, None, error))
                yield pd.DataFrame(rows, columns=["file", "row", "cells", "error"])

    return files.select("file", "content").mapInPandas(parse, ROWS)


def read_workbook_rows(
    spark: SparkSession, paths: list[str], sheet: str = SHEET, required: bool = False
) -> DataFrame:
    """The same for workbook files."""
    files = spark.read.format("binaryFile").load(paths).repartition(max(len(paths), 1), "path")
    name = F.element_at(F.split("path", "/"), -1)
    return workbook_rows(files.select(name.alias("file"), "content"), sheet, required)
