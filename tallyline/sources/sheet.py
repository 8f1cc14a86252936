"""Sheets of .xlsx workbooks as DataFrames of text columns.

Workbooks are read as binary files by Spark, from any store that it reads, and parsed on the workers,
one task for each workbook. All cells become text: dates as dd/MM/yyyy, whole numbers without a point.
The data source in workbooks reads one sheet in many tasks, from the stores that pyarrow knows.
"""

from __future__ import annotations

import datetime
import functools
import io
import itertools
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_C, _V, _T = f"{_NS}c", f"{_NS}v", f"{_NS}t"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Rows of a batch that a worker returns.
BATCH = 2_000
ARROW = {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "timestamp_ntz": pa.timestamp("us")}
#: Built-in number formats that are dates.
_DATES = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _column(ref: str) -> int:
    return _position(ref.rstrip("0123456789"))


@functools.lru_cache(16_384)
def _position(letters: str) -> int:
    """The position that a cell's letters name; a sheet has 16,384 at most."""
    n = 0
    for c in re.match(r"[A-Z]+", letters)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


@functools.lru_cache(100_000)
def _day(number: float) -> str:
    """dd/MM/yyyy of a day number."""
    return (datetime.datetime(1899, 12, 30) + datetime.timedelta(days=number)).strftime("%d/%m/%Y")


def _is_date_format(code: str) -> bool:
    return bool(re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code.lower())))


#: How a workbook writes a character that it can't hold.
_ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), text) if "_x" in text else text


class Workbook:
    """content: bytes, or a file that can be searched, of which only what is asked for is unpacked."""

    def __init__(self, content):
        self.zip = zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content)
        book = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        self.sheets = [(s.get("name"), targets[s.get(_REL)].lstrip("/").removeprefix("xl/")) for s in book.iter(f"{_NS}sheet")]

    @functools.cached_property
    def strings(self) -> list[str]:
        """The texts that cells share, read when the first cell needs one."""
        if "xl/sharedStrings.xml" not in self.zip.namelist():
            return []
        out = []
        with self.zip.open("xl/sharedStrings.xml") as f:
            for _, si in ElementTree.iterparse(f):
                if si.tag == f"{_NS}si":
                    out.append(_unescaped("".join(t.text or "" for t in si.iter(f"{_NS}t"))))
                    si.clear()
        return out

    @functools.cached_property
    def date_styles(self) -> set[int]:
        if "xl/styles.xml" not in self.zip.namelist():
            return set()
        root = ElementTree.fromstring(self.zip.read("xl/styles.xml"))
        own = {int(f.get("numFmtId")) for f in root.iter(f"{_NS}numFmt") if _is_date_format(f.get("formatCode", ""))}
        cells = root.find(f"{_NS}cellXfs")
        return {i for i, x in enumerate(cells if cells is not None else []) if int(x.get("numFmtId", 0)) in own | _DATES}

    def typed(self, cell: ElementTree.Element) -> tuple[str, str, float | None, datetime.datetime | None, bool | None]:
        """(kind, text, number, moment, truth) of a cell; kind: blank, text, number, date, boolean or error."""
        text, kind, v = self.text(cell), cell.get("t"), cell.find(f"{_NS}v")
        if kind in ("inlineStr", "s", "str"):
            return ("text" if text else "blank"), text, None, None, None
        if v is None or v.text is None:
            return "blank", "", None, None, None
        if kind == "b":
            return "boolean", text, None, None, v.text == "1"
        if kind == "e":
            return "error", text, None, None, None
        number = float(v.text)
        if int(cell.get("s", 0)) in self.date_styles:
            return "date", text, number, datetime.datetime(1899, 12, 30) + datetime.timedelta(days=number), None
        return "number", text, number, None, None

    def text(self, cell: ElementTree.Element) -> str:
        kind = cell.get("t")
        if kind == "inlineStr":
            return _unescaped("".join([t.text or "" for t in cell.iter(_T)]))
        v = cell.find(_V)
        if v is None or v.text is None:
            return ""
        if kind == "s":
            return self.strings[int(v.text)]
        if kind == "b":
            return "true" if v.text == "1" else "false"
        if kind in ("str", "e"):
            return _unescaped(v.text)
        number = float(v.text)
        if int(cell.get("s", 0)) in self.date_styles:
            return _day(number)
        return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)

    def entry(self, sheet: str | None = None) -> str:
        """Where in the archive the sheet of that name is, case aside, or the first one."""
        named = [part for name, part in self.sheets if sheet is None or name.lower() == sheet.lower()]
        if not named:
            raise ValueError(f"no sheet {sheet!r} among {[name for name, _ in self.sheets]}")
        return f"xl/{named[0]}"

    @staticmethod
    def cells(row: ElementTree.Element) -> dict[int, ElementTree.Element]:
        """Position -> cell."""
        return {_column(r) if (r := c.get("r")) else i: c for i, c in enumerate(row.iter(_C))}

    def rows(self, sheet: str | None = None, cell=None) -> Iterator[tuple[int, dict[int, str]]]:
        """(row number, position -> text, or what cell() makes of it) of the sheet of that name, case aside, or of the first one."""
        cell = cell or self.text
        with self.zip.open(self.entry(sheet)) as f:
            at = 0
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{_NS}row":
                    continue
                at = int(row.get("r", at + 1))
                yield at, {i: cell(c) for i, c in self.cells(row).items()}
                row.clear()


def headers(book: Workbook, sheet: str | None, header_row: int, trimmed: bool, blank: bool = False) -> dict[int, str]:
    """Position -> header; positions without one are left out, or with blank are blank up to the sheet's last used position."""
    found: dict[int, str] = {}
    last = -1
    for at, cells in book.rows(sheet):
        last = max(last, *cells) if cells else last
        if at == header_row:
            found = {i: t for i, h in cells.items() if (t := h.strip() if trimmed else h).strip()}
        if at >= header_row and not blank:
            break
    return {i: found.get(i, "") for i in range(last + 1)} if blank else found


def _mapped(spark: SparkSession, path: str, rows_of: Callable[[Workbook], Iterator[tuple]], schema: str) -> DataFrame:
    """(file, ...) of what rows_of() makes of each workbook under path, in batches of BATCH rows."""
    types = spark.createDataFrame([], schema).schema
    kinds = [pa.string(), *(ARROW[f.dataType.typeName()] for f in types.fields[1:])]

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = rows_of(Workbook(content))
                while part := list(itertools.islice(rows, BATCH)):
                    columns = [[file] * len(part), *map(list, zip(*part, strict=True))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=types.names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, types)


def read_headers(spark: SparkSession, path: str, sheet: str | None = None, header_row: int = 1, trimmed: bool = True, blank: bool = False) -> DataFrame:
    """(file, position, header) of each workbook under path; positions from 1, those without a header only with blank."""
    return _mapped(spark, path, lambda book: ((i + 1, h) for i, h in sorted(headers(book, sheet, header_row, trimmed, blank).items())), "file string, position long, header string")


def read_cells(spark: SparkSession, path: str, sheet: str | None = None, header_row: int = 1) -> DataFrame:
    """Typed cells below the header row: file, row, position, header, kind (blank cells are left out), text, number, moment, truth. A position without a header is named column<n>."""

    def rows_of(book: Workbook) -> Iterator[tuple]:
        heads = headers(book, sheet, header_row, True)
        for at, cells in book.rows(sheet, book.typed):
            if at > header_row:
                for i, (kind, *value) in sorted(cells.items()):
                    if kind != "blank":
                        yield (at, i + 1, heads.get(i, f"column{i + 1}"), kind, *value)

    return _mapped(spark, path, rows_of, "file string, row long, position long, header string, kind string, text string, number double, moment timestamp_ntz, truth boolean")


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, header_row: int = 1, trimmed: bool = True, nameless: bool = False) -> DataFrame:
    """The rows below the header row: `_file`, `_row` (from 1) and a text column for each header.

    Of headers that repeat the last counts. Rows blank in all named columns are dropped. Only headers,
    each once, are read ahead of the rows. nameless: positions without a header are columns too, named
    column<n>.
    """
    found = read_headers(spark, path, sheet, header_row, trimmed, blank=nameless)
    name = F.when(F.col("header") == "", F.concat(F.lit("column"), F.col("position").cast("string"))).otherwise(F.col("header"))
    first = found.select("file", "position", name.alias("header")).groupBy("header").agg(F.min(F.struct("file", "position")).alias("at"))
    names = [r.header for r in first.orderBy("at").select("header").collect()]
    schema = "_file string, _row long" + "".join(f", `{n.replace('`', '``')}` string" for n in names)

    def rows_of(book: Workbook) -> Iterator[tuple]:
        heads = headers(book, sheet, header_row, trimmed, blank=nameless)
        heads = {i: h or f"column{i + 1}" for i, h in heads.items()}
        for at, cells in book.rows(sheet):
            row = {heads[i]: t for i, t in sorted(cells.items()) if i in heads}
            if at > header_row and any(t.strip() for t in row.values()):
                yield (at, *(row.get(n, "") for n in names))

    return _mapped(spark, path, rows_of, schema)
