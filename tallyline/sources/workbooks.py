"""Workbooks as a data source: spark.read.format("sheet") and df.write.format("sheet").

Reading takes a part of a sheet in each task: parts are ranges of the sheet's own text, as stored in the
workbook, so that one large sheet is many tasks and no task holds a workbook. A task unpacks the sheet as a
stream, passes over the rows before its range without parsing them, and makes only the cells of the columns
that the schema names. Writing makes workbooks beside the target, one for each partition, or more where a
sheet is full; they appear all at once when all tasks have succeeded, and go when one has failed.

Paths are of any store that pyarrow's file systems read (local, HDFS, S3, ...).
"""

from __future__ import annotations

import datetime
import fnmatch
import io
import itertools
import operator
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .sheet import BATCH, Workbook, headers

#: Characters of a sheet's text that a task reads, unless the option `part` says otherwise; bytes unpacked at once.
PART, CHUNK = 32_000_000, 1 << 18
#: Rows of a sheet at most, the day that days are counted from, and the number of a date's cell style below.
MOST_ROWS, DAY_0, DATE_STYLE = 1_048_576, datetime.datetime(1899, 12, 30), 1
_BY_POSITION = operator.itemgetter(0)
#: Characters of rows that are packed at once.
WRITTEN = 1 << 16
_ROW = re.compile(rb"<((?:\w+:)?)row(?=[\s/>])[^>]*?(/?)>")
_NUMBER = re.compile(rb"""\sr=["'](\d+)["']""")
_CONTROL = re.compile(r"[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")


def store(path: str) -> tuple[pafs.FileSystem, str]:
    path = re.sub(r"^file:/(?!/)", "file:///", path)
    return pafs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][\w+.-]+:/", path) else (pafs.LocalFileSystem(), posixpath.abspath(path))


def listed(path: str) -> list[str]:
    """The workbooks of a path: a file, a folder's, or those that a pattern in the last part names; lock files are left out."""
    files, at = store(path)
    info = files.get_file_info(at)
    if info.type == pafs.FileType.File:
        return [at]
    folder, pattern = (at, "*.xlsx") if info.type == pafs.FileType.Directory else posixpath.split(at)
    found = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    names = sorted(f.path for f in found if f.type == pafs.FileType.File and fnmatch.fnmatch(f.base_name, pattern) and not f.base_name.startswith(("~$", "_", ".")))
    if not names:
        raise FileNotFoundError(f"no workbook at {path}")
    return names


@dataclass
class Part(InputPartition):
    """The rows of a workbook's sheet whose tag begins at the places start to end of its text."""

    path: str
    start: int
    end: int


class Stream:
    """The rows of a sheet, unpacked piece by piece."""

    def __init__(self, book: Workbook, sheet: str | None):
        self.book, self.entry = book, book.entry(sheet)

    def rows(self, start: int, end: int, least: int = 0) -> Iterator[tuple[int, ElementTree.Element]]:
        """(row number, element) of rows that begin within the range and have a number above least; those before it are counted only."""
        number, place, rest, head = 0, 0, b"", None
        with self.book.zip.open(self.entry) as f:
            while True:
                piece = f.read(CHUNK)
                rest += piece
                if head is None:
                    found = re.search(rb"<(\w+:)?worksheet[^>]*>", rest)
                    if not found:
                        if not piece:
                            return
                        continue
                    head = found[0], b"</" + (found[1] or b"") + b"worksheet>"
                if place + len(rest) <= start and (gone := self.passed(rest, head[1][2:-10])):
                    number, done = gone
                    place, rest = place + done, rest[done:]
                    continue
                done, wanted = 0, []
                for m in _ROW.finditer(rest):
                    if place + m.start() >= end:
                        yield from self.parsed(head, wanted)
                        return
                    close = m.end() if m[2] else rest.find(b"</" + m[1] + b"row>", m.end())
                    if close < 0:
                        break
                    own = _NUMBER.search(rest, m.start(), m.end())
                    number = int(own[1]) if own else number + 1
                    done = close if m[2] else close + len(m[1]) + 6
                    if place + m.start() >= start and number > least:
                        wanted.append((number, rest[m.start() : done]))
                yield from self.parsed(head, wanted)
                # An unfinished row is kept for the next piece, and else what may be the beginning of a tag.
                if not done:
                    first = _ROW.search(rest)
                    done = first.start() if first else max(0, rest.rfind(b"<"))
                place, rest = place + done, rest[done:]
                if not piece:
                    return

    @staticmethod
    def passed(rest: bytes, prefix: bytes) -> tuple[int, int] | None:
        """The number of the last whole row of a piece that lies before the range, and where it ends; none where that row doesn't tell its number, so that rows must be counted."""
        close = rest.rfind(b"</" + prefix + b"row>")
        m = _ROW.match(rest, rest.rfind(b"<" + prefix + b"row", 0, max(0, close))) if close > 0 else None
        own = _NUMBER.search(rest, m.start(), m.end()) if m and not m[2] else None
        return (int(own[1]), close + len(prefix) + 6) if own else None

    @staticmethod
    def parsed(head: tuple[bytes, bytes], rows: list[tuple[int, bytes]]) -> Iterator[tuple[int, ElementTree.Element]]:
        if rows:
            for (number, _), element in zip(rows, ElementTree.fromstring(head[0] + b"".join(r for _, r in rows) + head[1]), strict=True):
                yield number, element


class SheetReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, options
        if wrong := [f.name for f in schema.fields if f.dataType != (T.LongType() if f.name == "_row" else T.StringType())]:
            raise ValueError(f"columns of a sheet are text, and _row is a long: {wrong}")

    def partitions(self) -> list[Part]:
        """Of each workbook only the directory of its archive is read."""
        size, out = int(self.options.get("part", PART)), []
        for path in listed(self.options["path"]):
            with opened(self.options["path"], path) as f:
                book = Workbook(f)
                total = book.zip.getinfo(book.entry(self.options.get("sheet"))).file_size
            out += [Part(path, at, at + size) for at in range(0, max(1, total), size)]
        return out

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        names = self.schema.names
        kinds = [pa.int64() if n == "_row" else pa.string() for n in names]
        header_row, sheet = int(self.options.get("header_row", 1)), self.options.get("sheet")
        with opened(self.options["path"], part.path) as f:
            book = Workbook(f)
            heads = named(book, self.options)
            rows = self.values(book, Stream(book, sheet).rows(part.start, part.end, header_row), heads, set(names))
            while some := list(itertools.islice(rows, BATCH)):
                made = [[part.path if n == "_file" else number if n == "_row" else cells.get(n, "") for number, cells in some] for n in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds, strict=True)], names=names)

    @staticmethod
    def values(book: Workbook, rows, heads: dict[int, str], names: set[str]) -> Iterator[tuple[int, dict[str, str]]]:
        """(row number, column -> text) of the rows that aren't blank in all named columns, for the asked columns only. Of headers that repeat the last cell counts."""
        for number, row in rows:
            cells = {i: c for i, c in sorted(book.cells(row).items(), key=_BY_POSITION) if i in heads}
            asked = {h: book.text(c) for h, c in {heads[i]: c for i, c in cells.items()}.items() if h in names}
            if any(map(str.strip, asked.values())) or any(book.text(c).strip() for c in dict((heads[i], c) for i, c in cells.items() if heads[i] not in names).values()):
                yield number, asked


def opened(like: str, path: str):
    """A file of the same store, as one that can be searched."""
    return store(like)[0].open_input_file(path)


def named(book: Workbook, options: dict) -> dict[int, str]:
    """Position -> column of a workbook, as the options have it."""
    nameless = str(options.get("nameless", "false")).lower() == "true"
    trimmed = str(options.get("trimmed", "true")).lower() == "true"
    found = headers(book, options.get("sheet"), int(options.get("header_row", 1)), trimmed, blank=nameless)
    return {i: h or f"column{i + 1}" for i, h in found.items()}


# ---- writing


def column_letters(i: int) -> str:
    out, i = "", i + 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def cell(at: str, value) -> str:
    """A cell's text in the sheet; nothing for null. Characters that a workbook can't hold are written as it writes them, _xHHHH_."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, datetime.date):
        moment = value if isinstance(value, datetime.datetime) else datetime.datetime(value.year, value.month, value.day)
        return f'<c r="{at}" s="{DATE_STYLE}"><v>{(moment.replace(tzinfo=None) - DAY_0) / datetime.timedelta(days=1)!r}</v></c>'
    if isinstance(value, (int, float)) and value == value and abs(value) != float("inf"):
        return f'<c r="{at}"><v>{value!r}</v></c>'
    shown = str(value)
    if _CONTROL.search(shown):
        shown = _CONTROL.sub(lambda m: f"_x{ord(m[0]):04X}_", shown)
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(shown)}</t></is></c>'


_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_DOCUMENT = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"


class SheetFile:
    """A workbook with one sheet, written as a stream."""

    def __init__(self, out, names: list[str], sheet: str):
        self.letters, self.rows = [column_letters(i) for i in range(len(names))], 0
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
        put = lambda name, text: self.zip.writestr(name, f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>{text}')
        parts = "".join(f'<Override PartName="/xl/{p}.xml" ContentType="{_TYPE}.{t}+xml"/>' for p, t in (("workbook", "sheet.main"), ("worksheets/sheet1", "worksheet"), ("styles", "styles")))
        put("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>{parts}</Types>')
        links = lambda *to: f'<Relationships xmlns="{_PACKAGE}/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{_DOCUMENT}/{kind}" Target="{at}"/>' for i, (kind, at) in enumerate(to, 1)) + "</Relationships>"
        put("_rels/.rels", links(("officeDocument", "xl/workbook.xml")))
        put("xl/_rels/workbook.xml.rels", links(("worksheet", "worksheets/sheet1.xml"), ("styles", "styles.xml")))
        put("xl/workbook.xml", f'<workbook {_MAIN} xmlns:r="{_DOCUMENT}"><sheets><sheet name="{escape(sheet, {chr(34): "&quot;"})}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        put("xl/styles.xml", f'<styleSheet {_MAIN}><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>')
        self.sheet = self.zip.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.sheet.write(f"<worksheet {_MAIN}><sheetData>".encode())
        self.held, self.size = [], 0
        self.row(names)

    def row(self, values) -> None:
        self.rows += 1
        self.held.append(f'<row r="{self.rows}">{"".join([cell(f"{c}{self.rows}", v) for c, v in zip(self.letters, values, strict=True)])}</row>')
        self.size += len(self.held[-1])
        if self.size >= WRITTEN:
            self.flush()

    def flush(self) -> None:
        self.sheet.write("".join(self.held).encode("utf-8", "surrogatepass"))
        self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        last = f"{self.letters[-1]}{self.rows}" if self.letters else "A1"
        self.sheet.write(f'</sheetData><autoFilter ref="A1:{last}"/></worksheet>'.encode())
        self.sheet.close()
        self.zip.close()


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class SheetWriter(DataSourceArrowWriter):
    """Tasks write into a folder beside the target, under names of their attempt; the commit takes those of the attempts that succeeded and renames the folder."""

    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.path, self.sheet, self.overwrite = options["path"].rstrip("/"), options.get("sheet", "Data"), overwrite
        self.columns, self.most = schema.names, min(MOST_ROWS, int(options.get("rows", MOST_ROWS)))
        self.files, self.at = store(self.path)
        if len(schema.names) > 16_384 or self.most < 2:
            raise ValueError("a sheet has 16,384 columns at most, and a row below its header")
        if not overwrite and self.files.get_file_info(self.at).type != pafs.FileType.NotFound:
            raise FileExistsError(f"{self.path} exists")
        folder, name = posixpath.split(self.at)
        self.beside = f"{folder}/_{name}-{uuid.uuid4().hex}"

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "files"}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.files = store(self.path)[0]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        context, names, held, rows = TaskContext.get(), [], None, 0
        self.files.create_dir(self.beside, recursive=True)
        try:
            for batch in batches:
                for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if held is None or held[0].rows == self.most:
                        if held:
                            self.finish(*held)
                        names.append(f"part-{context.partitionId():05d}-{len(names):04d}-{context.taskAttemptId()}.xlsx")
                        out = self.files.open_output_stream(f"{self.beside}/{names[-1]}")
                        held = SheetFile(Counted(out), self.columns, self.sheet), out
                    held[0].row(values)
                    rows += 1
        finally:
            if held:
                self.finish(*held)
        return Written(names)

    @staticmethod
    def finish(made: SheetFile, out) -> None:
        made.close()
        out.close()

    def commit(self, messages: list[Written | None]) -> None:
        """The workbooks get names without their attempt, in the order of partitions; a result without rows is one workbook with a header."""
        ready = f"{self.beside}-ready"
        self.files.create_dir(ready, recursive=True)
        for name in (n for m in messages if m for n in m.names):
            self.files.move(f"{self.beside}/{name}", f"{ready}/{name.rpartition('-')[0]}.xlsx")
        if not any(m and m.names for m in messages):
            with self.files.open_output_stream(f"{ready}/part-00000-0000.xlsx") as out:
                SheetFile(Counted(out), self.columns, self.sheet).close()
        self.abort([])
        if self.overwrite and self.files.get_file_info(self.at).type != pafs.FileType.NotFound:
            self.files.move(self.at, f"{ready}-before")
        self.files.move(ready, self.at)
        self.drop(f"{ready}-before")

    def abort(self, messages: list[Written | None]) -> None:
        self.drop(self.beside)

    def drop(self, folder: str) -> None:
        kind = self.files.get_file_info(folder).type
        if kind == pafs.FileType.Directory:
            self.files.delete_dir(folder)
        elif kind == pafs.FileType.File:
            self.files.delete_file(folder)


class Counted(io.RawIOBase):
    """A stream that can't be searched, as archives are written to."""

    def __init__(self, out):
        self.out, self.at = out, 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        self.at += len(data)
        return len(data)

    def flush(self) -> None:
        if not self.out.closed:
            self.out.flush()


class SheetSource(DataSource):
    """Options: path, sheet (by name, case aside; the first one by default), header_row (1), trimmed (headers, true), nameless (columns without a header are column<n>, false), part; for writing sheet and rows (of a sheet at most).

    A schema that is given reads only its columns, `_file` and `_row` among them, and looks at no workbook
    ahead; without one it is that of all headers, `_file` and `_row` first.
    """

    @classmethod
    def name(cls) -> str:
        return "sheet"

    def schema(self) -> T.StructType:
        names: dict[str, None] = {}
        for path in listed(self.options["path"]):
            with opened(self.options["path"], path) as f:
                names |= dict.fromkeys(h for _, h in sorted(named(Workbook(f), self.options).items()))
        return T.StructType([T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType()), *(T.StructField(n, T.StringType()) for n in names)])

    def reader(self, schema: T.StructType) -> SheetReader:
        return SheetReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> SheetWriter:
        return SheetWriter(schema, dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(SheetSource)
