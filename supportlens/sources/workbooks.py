"""Workbooks (zipped sheet parts) as tables, read and written.

Reading: the files come through Spark's ``binaryFile`` source, so from any file
system Spark reads, one file per split; a task streams the wanted sheet part
of its file and emits batches of rows. A sheet holds 1,048,576 rows at most by
its format, so a file is a bounded piece of work; large inputs are many files.
The header row is looked up in the files' first rows, never guessed from data.

Writing: every task cuts its rows into workbooks of ``rows_per_book`` rows and
emits them as (name, content) rows, numbered by partition, so that a repeated
task makes the same names.

Cells are text: numbers as they are stored, booleans TRUE or FALSE, date-styled
numbers as ISO dates or timestamps, error cells and missing cells null. A
schema casts the columns. Defined cases: cells beyond the header's columns and
columns without a header cell are left out; a header that repeats gets ``.1``,
``.2`` at its end; rows without any cell are left out; columns that a file does
not have are null; a file without the sheet is an error; a sheet without a
header row has no rows. Texts keep every character: those that XML cannot hold
are written in the format's ``_xHHHH_`` form, and texts beyond the 32,767
characters that spreadsheet programs show are written whole.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice
from xml.etree.ElementTree import iterparse
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

ROWS_PER_BOOK = 100_000
BATCH = 2_000  # rows that a task holds

# Fixed values of the file format.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}  # numbers of the built-in date and time formats

_HELD = re.compile(r"_x([0-9A-Fa-f]{4})_")
_UNHELD = re.compile(r"[\x00-\x08\x0B-\x1F￾￿]|_(?=x[0-9A-Fa-f]{4}_)")


def _plain(text: str) -> str:
    return _HELD.sub(lambda m: chr(int(m[1], 16)), text) if "_x" in text else text


def _kept(text: str) -> str:
    return escape(_UNHELD.sub(lambda m: f"_x{ord(m[0]):04X}_", text))


# -- reading ----------------------------------------------------------------------

def _elements(book: zipfile.ZipFile, part: str, *tags: str) -> Iterator:
    """The elements of these names as they end, each let go of after its use."""
    with book.open(part) as f:
        wanted = {f"{{{_MAIN}}}{t}" for t in tags}
        path = []
        for event, e in iterparse(f, ("start", "end")):
            if event == "start":
                path.append(e)
                continue
            path.pop()
            if e.tag in wanted:
                yield e
                e.clear()
                if path:
                    path[-1].remove(e)


def _string(e) -> str:
    """The text of a string item, phonetic hints left out."""
    runs = [t.text or "" for t in e.iterfind(f"{{{_MAIN}}}t")]
    runs += [t.text or "" for t in e.iterfind(f"{{{_MAIN}}}r/{{{_MAIN}}}t")]
    return _plain("".join(runs))


def _sheet_part(book: zipfile.ZipFile, sheet: str | None) -> str:
    """The part of the named sheet, of the first one for None."""
    names = [(e.get("name"), e.get(f"{{{_REL}}}id")) for e in _elements(book, "xl/workbook.xml", "sheet")]
    found = [rid for name, rid in names if sheet is None or name == sheet]
    if not found:
        raise ValueError(f"no sheet {sheet!r} among {[n for n, _ in names]}")
    with book.open("xl/_rels/workbook.xml.rels") as f:
        target = next(e.get("Target") for _, e in iterparse(f) if e.get("Id") == found[0])
    return target.lstrip("/") if target.startswith("/") else "xl/" + target


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date or a time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    own, styles = set(), set()
    for e in _elements(book, "xl/styles.xml", "numFmt", "cellXfs"):
        if e.tag.endswith("numFmt"):
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", e.get("formatCode", "").lower())
            if re.search(r"[ymdhs]", code):
                own.add(int(e.get("numFmtId")))
        else:
            styles = {i for i, x in enumerate(e) if int(x.get("numFmtId", 0)) in own | _DATE_FORMATS}
    return styles


def _date(serial: str, from_1904: bool) -> str:
    base = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
    at = base + timedelta(milliseconds=round(float(serial) * 86_400_000))
    return at.date().isoformat() if at.time() == datetime.min.time() else at.isoformat(sep=" ")


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(content: bytes, sheet: str | None = None) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number, {column: text}) of the rows of one sheet, streamed; only
    the shared strings of the file are held."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part = _sheet_part(book, sheet)
        shared = ([_string(e) for e in _elements(book, "xl/sharedStrings.xml", "si")]
                  if "xl/sharedStrings.xml" in book.namelist() else [])
        dates = _date_styles(book)
        late = any(e.get("date1904") in ("1", "true") for e in _elements(book, "xl/workbook.xml", "workbookPr"))
        last = 0
        for row in _elements(book, part, "row"):
            last = int(row.get("r") or last + 1)
            cells, at = {}, -1
            for c in row:
                at = _column(c.get("r")) if c.get("r") else at + 1
                kind, v = c.get("t", "n"), c.find(f"{{{_MAIN}}}v")
                if kind == "inlineStr":
                    held = c.find(f"{{{_MAIN}}}is")
                    cells[at] = _string(held) if held is not None else ""
                elif v is None or kind == "e":
                    continue
                elif kind == "s":
                    cells[at] = shared[int(v.text)]
                elif kind == "str":
                    cells[at] = _plain(v.text or "")
                elif kind == "b":
                    cells[at] = "TRUE" if v.text == "1" else "FALSE"
                elif v.text:
                    cells[at] = _date(v.text, late) if kind == "n" and int(c.get("s", 0)) in dates else v.text
            if cells:
                yield last, cells


def _header(cells: dict[int, str]) -> dict[int, str]:
    """Column numbers and trimmed names of a header row."""
    names, seen = {}, {}
    for i in sorted(cells):
        name = cells[i].strip()
        if name:
            n = seen[name] = seen.get(name, -1) + 1
            names[i] = f"{name}.{n}" if n else name
    return names


def parse_workbooks(files: DataFrame, sheet: str | None = None, schema: str | T.StructType | None = None,
                    name_col: str = "path", content_col: str = "content", places: bool = False) -> DataFrame:
    """The rows of one sheet of every workbook in a (name, content) table.
    Without a schema the columns are those of all header rows, as text; with
    ``places`` the columns ``workbook`` and ``sheet_row`` come first."""
    ship_package(files.sparkSession)
    files = files.select(F.col(name_col).cast("string").alias("name"), F.col(content_col).alias("content"))
    if schema is None:
        def heads(batches):
            for batch in batches:
                for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    found = list(_header(next(sheet_rows(content.as_py(), sheet), (0, {}))[1]).items())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i for i, _ in found], pa.int32()), pa.array([n for _, n in found], pa.string())],
                        names=["i", "c"])

        # as many rows as the files have different columns
        found = files.mapInArrow(heads, "i int, c string").groupBy("c").agg(F.min("i").alias("i"))
        columns = [r.c for r in found.orderBy("i", "c").collect()]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = schema.names
    text = T.StructType([T.StructField("workbook", T.StringType()), T.StructField("sheet_row", T.LongType()),
                         T.StructField("cells", T.ArrayType(T.StringType()))])

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = sheet_rows(content.as_py(), sheet)
                at = {c: i for i, c in _header(next(rows, (0, {}))[1]).items()}
                places_ = [at.get(c) for c in columns]
                while some := list(islice(rows, BATCH)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some), pa.string()), pa.array([n for n, _ in some], pa.int64()),
                         pa.array([[None if i is None else cells.get(i) for i in places_] for _, cells in some],
                                  pa.list_(pa.string()))], names=text.names)

    rows = files.mapInArrow(run, text)
    cells = [F.col("cells")[i].cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
    return rows.select(*(["workbook", "sheet_row"] if places else []), *cells)


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None,
                   schema: str | T.StructType | None = None, places: bool = False) -> DataFrame:
    """One sheet (the first by default) of the workbooks under a path."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"{path}: no workbook there") from e
    return parse_workbooks(files, sheet, schema, places=places)


# -- writing ----------------------------------------------------------------------

def _cell(value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{_kept(str(value))}</t></is></c>'


def _letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _book(names: list[str], rows: Iterator[tuple], sheet: str) -> bytes:
    """One workbook of a single sheet, its rows streamed into the zip."""
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType='
        '"application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType='
        '"application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName='
        '"/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        "</Types>",
        "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" '
        f'Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name={quoteattr(sheet)} '
        'sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" '
        f'Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, xml in parts.items():
            book.writestr(zipfile.ZipInfo(name), '<?xml version="1.0" encoding="UTF-8"?>' + xml)
        with book.open(zipfile.ZipInfo("xl/worksheets/sheet1.xml"), "w", force_zip64=True) as f:
            f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            for n, row in enumerate([tuple(names)], 1):
                f.write(_row(n, row))
            for n, row in enumerate(rows, 2):
                f.write(_row(n, row))
            f.write(b"</sheetData></worksheet>")
    return out.getvalue()


def _row(n: int, row: tuple) -> bytes:
    cells = "".join(_cell(v).replace("<c", f'<c r="{_letters(i)}{n}"', 1) for i, v in enumerate(row))
    return f'<row r="{n}">{cells}</row>'.encode("utf-8")


def to_workbooks(df: DataFrame, sheet: str = "Sheet1", rows_per_book: int = ROWS_PER_BOOK) -> DataFrame:
    """The rows as workbooks: (``name``, ``content``), ``rows_per_book`` rows
    each at most. Columns that are no number or boolean are written as text."""
    if not 0 < rows_per_book < 1 << 20:
        raise ValueError("a sheet holds a header and 1,048,575 rows")
    ship_package(df.sparkSession)
    plain = (T.NumericType, T.BooleanType, T.StringType)
    texts = df.select(*[F.col(f"`{f.name}`") if isinstance(f.dataType, plain) and not isinstance(
        f.dataType, T.DecimalType) else F.col(f"`{f.name}`").cast("string").alias(f.name) for f in df.schema])
    names = df.columns

    def run(batches):
        rows = (row for b in batches for row in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)]))
        part, n = TaskContext.get().partitionId(), 0
        for first in rows:
            book = _book(names, (r for some in ([first], islice(rows, rows_per_book - 1)) for r in some), sheet)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part:05d}-{n:04d}.xlsx"]), pa.array([book], pa.binary())], names=["name", "content"])
            n += 1

    return texts.mapInArrow(run, "name string, content binary")
