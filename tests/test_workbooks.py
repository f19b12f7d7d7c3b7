"""Workbooks: round trips, files as spreadsheet programs write them, cases."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from supportlens.sources import workbooks as wb
from supportlens.sources.tables import read_any, read_table

from .conftest import SF_SMALL

MAIN = wb._MAIN
TEXTS = ["plain", "", " edge ", "a\nb\r\nc\td", "\x00\x0b\x1f￾", "<&>\"'", "_x0041_ _x000D_ _x", "日本 😀", "x" * 40_000,
         "TRUE", "1.50", "=1+1"]


def save(tmp_path, books):
    for r in books.collect():
        (tmp_path / r.name).write_bytes(r.content)


def test_round_trip_through_files(spark, tmp_path):
    rows = [(i, float(i) / 3, i % 2 == 0, t) for i, t in enumerate(TEXTS)] + [(None, None, None, None), (99, -0.0, None, None)]
    df = spark.createDataFrame(rows, "n bigint, x double, b boolean, t string").repartition(2)
    save(tmp_path, wb.to_workbooks(df, rows_per_book=3))
    assert len(os.listdir(tmp_path)) >= 4
    got = wb.read_workbooks(spark, str(tmp_path), schema=df.schema).collect()
    # a row without any cell is no row
    assert sorted(map(tuple, got), key=str) == sorted([r for r in rows if any(v is not None for v in r)], key=str)
    text = wb.read_workbooks(spark, str(tmp_path))
    assert text.columns == ["n", "x", "b", "t"] and {f.dataType.simpleString() for f in text.schema} == {"string"}
    places = wb.read_workbooks(spark, str(tmp_path), places=True)
    assert places.select("workbook", "sheet_row").distinct().count() == len(rows) - 1
    assert places.agg(F.min("sheet_row"), F.max("sheet_row")).first() == (2, 4)


def test_conversations_read_back_equal(spark):
    turns = read_table(spark, SF_SMALL, "conversations")
    got = wb.parse_workbooks(wb.to_workbooks(turns, rows_per_book=100), schema=turns.schema, name_col="name")
    assert got.exceptAll(turns).count() == turns.exceptAll(got).count() == 0


def foreign(path, rows, shared="", styles="", workbook="", sheets=(("Notes", "notes"), ("Queries", "queries"))):
    """A workbook with shared strings, styles and two sheets, the second wanted."""
    rel = wb._REL
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{rel}">{workbook}<sheets>' + "".join(
            f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, (n, _) in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{wb._PACKAGE}/relationships">' + "".join(
            f'<Relationship Id="rId{i}" Target="{"/xl/" if i == 2 else ""}worksheets/{p}.xml"/>'
            for i, (_, p) in enumerate(sheets, 1)) + "</Relationships>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{shared}</sst>')
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>')
        for _, p in sheets:
            body = rows if p == "queries" else "<row r='1'><c r='A1' t='n'><v>0</v></c></row>"
            z.writestr(f"xl/worksheets/{p}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')


def test_files_of_spreadsheet_programs(spark, tmp_path):
    shared = ("<si><t> Queries </t></si><si><r><t>where </t></r><r><rPr/><t>is it</t></r><rPh><t>no</t></rPh></si>"
              "<si><t>When</t></si><si><t>a_x000D_b</t></si>")
    styles = ('<numFmts><numFmt numFmtId="170" formatCode="dd\\-mmm&quot;x&quot;"/>'
              '<numFmt numFmtId="171" formatCode="[Red]0.00&quot;days&quot;"/></numFmts><cellStyleXfs><xf numFmtId="14"/>'
              '</cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/>'
              '<xf numFmtId="22"/></cellXfs>')
    rows = ("<row r='1'><c r='A1' t='s'><v>0</v></c><c r='C1' t='s'><v>2</v></c><c r='D1' t='s'><v>2</v></c></row>"
            "<row r='3'><c r='A3' t='s'><v>1</v></c><c r='B3'><v>9</v></c><c r='C3' s='1'><v>45000</v></c>"
            "<c r='D3' s='4'><v>45000.75</v></c></row><row r='4'/><row r='5'><c r='C5' s='3'><v>1.5</v></c></row>"
            "<row r='6'><c r='A6' t='s'><v>3</v></c><c r='C6' t='e'><v>#N/A</v></c><c r='D6' t='b'><v>1</v></c></row>"
            "<row r='7'><c r='A7' t='str'><f>A1</f><v>made</v></c><c r='C7' s='2'><v>1</v></c><c r='AB7'><v>7</v></c></row>")
    foreign(tmp_path / "book.xlsx", rows, shared, styles)
    df = read_any(spark, str(tmp_path / "book.xlsx"), sheet="Queries")
    assert df.columns == ["Queries", "When", "When.1"]
    assert [tuple(r) for r in df.collect()] == [
        ("where is it", "2023-03-15", "2023-03-15 18:00:00"), (None, "1.5", None), ("a\rb", None, "TRUE"),
        ("made", "1899-12-31", None)]
    foreign(tmp_path / "book.xlsx", rows, shared, styles, '<workbookPr date1904="1"/>')
    assert read_any(spark, str(tmp_path / "book.xlsx"), sheet="Queries").first()[1] == "2027-03-16"
    with pytest.raises(Exception, match="no sheet"):
        read_any(spark, str(tmp_path / "book.xlsx"), sheet="Other").collect()


def test_files_with_different_columns(spark, tmp_path):
    one = spark.createDataFrame([("q1", "c1")], "Queries string, category string").coalesce(1)
    two = spark.createDataFrame([("r2", "q2")], "reply string, ` Queries ` string").coalesce(1)
    for n, df in (("a", one), ("b", two)):
        (tmp_path / n).mkdir()
        save(tmp_path / n, wb.to_workbooks(df))
    got = wb.read_workbooks(spark, str(tmp_path))
    assert set(got.columns) == {"Queries", "category", "reply"}
    assert sorted(map(tuple, got.select("Queries", "category", "reply").collect())) == [("q1", "c1", None), ("q2", None, "r2")]


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "a string")
    assert wb.to_workbooks(none).count() == 0
    foreign(tmp_path / "book.xlsx", "")
    assert wb.read_workbooks(spark, str(tmp_path), "Queries", "a string").count() == 0
    with pytest.raises(ValueError):
        wb.to_workbooks(none, rows_per_book=1 << 20)
    assert len(list(wb.sheet_rows(wb._book(["a"], iter([(1,)]), "S&'\""), "S&'\""))) == 2
    assert zipfile.ZipFile(io.BytesIO(wb._book(["a"], iter([]), "S"))).testzip() is None
