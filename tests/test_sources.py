"""Sheets, newest files, publishing and the landing stream, on files made here."""

import zipfile

import pytest
from pyspark.sql import functions as F

from tallyline.sources import files, sheet
from tallyline.streaming import landing


def workbook(path, rows, name="Data"):
    """A workbook with one sheet; rows: row number -> cells (None leaves a cell out)."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    cell = lambda at, i, v: f'<c r="{chr(65 + i)}{at}" s="1"><v>{v[1]}</v></c>' if isinstance(v, tuple) else f'<c r="{chr(65 + i)}{at}"><v>{v}</v></c>' if isinstance(v, (int, float)) else f'<c r="{chr(65 + i)}{at}" t="inlineStr"><is><t>{v}</t></is></c>'
    data = "".join(f'<row r="{at}">{"".join(cell(at, i, v) for i, v in enumerate(cells) if v is not None)}</row>' for at, cells in rows.items())
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{data}</sheetData></worksheet>")
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')


def test_sheet(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {1: ["title"], 5: [" Id ", "Amount", None, "When", "Amount"], 6: ["k1", 10, "x", ("d", 45000), 1.5], 7: [" "], 9: ["k2", None, None, None, "7"]})
    rows = sheet.read_sheet(spark, str(tmp_path), header_row=5)
    assert rows.columns == ["_file", "_row", "Id", "Amount", "When"]
    assert sorted(tuple(r)[1:] for r in rows.collect()) == [(6, "k1", "1.5", "15/03/2023"), (9, "k2", "7", "")]
    heads = sheet.read_headers(spark, str(tmp_path), "data", 5, trimmed=False)
    assert [(r.position, r.header) for r in heads.orderBy("position").collect()] == [(1, " Id "), (2, "Amount"), (4, "When"), (5, "Amount")]
    heads = sheet.read_headers(spark, str(tmp_path), "data", 5, blank=True)
    assert [(r.position, r.header) for r in heads.orderBy("position").collect()] == [(1, "Id"), (2, "Amount"), (3, ""), (4, "When"), (5, "Amount")]
    wide = sheet.read_sheet(spark, str(tmp_path), header_row=5, nameless=True)
    assert wide.columns == ["_file", "_row", "Id", "Amount", "column3", "When"] and [r.column3 for r in wide.orderBy("_row").collect()] == ["x", ""]
    cells = [(r.row, r.header, r.kind, r.text, r.number, r.moment and r.moment.year) for r in sheet.read_cells(spark, str(tmp_path), header_row=5).orderBy("row", "position").collect()]
    assert cells == [(6, "Id", "text", "k1", None, None), (6, "Amount", "number", "10", 10.0, None), (6, "column3", "text", "x", None, None), (6, "When", "date", "15/03/2023", 45000.0, 2023), (6, "Amount", "number", "1.5", 1.5, None), (7, "Id", "text", " ", None, None), (9, "Id", "text", "k2", None, None), (9, "Amount", "text", "7", None, None)]
    with pytest.raises(Exception, match="no sheet"):
        sheet.read_sheet(spark, str(tmp_path), "other")


def test_newest(spark, tmp_path):
    for name in ("DS_FTX_20250101_000000.xlsx", "DS_FTX_20240101_000000_20260101_000000.xlsx", "~$DS_FTX_20990101_000000.xlsx", "old.xlsx"):
        (tmp_path / name).write_bytes(b"x")
    found = files.listed(spark, str(tmp_path))
    assert files.newest(found).endswith("DS_FTX_20240101_000000_20260101_000000.xlsx")
    codes = found.select(files.report_code(F.col("name"), ["DS_LTX", "DS_FTX"]).alias("c")).collect()
    assert sorted(str(r.c) for r in codes) == ["DS_FTX", "DS_FTX", "None"]
    with pytest.raises(FileNotFoundError):
        files.newest(found.limit(0))
    for name in ("ds_ftx_1.xlsx", "DS_FTX_compare_result_20990101_000000.xlsx", "AUTOMATION_SUMMARY_DS_FTX.xlsx", "DS_FTX_20990101_000000.xls"):
        (tmp_path / name).write_bytes(b"x")
    assert files.newest_report(spark, str(tmp_path), "DS_FTX", by_name=True).endswith("20260101_000000.xlsx")
    left = files.listed(spark, str(tmp_path), code="DS_FTX", without=files.RESULTS)
    assert sorted(r.name for r in left.collect()) == ["DS_FTX_20240101_000000_20260101_000000.xlsx", "DS_FTX_20250101_000000.xlsx", "ds_ftx_1.xlsx"]


def test_publish(spark, tmp_path):
    rows = spark.range(3)
    path = files.publish(rows, str(tmp_path), "DS_FTX", "1")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        files.publish(rows, str(tmp_path), "DS_FTX", "1")
    at = f"{tmp_path}/report=DS_FTX/run=2"
    for other in (at, f"{at}/", f"file:{at}", f"file://{at}/part", f"{tmp_path}", f"{tmp_path}/x/../report=DS_FTX/run=2"):
        with pytest.raises(ValueError, match="is an input"):
            files.publish(rows, str(tmp_path), "DS_FTX", "2", inputs=(other,))
    assert files.publish(rows, str(tmp_path), "DS_FTX", "1", another_name=True).endswith("run=1_01") and files.publish(rows, str(tmp_path), "DS_FTX", "1", another_name=True, inputs=(f"{at}0",)).endswith("run=1_02")


def test_landing(spark, tmp_path):
    run = lambda: landing.reconcile_arrivals(spark, str(tmp_path / "in"), "id long", lambda d: d.where("id % 2 = 0"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    spark.range(10).write.parquet(str(tmp_path / "in" / "a"))
    (tmp_path / "flat").mkdir()
    for part in (tmp_path / "in" / "a").glob("*.parquet"):
        part.rename(tmp_path / "in" / part.name)
    run()
    run()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 2, 4, 6, 8]


def test_names_by_their_numbers(spark):
    rows = [(n, n, None, None) for n in ("report 9.xlsx", "Report 10.xlsx", "report 010.xlsx", "report 2.xlsx", "a10b2", "a10b10", "a9b99")]
    listed = spark.createDataFrame(rows, "path string, name string, stamp string, modified timestamp")
    assert files.newest(listed.where("name like '%eport%'")).lower() in ("report 10.xlsx", "report 010.xlsx") and files.newest(listed.where("name in ('report 9.xlsx', 'report 2.xlsx')")) == "report 9.xlsx"
    assert [r.name for r in listed.where("name like 'a%'").orderBy(files.numeric_name(F.col("name"))).collect()] == ["a9b99", "a10b2", "a10b10"]


def test_two_writers_get_two_names(spark, tmp_path):
    """Writers at the same time, and one that has died, each have their own name; nothing but their folders is left."""
    import concurrent.futures
    import threading

    at, ready = f"{tmp_path}/report=X/run=1", threading.Barrier(6)

    def write(_):
        with files.claimed(spark, at) as name:
            ready.wait()
            spark.range(1).write.parquet(name)
            return name

    with concurrent.futures.ThreadPoolExecutor(6) as pool:
        names = list(pool.map(write, range(6)))
    assert sorted(names) == [at, *(f"{at}_{i:02d}" for i in range(1, 6))]
    assert sorted(p.name for p in (tmp_path / "report=X").iterdir() if not p.name.startswith(".")) == sorted(n.rpartition("/")[2] for n in names)
    (tmp_path / "report=X" / "_claim-run=1_06").touch()
    assert files.publish(spark.range(1), str(tmp_path), "X", "1", another_name=True) == f"{at}_07"
    with pytest.raises(ZeroDivisionError), files.claimed(spark, at) as name:
        raise ZeroDivisionError(name)
    assert files.publish(spark.range(1), str(tmp_path), "X", "1", another_name=True) == f"{at}_08"
    with pytest.raises(FileExistsError), files.claimed(spark, at, most=5):
        pass
