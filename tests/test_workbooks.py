"""Workbooks as a data source: ranges of one sheet, columns that aren't asked for, writing whole or not at all."""

import datetime
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyline.sources import files, sheet, workbooks

from test_sources import workbook


def read(spark, path, schema=None, **options):
    workbooks.register(spark)
    reader = spark.read.format("sheet").options(**options)
    return (reader.schema(schema) if schema else reader).load(str(path))


def plain(df):
    return sorted(tuple(str(x) for x in r[1:]) for r in df.collect())


def large(path, n=500, seed=1):
    r = random.Random(seed)
    rows = {5: [" Id ", "Amount", None, "When", "Amount"]} | {6 + i + i // 9: [f"k{i}", r.choice([i, 1.5, None]), "x" * r.randint(0, 40), ("d", 45000 + i), r.choice([None, " ", i])] for i in range(n)}
    workbook(path, rows | {2000: [None, None, "only without a header"], 2001: [" ", None, None, None, " "]})


def test_same_rows_in_any_ranges(spark, tmp_path):
    """One partition or hundreds, whatever the sheet's text is cut at: the rows of the reader of whole workbooks."""
    large(tmp_path / "a.xlsx")
    large(tmp_path / "b.xlsx", 40, seed=2)
    want = sheet.read_sheet(spark, str(tmp_path), header_row=5)
    for part in (10**9, 5_000, 777):
        got = read(spark, tmp_path, header_row=5, part=part)
        assert got.columns == want.columns and plain(got) == plain(want)
        assert got.rdd.getNumPartitions() == {10**9: 2, 5_000: got.rdd.getNumPartitions(), 777: got.rdd.getNumPartitions()}[part] and (part == 10**9 or got.rdd.getNumPartitions() > 10)
    for where in (f"file:{tmp_path}", f"file://{tmp_path}/a.xlsx"):
        assert read(spark, where, header_row=5).count() > 400
    assert plain(read(spark, tmp_path / "*.xlsx", header_row=5, nameless=True)) == plain(sheet.read_sheet(spark, str(tmp_path), header_row=5, nameless=True))
    assert plain(read(spark, tmp_path / "b.xlsx", header_row=5, trimmed=False, sheet="data")) == plain(sheet.read_sheet(spark, str(tmp_path / "b.xlsx"), "data", 5, trimmed=False))


def test_pieces_of_any_size(spark, tmp_path, monkeypatch):
    """Rows that run over the pieces that are unpacked, rows without a number, and a sheet with a prefix."""
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    large(tmp_path / "a.xlsx", 60)
    with zipfile.ZipFile(tmp_path / "a.xlsx") as z:
        parts = {n: z.read(n).decode() for n in z.namelist()}
    body = "".join(f"<x:row><x:c t='inlineStr'><x:is><x:t>v{i}</x:t></x:is></x:c></x:row>" for i in range(20))
    parts["xl/worksheets/sheet1.xml"] = f'<x:worksheet xmlns:x="{ns}"><x:sheetData><x:row/>{body}<x:row r="40" ><x:c t="n"><x:v>7</x:v></x:c></x:row></x:sheetData></x:worksheet>'
    with zipfile.ZipFile(tmp_path / "p.xlsx", "w") as z:
        for n, t in parts.items():
            z.writestr(n, t)
    for size in (16, 50, 1 << 18):
        monkeypatch.setattr(workbooks, "CHUNK", size)
        for name, least in (("a.xlsx", 5), ("p.xlsx", 2)):
            book = sheet.Workbook((tmp_path / name).read_bytes())
            total = book.zip.getinfo(book.entry()).file_size
            want = [(at, cells) for at, cells in book.rows() if at > least]
            for cuts in ([0, total], [0, 100, 101, total // 2, total], [*range(0, total, 61), total]):
                got = [(at, {i: book.text(c) for i, c in book.cells(row).items()}) for a, b in zip(cuts, cuts[1:], strict=False) for at, row in workbooks.Stream(book, None).rows(a, b, least)]
                assert got == want, (name, size, cuts)


def test_columns_that_are_not_asked_for(spark, tmp_path, monkeypatch):
    """A schema reads its columns alone, without a look at the headers ahead; cells of others aren't made but to tell a blank row."""
    large(tmp_path / "a.xlsx")
    got, want = read(spark, tmp_path, "When string, _row long", header_row=5), sheet.read_sheet(spark, str(tmp_path), header_row=5).select("When", "_row")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    book = sheet.Workbook((tmp_path / "a.xlsx").read_bytes())
    asked = []
    monkeypatch.setattr(book, "text", lambda c, f=book.text: (asked.append(c.get("r")[0]), f(c))[1])
    heads = {0: "Id", 1: "Amount", 3: "When", 4: "Amount"}
    rows = list(workbooks.SheetReader.values(book, workbooks.Stream(book, None).rows(0, 10**9, 5), heads, {"When"}))
    # All but the last two rows are filled in the asked column; the last is blank in all named ones.
    assert len(rows) == 500 and asked.count("D") == 500 and sum(a != "D" for a in asked) == 2
    with pytest.raises(Exception, match="columns of a sheet are text"):
        read(spark, tmp_path, "When date").collect()
    with pytest.raises(Exception, match="no workbook"):
        read(spark, tmp_path / "none*.xlsx").collect()
    assert read(spark, tmp_path, "Unheard string, _row long", header_row=5).where("Unheard != ''").count() == 0


def test_written_and_read_back(spark, tmp_path):
    odd = ["plain", " spaces ", "a\nb\tc", "a\rb", "\x01\x0b", "_x0041_", "_x", "<&>\"'", "é漢\U0001f600", "", "x" * 40_000, "1e5", "ไม่พบข้อมูล"]
    rows = spark.createDataFrame([(i, t, i / 4, i % 2 == 0, datetime.date(2020, 1, 1 + i), None) for i, t in enumerate(odd)], "n long, `text <1>` string, x double, truth boolean, day date, gone string").repartition(3)
    workbooks.register(spark)
    rows.write.format("sheet").mode("append").option("sheet", "A & B").save(str(tmp_path / "out"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    back = {r.n: r for r in read(spark, tmp_path / "out", sheet="a & b").collect()}
    for i, t in enumerate(odd):
        r = back[str(i)]
        # Blank cells and null ones are the same in a sheet.
        assert (r["text <1>"], r.x, r.truth, r.day, r.gone) == (t, str(i // 4) if i % 4 == 0 else repr(i / 4), str(i % 2 == 0).lower(), f"{1 + i:02d}/01/2020", "")
    with pytest.raises(Exception, match="exists"):
        rows.write.format("sheet").mode("append").save(str(tmp_path / "out"))
    rows.limit(1).write.format("sheet").mode("overwrite").save(str(tmp_path / "out"))
    assert read(spark, tmp_path / "out").count() == 1 and sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    rows.limit(0).write.format("sheet").mode("overwrite").save(str(tmp_path / "out"))
    assert read(spark, tmp_path / "out").columns[2:] == rows.columns and read(spark, tmp_path / "out").count() == 0


def test_full_sheets_and_order(spark, tmp_path):
    """A sheet that is full is followed by another one; sorted rows lie in the order of files and rows."""
    workbooks.register(spark)
    spark.range(1000).orderBy(F.desc("id")).write.format("sheet").mode("append").option("rows", 101).save(str(tmp_path / "out"))
    found = sorted((r._file, r._row, int(r.id)) for r in read(spark, tmp_path / "out").collect())
    assert [r[2] for r in found] == list(range(999, -1, -1)) and max(r[1] for r in found) == 101 and len({r[0] for r in found}) >= 10


def test_nothing_is_left_of_a_failed_write(spark, tmp_path):
    workbooks.register(spark)
    ok, bad = spark.range(100), spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no such row"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no such row"):
        bad.repartition(4).write.format("sheet").mode("append").save(str(tmp_path / "out"))
    assert list(tmp_path.iterdir()) == []
    ok.write.format("sheet").mode("append").save(str(tmp_path / "out"))
    with pytest.raises(Exception, match="no such row"):
        bad.write.format("sheet").mode("overwrite").save(str(tmp_path / "out"))
    assert [p.name for p in tmp_path.iterdir()] == ["out"] and read(spark, tmp_path / "out").count() == 100


def test_published_as_workbooks(spark, tmp_path):
    path = files.publish(spark.range(5), str(tmp_path), "DS_FTX", "1", kind="sheet")
    assert read(spark, path).count() == 5
    with pytest.raises(Exception, match="exists"):
        files.publish(spark.range(5), str(tmp_path), "DS_FTX", "1", kind="sheet")
    assert files.publish(spark.range(5), str(tmp_path), "DS_FTX", "1", kind="sheet", another_name=True).endswith("run=1_01")


def test_a_report_from_workbook_to_workbook(spark, tmp_path):
    """Sheets are read by ranges, reconciled, laid out in the order of their status and written as one workbook a partition, which hold that order."""
    from tallyline.plans import contracts as k, registry, stages

    heads = [k.TEST_ID, k.TEST_NO, k.FROM_CCY, k.SETTLED_CCY, k.TXN_DATE]
    workbook(tmp_path / "test.xlsx", {k.TEST_DATA_HEADER_ROW: heads} | {k.TEST_DATA_HEADER_ROW + 1 + i: [f"id{i}", i, "USD", "EUR", "01/02/2025"] for i in range(90)}, "DS_FTX")
    workbook(tmp_path / "report.xlsx", {1: ["Ref. TX No.", "Buy Currency Id", "Sell Currency Id", "Transaction Date"]} | {2 + i: [f"id{i}", "usd" if i % 3 else "JPY", "EUR", "01/02/2025"] for i in range(10, 120)}, "DS_FTX")
    test = read(spark, tmp_path / "test.xlsx", header_row=k.TEST_DATA_HEADER_ROW, sheet="ds_ftx", part=1500)
    report = read(spark, tmp_path / "report.xlsx", part=1500)
    results = registry.reconcile("DS_FTX", test, report)
    made = stages.result_sheet("DS_FTX", stages.output_rows(results, report, F.trim("`Ref. TX No.`")), report)
    path = files.publish(made, str(tmp_path / "out"), "DS_FTX", "1", kind="sheet", inputs=(str(tmp_path / "test.xlsx"), str(tmp_path / "report.xlsx")))
    rows = sorted((tuple(r) for r in read(spark, path).collect()), key=lambda r: r[:2])
    assert read(spark, path).columns[2:] == ["Test Script No.", "Result", "Remark", "Ref. TX No.", "Buy Currency Id", "Sell Currency Id", "Transaction Date"]
    order = [r[3] for r in rows]
    assert order == ["PASS"] * sum(i % 3 > 0 for i in range(10, 90)) + ["UNTAGGED"] * 30 + ["FAIL"] * sum(i % 3 == 0 for i in range(10, 90)) + ["MISSING"] * 10
    assert [r[5] for r in rows if r[3] == "FAIL"] == [f"id{i}" for i in range(12, 90, 3)] and rows[0][2:6] == ("10", "PASS", "", "id10")
