"""Validation before, and output and detail rows after a report's reconciliation."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators import compare, summary
from tallyline.plans import contracts as k, registry, reports, stages

from test_reports import sheet


def test_headers_and_cells(spark):
    contract = k.CONTRACTS["DS_PTX"]
    columns = [c for c in contract.test_data() if c not in ("Txn Date", "Fee Amount 2", "Payment rail")] + ["Transaction  date", "Fee Amount Type 2"]
    found = stages.check_headers(spark, columns, contract.test_data(), contract.fee_slots)
    out = {r.name: r.outcome for r in found.collect()}
    assert out["Txn Date"] == out["Fee Amount 2"] == "ALIAS" and out["Payment rail"] == "NO_SIMILAR_HEADER" and out[k.TEST_ID] == "FOUND"
    with pytest.raises(ValueError, match="Payment rail"):
        stages.require_headers(found)
    assert stages.fee_columns(["Fee Type 2", "fee  amount type 1", "Fee Amount 2", "Fee", "Fee Currency 2"]) == {1: {"amount": "fee  amount type 1"}, 2: {"type": "Fee Type 2", "amount": "Fee Amount 2", "currency": "Fee Currency 2"}}
    test = sheet(spark, [{k.TEST_ID: "a", "Txn Date": " ", "Fee Type 1": "T", "Fee Charge Account No. Type 1": None, "Fee Amount Type 1": "1"}])
    checked = stages.check_cells(test, contract)
    assert checked.columns == ["_file", "_row", "header", "value", "status", "remark"]
    assert {(r.status, r.remark) for r in checked.collect()} == {("FOUND", k.HAS_VALUE), ("EMPTY", k.REQUIRED_MESSAGE), ("INCOMPLETE_REQUIRED", k.REQUIRED_MESSAGE)}
    written = {}
    with pytest.raises(ValueError, match="missing headers"):
        stages.validate(test, test.columns[1:], contract, written.__setitem__)
    assert sorted(written) == ["cells", "headers"]
    full = [*contract.test_data()]
    assert stages.validate(sheet(spark, [dict.fromkeys(full)]), full, contract, written.__setitem__).where("status = 'EMPTY'").count() > 0
    cells = {r.header: r.status for r in checked.collect()}
    assert cells[k.TEST_ID] == "FOUND" and cells["Txn Date"] == "EMPTY" and cells["Fee account 1"] == "INCOMPLETE_REQUIRED" and cells["Fee type 1"] == "FOUND"


def test_output_and_details(spark):
    base = {k.FROM_CCY: "USD", k.SETTLED_CCY: "EUR", k.TXN_DATE: "1/2/2025", "Fee Type 2": "F", "Fee Amount 2": "3"}
    test = sheet(spark, [base | {k.TEST_ID: "a", k.TEST_NO: "1"}, base | {k.TEST_ID: "b", k.TEST_NO: "2"}, base | {k.TEST_ID: "c", k.TEST_NO: "3"}])
    row = {"Buy Currency Id": "USD", "Sell Currency Id": "EUR", "Transaction Date": "2025-02-01"}
    report = sheet(spark, [row | {"Ref. TX No.": "b", "Buy Currency Id": "X"}, row | {"Ref. TX No.": "x"}, row | {"Ref. TX No.": "a"}])
    results = reports.ftx(test, report)
    out = stages.output_rows(results, report, F.col("`Ref. TX No.`")).collect()
    assert [(r.key, r.status) for r in out] == [("a", "PASS"), ("x", "UNTAGGED"), ("b", "FAIL"), ("c", "MISSING")]
    made = stages.result_sheet("DS_FTX", stages.output_rows(results, report, F.col("`Ref. TX No.`")), report)
    assert made.columns == ["Test Script No.", "Result", "Remark", *(c for c in report.columns if c != "_row")] and [r["Test Script No."] for r in made.collect()] == ["1", None, "2", "3"]
    details = {r.key: (r.tier, r.test_row, [tuple(f) for f in r.fees]) for r in stages.detail_rows(results, test).collect()}
    assert details == {x: (1, 6 + i, [(2, "F", "", "3")]) for i, x in enumerate("abc")}
    summary.enforce(stages.repeated_tests(test), "repeated id")
    with pytest.raises(ValueError, match="repeated id"):
        summary.enforce(stages.repeated_tests(test.union(test)), "repeated id")


def test_summaries(spark):
    base = {k.FROM_CCY: "USD", k.SETTLED_CCY: "EUR", k.TXN_DATE: "1/2/2025"}
    test = sheet(spark, [base | {k.TEST_ID: "a", k.TEST_NO: "1"}, base | {k.TEST_ID: "b", k.TEST_NO: "1"}, base | {k.TEST_ID: "c", k.TEST_NO: k.REQUIRED_MESSAGE}])
    results = registry.reconcile("ds_ftx ", test, sheet(spark, [{"Ref. TX No.": "a"}]))
    checked, details = registry.summarise("DS_FTX", results, test)
    # By test number alone the first row counts; a message in a blank cell is no number.
    assert {r.key: r.test_row for r in details.collect()} == {"a": 6, "b": 6, "c": None}
    found = checked.first()
    assert (found.total, found.n_fail, found.n_details, found.balanced, found.complete) == (3, 3, 3, True, True)
    summary.enforce(summary.violations(checked), "counts")
    with pytest.raises(ValueError, match="counts"):
        summary.enforce(summary.violations(summary.integrity(results, details.limit(2))), "counts")
    with pytest.raises(ValueError, match="DF_FXU"):
        registry.selected(["DS_LTX", "DF_FXU"])
    assert registry.selected(["ds_ltx", "DS_FTX", "DS_LTX"]) == ["DS_LTX", "DS_FTX"]
    with pytest.raises(ValueError, match="no summary"):
        registry.summarise("DF_FXU", results, test)
    registry.register("DX_NEW", lambda t, r: t, registry.SummaryConfig())
    try:
        assert registry.reconcile("DX_NEW", test, test) is test
    finally:
        del registry.PLANS["DX_NEW"], registry.SUMMARIES["DX_NEW"]
    fields = [compare.Field(x, F.lit("PASS"), F.lit(""), F.lit("")) for x in "abc"]
    assert [f.name for f in compare.chosen(fields, lambda f: f.name != "b")] == ["a", "c"]
