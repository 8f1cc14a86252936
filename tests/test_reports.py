"""The four report plans on small sheets."""

from pyspark.sql import functions as F

from tallyline.plans import contracts as k, registry, reports


def sheet(spark, rows):
    names = list(dict.fromkeys(n for r in rows for n in r))
    return spark.createDataFrame([(i + 6, *(r.get(n) for n in names)) for i, r in enumerate(rows)], "_row long, " + ", ".join(f"`{n}` string" for n in names))


def results(df):
    return {r.key: (r.status, r.outcome, r.report_row) for r in df.collect()}


def test_unique_keys(spark):
    base = {k.FROM_CCY: "usd", k.SETTLED_CCY: "EUR", k.TXN_DATE: "1/2/2025", k.SETTLED_AMOUNT: "10", k.CUSTOMER_TYPE: "NR"}
    test = sheet(spark, [base | {k.TEST_ID: i, k.TEST_NO: i} for i in ("ok", "bad", "dup", "gone", "ab1")] + [base | {k.TEST_ID: "thb", k.FROM_CCY: "THB"}, base | {k.TEST_ID: " "}])
    row = {"Buy Currency Id": "USD", "Sell Currency Id": "eur", "Transaction Date": "2025-02-01"}
    report = sheet(spark, [row | {"Ref. TX No.": i} for i in ("ok ", "dup", "dup", "AB1", "thb", "extra")] + [row | {"Ref. TX No.": "bad", "Sell Currency Id": "JPY"}])
    out = reports.ftx(test, report)
    assert results(out) == {"ok": ("PASS", "COMPARE", 6), "bad": ("FAIL", "COMPARE", 12), "dup": ("FAIL", "DUPLICATE", 7), "gone": ("FAIL", "MISSING", None), "ab1": ("FAIL", "MISSING", None), "thb": ("PASS", "EXCLUDED", 10), "": ("FAIL", "BLANK_KEY", None)}
    assert {r.key: r.remark for r in out.collect()}["bad"] == "Sell Currency Id: Value Mismatch | [Test Data]: EUR | [DS_FTX]: JPY"
    left = reports.unmatched_report_rows(out, report, F.trim("`Ref. TX No.`"))
    assert sorted(r.key for r in left.collect()) == ["AB1", "extra"]
    assert tuple(reports.summary(out).first()) == (7, 2, 5, 0)


def test_last_row_and_slots(spark):
    base = {k.TXN_DATE: "01/02/2025", k.FROM_CCY: "USD", k.RESIDENCE: "Non", k.TO_CCY: "USD", k.CIF_NO: "7", "Test No.": "T1"}
    test = sheet(spark, [base | {k.TEST_ID: "abc123", "Fee Type 2": "F", "Fee Amount 2": "10"}, base | {k.TEST_ID: "nofee1"}, base | {k.TEST_ID: "resid1", "Fee Amount Type 1": "1", k.RESIDENCE: "Resident (x)", k.FROM_CCY: "THB", k.TO_ACCOUNT_TYPE: "FCD 1"}])
    good = {"Reference Transaction Number": "ABC123_02_GPMH_ABC_RM", "Data Set Date": "2025-02-01", "Currency Id": "usd", "Payment Method": "234004", "Receive Payment Transaction Type": "270001", "Receive Payment Item Type": "268002", "Transaction Amount in Foreign Currency": "10.005", "Cust Code": "7"}
    report = sheet(spark, [good | {"Currency Id": "EUR"}, good])
    assert results(reports.ptx(test, report)) == {"ABC123_02_GPMH_ABC_RM": ("PASS", "COMPARE", 7), "NO_FEE_ROW_7": ("SKIP", "SKIP", None), "RESID1_01_GPMH_RES_RM": ("PASS", "EXPECTED_ABSENCE", None)}
    assert results(reports.ptx(test, report, no_fee_fails=True))["NO_FEE_ROW_7"][0] == "FAIL"


def test_first_row_and_suffixes(spark):
    base = {k.TEST_NO: "T1-RETURN", k.FROM_ACCOUNT: "acc1", k.FROM_CCY: "USD", k.TXN_DATE: "01/02/2025", k.PURPOSE: "318", k.TRANSFER_AMOUNT: "1,000", k.DEBIT_AMOUNT: "1,010"}
    test = sheet(spark, [base | {k.TEST_ID: "abcdef250201", "Fee Amount Type 1": "4", "Fee Amount 2": "6", "Fee Amount 3": "x"}, base | {k.TEST_ID: "nothing", k.TRANSFER_AMOUNT: "0", k.DEBIT_AMOUNT: ""}, base | {k.TEST_ID: "res1", k.RESIDENCE: "resident", k.FROM_CCY: "THB", k.TO_CCY: "USD"}])
    row = {"FI Arrangement Number": "ACC1", "Currency Id": "usd", "Transaction Date": "2025", "Outflow Transaction Purpose": "0318"}
    report = sheet(spark, [row | {"Reference Transaction Number": "ABCDEF250201DR", "Transaction Amount": "1010"}, row | {"Reference Transaction Number": "ABCDEF250201DR", "Transaction Amount": "5"}, row | {"Reference Transaction Number": "abcdef250201fe", "Transaction Amount": "11"}])
    out = reports.ltx(test, report)
    assert results(out) == {"ABCDEF250201DR": ("PASS", "COMPARE", 6), "ABCDEF250201FE": ("FAIL", "COMPARE", 8), "RES1DR": ("PASS", "EXPECTED_ABSENCE", None)}
    assert {r.test_no for r in out.collect()} == {"T1"}


def test_summed_rows(spark):
    base = {k.FROM_CCY: "THB", k.TO_CCY: "USD", k.SETTLED_CCY: "USD", k.TXN_DATE: "28/11/2025", k.PURPOSE: "P1"}
    test = sheet(spark, [base | {k.TEST_ID: i, k.SETTLED_AMOUNT: a} for i, a in (("sum", "30"), ("short", "31"), ("big", "50000"), ("gone", "1"))] + [base | {k.TEST_ID: "eur", k.SETTLED_CCY: "EUR", k.SETTLED_AMOUNT: "1"}, base | {k.TEST_ID: "blank", k.FROM_CCY: ""}, base | {k.TEST_ID: "thb", k.TO_CCY: "THB"}, base | {k.TEST_ID: "other", k.FROM_CCY: "EUR", k.SETTLED_AMOUNT: "1"}])
    row = {"Data Set Date": "01/12/2025", "Leg Type": k.LEG_SELL, "Outflow Transaction Purpose": "p1", "Country Id of Beneficiary Involved Party": "US", "Currency Id": "usd"}
    report = sheet(spark, [row | {"Arr Number": i, "Foreign Currency Amount": a} for i, a in (("SUM", "10"), ("sum", "20"), ("short", "10"), ("short", "20"), ("other", "1"))])
    out = results(reports.ftu(test, report, spark.createDataFrame([("JPY", 0.01)], "currency string, rate double")))
    assert {i: v[:2] for i, v in out.items()} == {"SUM": ("PASS", "COMPARE"), "SHORT": ("FAIL", "COMPARE"), "BIG": ("PASS", "EXPECTED_ABSENCE"), "GONE": ("FAIL", "MISSING"), "EUR": ("FAIL", "NO_RATE"), "BLANK": ("PASS", "EXPECTED_ABSENCE"), "THB": ("FAIL", "INVALID"), "OTHER": ("FAIL", "UNEXPECTED")}


def test_rows_of_several_files(spark):
    """Rows 6 of two files are two rows, on either side, in every plan."""
    two = lambda rows: (lambda s: s.where("_row = 6").withColumn("_file", F.lit("a")).unionByName(s.where("_row = 7").withColumn("_file", F.lit("b")).withColumn("_row", F.lit(6).cast("long"))))(sheet(spark, rows))
    both = lambda out: {(r.key, r._file): (r.status, r.remark != "", r.report_file) for r in out.collect()}
    base = {k.TXN_DATE: "01/02/2025", k.FROM_CCY: "USD", k.TO_CCY: "THB", k.SETTLED_CCY: "USD", k.SETTLED_AMOUNT: "5", k.FROM_ACCOUNT: "acc", k.TRANSFER_AMOUNT: "5", k.CUSTOMER_TYPE: "NR", "Fee Type 1": "F", "Fee Amount Type 1": "5", k.PURPOSE: "P1"}
    test = two([base | {k.TEST_ID: "good11", k.TEST_NO: "1"}, base | {k.TEST_ID: "baad11", k.TEST_NO: "2"}])
    report = lambda key, one, other, row, wrong: two([row | {key: one} | wrong, row | {key: other}])
    ftx = reports.ftx(test, report("Ref. TX No.", "baad11", "good11", {"Buy Currency Id": "USD", "Sell Currency Id": "USD", "Transaction Date": "01/02/2025"}, {"Buy Currency Id": "JPY"}))
    assert both(ftx) == {("good11", "a"): ("PASS", False, "b"), ("baad11", "b"): ("FAIL", True, "a")}
    ptx_row = {"Data Set Date": "01/02/2025", "Currency Id": "USD", "Payment Method": k.PAYMENT_METHOD, "Receive Payment Transaction Type": k.TRANSACTION_TYPE, "Receive Payment Item Type": k.ITEM_TYPE, "Transaction Amount in Foreign Currency": "5"}
    ptx = reports.ptx(test, report("Reference Transaction Number", "BAAD11_01_GPMH_BAA_RM", "GOOD11_01_GPMH_GOO_RM", ptx_row, {"Currency Id": "JPY"}))
    assert both(ptx) == {("GOOD11_01_GPMH_GOO_RM", "a"): ("PASS", False, "b"), ("BAAD11_01_GPMH_BAA_RM", "b"): ("FAIL", True, "a")}
    ltx_row = {"FI Arrangement Number": "ACC", "Currency Id": "USD", "Transaction Date": "01/02/2025", "Outflow Transaction Purpose": "P1", "Transaction Amount": "5"}
    ltx = reports.ltx(test, report("Reference Transaction Number", "BAAD11DR", "GOOD11DR", ltx_row, {"Transaction Amount": "6"}))
    assert {key: v for key, v in both(ltx).items() if key[0].endswith("DR")} == {("GOOD11DR", "a"): ("PASS", False, "b"), ("BAAD11DR", "b"): ("FAIL", True, "a")}
    ftu_row = {"Data Set Date": "01/02/2025", "Leg Type": k.LEG_BUY, "Inflow Transaction Purpose": "P1", "Country Id of Beneficiary Involved Party": "US", "Currency Id": "USD", "Foreign Currency Amount": "5"}
    ftu = reports.ftu(test, report("Arr Number", "BAAD11", "GOOD11", ftu_row, {"Leg Type": k.LEG_SELL}), spark.createDataFrame([], "currency string, rate double"))
    assert {key: v[0] for key, v in both(ftu).items()} == {("GOOD11", "a"): "FAIL", ("BAAD11", "b"): "FAIL"}
    # Of equal keys the first and the last row go by file, then row.
    same = report("Reference Transaction Number", "GOOD11DR", "GOOD11DR", ltx_row, {"Transaction Amount": "6"})
    assert both(reports.ltx(test, same))["GOOD11DR", "a"] == ("FAIL", True, "a")


def test_remarks(spark):
    test = sheet(spark, [{k.TEST_ID: "abcdef", k.TEST_NO: "1", k.FROM_ACCOUNT: "acc", k.FROM_CCY: "USD", k.TXN_DATE: "01/02/2025", k.TRANSFER_AMOUNT: "5", k.TO_CIF_NAME: "N", "Fee Type 1": "F"}])
    row = {"Reference Transaction Number": "ABCDEFDR", "FI Arrangement Number": "other", "Transaction Amount": "5", "Currency Id": "EUR", "Transaction Date": "01/02/2025", "Beneficiary or Sender Name": "N", "Relationship with Beneficiary or Sender": "1"}
    ltx = reports.ltx(test, sheet(spark, [row])).first()
    assert ltx.remark.split("\n") == [f'[TS] : {k.FROM_ACCOUNT} = "acc" | [LTX] : FI Arrangement Number = "other"', '[TS] : From Currency (CCY) = "USD" | [LTX] : Currency Id = "EUR"', f'[TS] : {k.PURPOSE} = "" | [LTX] : Outflow Transaction Purpose = ""', f'[LTX] : Relationship with Beneficiary or Sender = "1" {k.MUST_BE} "172064"', k.PLEASE_REVIEW]
    ptx_row = {"Reference Transaction Number": "ABCDEF_01_GPMH_ABC_RM", "Data Set Date": "2025-02-01", "Currency Id": "USD", "Cust Code": "7", "Transaction Amount in Foreign Currency": ""}
    ptx = reports.ptx(test, sheet(spark, [ptx_row]), core=("Currency Id", "Unheard Of")).first()
    assert ptx.remark.split("\n") == ["Unheard Of: Compare Rule Not Found | [TS]: (blank) | [DS-PTX]: (blank)", "Cust Code: Expected Value Is Blank | [TS]: (blank) | [DS-PTX]: 7"]
    assert ptx.passed_fields == ["Currency Id"] and ptx.failed_fields == ["Cust Code", "Unheard Of"]
    ftu_test = sheet(spark, [{k.TEST_ID: "a", k.FROM_CCY: "THB", k.TO_CCY: "USD", k.SETTLED_CCY: "USD", k.SETTLED_AMOUNT: "3", k.TXN_DATE: "01/12/2025"}])
    ftu_row = {"Arr Number": "A", "Data Set Date": "01/12/2025", "Leg Type": k.LEG_SELL, "Country Id of Beneficiary Involved Party": "US", "Currency Id": "USD", "Foreign Currency Amount": "1"}
    ftu = reports.ftu(ftu_test, sheet(spark, [ftu_row, ftu_row]), spark.createDataFrame([], "currency string, rate double")).first()
    assert ftu.status == "FAIL" and ftu.remark.split("\n")[-2:] == [f'[TS] : {k.SETTLED_AMOUNT} = "3.0" | [FTU] : Foreign Currency Amount = "2.0"', "Aggregate 2 raw rows by Arr Number."]


def test_nothing_is_shuffled_after_the_match(spark):
    base = {k.TEST_ID: "abcdef", k.TEST_NO: "1", k.TXN_DATE: "01/02/2025", k.FROM_CCY: "USD", "Fee Type 1": "F"}
    test = report = sheet(spark, [base | {"Ref. TX No.": "abcdef", "Reference Transaction Number": "x"}])
    for plan in (reports.ltx, reports.ptx, reports.ftx):
        text = plan(test, report)._jdf.queryExecution().executedPlan().toString()
        assert text.count("Scan ExistingRDD") <= 2 and text.count("Exchange") <= 3, plan


def test_another_builder_of_cases(spark):
    """A plan takes its expected cases from a builder that a caller gives, here one more slot for each row and none for the others."""
    base = {k.TEST_ID: "abcdef", k.TEST_NO: "1", k.FROM_ACCOUNT: "acc", k.FROM_CCY: "USD", k.TXN_DATE: "01/02/2025", k.TRANSFER_AMOUNT: "5"}
    test = sheet(spark, [base, base | {k.TEST_ID: "other", k.TEST_NO: "skip"}])
    row = {"FI Arrangement Number": "ACC", "Transaction Amount": "5", "Currency Id": "USD", "Transaction Date": "01/02/2025"}
    report = sheet(spark, [row | {"Reference Transaction Number": x} for x in ("ABCDEFDR", "ABCDEFXX")])

    def doubled(rows):
        made = reports.ltx_cases(rows).where("test_no != 'skip'")
        return made.union(made.withColumn("key", F.regexp_replace("key", "DR$", "XX")))

    assert results(reports.ltx(test, report, cases=doubled)) == {"ABCDEFDR": ("PASS", "COMPARE", 6), "ABCDEFXX": ("PASS", "COMPARE", 7)}
    only = lambda f: lambda rows: f(rows).where("test_no = '1'")
    assert set(results(reports.ftx(test, report, cases=only(reports.ftx_cases)))) == {"abcdef"} and set(results(registry.reconcile("DS_PTX", test, report, cases=only(reports.ptx_cases)))) == {"NO_FEE_ROW_6"}
    assert set(results(reports.ftu(test, report, spark.createDataFrame([], "currency string, rate double"), cases=only(reports.ftu_cases)))) == {"ABCDEF"}


def test_slots_and_their_columns(spark):
    """A third slot, and a field that is held against another column in each slot."""
    base = {k.TEST_ID: "abc123", k.TEST_NO: "1", k.TXN_DATE: "01/02/2025", k.FROM_CCY: "USD", "Payer 1": "P1", "Payer 3": "P3", k.CIF_NO: "7"}
    test = sheet(spark, [base | {"Fee Type 1": "F", "Fee Amount Type 1": "1", "Fee Type 3": "F", "Fee Amount Type 3": "3"}])
    row = {"Data Set Date": "2025-02-01", "Currency Id": "usd", "Payment Method": k.PAYMENT_METHOD, "Receive Payment Transaction Type": k.TRANSACTION_TYPE, "Receive Payment Item Type": k.ITEM_TYPE}
    report = sheet(spark, [row | {"Reference Transaction Number": f"ABC123_0{i}_GPMH_ABC_RM", "Transaction Amount in Foreign Currency": str(i), "Cust Code": who} for i, who in ((1, "P1"), (3, "P3"))])
    two = results(reports.ptx(test, report))
    assert two == {"ABC123_01_GPMH_ABC_RM": ("FAIL", "COMPARE", 6)}
    payer = reports.PTX_FIELDS | {"Cust Code": lambda slot: (f"Payer {slot}",)}
    three = registry.reconcile("DS_PTX", test, report, slots=(1, 2, 3), mapping=payer)
    assert results(three) == {"ABC123_01_GPMH_ABC_RM": ("PASS", "COMPARE", 6), "ABC123_03_GPMH_ABC_RM": ("PASS", "COMPARE", 7)}
    wrong = reports.ptx(test, report, slots=(1, 3), mapping=payer | {"Cust Code": lambda slot: (f"Payer {4 - slot}",)})
    assert {r.key[7:9]: r.remark for r in wrong.collect()} == {"01": "Cust Code: Value Mismatch | [TS]: P3 | [DS-PTX]: P1", "03": "Cust Code: Value Mismatch | [TS]: P1 | [DS-PTX]: P3"}
    # A field that isn't mapped is held against nothing.
    assert "Expected Value Is Blank" in reports.ptx(test, report, mapping={f: m for f, m in payer.items() if f != "Cust Code"}).first().remark


def test_chosen_rules(spark):
    """Rules that a caller leaves out, or asks for in some rows only."""
    base = {k.TEST_NO: "1", k.FROM_ACCOUNT: "acc", k.FROM_CCY: "USD", k.TXN_DATE: "01/02/2025", k.TRANSFER_AMOUNT: "5", "Fee Amount Type 1": "5", k.SETTLED_CCY: "EUR", k.CUSTOMER_TYPE: "NR"}
    test = sheet(spark, [base | {k.TEST_ID: "abcdef"}])
    row = {"FI Arrangement Number": "other", "Transaction Amount": "5", "Currency Id": "EUR", "Transaction Date": "01/02/2025", "Outflow Transaction Purpose": ""}
    report = sheet(spark, [row | {"Reference Transaction Number": x} for x in ("ABCDEFDR", "ABCDEFFE")])
    state = lambda wanted: {r.key[-2:]: (r.status, r.review_fields) for r in reports.ltx(test, report, wanted=wanted).collect()}
    assert {x: s for x, (s, _) in state(None).items()} == {"DR": "FAIL", "FE": "FAIL"}
    assert state(lambda f: f.name in ("Transaction Amount", "Currency Id")) == {"DR": ("PASS", ["Currency Id"]), "FE": ("PASS", ["Currency Id"])}
    assert state(lambda f: f.name == "Transaction Amount" or (F.col("suffix") == "DR" if f.name == "FI Arrangement Number" else False)) == {"DR": ("FAIL", []), "FE": ("PASS", [])}
    assert state(lambda f: (F.col("actual")["Transaction Amount"] == "5") & (f.name == "Currency Id"))["DR"] == ("PASS", ["Currency Id"])
    assert state(lambda f: False) == {"DR": ("PASS", []), "FE": ("PASS", [])}
    ftx = reports.ftx(test, sheet(spark, [{"Ref. TX No.": "abcdef", "Buy Currency Id": "JPY", "Sell Currency Id": "EUR", "Transaction Date": "2025-02-01"}]), wanted=lambda f: f.name != "Buy Currency Id").first()
    assert (ftx.status, ftx.passed_fields) == ("PASS", ["Sell Currency Id", "Transaction Date"])
    ftu_test = sheet(spark, [{k.TEST_ID: "a", k.FROM_CCY: "THB", k.TO_CCY: "USD", k.SETTLED_CCY: "USD", k.SETTLED_AMOUNT: "3", k.TXN_DATE: "01/12/2025"}])
    ftu_row = {"Arr Number": "A", "Leg Type": k.LEG_SELL, "Foreign Currency Amount": "1"}
    ftu = reports.ftu(ftu_test, sheet(spark, [ftu_row]), spark.createDataFrame([], "currency string, rate double"), wanted=lambda f: f.name == "Leg Type").first()
    assert (ftu.status, ftu.passed_fields, ftu.remark) == ("PASS", ["Leg Type"], k.FTU_SELL)


def test_summed_rows_stay_where_they_met(spark):
    """FTU shuffles the report by all that is compared, and both sides by the key; results of several report rows are folded there, by field and status."""
    test = sheet(spark, [{k.TEST_ID: "a", k.FROM_CCY: "THB", k.TO_CCY: "USD", k.SETTLED_CCY: "USD", k.SETTLED_AMOUNT: "3", k.TXN_DATE: "01/12/2025", k.PURPOSE: "P1"}])
    row = {"Arr Number": "A", "Data Set Date": "01/12/2025", "Leg Type": k.LEG_SELL, "Outflow Transaction Purpose": "P1", "Country Id of Beneficiary Involved Party": "US", "Currency Id": "USD", "Foreign Currency Amount": "1"}
    report = sheet(spark, [row, row | {"Leg Type": "x"}, row | {"Currency Id": "JPY"}])
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = reports.ftu(test, report, spark.createDataFrame([], "currency string, rate double"))
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
        found = out.first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert found.passed_fields == ["Country", "Currency Id", "Data Set Date", "Foreign Currency Amount", "Leg Type", "Purpose"] and found.failed_fields == ["Currency Id", "Leg Type"] and found.review_fields == []
    assert [line.split(" = ")[0] for line in found.remark.split("\n")[:2]] == ["[FTU] : Leg Type", f"[TS] : {k.SETTLED_CCY}"]
