"""Matching of two tables by amount, and of results with test rows, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import matching
from tallyline.plans import contracts as k, stages

from test_reports import sheet

OUT = ["outcome", "n_near", "partner_id"]


def closest(spark, expected, actual, **more):
    e, a = (spark.createDataFrame(rows, f"{i} long, g string, x double, y double") for rows, i in ((expected, "id"), (actual, "aid")))
    return {r.id: tuple(r[c] for c in OUT) for r in matching.closest_amounts(e, a, "g", "id", "x", "aid", "x", 0.01, **more).collect()}


def brute(expected, actual, fallback=False, itself=False):
    out = {}
    for i, g, x, y in expected:
        for by in (x, y)[: 1 + fallback]:
            near = [j for j, h, z, _ in actual if g == h and None not in (by, z) and abs(by - z) <= 0.01 and not (itself and i == j)]
            if near:
                break
        out[i] = ("NONE" if not near else "UNIQUE" if len(near) == 1 else "AMBIGUOUS", len(near), min(near, default=None))
    return out


def test_ids_of_two_tables_meet_by_chance(spark):
    assert closest(spark, [(1, "g", 100.0, None)], [(1, "g", 100.0, None)]) == {1: ("UNIQUE", 1, 1)}
    assert closest(spark, [(1, "g", 5.0, 100.0), (2, "g", None, 3.0), (3, "h", 100.0, None)], [(1, "g", 100.0, None), (9, "g", 3.0, None), (2, "g", 3.0, None)], fallback="y") == {1: ("UNIQUE", 1, 1), 2: ("AMBIGUOUS", 2, 2), 3: ("NONE", 0, None)}


@pytest.mark.parametrize("itself", [False, True])
@pytest.mark.parametrize("fallback", [False, True])
def test_amounts_against_brute_force(spark, itself, fallback):
    r = random.Random(5)
    amount = lambda: r.choice([None, *(round(r.choice([1, 2, 3]) + r.randint(0, 4) / 200, 4) for _ in range(6))])
    rows = lambda n: [(i, r.choice(["a", "b", None]), x := amount(), x if itself else amount()) for i in range(n)]
    expected = rows(150)
    actual = expected if itself else rows(150)
    if itself:
        e = spark.createDataFrame(expected, "id long, g string, x double, y double")
        got = {x.id: tuple(x[c] for c in OUT) for x in matching.closest_amounts(e, e, "g", "id", "x", "id", "x", 0.01, "y" if fallback else None, itself=True).collect()}
    else:
        got = closest(spark, expected, actual, fallback="y" if fallback else None)
    same = [(i, g if g else object(), x, y) for i, g, x, y in expected]
    assert got == brute(same, [(i, g, x, y) for i, g, x, y in actual], fallback, itself) and len({v[0] for v in got.values()}) >= 2


def details(spark, results, tests, **more):
    found = spark.createDataFrame(results, "key string, test_no string, status string")
    return {(r.key, r.test_no): (r.tier, r.test_row) for r in stages.detail_rows(found, sheet(spark, [{k.TEST_ID: i, k.TEST_NO: no} for i, no in tests]), **more).collect()}


def test_details_by_reference_then_number_then_the_only_one_left(spark):
    assert details(spark, [("X9DR", "T1", "PASS")], [("", "T1")]) == {("X9DR", "T1"): (2, 6)}
    tests = [("x1", "T1"), ("x2", "T1"), ("x3", None), (None, "T4"), ("x5", " t 5 ")]
    results = [("X1DR", "T1", "PASS"), ("x2FE", "T1", "PASS"), ("other", "x3", "PASS"), ("", "T4", "PASS"), (None, "T5", "FAIL"), ("", "", "PASS")]
    assert details(spark, results, tests) == {("X1DR", "T1"): (1, 6), ("x2FE", "T1"): (1, 7), ("other", "x3"): (2, 8), ("", "T4"): (2, 9), (None, "T5"): (2, 10), ("", ""): (3, 8)}
    # A message in a blank cell is neither a number nor blank.
    assert details(spark, [("x1DR", "", "PASS"), ("", "", "PASS")], [("x1", k.REQUIRED_MESSAGE), ("x2", "")]) == {("x1DR", ""): (1, 6), ("", ""): (3, 7)}


@pytest.mark.parametrize("results, tests, said", [
    ([("x3DR", "T1")], [("x3", "T1"), ("X3", "T2")], "duplicate reference"),
    ([("x1DR", "T1")], [("x1", "T1"), ("x3", "T2"), ("x3", "T3")], "duplicate reference"),
    ([("other", "T1")], [("x1", "T1"), ("x2", "T1")], "ambiguous"),
    ([("", "")], [("x1", ""), ("x2", " ")], "ambiguous"),
    ([("other", "T9")], [("x1", "T1")], "no test row"),
    ([("", "")], [("x1", "T1")], "no test row"),
    ([("other", k.REQUIRED_MESSAGE)], [("x1", k.REQUIRED_MESSAGE)], "no test row"),
])
def test_what_is_not_one_test_row_fails_the_job(spark, results, tests, said):
    """The plan is made without an error; its job raises."""
    rows = spark.createDataFrame([(*x, "PASS") for x in results], "key string, test_no string, status string")
    made = stages.detail_rows(rows, sheet(spark, [{k.TEST_ID: i, k.TEST_NO: no} for i, no in tests]))
    with pytest.raises(Exception, match=said):
        made.collect()


def test_a_missing_number_is_found_by_none(spark):
    """Without references, results that have no test row stay, with tier 0."""
    assert details(spark, [("a", "T1", "PASS"), ("b", "T2", "PASS"), ("c", "", "PASS")], [("x", "T1"), ("y", "T1"), ("z", "")], by_reference=False) == {("a", "T1"): (2, 6), ("b", "T2"): (0, None), ("c", ""): (0, None)}


def test_one_pass_over_each_sheet(spark):
    """FTU reads each sheet once, shuffles four times, and folds equal report rows before they meet their test row."""
    from tallyline.plans import reports

    n = 2_000
    test = sheet(spark, [{k.TEST_ID: "a", k.FROM_CCY: "THB", k.TO_CCY: "USD", k.SETTLED_CCY: "USD", k.SETTLED_AMOUNT: str(n), k.TXN_DATE: "01/12/2025", k.PURPOSE: "P"}])
    row = {"Arr Number": "A", "Data Set Date": "01/12/2025", "Leg Type": k.LEG_SELL, "Outflow Transaction Purpose": "P", "Country Id of Beneficiary Involved Party": "US", "Currency Id": "USD", "Foreign Currency Amount": "1"}
    report = sheet(spark, [row | {"Currency Id": "EUR" if i % 2 else "USD"} for i in range(n)])
    ftu = lambda r: reports.ftu(test, r, spark.createDataFrame([], "currency string, rate double"))
    plan = ftu(report)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD[_row") == 2 and plan.count("Exchange hashpartitioning") <= 4
    bad, good = ftu(report).first(), ftu(report.withColumn("Currency Id", F.lit("usd"))).first()
    # Each different line is once in the remark.
    assert bad.status == "FAIL" and bad.remark.split("\n") == [f'[TS] : {k.SETTLED_CCY} = "USD" | [FTU] : Currency Id = "EUR"', f"Aggregate {n} raw rows by Arr Number."]
    assert good.status == "PASS" and good.remark.split("\n") == [k.FTU_SELL, f"Aggregate {n} raw rows by Arr Number."] and good.report_row == 6
    assert (bad.failed_fields, bad.passed_fields) == (["Currency Id"], ["Country", "Currency Id", "Data Set Date", "Foreign Currency Amount", "Leg Type", "Purpose"])


def test_summary_sheet(spark):
    """Test rows beside their results, once for each block, and as many fee groups as the template or a row asks for."""
    test = sheet(spark, [{k.TEST_ID: f"x{i}", k.TEST_NO: f"T{i}", "Fee Amount 2": "7" if i == 1 else k.REQUIRED_MESSAGE, "Fee Type 5": "late" if i == 9 else " ", "Scenario": f"s{i}"} for i in range(3)])
    rows = [("X0DR", "PASS", 1), ("X0FE", "PASS", 2), ("X1DR", "FAIL", 3), ("X1FE", "PASS", 4), ("X2DR", "PASS", 5)]
    results = spark.createDataFrame([(key, "", s, s.lower(), "f", r) for key, s, r in rows], "key string, test_no string, status string, remark string, report_file string, report_row long")
    out = stages.summary_sheet(stages.detail_rows(results, test), test, ("Scenario",), 1)
    assert out.columns == ["place", "block", "Test Result", "Reason", "Reference", k.TEST_NO, "Scenario", *(h.format(i) for i in (1, 2) for h in stages.SUMMARY_FEES.values())]
    found = sorted(tuple(r) for r in out.collect())
    assert [r[:7] for r in found] == [(1, 1, "PASS", "pass", "X0DR", "T0", "s0"), (2, 1, "PASS", "pass", "X0FE", "T0", "s0"), (3, 2, "PASS", "pass", "X1FE", "T1", "s1"), (4, 3, "PASS", "pass", "X2DR", "T2", "s2"), (5, 4, "FAIL", "fail", "X1DR", "T1", "s1")]
    assert [r[13] for r in found] == ["", "", "7", "", "7"] and not any("".join(r[7:13]) for r in found)


def test_rows_that_ask_for_nothing_are_dealt(spark):
    """Rows with a reference and no number, and rows with a number and no reference, don't meet in one task of the join that they don't need."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    kept = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        blank = F.lit("")
        name = F.concat(F.lit("r"), F.col("id").cast("string"))
        table = spark.range(2000).select(F.when(F.col("id") < 1000, name).otherwise(blank).alias("reference"), F.array(F.upper(name)).alias("numbers"), F.col("id").alias("row"))
        for rows in (spark.range(1000).select(name.alias("reference"), blank.alias("number"), "id"), spark.range(1000, 2000).select(blank.alias("reference"), F.upper(name).alias("number"), "id")):
            for part in (matching.resolved(rows, table, "reference", "number", "row"), matching.asked(rows, table.select(F.col("numbers")[0].alias("key"), "row"), F.when(F.col("id") < 0, "none"), "key", F.concat("reference", "number"))):
                found = part.withColumn("task", F.spark_partition_id())
                sizes = [r.n for r in found.groupBy("task").agg(F.count("*").alias("n"), F.sum("row").alias("of")).collect()]
                assert len(sizes) == 8 and max(sizes) < 250, sizes
            found = matching.resolved(rows, table, "reference", "number", "row")
            assert found.columns == ["reference", "number", "id", "tier", "row"] and found.where("row = id").count() == 1000
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
