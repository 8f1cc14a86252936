"""Truth tables of policies, rules, comparators, completeness and rollup."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators import compare as c, completeness, matching, reshape, rollup, rules, summary
from tallyline.operators.matching import Policy


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


@pytest.mark.parametrize("policy, want", [(Policy.FIRST, [("K0", "MISSING", None), ("K1", "MATCH", 10), ("K2", "MATCH", 10)]), (Policy.LAST, [("K0", "MISSING", None), ("K1", "MATCH", 10), ("K2", "MATCH", 20)]), (Policy.UNIQUE, [("K0", "MISSING", None), ("K1", "MATCH", 10), ("K2", "DUPLICATE", 10)]), (Policy.AGGREGATE, [("K0", "MISSING", None), ("K1", "MATCH", 10), ("K2", "MATCH", 10)])])
def test_policies(spark, policy, want):
    expected = spark.createDataFrame([("K0",), ("K1",), ("K2",)], "k string")
    actual = spark.createDataFrame([("K1", 1, 10), ("K2", 3, 20), ("K2", 2, 10)], "k string, _row int, amount int")
    m = matching.match(expected, actual, "k", policy, ["_row"], ("amount",))
    assert sorted((r.k, r.match, r.actual and r.actual.amount) for r in m.collect()) == want
    if policy is Policy.AGGREGATE:
        assert {r.k: r.sum_amount for r in m.collect()} == {"K0": None, "K1": 10, "K2": 30}


def test_sides_add_up(spark):
    e, a = (spark.createDataFrame([(x,) for x in s], "k string") for s in ("abc", "bcd"))
    sides = {r.side: r["count"] for r in matching.both_sides(e, a, "k").groupBy("side").count().collect()}
    assert sides == {"MATCHED": 2, "MISSING": 1, "UNTAGGED": 1}
    assert matching.missing(e, a, "k").count() == 1 and matching.untagged(a, e, "k").count() == 1


@pytest.mark.parametrize("source, target, want", [("", "USD", "INVALID"), ("THB", "THB", "INVALID"), ("thb", "usd", "SELL_FCY"), ("USD", "THB", "BUY_FCY"), ("USD", "EUR", "NOT_FTU"), (None, None, "INVALID")])
def test_direction(spark, source, target, want):
    assert one(spark, rules.direction(F.lit(source).cast("string"), F.lit(target).cast("string"), "THB")) == want


@pytest.mark.parametrize("source, who, amount, want", [("USD", "Resident", 50_000.0, True), ("USD", "R", 50_000.01, False), ("USD", "R", -1.0, False), ("USD", "NR", 1.0, False), ("THB", "NR", 1e9, True), ("USD", "R", None, False)])
def test_exclusion(spark, source, who, amount, want):
    assert one(spark, rules.excluded_conversion(F.lit(source), F.lit("USD"), F.lit(who), F.lit(amount).cast("double"))) is want


@pytest.mark.parametrize("expectation, found, passes, want", [("MUST_EXIST", True, False, "COMPARE"), ("MUST_EXIST", False, False, "MISSING"), ("MUST_NOT_EXIST", True, False, "UNEXPECTED"), ("MUST_NOT_EXIST", True, True, "EXPECTED_ABSENCE"), ("MUST_NOT_EXIST", False, False, "EXPECTED_ABSENCE")])
def test_presence(spark, expectation, found, passes, want):
    assert one(spark, rules.presence(F.lit(expectation), F.lit(found), passes)) == want


COMPARED = [
    (c.exact_or_review, "007", "7", "PASS"), (c.exact_or_review, "", "X", "REVIEW"), (c.exact_or_review, "A", "b", "REVIEW"),
    (lambda e, a: c.typed("TEXT", e, a), "", "", "PASS"), (lambda e, a: c.typed("AMOUNT", e, a), "1,000", "1000", "FAIL"), (lambda e, a: c.typed("AMOUNT", e, a), "100", "100.005", "PASS"), (lambda e, a: c.typed("NUMBER", e, a), "1.0", "1", "PASS"),
    (c.optional_value, "any", "", "PASS"), (c.optional_value, "", "x", "FAIL"), (c.optional_value, "X ", "x", "PASS"), (c.spaced_text, "a  b", " A B ", "PASS"), (c.loose_date, "1/2/2025", "2025-02-01", "PASS"), (c.loose_date, "soon", "SOON", "PASS"),
    (c.business_date, "28/11/2025", "01/12/2025", "PASS"), (c.business_date, "29/11/2025", "30/11/2025", "FAIL"), (c.business_date, "31/02/2025", "01/03/2025", "FAIL"), (c.business_date, "", "01/03/2025", "REVIEW"),
    (lambda e, a: c.purpose(F.lit("BUY_FCY"), e, a, a), "P1", "P1", "FAIL"), (lambda e, a: c.purpose(F.lit("BUY_FCY"), e, a, F.lit("")), "p1", "P1", "PASS"), (lambda e, a: c.fixed_value("172064", a, e), "", "172064", "REVIEW"), (lambda e, a: c.fixed_value("172064", a), "", "1", "FAIL"),
]


@pytest.mark.parametrize("f, expected, actual, want", COMPARED)
def test_compared(spark, f, expected, actual, want):
    assert one(spark, f(F.lit(expected), F.lit(actual))) == want


@pytest.mark.parametrize("cells, want", [(("T", "A", "1"), ["FOUND"] * 3), ((None, " ", ""), []), ((None, None, "1"), ["INCOMPLETE_CHECK", "INCOMPLETE_CHECK", "FOUND"]), (("T", None, None), ["FOUND", "INCOMPLETE_REQUIRED", "INCOMPLETE_REQUIRED"]), (("T", "A", None), ["FOUND", "FOUND", "INCOMPLETE_REQUIRED"])])
def test_complete_group(spark, cells, want):
    assert [x.status for x in one(spark, completeness.complete_group(*(F.lit(x).cast("string") for x in cells)))] == want


@pytest.mark.parametrize("statuses, with_skip, want", [(["PASS", "FAIL"], True, "FAIL"), (["SKIP", "SKIP"], True, "SKIP"), (["PASS", "SKIP"], True, "PASS"), (["PASS", "FAIL"], False, "FAIL")])
def test_rollup(spark, statuses, with_skip, want):
    rows = spark.createDataFrame([(1, i, f"f{i}", "", "x", s) for i, s in enumerate(statuses)], "k int, ordinal int, field string, expected string, actual string, status string")
    out = rollup.rolled(rows, ["k"], with_skip).first()
    assert out.status == want
    assert out.remark == "\n".join(f"f{i}: expected (blank), actual x" for i, s in enumerate(statuses) if s == "FAIL")


def test_slots_keep_their_number(spark):
    rows = spark.createDataFrame([(1, None, "5"), (2, None, None)], "id int, a string, b string")
    out = reshape.slots(rows, {1: {"v": F.col("a")}, 2: {"v": F.col("b")}}, {1: F.col("a").isNotNull(), 2: F.col("b").isNotNull()})
    assert sorted((r.id, r.slot, r.v, r.has_slot) for r in out.collect()) == [(1, 2, "5", True), (2, None, None, False)]


def test_summary(spark):
    rows = spark.createDataFrame([("a", "PASS"), ("a", "FAIL"), ("b", "ODD")], "k string, status string")
    assert {r.k: (r.total, r.balanced) for r in summary.counts(rows, ["k"]).collect()} == {"a": (2, True), "b": (1, False)}
    with pytest.raises(ValueError, match="twice"):
        summary.enforce(summary.repeated_keys(rows, ["k"]), "twice")
    summary.enforce(summary.repeated_keys(rows.limit(0), ["k"]), "twice")


def test_order(spark):
    rows = spark.createDataFrame([(1, "FAIL"), (2, "PASS"), (3, "UNTAGGED"), (4, "MISSING"), (5, "SKIP")], "_row int, status string")
    assert [r._row for r in rollup.in_order(rows, "status", ["_row"], rollup.ORDER_WITH_SKIP).collect()] == [2, 3, 5, 1, 4]
