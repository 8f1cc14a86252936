"""Truth tables of normalisation, numbers, dates and keys."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallyline.functions import dates, keys, normalize as n, numbers


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize(
    "f, value, want",
    [
        (n.trim, "  a b　﻿", "a b"),
        (n.trim, None, ""),
        (n.collapse, " a  \t b\r\n", "a b"),
        (n.canonical_header, "From  Account ( A/C Client/Sender)", "fromaccount(a/cclient/sender)"),
        (n.bare_header, "Txn-Date (วันที่) #1", "txndateวันที่1"),
        (n.value, " a​b ", "ab"),
        (n.upper_text, " a  b ", "A B"),
        (n.identifier, "0007", "7"),
        (n.identifier, "00", "0"),
        (n.identifier, "A07", "a07"),
        (n.summary_key, " ab 1 ", "AB1"),
    ],
)
def test_normalised(spark, f, value, want):
    assert one(spark, f(F.lit(value).cast("string"))) == want


@pytest.mark.parametrize("value, commas, want", [("1,000.00", True, 1000.0), ("1,000", False, None), ("1d", True, None), ("NaN", True, None), ("Infinity", True, None), (" 5 ", True, 5.0), ("1e3", True, 1000.0), ("0x10", True, None), ("", True, None), ("-0", True, 0.0)])
def test_number(spark, value, commas, want):
    assert one(spark, numbers.number(F.lit(value), commas)) == want


def test_tolerance_is_binary(spark):
    assert one(spark, numbers.within(F.lit(100.01), F.lit(100.0))) is False
    assert one(spark, numbers.within(F.lit(None).cast("double"), F.lit(1.0))) is False
    assert one(spark, numbers.money(F.lit(49999.5))) == "49,999.5"
    assert one(spark, numbers.money(F.lit(50000.0))) == "50,000"


@pytest.mark.parametrize("value, strict, loose", [("1/2/2025", "2025-02-01", "2025-02-01"), ("2025-2-1", "2025-02-01", "2025-02-01"), ("31/02/2025", None, None), ("1-2-2025", None, "2025-02-01"), ("2025/02/01 10:00", None, "2025-02-01"), ("", None, None), (None, None, None)])
def test_dates(spark, value, strict, loose):
    day = lambda s: s and datetime.date.fromisoformat(s)
    c = F.lit(value).cast("string")
    assert (one(spark, dates.strict_date(c)), one(spark, dates.loose_date(c))) == (day(strict), day(loose))


@pytest.mark.parametrize("expected, actual, want", [("2025-11-28", "2025-12-01", True), ("2025-11-28", "2025-11-29", False), ("2025-11-29", "2025-11-30", False), ("2025-11-29", "2025-12-01", True), ("2025-11-26", "2025-11-27", True)])
def test_next_weekday(spark, expected, actual, want):
    d = lambda s: F.lit(s).cast("date")
    assert one(spark, dates.same_or_next_weekday(d(expected), d(actual))) is want


def test_references_and_keys(spark):
    assert one(spark, dates.reference_date(F.lit("ABCDEF250201DR"))) == datetime.date(2025, 2, 1)
    assert one(spark, dates.reference_date(F.lit("ABCDEF259931DR"))) is None
    assert one(spark, dates.reference_date_text(F.lit("ABCDEF250201DR"))) == "01/02/2025"
    assert one(spark, keys.slot_key(F.lit(" abc123 "), F.lit(2))) == "ABC123_02_GPMH_ABC_RM"
    assert one(spark, keys.slot_key(F.lit("ab"), F.lit(2))) is None
    assert one(spark, keys.slot_key(F.lit("abc"), F.lit(123))) == "ABC_123_GPMH_ABC_RM"
    assert one(spark, dates.date_serial(dates.serial_date(F.lit(45000)))) == 45000
