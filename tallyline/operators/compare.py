"""Comparators: an expected and an actual Column -> a Column of PASS, FAIL, REVIEW or SKIP."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, normalize as n
from ..functions.numbers import TOLERANCE, number, within

PASS, FAIL, REVIEW, SKIP = "PASS", "FAIL", "REVIEW", "SKIP"


def passed(ok: Column, otherwise: str = FAIL) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), PASS).otherwise(otherwise)


def exact_or_review(expected: Column, actual: Column) -> Column:
    """Never fails: what is blank or differs is to be reviewed. Leading zeros of numbers and case don't count."""
    filled = ~n.blank(expected) & ~n.blank(actual)
    return passed(filled & (n.identifier(expected) == n.identifier(actual)), REVIEW)


def fixed_value(literal: str, actual: Column, source: Column | None = None) -> Column:
    """FAIL unless the literal, case aside; equal with a blank source is to be reviewed."""
    same = F.lower(n.value(actual)) == literal.lower()
    return F.when(~same, FAIL).when(n.blank(source) if source is not None else F.lit(False), REVIEW).otherwise(PASS)


def date_or_reference(expected: Column, actual: Column, reference: Column) -> Column:
    e = n.value(expected)
    return passed((e != "") & ((e == n.value(actual)) | (e == dates.reference_date_text(reference))), REVIEW)


def amount_or_fallback(actual: Column, primary: Column, fallback: Column | None = None, tolerance: float = TOLERANCE) -> Column:
    """primary, fallback or none: the first amount within the tolerance."""
    out = F.when(within(primary, actual, tolerance), "primary")
    return (out.when(within(fallback, actual, tolerance), "fallback") if fallback is not None else out).otherwise("none")


def both_blank(expected: Column, actual: Column) -> Column:
    return (n.text(expected) == "") & (n.text(actual) == "")


def upper_equal(expected: Column, actual: Column) -> Column:
    return n.upper_key(expected) == n.upper_key(actual)


def spaced_equal(expected: Column, actual: Column) -> Column:
    return n.upper_text(expected) == n.upper_text(actual)


def typed(kind: str, expected: Column, actual: Column, tolerance: float = TOLERANCE) -> Column:
    """TEXT and DATE by trimmed upper-case text, NUMBER exactly, AMOUNT within the tolerance, thousands separators not understood; both blank are equal."""
    if kind in ("TEXT", "DATE"):
        same = upper_equal(expected, actual)
    elif kind == "NUMBER":
        same = number(expected, commas=False) == number(actual, commas=False)
    elif kind == "AMOUNT":
        same = within(number(expected, commas=False), number(actual, commas=False), tolerance)
    else:
        raise ValueError(f"no such comparison: {kind}")
    return passed(both_blank(expected, actual) | same)


def optional_value(expected: Column, actual: Column) -> Column:
    """A blank actual value passes as skipped; a blank expected one beside a filled one fails."""
    return F.when(n.trim(actual) == "", PASS).when(n.trim(expected) == "", FAIL).otherwise(typed("TEXT", expected, actual))


def spaced_text(expected: Column, actual: Column) -> Column:
    return passed(spaced_equal(expected, actual))


def loose_date(expected: Column, actual: Column) -> Column:
    """Equal as dates, else as text."""
    a, b = dates.loose_date(expected), dates.loose_date(actual)
    return passed(F.coalesce(a.cast("string"), n.upper_text(expected)) == F.coalesce(b.cast("string"), n.upper_text(actual)))


def date_of_set_or_reference(expected: Column, data_set_date: Column, reference: Column) -> Column:
    e = dates.loose_date(expected)
    return passed(e.isNotNull() & ((e == dates.loose_date(data_set_date)) | (e == dates.reference_date(reference))))


def business_date(expected: Column, actual: Column) -> Column:
    """The date or the next weekday; a blank expected date is only information."""
    return F.when(n.blank(expected), REVIEW).otherwise(passed(dates.same_or_next_weekday(dates.strict_date(expected), dates.strict_date(actual))))


def directional(direction: Column, buy: Column, sell: Column) -> Column:
    return F.when(direction == "BUY_FCY", buy).when(direction == "SELL_FCY", sell)


def purpose(direction: Column, expected: Column, inflow: Column, outflow: Column) -> Column:
    """Buying fills the inflow purpose and leaves the outflow one blank; selling the other way round. A blank expected purpose is only information."""
    own, other = directional(direction, inflow, outflow), directional(direction, outflow, inflow)
    return F.when(n.upper_key(other) != "", FAIL).when(n.blank(expected), REVIEW).otherwise(passed(upper_equal(expected, own)))


@dataclass(frozen=True)
class Field:
    """A named comparison: status is a Column of PASS, FAIL, REVIEW, SKIP or null (not applicable).

    source: the expected side's name of the field. reason: text or Column, why it doesn't pass. fixed: the
    expected value is a constant.
    """

    name: str
    status: Column
    expected: Column
    actual: Column
    source: str = ""
    reason: str | Column = "Value Mismatch"
    fixed: bool = False


#: The type of results().
RESULTS = "array<struct<ordinal:int,field:string,expected:string,actual:string,status:string,source:string,reason:string,fixed:boolean>>"
RULE_NOT_FOUND = "Compare Rule Not Found"


def for_headers(rules: dict[str, Field], headers: tuple[str, ...], actual: Callable[[str], Column]) -> list[Field]:
    """The rule of each header; one without a rule fails."""
    return [rules.get(h) or Field(h, F.lit(FAIL), F.lit(""), actual(h), reason=RULE_NOT_FOUND) for h in headers]


Choice = Callable[[Field], "bool | Column"]


def chosen(fields: list[Field], wanted: Choice | None) -> list[Field]:
    """The fields of a rule set that a caller picks, in their order: all of a field's rows (a bool), or those for which a Column over the expected and the `actual` row holds."""
    out = []
    for f in fields:
        keep = True if wanted is None else wanted(f)
        if isinstance(keep, Column):
            out.append(replace(f, status=F.when(keep, f.status)))
        elif keep:
            out.append(f)
    return out


def results(fields: list[Field]) -> Column:
    """Array of the applicable fields' results, in order: a row's comparison stays in the row."""
    reason = lambda f: f.reason if isinstance(f.reason, Column) else F.lit(f.reason)
    items = [
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(f.name).alias("field"), n.text(f.expected).alias("expected"), n.text(f.actual).alias("actual"), f.status.alias("status"),
            F.lit(f.source).alias("source"), reason(f).alias("reason"), F.lit(f.fixed).alias("fixed"),
        )
        for i, f in enumerate(fields)
    ]
    return F.filter(F.array(*items).cast(RESULTS), lambda x: x["status"].isNotNull())


def long_results(rows: DataFrame, keys: list[str], fields: list[Field]) -> DataFrame:
    """keys, ordinal, field, expected, actual, status, source, reason, fixed: one row for each row and applicable field, made by one projection."""
    return rows.select(*keys, F.inline(results(fields)))
