"""Presence and exclusion rules: data that compiles to one CASE expression."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.normalize import upper_text

MUST_EXIST, MUST_NOT_EXIST = "MUST_EXIST", "MUST_NOT_EXIST"


@dataclass(frozen=True)
class Condition:
    """field EQUALS / NOT_EQUALS / NOT_EMPTY / STARTS_WITH value, on upper-cased text with single spaces. A missing field is blank."""

    field: str
    test: str
    value: str = ""

    def column(self, field: Callable[[str], Column] = F.col) -> Column:
        have, want = upper_text(field(self.field)), self.value.upper()
        if self.test == "EQUALS":
            return have == want
        if self.test == "NOT_EQUALS":
            return have != want
        if self.test == "NOT_EMPTY":
            return have != ""
        if self.test == "STARTS_WITH":
            return have.startswith(want)
        raise ValueError(f"no such test: {self.test}")


@dataclass(frozen=True)
class Rule:
    """All conditions hold -> outcome."""

    name: str
    conditions: tuple[Condition, ...]
    outcome: str = MUST_NOT_EXIST

    def column(self, field: Callable[[str], Column] = F.col) -> Column:
        return reduce(lambda a, b: a & b, (c.column(field) for c in self.conditions))

    def fields(self) -> list[str]:
        return list(dict.fromkeys(c.field for c in self.conditions))


def decide(rules: list[Rule], default: str = MUST_EXIST, field: Callable[[str], Column] = F.col) -> Column:
    """The outcome of the first rule that holds."""
    out = None
    for r in rules:
        out = F.when(r.column(field), r.outcome) if out is None else out.when(r.column(field), r.outcome)
    return F.lit(default) if out is None else out.otherwise(default)


def presence(expectation: Column, found: Column, excluded_passes: bool = False) -> Column:
    """COMPARE, MISSING, UNEXPECTED or EXPECTED_ABSENCE; with excluded_passes a row that must not exist passes even if found."""
    unwanted = expectation == MUST_NOT_EXIST
    return F.when(unwanted & (~found | F.lit(excluded_passes)), "EXPECTED_ABSENCE").when(unwanted, "UNEXPECTED").when(found, "COMPARE").otherwise("MISSING")


def direction(source: Column, target: Column, base: str) -> Column:
    """Which side of a conversion is the base currency."""
    s, t = upper_text(source), upper_text(target)
    return F.when((s == "") | (t == "") | ((s == base) & (t == base)), "INVALID").when(s == base, "SELL_FCY").when(t == base, "BUY_FCY").otherwise("NOT_FTU")


def excluded_conversion(source: Column, settled: Column, customer_type: Column, amount: Column, base: str = "THB", foreign: str = "USD", most: float = 50_000) -> Column:
    """Conversions from the base currency, and residents' same-currency ones up to the limit, aren't reported."""
    s, t, who = upper_text(source), upper_text(settled), upper_text(customer_type)
    small = (s == t) & (s == foreign) & who.isin("R", "RESIDENT") & F.coalesce((amount >= 0) & (amount <= most), F.lit(False))
    return (s == base) | small


def resident_to_foreign_account(status: Column, source: Column, account_type: Column, target: Column, base: str = "THB") -> Column:
    """A resident's payment from the base currency into a foreign-currency account, told by the account's type or else by the target currency."""
    who, s, a, t = (upper_text(c) for c in (status, source, account_type, target))
    fcd = (a == "FCD") | a.startswith("FCD ") | a.startswith("FCD(")
    return ((who == "RESIDENT") | who.startswith("RESIDENT (")) & (s == base) & (fcd | ((a == "") & (t != "") & (t != base)))


#: residents' payments from THB into foreign currency must not be in the report.
RESIDENT_STATUS, FROM_CURRENCY, TO_CURRENCY = "From Customer (Resident/Non Resident)", "From Currency (CCY)", "To Currency (CCY)"
RESIDENT_THB_TO_FOREIGN = Rule(
    "resident_thb_to_foreign",
    (Condition(RESIDENT_STATUS, "EQUALS", "RESIDENT"), Condition(FROM_CURRENCY, "EQUALS", "THB"), Condition(TO_CURRENCY, "NOT_EMPTY"), Condition(TO_CURRENCY, "NOT_EQUALS", "THB")),
)
