"""Numbers in text. What isn't a number is null; nothing raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import trim

#: Fixed value: the default tolerance of amounts, in binary floating point.
TOLERANCE = 0.01
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number(c: Column, commas: bool = True) -> Column:
    """The number in the text; thousands separators are dropped if commas, else they make it null. Blank is null."""
    t = trim(c)
    t = F.replace(t, F.lit(","), F.lit("")) if commas else t
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def number_or_zero(c: Column, commas: bool = False) -> Column:
    return F.coalesce(number(c, commas), F.lit(0.0))


def within(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """Whether two numbers differ by the tolerance at most; false if one is missing."""
    return F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))


def total(*cs: Column) -> Column:
    """Sum across columns; what isn't a number adds nothing."""
    out = F.lit(0.0)
    for c in cs:
        out = out + F.coalesce(c, F.lit(0.0))
    return out


def money(c: Column) -> Column:
    """At most two decimals, thousands separated, for remarks."""
    return F.regexp_replace(F.format_number(c, 2), r"\.?0+$", "")
