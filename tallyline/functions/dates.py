"""Dates in text. What isn't a calendar date is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import text, trim


def _made(c: Column, pattern: str, y: int, m: int, d: int) -> Column:
    part = lambda i, n: F.lpad(F.regexp_extract(c, pattern, i), n, "0")
    return F.when(c.rlike(pattern), F.try_to_date(F.concat_ws("-", part(y, 4), part(m, 2), part(d, 2)), "yyyy-MM-dd"))


def strict_date(c: Column) -> Column:
    """d/M/yyyy or yyyy-M-d and nothing else."""
    t = trim(c)
    return F.coalesce(_made(t, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", 3, 2, 1), _made(t, r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 1, 2, 3))


def loose_date(c: Column) -> Column:
    """Day or year first, / or - between, whatever follows the date."""
    t = trim(c)
    return F.coalesce(_made(t, r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})(?!\d).*$", 3, 2, 1), _made(t, r"^(\d{4})[/-](\d{1,2})[/-](\d{1,2})(?!\d).*$", 1, 2, 3))


def serial_date(c: Column) -> Column:
    """The date of a spreadsheet's day number."""
    return F.date_add(F.lit("1899-12-30").cast("date"), c.cast("int"))


def date_serial(c: Column) -> Column:
    return F.datediff(c, F.lit("1899-12-30").cast("date"))


def next_weekday(d: Column) -> Column:
    """The day after, past Saturday and Sunday."""
    return F.date_add(d, F.when(F.weekday(d) == 4, 3).when(F.weekday(d) == 5, 2).otherwise(1))


def same_or_next_weekday(expected: Column, actual: Column) -> Column:
    return F.coalesce((actual == expected) | (actual == next_weekday(expected)), F.lit(False))


def reference_date(reference: Column) -> Column:
    """The date in characters 7 to 12 (yymmdd) of a reference; null if they aren't a calendar date."""
    digits = F.substring(text(reference), 7, 6)
    return F.when(digits.rlike("^[0-9]{6}$"), F.try_to_date(F.concat(F.lit("20"), digits), "yyyyMMdd"))


def reference_date_text(reference: Column) -> Column:
    """dd/mm/20yy from the same characters, unchecked; blank if the reference is shorter than 12."""
    r = text(reference)
    made = F.concat(F.substring(r, 11, 2), F.lit("/"), F.substring(r, 9, 2), F.lit("/20"), F.substring(r, 7, 2))
    return F.when(F.length(r) >= 12, made).otherwise("")
