"""How headers, keys and values are made comparable.

All take and return Columns. White space is Unicode white space with the byte-order mark, as trimmed
by scripting languages, which is wider than what trim() removes. A missing value is the same as a
blank one, so results are never null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space and the byte-order mark; characters without a width.
SPACES = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
ZERO_WIDTH = "\u200b\u200c\u200d\ufeff"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def trim(c: Column) -> Column:
    return F.btrim(text(c), F.lit(SPACES))


def collapse(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.btrim(F.regexp_replace(F.translate(text(c), SPACES, " " * len(SPACES)), "  +", " "), F.lit(" "))


def header(c: Column) -> Column:
    return F.lower(collapse(c))


def canonical_header(c: Column) -> Column:
    """Lower case without any white space; symbols stay."""
    return F.translate(F.lower(text(c)), SPACES, "")


def bare_header(c: Column) -> Column:
    """Only Latin letters, digits and Thai letters: headers alike in this differ in symbols."""
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9\\x{0E01}-\\x{0E59}]", "")


def value(c: Column) -> Column:
    """No-break spaces to spaces, zero-width characters dropped, trimmed; case and inner spaces stay."""
    return trim(F.translate(text(c), "\u00a0" + ZERO_WIDTH, " "))


def cell_header(c: Column) -> Column:
    return F.lower(collapse(value(c)))


def upper_key(c: Column) -> Column:
    return F.upper(trim(c))


def upper_text(c: Column) -> Column:
    return F.upper(collapse(c))


def summary_key(c: Column) -> Column:
    return F.upper(F.translate(value(c), SPACES, ""))


def identifier(c: Column) -> Column:
    """Digits lose their leading zeros, other identifiers their case."""
    v = value(c)
    return F.when(v.rlike("^[0-9]+$"), F.regexp_replace(v, "^0+(?=[0-9])", "")).otherwise(F.lower(v))


def strip_suffix(c: Column, *suffixes: str) -> Column:
    """Without the first of the suffixes that it ends in."""
    return F.regexp_replace(text(c), f"({'|'.join(suffixes)})$", "")


def blank(c: Column) -> Column:
    return value(c) == ""


def first_filled(*cs: Column) -> Column:
    """The first trimmed value that isn't blank; blank if none is."""
    return F.coalesce(*(F.nullif(trim(c), F.lit("")) for c in cs), F.lit(""))


def without_placeholder(c: Column, *messages: str) -> Column:
    """The value, blank where it is a message that a validation left in a blank cell."""
    v = value(c)
    return F.when(v.isin(*messages), "").otherwise(v)
