"""Data quality of sheets: headers, required cells, complete groups of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as n

FOUND, EMPTY, INCOMPLETE_REQUIRED, INCOMPLETE_CHECK = "FOUND", "EMPTY", "INCOMPLETE_REQUIRED", "INCOMPLETE_CHECK"


def header_match(required: DataFrame, actual: DataFrame, aliases: DataFrame) -> DataFrame:
    """For each required name: outcome, the actual header and its position.

    required: name. actual: position, header. aliases: name, alias. FOUND and ALIAS compare without
    white space and case; of several the first position counts. Otherwise SYMBOL_NOT_MATCH names a
    header that is alike but for symbols, and NO_SIMILAR_HEADER none. Header tables are as small as a
    sheet is wide.
    """
    named = required.select("name", n.canonical_header(F.col("name")).alias("k"), F.lit(0).alias("by_alias"))
    known = named.unionByName(required.join(aliases, "name").select("name", n.canonical_header(F.col("alias")).alias("k"), F.lit(1).alias("by_alias")))
    heads = actual.select("position", "header", n.canonical_header(F.col("header")).alias("k"), n.bare_header(F.col("header")).alias("bare"))
    exact = known.join(heads, "k").groupBy("name").agg(F.min_by(F.struct("header", "position", "by_alias"), F.struct("position", "by_alias")).alias("e"))
    # Headers without a letter or digit are like none.
    like = required.select("name", n.bare_header(F.col("name")).alias("bare")).where("bare != ''").join(heads, "bare").groupBy("name").agg(F.min_by(F.struct("header", "position"), "position").alias("s"))
    joined = required.join(exact, "name", "left").join(like, "name", "left")
    outcome = F.when(F.col("e.by_alias") == 0, "FOUND").when(F.col("e").isNotNull(), "ALIAS").when(F.col("s").isNotNull(), "SYMBOL_NOT_MATCH").otherwise("NO_SIMILAR_HEADER")
    return joined.select("name", outcome.alias("outcome"), F.coalesce("e.header", "s.header").alias("header"), F.coalesce("e.position", "s.position").alias("position"))


def not_in(required: DataFrame, actual: DataFrame, name: str) -> DataFrame:
    """Distinct required names that actual lacks."""
    return required.select(name).distinct().join(actual.select(name), name, "left_anti")


def unsupported(requested: list[str], supported: list[str]) -> list[str]:
    """Distinct requested names, in order, that aren't supported."""
    return [x for x in dict.fromkeys(requested) if x not in set(supported)]


def cell_states(columns: list[str]) -> Column:
    """Array of (header, value, status) of these cells of a row; status: FOUND or EMPTY."""
    value = lambda c: n.value(F.col(f"`{c}`"))
    return F.array(*(F.struct(F.lit(c).alias("header"), value(c).alias("value"), F.when(value(c) == "", EMPTY).otherwise(FOUND).alias("status")) for c in columns))


def required_cells(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, header, value, status (FOUND or EMPTY) for each cell; columns that rows lack are left out."""
    return rows.select(*keys, F.inline(cell_states([c for c in columns if c in rows.columns])))


def complete_group(kind: Column, account: Column, amount: Column) -> Column:
    """Array of (part, value, status) for a group of three cells.

    All filled: three FOUND. None: nothing. The amount alone: the others are to be checked. Else blanks
    are required.
    """
    k, a, m = (~n.blank(c) for c in (kind, account, amount))
    filled = k.cast("int") + a.cast("int") + m.cast("int")
    alone = m & ~k & ~a
    state = lambda have: F.when(have, FOUND).when(alone, INCOMPLETE_CHECK).otherwise(INCOMPLETE_REQUIRED)
    cells = (("type", k, kind), ("account", a, account), ("amount", m, amount))
    parts = F.array(*(F.struct(F.lit(p).alias("part"), n.value(c).alias("value"), state(have).alias("status")) for p, have, c in cells))
    return F.when(filled > 0, parts).otherwise(F.filter(parts, lambda x: F.lit(False)))


def group_states(columns: list[str], groups: list[tuple[str, str, str]]) -> Column:
    """Array of (slot, part, value, status) of a row's filled groups; a group with a missing column is skipped."""
    have = [(i, g) for i, g in enumerate(groups, 1) if set(g) <= set(columns)]
    return F.flatten(F.array(*(_slotted(i, complete_group(*(F.col(f"`{c}`") for c in g))) for i, g in have)))


def group_completeness(rows: DataFrame, keys: list[str], groups: list[tuple[str, str, str]]) -> DataFrame:
    """keys, slot, part, value, status for each filled group; a group with a missing column is skipped."""
    return rows.select(*keys, F.inline(group_states(rows.columns, groups)))


def _slotted(slot: int, parts: Column) -> Column:
    return F.transform(parts, lambda x: F.struct(F.lit(slot).alias("slot"), x["part"].alias("part"), x["value"].alias("value"), x["status"].alias("status")))


def without_trailing_blanks(rows: DataFrame, per: list[str], ordinal: str, filled: Column) -> DataFrame:
    """Rows up to the last filled one of each group; blank rows between stay."""
    last = rows.where(filled).groupBy(*per).agg(F.max(ordinal).alias("_last"))
    return rows.join(last, per).where(F.col(ordinal) <= F.col("_last")).drop("_last")


def without_blank_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with at least one filled column."""
    any_filled = F.lit(False)
    for c in columns:
        any_filled = any_filled | ~n.blank(F.col(f"`{c}`"))
    return rows.where(any_filled)
