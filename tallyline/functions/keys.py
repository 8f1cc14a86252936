"""Keys that expected rows are found by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import trim


def slot_key(identifier: Column, slot: Column, infix: str = "GPMH", end: str = "RM") -> Column:
    """ID_NN_infix_III_end, III the first three characters of the id; null for an id under three characters or a slot under 1."""
    i = F.upper(trim(identifier))
    two = F.when(slot < 100, F.lpad(slot.cast("string"), 2, "0")).otherwise(slot.cast("string"))
    made = F.concat_ws("_", i, two, F.lit(infix), F.substring(i, 1, 3), F.lit(end))
    return F.when((F.length(i) >= 3) & (slot >= 1), made)


def suffix_keys(identifier: Column, slots: dict[str, Column]) -> Column:
    """Array of (suffix, key) for each suffix whose condition holds."""
    made = [F.when(on, F.struct(F.lit(s).alias("suffix"), F.concat(F.upper(trim(identifier)), F.lit(s)).alias("key"))) for s, on in slots.items()]
    return F.filter(F.array(*made), lambda x: x.isNotNull())
