"""Repeated groups of columns to rows and back; runs of equal rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def slots(rows: DataFrame, parts: dict[int, dict[str, Column]], used: dict[int, Column], keep_empty: bool = True) -> DataFrame:
    """One row for each used slot, with `slot` (the group's own number, gaps kept), `has_slot` and the parts.

    parts: slot -> name -> Column; used: slot -> whether it is filled. With keep_empty a row without a
    used slot stays once, with a null slot.
    """
    made = F.filter(F.array(*(F.when(used[i], F.struct(F.lit(i).alias("slot"), *(c.alias(k) for k, c in p.items()))) for i, p in parts.items())), lambda x: x.isNotNull())
    out = rows.select("*", (F.inline_outer if keep_empty else F.inline)(made))
    return out.withColumn("has_slot", F.col("slot").isNotNull())


def active_slots(parts: dict[int, dict[str, Column]], used: dict[int, Column]) -> Column:
    """Array of the filled groups as structs, in order."""
    return F.filter(F.array(*(F.when(used[i], F.struct(F.lit(i).alias("slot"), *(c.alias(k) for k, c in p.items()))) for i, p in parts.items())), lambda x: x.isNotNull())


def max_active_slot(rows: DataFrame, used: dict[int, Column]) -> DataFrame:
    """One row: the highest slot that any row fills, 0 if none."""
    return rows.select(F.greatest(F.lit(0), *(F.when(c, i).otherwise(0) for i, c in used.items())).alias("s")).agg(F.coalesce(F.max("s"), F.lit(0)).alias("max_slot"))


def widened(rows: DataFrame, keys: list[str], slot: str, values: list[str], most: int) -> DataFrame:
    """Long slots to columns <value>_<slot> for slots 1 to most, which the caller finds first with max_active_slot."""
    cells = [F.max(F.when(F.col(slot) == i, F.col(v))).alias(f"{v}_{i}") for i in range(1, most + 1) for v in values]
    return rows.groupBy(*keys).agg(*cells)


def islands(rows: DataFrame, per: list[str], order: list[str], value: str) -> DataFrame:
    """Runs of equal neighbouring values: `island` numbers them from 1 within each group."""
    w = Window.partitionBy(*per).orderBy(*order)
    new = (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    return rows.withColumn("_new", new).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
