"""Places in, and runs of equal values along, one order over all rows, without a window over all rows.

Rows are sorted by ranges, one partition a range, and checkpointed, so that a row's partition and its place
in it are fixed whatever is lost later. Partitions are cut into blocks of so many rows, which are dealt anew
where neighbours are compared, so that no task holds a range. Each block then tells a few numbers about
itself; the driver adds these up, one row for each block, and every row is moved on by what lies before its
block.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import shared_folder

#: A row's place in its block fills so many bits of the number that Spark gives it; those above are the block's, its partition and its place there.
_BITS = 16
PART, INDEX = "_part", "_index"


def checkpointed(rows: DataFrame) -> DataFrame:
    """rows, computed once and written to the session's checkpoint folder."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def sequenced(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """rows sorted by ranges of the order, with `_part`, the number of the block, and `_index`, the place in it from 0. An order without ties gives the same in every run."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    numbered = sorted_.withColumns({PART: F.shiftright("_id", _BITS), INDEX: F.col("_id").bitwiseAND(F.lit((1 << _BITS) - 1))}).drop("_id")
    return checkpointed(numbered)


def moved(rows: DataFrame, before: dict[int, int], into: str, value: Column) -> DataFrame:
    """value, raised by what lies before the row's block."""
    table = rows.sparkSession.createDataFrame(sorted(before.items()), f"{PART} long, _before long")
    return rows.join(F.broadcast(table), PART).withColumn(into, (value + F.col("_before")).cast("long")).drop("_before")


def placed(rows: DataFrame, order: list[Column | str], into: str = "place", kept: bool = False) -> DataFrame:
    """rows with the place of each, from 1, in that order over all of them.

    kept: rows that are dear to make, as those of sheets, lie on the executors' disks until they are sorted;
    else they are made twice, as ranges are chosen by a look at all rows.
    """
    if kept:
        rows = rows.persist(StorageLevel.DISK_ONLY)
    made, before, total = sequenced(rows, order), {}, 0
    if kept:
        rows.unpersist()
    for r in made.groupBy(PART).count().orderBy(PART).collect():
        before[r[PART]], total = total, total + r["count"]
    return moved(made, before, into, F.col(INDEX) + 1).drop(PART, INDEX)


def runs(rows: DataFrame, order: list[str], value: str, per: list[str] = (), into: str = "island") -> DataFrame:
    """Runs of equal neighbouring values in that order: `island` numbers them from 1, and from 1 again in each group of `per`, by which the order begins.

    A run, and a group, may go on over many blocks. Null is a value like others.
    """
    made = sequenced(rows, [*per, *order])
    here = Window.partitionBy(PART).orderBy(INDEX)
    up_to = here.rowsBetween(Window.unboundedPreceding, 0)
    first = F.col(INDEX) == 0
    group = F.struct(*(F.col(f"`{c}`") for c in per)) if per else F.lit(True)
    begins = ~first & ~group.eqNullSafe(F.lag(group).over(here))
    fresh = first | begins | ~F.col(f"`{value}`").eqNullSafe(F.lag(f"`{value}`").over(here))
    # The runs so far in the block, and how many of them were before its last group began; null while that is the group it begins with.
    made = made.withColumns({"_fresh": fresh.cast("long"), "_begins": begins}).withColumn("_runs", F.sum("_fresh").over(up_to))
    made = made.withColumn("_ahead", F.max(F.when(F.col("_begins"), F.col("_runs") - 1)).over(up_to)).drop("_fresh", "_begins")
    ends = F.struct(group.alias("group"), F.col(f"`{value}`").alias("value"))
    parts = made.groupBy(PART).agg(F.min_by(ends, INDEX).alias("head"), F.max_by(ends, INDEX).alias("tail"), F.max("_runs").alias("runs"), F.max("_ahead").alias("ahead")).orderBy(PART).collect()
    before, tail, reached = {}, None, 0
    for p in parts:
        same = tail is not None and p.head.group == tail.group
        before[p[PART]] = reached - (p.head.value == tail.value) if same else 0
        reached = p.runs + before[p[PART]] if p.ahead is None else p.runs - p.ahead
        tail = p.tail
    table = made.sparkSession.createDataFrame(sorted(before.items()), f"{PART} long, _before long")
    number = F.when(F.col("_ahead").isNull(), F.col("_runs") + F.col("_before")).otherwise(F.col("_runs") - F.col("_ahead"))
    return made.join(F.broadcast(table), PART).withColumn(into, number.cast("long")).drop("_runs", "_ahead", "_before", PART, INDEX)
