"""Sharding by proportional stratified interleaving.

Rows are ranked within their source in a seeded random order; the fractional rank orders all rows so
that each stretch of them has the mixture of the whole, and the order is cut into equal stretches.
Only ids, sources and sizes are shuffled. No rank is taken over a whole source or the whole table in
one task: rows are dealt by ranges of the hash and of the fractional rank, ranked within these, and
moved on by the counts of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, told_apart

#: Rows that a range holds, about; a range is ranked in one task. Ranges of a block, whose counts are summed up in one task.
RANGE_ROWS, BLOCK = 2_000, 1_000


def starts(rows: DataFrame, groups: list[str], bucket: str) -> DataFrame:
    """groups, bucket, `_before` (the rows of the group in lower buckets) and `_n` (all its rows).

    Counts are summed up within blocks of buckets and then over blocks, so that no task sums up more than
    BLOCK counts, or one for each block.
    """
    counts = rows.groupBy(*groups, bucket).agg(F.count("*").alias("_c")).withColumn("_block", F.floor(F.col(bucket) / BLOCK))
    lower = lambda w: F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = counts.withColumn("_inside", lower(Window.partitionBy(*groups, "_block").orderBy(bucket)))
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    blocks = counts.groupBy(*groups, "_block").agg(F.sum("_c").alias("_c")).withColumn("_ahead", lower(whole.orderBy("_block"))).withColumn("_n", F.sum("_c").over(whole)).drop("_c")
    return inside.join(blocks, [*groups, "_block"]).select(*groups, bucket, (F.col("_inside") + F.col("_ahead")).alias("_before"), "_n")


def ranked(rows: DataFrame, groups: list[str], bucket: str, order: list, into: str) -> DataFrame:
    """rows with the place, from 0, of each in its group by bucket and then order, and `_n`, the rows of the group. Groups and buckets aren't null."""
    within = F.row_number().over(Window.partitionBy(*groups, bucket).orderBy(*order)) - 1
    placed = rows.withColumn("_within", within).join(starts(rows, groups, bucket), [*groups, bucket])
    return placed.withColumn(into, (F.col("_within") + F.col("_before")).cast("long")).drop("_within", "_before")


def interleave(docs: DataFrame, shards: int = 24, seed: int = 42, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for each row; the law is `rows`.

    size: UTF-8 bytes of the text plus 8; a null text has no bytes, and its crc32 is that of none, 0.
    Shards' row counts differ by one at most; with fewer rows than shards some stay empty. Rows without
    a source are a source of their own. A row's order is a hash of its id and text; rows alike in these and
    in source are counted and told apart by a number, so that however many there are, they are dealt to
    all ranges, and the result doesn't depend on the layout of the input. An empty table gives no rows.
    Texts of any length count by size and crc32 alone.
    """
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    # A few numbers for each row are written once; texts aren't read again.
    counted = keep(rows.groupBy(*rows.columns).agg(F.count("*").alias("_k")), "sizes")
    total, most = (x or 0 for x in counted.agg(F.sum("_k"), F.max("_k")).first())
    ranges = max(1, total // RANGE_ROWS)

    # Ranges are dealt by all that tells rows apart, so that many rows of one id or one text don't lie in one.
    rows = told_apart(counted, "_k", "_copy", most).withColumn("_s", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), F.col("source").cast("string"))))
    rows = rows.withColumn("_h", F.xxhash64("doc_id", F.lit(seed))).withColumn("_b", F.pmod(F.xxhash64("doc_id", "text_crc32", "size", "_copy", F.lit(seed)), F.lit(ranges)))
    order = ["_h", "doc_id", "text_crc32", "size", "_copy"]
    rows = keep(ranked(rows, ["_s"], "_b", order, "_rank"), "ranked")

    # The fractional rank is (rank + 1/2) / n; its range is exact in whole numbers.
    rows = rows.withColumn("_f", (F.col("_rank") * 2 + 1) / (F.col("_n") * 2)).withColumn("_b", F.expr(f"((_rank * 2 + 1) * {ranges}) div (_n * 2)")).drop("_n")
    rows = ranked(rows, [], "_b", ["_f", "_h", *order[1:], "source"], "_place")

    shard = F.expr(f"_place * {shards} div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return rows.withColumn("shard", shard.cast("int")).select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("_place") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
