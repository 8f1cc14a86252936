"""From results per field to one row per expected row: status, remarks, failed fields, order.

Results of one row's fields are an array in the row (compare.results) and are rolled up there, without a
shuffle. Only where several rows make one result, they are rows that are grouped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .compare import FAIL, PASS, REVIEW, SKIP


def row_status(results: Column, with_skip: bool = True) -> Column:
    """FAIL if any fails; SKIP if there are some and all are skipped; else PASS."""
    out = F.when(F.exists(results, lambda x: x["status"] == FAIL), FAIL)
    return (out.when((F.size(results) > 0) & F.forall(results, lambda x: x["status"] == SKIP), SKIP) if with_skip else out).otherwise(PASS)


def row_lines(results: Column, line: Callable[[Column], Column], *statuses: str) -> Column:
    """Array of a line for each result of these statuses, in the fields' order."""
    return F.transform(F.filter(results, lambda x: x["status"].isin(*statuses)), line)


def row_names(results: Column, status: str) -> Column:
    """Sorted array of the fields of this status; fields that passed as skipped aren't among the passed."""
    held = F.filter(results, lambda x: (x["status"] == status) & ~((x["status"] == PASS) & F.lower(F.trim(x["reason"])).startswith("skipped")))
    return F.array_sort(F.array_distinct(F.transform(held, lambda x: x["field"])))


def row_map(results: Column) -> Column:
    """Map from field to status; of repeated fields the last one counts."""
    last = F.filter(results, lambda x: ~F.exists(results, lambda y: (y["field"] == x["field"]) & (y["ordinal"] > x["ordinal"])))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["field"], x["status"])))


def plain_line(x: Column) -> Column:
    return F.concat(x["field"], F.lit(": expected "), shown(x["expected"]), F.lit(", actual "), shown(x["actual"]))


def group_status(status: Column, with_skip: bool = True) -> Column:
    """An aggregate: FAIL if any fails; SKIP if all are skipped; else PASS."""
    out = F.when(F.bool_or(status == FAIL), FAIL)
    return (out.when(F.bool_and(status == SKIP), SKIP) if with_skip else out).otherwise(PASS)


def ordered(value: Column, when: Column, ordinal: str = "ordinal") -> Column:
    """An aggregate: array of the values whose condition holds, by ordinal. Groups are the fields of one row, so they are small."""
    both = F.collect_list(F.when(when, F.struct(F.col(ordinal).alias("o"), value.alias("v"))))
    return F.transform(F.array_sort(both), lambda x: x["v"])


def shown(c: Column) -> Column:
    return F.when(c == "", "(blank)").otherwise(c)


def remark(field: str = "field", expected: str = "expected", actual: str = "actual", status: str = "status") -> Column:
    """An aggregate: a line for each failed field, in the fields' order."""
    line = F.concat(F.col(field), F.lit(": expected "), shown(F.col(expected)), F.lit(", actual "), shown(F.col(actual)))
    return F.array_join(ordered(line, F.col(status) == FAIL), "\n")


def rolled(results: DataFrame, keys: list[str], with_skip: bool = True) -> DataFrame:
    """keys, status, remark, passed_fields, failed_fields and review_fields (sorted arrays), n_fields."""
    named = lambda s: F.array_sort(F.collect_set(F.when(F.col("status") == s, F.col("field"))))
    return results.groupBy(*keys).agg(
        group_status(F.col("status"), with_skip).alias("status"),
        remark().alias("remark"),
        named(PASS).alias("passed_fields"),
        named(FAIL).alias("failed_fields"),
        named(REVIEW).alias("review_fields"),
        F.count("*").alias("n_fields"),
    )


#: Order of the output by status; what isn't listed comes after the listed.
ORDER_WITH_SKIP = ("PASS", "UNTAGGED", "SKIP", "FAIL", "MISSING")
ORDER = ("PASS", "UNTAGGED", "FAIL", "EXPECTED_ABSENCE", "MISSING")


def bucket(status: Column, order: tuple[str, ...]) -> Column:
    out = F.lit(len(order) + 1)
    for i, s in reversed(list(enumerate(order, 1))):
        out = F.when(status == s, i).otherwise(out)
    return out


def in_order(rows: DataFrame, status: str, within: list[str], order: tuple[str, ...] = ORDER) -> DataFrame:
    """Rows by bucket and then source order. The sort is a range-partitioned one."""
    return rows.withColumn("bucket", bucket(F.col(status), order)).orderBy("bucket", *within)


def ordinals(rows: DataFrame, status: str, within: list[str], per: list[str], order: tuple[str, ...] = ORDER) -> DataFrame:
    """The place of each row in that order, within each group of `per`."""
    ranked = rows.withColumn("bucket", bucket(F.col(status), order))
    return ranked.withColumn("place", F.row_number().over(Window.partitionBy(*per).orderBy("bucket", *within)))
