"""Counts and integrity checks of reconciled rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counts(rows: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """by, total, n_pass, n_fail, n_skip, and balanced: whether these make up the total."""
    n = {s: F.count_if(F.col(status) == s.upper()) for s in ("pass", "fail", "skip")}
    out = rows.groupBy(*by).agg(F.count("*").alias("total"), *(c.alias(f"n_{s}") for s, c in n.items()))
    return out.withColumn("balanced", F.col("total") == F.col("n_pass") + F.col("n_fail") + F.col("n_skip"))


def integrity(results: DataFrame, details: DataFrame, status: str = "status") -> DataFrame:
    """One row: total, n_pass, n_fail, n_skip, n_details, balanced (these make up the total) and complete (as many details as results)."""
    total = counts(results, [], status)
    return total.crossJoin(details.agg(F.count("*").alias("n_details"))).withColumn("complete", F.col("total") == F.col("n_details"))


def violations(checked: DataFrame) -> DataFrame:
    """Rows of integrity() that don't add up, for enforce()."""
    return checked.where("not balanced or not complete")


def observed(rows: DataFrame, by: str = "status", values: tuple[str, ...] = ("PASS", "FAIL", "SKIP")) -> tuple[DataFrame, Observation]:
    """rows, and what is counted of them while a plan that holds them is written: total, and n_<value> for each value. It has nothing to give until then, and waits."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("total"), *(F.count_if(F.col(by) == v).alias(f"n_{v.lower()}") for v in values)), seen


def gate(results: dict[str, int], details: int) -> dict[str, int]:
    """The counts of results; raises if they don't make up the total, or there aren't as many details."""
    if (parts := sum(results[f"n_{s}"] for s in ("pass", "fail", "skip"))) != results["total"]:
        raise ValueError(f"counts: {parts} of {results['total']} results pass, fail or are skipped")
    if details != results["total"]:
        raise ValueError(f"counts: {details} details of {results['total']} results")
    return results


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def enforce(violations: DataFrame, check: str) -> None:
    """Raise if there is a violation, naming one. Reads at most one row."""
    if rows := violations.limit(1).collect():
        raise ValueError(f"{check}: {rows[0].asDict(recursive=True)}")


Hook = Callable[[DataFrame], Column]


def exceptions(rows: DataFrame, hook: Hook | None) -> DataFrame:
    """`reason` from an optional callable that returns a Column; null without one."""
    return rows.withColumn("reason", hook(rows) if hook else F.lit(None).cast("string"))
