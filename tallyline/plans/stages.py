"""What comes before and after a report's reconciliation: sheet validation, output rows, detail rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as n
from ..operators import completeness, matching, ordering, reshape, rollup, summary
from . import contracts as k
from .reports import ROW, at, identified, lookup

#: Headers of fee columns; the slot is the number in them.
FEE_HEADERS = {"type": r"^fee type (\d+)$", "account": r"^fee charge account no\.? type (\d+)$", "amount": r"^fee amount(?: type)? (\d+)$", "currency": r"^fee currency (\d+)$"}


def fee_columns(columns: list[str]) -> dict[int, dict[str, str]]:
    """slot -> part -> column, for the fee columns among a sheet's headers."""
    out: dict[int, dict[str, str]] = {}
    for c in columns:
        plain = " ".join(c.split()).lower()
        for part, pattern in FEE_HEADERS.items():
            if m := re.match(pattern, plain):
                out.setdefault(int(m[1]), {})[part] = c
    return dict(sorted(out.items()))


def check_headers(spark: SparkSession, columns: list[str], required: tuple[str, ...], fee_slots: int = 0) -> DataFrame:
    """One row for each required header: how it was found, or what is nearest to it."""
    aliases = k.ALIASES | k.fee_aliases(fee_slots)
    pairs = [(name, a) for name in required for a in aliases.get(name, ())]
    return completeness.header_match(
        spark.createDataFrame([(x,) for x in required], "name string"),
        spark.createDataFrame(list(enumerate(columns, 1)), "position long, header string"),
        spark.createDataFrame(pairs, "name string, alias string"),
    )


def require_headers(found: DataFrame) -> None:
    """Raise, naming all required headers that are missing. Reads one row for each at most."""
    missing = [r.name for r in found.where("outcome not in ('FOUND', 'ALIAS')").orderBy("name").collect()]
    if missing:
        raise ValueError(f"missing headers: {missing}")


def check_cells(test: DataFrame, contract: k.Contract) -> DataFrame:
    """The validation sheet: _file, _row, header, value, status, remark for required cells, and for the parts of fee groups that have any. The sheet is read once."""
    test = identified(test)
    names = [k.TEST_ID, *contract.core, *contract.customer]
    asked = test.select(*ROW, *(lookup(test, c).alias(c) for c in names), *(at(g[p]).alias(f"{p} {i}") for i, g in fee_columns(test.columns).items() for p in g))
    slots = [i for i, g in fee_columns(test.columns).items() if {"type", "account", "amount"} <= set(g) and i <= contract.fee_slots]
    cells = completeness.cell_states(names)
    if slots:
        parts = completeness.group_states(asked.columns, [(f"type {i}", f"account {i}", f"amount {i}") for i in slots])
        number = F.array(*map(F.lit, slots))
        named = F.transform(parts, lambda x: F.struct(F.concat_ws(" ", F.lit("Fee"), x["part"], F.element_at(number, x["slot"])).alias("header"), x["value"].alias("value"), x["status"].alias("status")))
        cells = F.concat(cells, named)
    remark = F.when(F.col("status") == completeness.FOUND, k.HAS_VALUE).when(F.col("status") == completeness.INCOMPLETE_CHECK, k.CHECK_MESSAGE).otherwise(k.REQUIRED_MESSAGE)
    return asked.select(*ROW, F.inline(cells)).withColumn("remark", remark)


STATES = (completeness.FOUND, completeness.EMPTY, completeness.INCOMPLETE_REQUIRED, completeness.INCOMPLETE_CHECK)


def validate(test: DataFrame, columns: list[str], contract: k.Contract, write: Callable[[str, DataFrame], None]) -> DataFrame:
    """Check headers, then cells; hand both results to write; then raise if a required header is missing. Cells that don't pass fail nothing. Returns the cells' results.

    Cells are never changed: what a check says about them stands beside them, not in them.
    """
    return validated(test, columns, contract, write)[0]


def validated(test: DataFrame, columns: list[str], contract: k.Contract, write: Callable[[str, DataFrame], None]) -> tuple[DataFrame, Observation]:
    """validate(), and the number of cells of each state, counted as write() writes them: the sheet is read once for both. A write() that runs nothing counts nothing."""
    headers = check_headers(test.sparkSession, columns, contract.test_data(), contract.fee_slots)
    cells, seen = summary.observed(check_cells(test, contract), values=STATES)
    write("headers", headers)
    write("cells", cells)
    require_headers(headers)
    return cells, seen


def output_rows(results: DataFrame, report: DataFrame, key: Column, order: tuple[str, ...] = rollup.ORDER) -> DataFrame:
    """The result sheet: each report row with the results that it was found by, untagged rows with blank status, then expected rows that the report lacks; in the order of their status.

    A report row that several results share appears once for each.
    """
    rows = identified(report).withColumnsRenamed({"_row": "report_row", "_file": "report_file"})
    tagged = results.select("test_no", "key", "status", "outcome", "remark", "report_file", "report_row")
    found = matching.fan_out(rows, tagged.where("report_row is not null"), ["report_file", "report_row"]).withColumn("key", F.coalesce("key", key))
    lacking = tagged.where("report_row is null").withColumn("status", F.when(F.col("outcome") == "EXPECTED_ABSENCE", "EXPECTED_ABSENCE").when(F.col("status") == "FAIL", "MISSING").otherwise(F.col("status")))
    all_rows = found.withColumn("status", F.coalesce("status", F.lit("UNTAGGED"))).unionByName(lacking, allowMissingColumns=True)
    return rollup.in_order(all_rows, "status", ["report_file", "report_row", "key"], order)


def output_places(output: DataFrame, order: tuple[str, ...] = rollup.ORDER) -> DataFrame:
    """output_rows() with `place`, the row of the result sheet that each takes, below the header's. No task holds the sheet."""
    return ordering.placed(output.withColumn("bucket", rollup.bucket(F.col("status"), order)), ["bucket", "report_file", "report_row", "key"]).withColumn("place", F.col("place") + k.REPORT_HEADER_ROW)


def result_sheet(code: str, output: DataFrame, report: DataFrame) -> DataFrame:
    """The output rows under the headers of the report's result sheet: test number, result, remark, then the report's columns; its order is the rows' order."""
    number, result, remark = k.RESULT_SHEETS[code]
    own = [c for c in report.columns if c not in ROW]
    return output.select(F.col("test_no").alias(number), F.col("status").alias(result), F.col("remark").alias(remark), *map(at, own))


def detail_rows(results: DataFrame, test: DataFrame, suffixes: tuple[str, ...] = ("DR", "FE"), by_reference: bool = True, fees_too: bool = True) -> DataFrame:
    """Each result beside its test row (test_file, test_row): by reference without its suffix, else by test number, else the only test row without a number; `tier` tells which.

    A test row without a number has its reference for one. Repeated references, several test rows of one
    number and results without a test row fail the job (matching.resolved). Without by_reference the test
    number alone counts, of several test rows the first, and a result may have none. Messages that a
    validation left in blank cells are blank. Filled fee groups come as one array column, `fees`, of
    (slot, type, account, amount).
    """
    test = identified(test)
    plain = lambda c: n.without_placeholder(c, k.REQUIRED_MESSAGE, k.CHECK_MESSAGE)
    fees = {i: {p: plain(at(g[p])) if p in g else F.lit("") for p in ("type", "account", "amount")} for i, g in fee_columns(test.columns).items()} if fees_too else {}
    used = {i: (p["type"] != "") | (p["account"] != "") | (p["amount"] != "") for i, p in fees.items()}
    active = reshape.active_slots(fees, used) if fees else F.lit(None).cast("array<struct<slot:int,type:string,account:string,amount:string>>")
    found_at = F.struct(F.col("_file").alias("test_file"), F.col("_row").alias("test_row"))
    without = lambda c: n.strip_suffix(n.summary_key(c), *suffixes) if suffixes else n.summary_key(c)
    identifier, own = lookup(test, k.TEST_ID), lookup(test, k.TEST_NO)
    keyed = test.select(F.struct(found_at.alias("at"), active.alias("fees")).alias("test_at"), without(plain(identifier)).alias("reference"), n.summary_key(plain(own)).alias("number"), (n.summary_key(own) == "").alias("unnumbered"), (plain(own) == n.value(own)).alias("own_number"), (plain(identifier) == n.value(identifier)).alias("own_reference"), n.summary_key(plain(identifier)).alias("whole"))
    rows = results.withColumn("reference", without(F.col("key"))).withColumn("number", n.summary_key(F.col("test_no")))
    if by_reference:
        # A message in a blank cell is no number, and none is taken in its place.
        number = F.when(F.col("own_number") & F.col("own_reference"), F.nullif(F.when(F.col("number") != "", F.col("number")).otherwise(F.col("whole")), F.lit("")))
        numbers = F.array_compact(F.array(number, F.when(F.col("unnumbered"), "")))
        found = matching.resolved(rows, keyed.select("test_at", "reference", numbers.alias("numbers")), "reference", "number", "test_at")
    else:
        first = keyed.where("number != ''").groupBy(F.col("number").alias("_number")).agg(F.min("test_at").alias("test_at"))
        found = matching.asked(rows, first, F.when(F.col("number") != "", F.col("number")), "_number", F.col("reference")).drop("_number").withColumn("tier", F.when(F.col("test_at").isNotNull(), 2).otherwise(0))
    return found.select("*", "test_at.fees", "test_at.at.*").drop("reference", "number", "test_at")


#: Headers of a summary sheet's fee groups, by part.
SUMMARY_FEES = {"type": "Fee Type {}", "account": "Fee Charge Account No. Type {}", "amount": "Fee Amount Type {}", "currency": "Fee Currency {}"}


def summary_sheet(details: DataFrame, test: DataFrame, fields: tuple[str, ...], least_fees: int = 0, order: tuple[str, ...] = rollup.ORDER) -> DataFrame:
    """The rows of a summary sheet: place (from 1), block, test result, reason, reference, then of the test row its number, `fields`, and its fee groups side by side.

    details: of detail_rows(). There are as many fee groups as the highest that any row's test row fills, at
    least least_fees, gaps among them left blank; that number is found by a count ahead. Rows are in the
    order of a result sheet; neighbours with the same test row are a block, whose cells of the test row a
    sheet shows once. Messages that a validation left in blank cells are blank.
    """
    test = identified(test)
    plain = lambda c: n.without_placeholder(c, k.REQUIRED_MESSAGE, k.CHECK_MESSAGE)
    fees = {i: {p: plain(at(g[p])) if p in g else F.lit("") for p in SUMMARY_FEES} for i, g in fee_columns(test.columns).items()}
    names = {f: f"field {i}" for i, f in enumerate((k.TEST_NO, *fields))}
    parts = {(i, p): f"{p} {i}" for i in fees for p in SUMMARY_FEES}
    row = test.select(F.col("_file").alias("test_file"), F.col("_row").alias("test_row"), *(plain(lookup(test, f)).alias(c) for f, c in names.items()), *(fees[i][p].alias(c) for (i, p), c in parts.items()))
    told = details.select("test_file", "test_row", F.col("status").alias("Test Result"), F.col("remark").alias("Reason"), F.col("key").alias("Reference"), rollup.bucket(F.col("status"), order).alias("_bucket"), "report_file", "report_row")
    joined = told.join(row, ["test_file", "test_row"], "left")
    used = {i: F.concat(*(F.coalesce(at(parts[i, p]), F.lit("")) for p in SUMMARY_FEES)) != "" for i in fees}
    most = max(least_fees, reshape.max_active_slot(joined, used).first()[0] if used else 0)
    order_by = ["_bucket", "report_file", "report_row", "Reference"]
    same = F.struct("test_file", "test_row")
    numbered = ordering.runs(ordering.placed(joined.withColumn("_test", same), order_by), ["place"], "_test", into="block")
    shown = lambda c: F.coalesce(at(c), F.lit(""))
    wide = [(shown(parts[i, p]) if i in fees else F.lit("")).alias(head.format(i)) for i in range(1, most + 1) for p, head in SUMMARY_FEES.items()]
    return numbered.select("place", "block", "Test Result", "Reason", "Reference", *(shown(c).alias(f) for f, c in names.items()), *wide)


def repeated_tests(test: DataFrame) -> DataFrame:
    """Transaction ids that several test rows share; for summary.enforce where a report asks for unique ones."""
    keyed = test.select(n.upper_key(lookup(test, k.TEST_ID)).alias("key")).where("key != ''")
    return keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
