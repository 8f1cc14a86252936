"""The four reports' reconciliation plans.

Each takes the test data (expected) and the report (actual) as sheets read by sources.sheet, that is
text columns, `_file` and `_row` (a sheet of one file may lack `_file`), and returns the row results:
test_no, key, _file and _row (of the test data), status, outcome, remark, passed_fields, failed_fields,
review_fields, report_file, report_row. A row is named by file and row together, and of equal keys the
first or last row goes by file, then row. Every plan is lazy; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, keys, normalize as n
from ..functions.numbers import TOLERANCE, money, number, number_or_zero, total, within
from ..operators import compare as c, matching, reshape, rollup, rules
from ..operators.matching import Policy
from . import contracts as k


def lookup(rows: DataFrame, *names: str) -> Column:
    """The column whose header is one of the names, white space and case aside; the last such column; blank if there is none."""
    canonical = lambda h: "".join(h.lower().split())
    wanted = {canonical(x) for x in names}
    found = [x for x in rows.columns if canonical(x) in wanted]
    return n.text(F.col(f"`{found[-1]}`")) if found else F.lit("")


def at(name: str) -> Column:
    return F.col(f"`{name}`")


def report_field(name: str, *more: str) -> Column:
    return n.text(F.col("actual")[name]) if not more else n.text(F.coalesce(*(F.col("actual")[x] for x in (name, *more))))


ROW = ["_file", "_row"]


def identified(sheet: DataFrame) -> DataFrame:
    """The sheet with `_file`, blank if it has none."""
    return sheet if "_file" in sheet.columns else sheet.withColumn("_file", F.lit(""))


def with_key(report: DataFrame, key: Column, wanted: tuple[str, ...]) -> DataFrame:
    """The report's key, file, row number and wanted columns, blank where the sheet lacks one."""
    return report.select(key.alias("key"), *ROW, *(lookup(report, x).alias(x) for x in wanted)).where("key != ''")


def pair_line(label: str) -> Callable[[Column], Column]:
    """A remark's line that holds the two sides' fields against each other; of a constant only the report's."""
    quoted = lambda c: F.concat(F.lit('"'), n.trim(c), F.lit('"'))

    def line(x: Column) -> Column:
        there = F.concat(F.lit(f"[{label}] : "), x["field"], F.lit(" = "), quoted(x["actual"]))
        both = F.concat(F.lit("[TS] : "), x["source"], F.lit(" = "), quoted(x["expected"]), F.lit(" | "), there)
        return F.when(x["fixed"], F.concat(there, F.lit(f" {k.MUST_BE} "), quoted(x["expected"]))).otherwise(both)

    return line


def reason_line(left: str, right: str, bare_blank: bool = False) -> Callable[[Column], Column]:
    """A remark's line that gives the reason, then both values."""
    value = (lambda c: c) if bare_blank else (lambda c: rollup.shown(n.trim(c)))
    return lambda x: F.concat(x["field"], F.lit(": "), x["reason"], F.lit(f" | [{left}]: "), value(x["expected"]), F.lit(f" | [{right}]: "), value(x["actual"]))


def named(rows: DataFrame, status: Column, remark: Column, passed: Column, failed: Column, review: Column) -> DataFrame:
    """The row results; rows that weren't compared have the status of their outcome and the note as remark."""
    compared = F.col("outcome") == "COMPARE"
    state = F.when(compared, status).when(F.col("outcome").isin("EXPECTED_ABSENCE", "EXCLUDED"), c.PASS).when(F.col("outcome") == "SKIP", c.SKIP).otherwise(c.FAIL)
    some = lambda x: F.when(compared, x).otherwise(F.array().cast("array<string>"))
    return rows.select(
        "test_no", "key", *ROW, state.alias("status"), "outcome", F.when(compared, F.coalesce(remark, F.lit(""))).otherwise(F.coalesce("note", F.lit(""))).alias("remark"),
        some(passed).alias("passed_fields"), some(failed).alias("failed_fields"), some(review).alias("review_fields"), F.col("actual._file").alias("report_file"), F.col("actual._row").alias("report_row"),
    )


def finished(rows: DataFrame, fields: list[c.Field], remark: Callable[[Column], Column], with_skip: bool = True, wanted: c.Choice | None = None) -> DataFrame:
    """rows (with `outcome` and `note`), each compared by the wanted fields and rolled up where it stands: after the match nothing is shuffled."""
    rows = rows.withColumn("_results", F.when(F.col("outcome") == "COMPARE", c.results(c.chosen(fields, wanted))))
    found = F.col("_results")
    return named(rows, rollup.row_status(found, with_skip), remark(found), *(rollup.row_names(found, s) for s in (c.PASS, c.FAIL, c.REVIEW)))


#: The expected cases of a test sheet: DataFrame -> DataFrame. Another builder takes the place of a plan's own by the argument `cases`.
Cases = Callable[[DataFrame], DataFrame]


def ltx_cases(test: DataFrame) -> DataFrame:
    """Two slots per test row, DR for the transfer and FE for the fees, if their amounts are above the tolerance: ROW, test_no, key, suffix, fees, transfer, debit, expectation and the columns that rules read."""
    fees = total(*(number(lookup(test, *k.fee_aliases(5)[k.fee_headers(i)[2]])) for i in range(1, 6)))
    transfer, debit = number(lookup(test, k.TRANSFER_AMOUNT)), number(lookup(test, k.DEBIT_AMOUNT))
    large = lambda a: F.coalesce(a > TOLERANCE, F.lit(False))
    base = test.select(
        *ROW, n.trim(F.regexp_replace(lookup(test, k.TEST_NO), "(?i)-return$", "")).alias("test_no"), n.trim(lookup(test, k.TEST_ID)).alias("id"), fees.alias("fees"), transfer.alias("transfer"), debit.alias("debit"),
        rules.decide([rules.RESIDENT_THB_TO_FOREIGN], field=lambda f: lookup(test, f)).alias("expectation"),
        *(lookup(test, x).alias(x) for x in (k.FROM_ACCOUNT, k.FROM_CCY, k.TXN_DATE, k.PURPOSE, k.TO_CIF_NAME, k.TO_REGION, k.CIF_NO, k.CIF_NAME)),
    ).where("id != ''")
    return base.select("*", F.inline(keys.suffix_keys(F.col("id"), {"DR": large(F.col("transfer")) | large(F.col("debit")), "FE": large(F.col("fees"))})))


def ltx(test: DataFrame, report: DataFrame, cases: Cases = ltx_cases, wanted: c.Choice | None = None) -> DataFrame:
    """The first report row of a case's key counts. The row's status comes from its key conditions (account and amount); field rules only ask for review."""
    test, report = identified(test), identified(report)
    expected = cases(test)
    actual = with_key(report, n.upper_key(lookup(report, "Reference Transaction Number")), k.CONTRACTS["DS_LTX"].report)
    rows = matching.match(expected, actual, "key", Policy.FIRST, ROW)
    rows = rows.withColumn("outcome", rules.presence(F.col("expectation"), F.col("match") == "MATCH")).withColumn("note", F.when(F.col("outcome") == "MISSING", "not in the report").when(F.col("outcome") == "UNEXPECTED", "in the report, but must not be").otherwise("must not be in the report, and is not"))
    amount, dr = number(report_field("Transaction Amount")), F.col("suffix") == "DR"
    near = F.when(dr, within(F.col("transfer"), amount) | within(F.col("debit"), amount)).otherwise(within(F.col("fees"), amount))
    account = (n.value(at(k.FROM_ACCOUNT)) != "") & (F.lower(n.value(at(k.FROM_ACCOUNT))) == F.lower(n.value(report_field("FI Arrangement Number"))))
    only_dr = lambda status, gate=None: F.when(dr & (~n.blank(gate) if gate is not None else F.lit(True)), status)
    exact = lambda name, source, gate=None: c.Field(name, only_dr(c.exact_or_review(at(source), report_field(name)), gate), at(source), report_field(name), source)
    filled = lambda source, f: c.Field(f.name, F.when(~n.blank(source), f.status), f.expected, f.actual, f.source, f.reason, f.fixed)
    to_name, relation, inflow = at(k.TO_CIF_NAME), "Relationship with Beneficiary or Sender", "Inflow Transaction Purpose"
    fields = [
        c.Field("FI Arrangement Number", c.passed(account), at(k.FROM_ACCOUNT), report_field("FI Arrangement Number"), k.FROM_ACCOUNT),
        c.Field("Transaction Amount", c.passed(near), F.when(dr, F.coalesce("transfer", "debit")).otherwise(F.col("fees")), report_field("Transaction Amount"), "Amount"),
        c.Field("Transaction Date", c.date_or_reference(at(k.TXN_DATE), report_field("Transaction Date"), F.col("key")), at(k.TXN_DATE), report_field("Transaction Date"), k.TXN_DATE),
        c.Field("Currency Id", c.exact_or_review(at(k.FROM_CCY), report_field("Currency Id")), at(k.FROM_CCY), report_field("Currency Id"), k.FROM_CCY),
        exact("Outflow Transaction Purpose", k.PURPOSE),
        exact("Beneficiary or Sender Name", k.TO_CIF_NAME, to_name),
        filled(at(k.TO_REGION), exact("Country Id of Beneficiary or Sender", k.TO_REGION, to_name)),
        # Fixed-value mismatches only ask for review; the row stays as its key conditions have it.
        c.Field(relation, only_dr(F.replace(c.fixed_value(k.RELATIONSHIP_OTHER, report_field(relation)), F.lit(c.FAIL), F.lit(c.REVIEW)), to_name), F.lit(k.RELATIONSHIP_OTHER), report_field(relation), fixed=True),
        exact("Cust Code", k.CIF_NO, at(k.CIF_NO)),
        filled(at(k.CIF_NAME), exact("Cust Name", k.CIF_NAME, at(k.CIF_NO))),
        c.Field(inflow, F.when(~n.blank(report_field(inflow)) & ~n.blank(at(k.PURPOSE)), c.exact_or_review(at(k.PURPOSE), report_field(inflow))), at(k.PURPOSE), report_field(inflow), k.PURPOSE),
    ]

    def remark(found: Column) -> Column:
        review = rollup.row_lines(found, pair_line("LTX"), c.REVIEW)
        last = F.when(F.size(review) > 0, F.array(F.lit(k.PLEASE_REVIEW))).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(rollup.row_lines(found, pair_line("LTX"), c.FAIL), review, last), "\n")

    return finished(rows, fields, remark, wanted=wanted)


PTX_CORE = ("Receive Payment Transaction Date", "Currency Id", "Payment Method", "Receive Payment Transaction Type", "Receive Payment Item Type", "Transaction Amount in Foreign Currency")


#: Report field -> slot -> the names of the test data's column that it is held against.
Mapping = dict[str, Callable[[int], tuple[str, ...]]]
PTX_FIELDS: Mapping = {
    "Receive Payment Transaction Date": lambda slot: (k.TXN_DATE,), "Currency Id": lambda slot: (k.FROM_CCY,), "Transaction Amount in Foreign Currency": lambda slot: tuple(k.fee_aliases(slot)[k.fee_headers(slot)[2]]),
    "Cust Code": lambda slot: (k.CIF_NO,), "CMF CODE": lambda slot: (k.CIF_NO,), "Cust Name": lambda slot: (k.CIF_NAME,), "Involved Party Id": lambda slot: (k.TO_CIF_NO,), "Involved Party Name": lambda slot: (k.TO_CIF_NAME,), "Country Id of Involved Party": lambda slot: (k.TO_REGION,),
}
PTX_SLOTS = (1, 2)


def of(field: str) -> Column:
    """What a report's field is held against."""
    return n.text(at(f"of {field}"))


def ptx_cases(test: DataFrame, slots: tuple[int, ...] = PTX_SLOTS, mapping: Mapping = PTX_FIELDS) -> DataFrame:
    """One row per filled fee slot, or one without a slot: ROW, test_no, id, slot, has_slot, key, excluded, and `of <field>` for each mapped field, from the slot's own columns."""
    kinds, amounts = ({i: lookup(test, *name(i)) for i in slots} for name in (lambda i: (k.fee_headers(i)[0],), PTX_FIELDS["Transaction Amount in Foreign Currency"]))
    parts = {i: {f"of {f}": lookup(test, *name(i)) for f, name in mapping.items()} for i in slots}
    used = {i: ~n.blank(kinds[i]) | ~n.blank(amounts[i]) for i in slots}
    number_names = ("Test No.", "Test No", "Test Script No.", "Test Script No")
    resident = rules.resident_to_foreign_account(lookup(test, k.RESIDENCE), lookup(test, k.FROM_CCY), lookup(test, k.TO_ACCOUNT_TYPE), lookup(test, k.TO_CCY))
    base = reshape.slots(test, parts, used).select(*ROW, "slot", "has_slot", n.first_filled(*(lookup(test, x) for x in number_names)).alias("test_no"), lookup(test, k.TEST_ID).alias("id"), resident.alias("excluded"), *(at(f"of {f}") for f in mapping))
    base = base.where((n.trim(F.col("id")) != "") | (F.col("test_no") != ""))
    return base.withColumn("key", F.when(F.col("has_slot"), keys.slot_key(F.col("id"), F.col("slot"))).otherwise(F.concat(F.lit("NO_FEE_ROW_"), F.col("_row").cast("string"))))


def ptx(test: DataFrame, report: DataFrame, no_fee_fails: bool = False, core: tuple[str, ...] = PTX_CORE, slots: tuple[int, ...] = PTX_SLOTS, mapping: Mapping = PTX_FIELDS, cases: Cases | None = None, wanted: c.Choice | None = None) -> DataFrame:
    """One expected row per fee slot; the last report row counts. A row without fees is skipped, or fails with no_fee_fails.

    core: the headers to compare; one that no rule is known for fails. slots, mapping: the fee slots, and
    which column of the test data a report's field is held against in each; a field that isn't mapped is
    held against nothing.
    """
    test, report = identified(test), identified(report)
    mapping = dict.fromkeys(PTX_FIELDS, lambda slot: ()) | mapping
    expected = (cases or (lambda t: ptx_cases(t, slots, mapping)))(test)
    names = tuple(dict.fromkeys((*k.CONTRACTS["DS_PTX"].report, *core, "Receive Payment Item Description", "Data Set Date")))
    actual = with_key(report, n.trim(lookup(report, "Reference Transaction Number")), names)
    rows = matching.match(expected, actual, "key", Policy.LAST, ROW)
    found = F.col("match") == "MATCH"
    outcome = F.when(F.col("excluded") & found, "UNEXPECTED").when(F.col("excluded"), "EXPECTED_ABSENCE").when(~F.col("has_slot") & ~F.lit(no_fee_fails), "SKIP").when(F.col("key").isNull(), "INVALID_KEY").when(~found, "MISSING").otherwise("COMPARE")
    rows = rows.withColumn("outcome", outcome).withColumn("note", F.lower(F.replace(F.col("outcome"), F.lit("_"), F.lit(" "))))
    source = lambda f: next(iter(mapping[f](slots[0])), "")
    typed = lambda name, kind, e, source="", reason="Value Mismatch": c.Field(name, c.typed(kind, e, report_field(name)), e, report_field(name), source, reason)
    date, money_field = "Receive Payment Transaction Date", "Transaction Amount in Foreign Currency"
    rules_of = {
        date: c.Field(date, c.date_of_set_or_reference(of(date), report_field("Data Set Date"), F.col("key")), of(date), report_field("Data Set Date"), source(date), F.when(dates.loose_date(of(date)).isNull(), "Invalid Txn Date").otherwise("Txn Date does not match Data Set Date or Reference Transaction Date")),
        "Currency Id": typed("Currency Id", "TEXT", of("Currency Id"), source("Currency Id")),
        "Payment Method": typed("Payment Method", "TEXT", F.lit(k.PAYMENT_METHOD)),
        "Receive Payment Transaction Type": typed("Receive Payment Transaction Type", "TEXT", F.lit(k.TRANSACTION_TYPE)),
        "Receive Payment Item Type": typed("Receive Payment Item Type", "TEXT", F.lit(k.ITEM_TYPE)),
        money_field: typed(money_field, "AMOUNT", number_or_zero(of(money_field)).cast("string"), "Fee Amount"),
    }

    def optional(name: str, e: Column, source: str = "") -> c.Field:
        a = report_field(name)
        reason = F.when(n.trim(a) == "", "Skipped: the report's value is blank").when(n.trim(e) == "", "Expected Value Is Blank").otherwise("Value Mismatch")
        return c.Field(name, c.optional_value(e, a), e, a, source, reason)

    customer = [optional(f, of(f), source(f)) for f in ("Cust Code", "CMF CODE", "Cust Name", "Involved Party Id", "Involved Party Name", "Country Id of Involved Party")]
    fields = [*c.for_headers(rules_of, core, report_field), *customer, optional("Receive Payment Item Description", F.lit(""))]
    return finished(rows, fields, lambda found: F.array_join(rollup.row_lines(found, reason_line("TS", "DS-PTX"), c.FAIL), "\n"), wanted=wanted)


def ftx_cases(test: DataFrame) -> DataFrame:
    """ROW, test_no, key, excluded and the columns that rules read."""
    who = n.first_filled(lookup(test, k.CUSTOMER_TYPE), lookup(test, k.CUSTOMER_TYPE_NAME))
    excluded = rules.excluded_conversion(lookup(test, k.FROM_CCY), lookup(test, k.SETTLED_CCY), who, number(lookup(test, k.SETTLED_AMOUNT)))
    return test.select(*ROW, lookup(test, k.TEST_NO).alias("test_no"), n.trim(lookup(test, k.TEST_ID)).alias("key"), excluded.alias("excluded"), *(lookup(test, x).alias(x) for x in (k.FROM_CCY, k.SETTLED_CCY, k.TXN_DATE)))


def ftx(test: DataFrame, report: DataFrame, cases: Cases = ftx_cases, wanted: c.Choice | None = None) -> DataFrame:
    """Keys are case-sensitive and must be unique; excluded rows pass whether or not the report has them."""
    test, report = identified(test), identified(report)
    expected = cases(test)
    actual = with_key(report, n.trim(lookup(report, "Ref. TX No.")), k.CONTRACTS["DS_FTX"].report)
    rows = matching.match(expected, actual, "key", Policy.UNIQUE, ROW)
    outcome = F.when(F.col("key") == "", "BLANK_KEY").when(F.col("excluded"), "EXCLUDED").when(F.col("match") == "MATCH", "COMPARE").otherwise(F.col("match"))
    rows = rows.withColumn("outcome", outcome).withColumn("note", F.lower(F.replace(F.col("outcome"), F.lit("_"), F.lit(" "))))
    pairs = (("Buy Currency Id", k.FROM_CCY, c.spaced_text), ("Sell Currency Id", k.SETTLED_CCY, c.spaced_text), ("Transaction Date", k.TXN_DATE, c.loose_date))
    fields = [c.Field(name, f(at(e), report_field(name)), at(e), report_field(name), e) for name, e, f in pairs]
    line = reason_line("Test Data", "DS_FTX", bare_blank=True)
    return finished(rows, fields, lambda found: F.array_join(F.array_distinct(rollup.row_lines(found, line, c.FAIL)), "\n"), with_skip=False, wanted=wanted)


def ftu_cases(test: DataFrame) -> DataFrame:
    """ROW, test_no, key, direction, from, to, settled, amount, date, purpose."""
    source, target, settled = (n.upper_key(lookup(test, x)) for x in (k.FROM_CCY, k.TO_CCY, k.SETTLED_CCY))
    return test.select(
        *ROW, lookup(test, k.TEST_NO).alias("test_no"), n.upper_key(lookup(test, k.TEST_ID)).alias("key"), rules.direction(source, target, "THB").alias("direction"), source.alias("from"), target.alias("to"),
        settled.alias("settled"), number(lookup(test, k.SETTLED_AMOUNT)).alias("amount"), lookup(test, k.TXN_DATE).alias("date"), lookup(test, k.PURPOSE).alias("purpose"),
    ).where("key != ''")


def ftu(test: DataFrame, report: DataFrame, usd_rates: DataFrame, exception: Callable[[DataFrame], Column] | None = None, cases: Cases = ftu_cases, wanted: c.Choice | None = None) -> DataFrame:
    """All report rows of a key are compared and their amounts summed. usd_rates: currency, rate; a missing rate fails the row.

    exception(rows) may give a reason for which a row must not be in the report. Each sheet is read once; a
    remark has each different line once, in the order of the report's rows.
    """
    test, report = identified(test), identified(report)
    base = cases(test)
    base = matching.looked_up(base, "settled", usd_rates, "rate")
    usd = F.when(F.col("settled") == "USD", F.col("amount")).otherwise(F.col("amount") * F.col("rate"))
    expected = base.withColumn("usd", usd).withColumn("reason", exception(base) if exception else F.lit(None).cast("string"))
    d = F.col("direction")
    large = F.coalesce(F.col("usd") >= k.USD_LIMIT, F.lit(False))
    unwanted = (d == "NOT_FTU") | large | F.col("reason").isNotNull()
    # What a test row comes to without a look at its fields; they are compared where this is null.
    settled = (
        F.when((d == "INVALID") & ((F.col("from") == "") | (F.col("to") == "")), "EXPECTED_ABSENCE")
        .when(d == "INVALID", "INVALID")
        .when(F.col("usd").isNull() & F.col("amount").isNotNull() & d.isin("BUY_FCY", "SELL_FCY"), "NO_RATE")
        .when(unwanted, "UNWANTED")
    )
    expected = expected.withColumn("_settled", settled)
    compared = k.CONTRACTS["DS_FTU"].report[1:-1]
    actual = with_key(report, n.upper_key(lookup(report, "Arr Number")), k.CONTRACTS["DS_FTU"].report).withColumn("report_amount", number(F.col("Foreign Currency Amount")))
    # Report rows of a key that are alike in all that is compared are one row with their number, sum and first place, so that a key of very many rows is a few.
    amounts = F.sum("report_amount").alias("sum_report_amount"), F.count_if(F.col("report_amount").isNull()).alias("nulls_report_amount")
    alike = actual.groupBy("key", *map(at, compared)).agg(F.count("*").alias("n_actual"), *amounts, F.min(F.struct(*ROW)).alias("_at"))
    met = expected.join(alike.select("key", "n_actual", "sum_report_amount", "nulls_report_amount", "_at", F.struct(*map(at, compared)).alias("actual")), "key", "left")
    country = F.element_at(F.create_map(*(F.lit(x) for pair in k.COUNTRY_OF.items() for x in pair)), F.col("to"))
    leg = c.directional(d, F.lit(k.LEG_BUY), F.lit(k.LEG_SELL))
    own = c.directional(d, report_field("Inflow Transaction Purpose"), report_field("Outflow Transaction Purpose"))
    fields = [
        c.Field("Data Set Date", c.business_date(F.col("date"), report_field("Data Set Date")), F.col("date"), report_field("Data Set Date"), k.TXN_DATE),
        c.Field("Leg Type", c.passed(n.upper_key(report_field("Leg Type")) == leg), leg, report_field("Leg Type"), fixed=True),
        c.Field("Purpose", c.purpose(d, F.col("purpose"), report_field("Inflow Transaction Purpose"), report_field("Outflow Transaction Purpose")), F.col("purpose"), own, k.PURPOSE),
        c.Field("Country", c.passed(n.upper_key(report_field("Country Id of Beneficiary Involved Party")) == country), country, report_field("Country Id of Beneficiary Involved Party"), k.TO_CCY),
        c.Field("Currency Id", F.when(F.col("settled") == "", c.REVIEW).otherwise(c.passed(n.upper_key(report_field("Currency Id")) == F.col("settled"))), F.col("settled"), report_field("Currency Id"), k.SETTLED_CCY),
    ]
    picked, states = c.chosen(fields, wanted), (c.PASS, c.FAIL, c.REVIEW)
    here = F.col("_at").isNotNull() & F.col("_settled").isNull()
    met = met.withColumns({f"_status {i}": F.when(here, f.status) for i, f in enumerate(picked)})
    status = lambda i: at(f"_status {i}")
    # One bit for each field and status, so that what the rows of a key came to is one number; lines are made of what doesn't pass alone.
    bit = lambda i, s: 1 << (i * len(states) + states.index(s))
    bits = F.lit(0)
    for i in range(len(picked)):
        bits = bits + F.when(status(i) == c.PASS, bit(i, c.PASS)).when(status(i) == c.FAIL, bit(i, c.FAIL)).when(status(i) == c.REVIEW, bit(i, c.REVIEW)).otherwise(0)
    line = lambda f: pair_line("FTU")({"field": F.lit(f.name), "source": F.lit(f.source), "expected": n.text(f.expected), "actual": n.text(f.actual), "fixed": F.lit(f.fixed)})
    said = [F.when(status(i).isin(c.FAIL, c.REVIEW), F.struct(F.col("_at").alias("at"), F.lit(i).alias("ordinal"), line(f).alias("line"))) for i, f in enumerate(picked)]
    lines = F.array_compact(F.array(*said)) if said else F.array().cast("array<struct<at:struct<_file:string,_row:bigint>,ordinal:int,line:string>>")
    carried = [x for x in expected.columns if x not in ("key", *ROW)]
    # A test row has one key, by which its rows lie together since the join.
    rows = met.groupBy("key", *ROW).agg(
        F.first(F.struct(*carried)).alias("e"), F.coalesce(F.sum("n_actual"), F.lit(0)).alias("n_actual"), F.sum("sum_report_amount").alias("sum_report_amount"), F.coalesce(F.sum("nulls_report_amount"), F.lit(0)).alias("nulls_report_amount"),
        F.min("_at").alias("actual"), F.bit_or(bits).alias("_bits"), F.flatten(F.collect_list(lines)).alias("_lines"),
    ).select("key", *ROW, "e.*", "n_actual", "sum_report_amount", "nulls_report_amount", "actual", "_bits", "_lines")
    found = F.col("n_actual") > 0
    before = F.col("_settled")
    outcome = F.when(before != "UNWANTED", before).when(before.isNotNull() & found, "UNEXPECTED").when(before.isNotNull(), "EXPECTED_ABSENCE").when(~found, "MISSING").otherwise("COMPARE")
    around = lambda parts, x: F.concat(F.lit(parts[0]), x, F.lit(parts[1]))
    why = F.when(d == "NOT_FTU", k.FTU_NO_THB).when(large, around(k.FTU_LIMIT, money(F.col("usd")))).otherwise(around(k.FTU_EXCEPTION, F.col("reason")))
    missing = F.lit(f'[TS] : {k.TEST_ID} = "'), F.col("key"), F.lit(f'" | [FTU] : Arr Number = "{k.NOT_FOUND_TEXT}"')
    note = F.when(F.col("outcome") == "MISSING", F.concat(*missing)).when(unwanted & F.col("outcome").isin("UNEXPECTED", "EXPECTED_ABSENCE"), F.concat(why, F.when(found, k.FTU_PRESENT).otherwise(k.FTU_ABSENT))).otherwise(F.lower(F.replace(F.col("outcome"), F.lit("_"), F.lit(" "))))
    rows = rows.withColumn("outcome", outcome).withColumn("note", note)
    # The sum is one more field behind those of the report rows.
    summed = F.when(F.col("amount").isNull(), c.REVIEW).otherwise(c.passed((F.col("nulls_report_amount") == 0) & within(F.col("amount"), F.col("sum_report_amount"))))
    sum_fields = c.chosen([c.Field("Foreign Currency Amount", summed, F.col("amount"), F.col("sum_report_amount"), k.SETTLED_AMOUNT)], wanted)
    rows = rows.withColumn("_sum", F.when(F.col("outcome") == "COMPARE", c.results(sum_fields)))
    having = lambda s: [(f.name, F.col("_bits").bitwiseAND(F.lit(bit(i, s))) != 0) for i, f in enumerate(picked)] + [(f.name, f.status == s) for f in sum_fields]
    names = {s: F.array_compact(F.array(*(F.when(on, F.lit(name)) for name, on in sorted(having(s), key=lambda x: x[0])))).cast("array<string>") for s in states}
    status = F.when(F.size(names[c.FAIL]) > 0, c.FAIL).otherwise(c.PASS)
    success = F.when(F.size(names[c.FAIL]) > 0, F.array().cast("array<string>")).otherwise(F.array(F.when(d == "BUY_FCY", k.FTU_BUY).otherwise(k.FTU_SELL)))
    several = F.when(F.col("n_actual") > 1, F.array(F.format_string("Aggregate %d raw rows by Arr Number.", F.col("n_actual")))).otherwise(F.array().cast("array<string>"))
    lines = F.array_distinct(F.transform(F.array_sort("_lines"), lambda x: x["line"]))
    return named(rows, status, F.array_join(F.concat(success, lines, rollup.row_lines(F.col("_sum"), pair_line("FTU"), c.FAIL, c.REVIEW), several), "\n"), names[c.PASS], names[c.FAIL], names[c.REVIEW])


def unmatched_report_rows(results: DataFrame, report: DataFrame, key: Column) -> DataFrame:
    """Report rows whose key no test row expects, with status UNTAGGED."""
    rows = identified(report).select(key.alias("key"), F.col("_file").alias("report_file"), F.col("_row").alias("report_row"))
    return matching.untagged(rows, results, "key").withColumn("status", F.lit("UNTAGGED"))


def summary(results: DataFrame) -> DataFrame:
    """One row: totals by status."""
    return results.agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in (c.PASS, c.FAIL, c.SKIP)))
