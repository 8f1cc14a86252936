"""Queries over the driver's tables, each one operator of the library, with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, keys, normalize as n
from ..functions.numbers import number, within
from ..operators import compare as c, completeness, matching, ordering, reshape, rollup, rules, summary
from ..operators.matching import Policy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")


def cents(c) -> F.Column:
    return F.round(c * 100).cast("bigint")


def big(c) -> F.Column:
    return c.cast("bigint")


# ---- joins under a policy


@query("""select o_orderkey, coalesce(k, 0) as n_actual, case when k is null then 'MISSING' when k > 1 then 'DUPLICATE' else 'MATCH' end as state
from orders left join (select l_orderkey, count(*) k from lineitem group by 1) on l_orderkey = o_orderkey""")
def recon_unique(spark, sf_dir):
    m = matching.match(table(spark, sf_dir, "orders").select("o_orderkey"), lines(spark, sf_dir).select("o_orderkey", *LINE_ORDER), "o_orderkey", Policy.UNIQUE, LINE_ORDER)
    return m.select("o_orderkey", "n_actual", F.col("match").alias("state"))


def _picked(spark, sf_dir, policy):
    m = matching.match(table(spark, sf_dir, "orders").select("o_orderkey"), lines(spark, sf_dir).select("o_orderkey", *LINE_ORDER), "o_orderkey", policy, LINE_ORDER)
    return m.select("o_orderkey", F.col("match").alias("state"), "actual.l_partkey", "actual.l_linenumber", cents(F.col("actual.l_extendedprice")).alias("price_cents"))


_PICKED = """select o_orderkey, case when l_orderkey is null then 'MISSING' else 'MATCH' end as state, l_partkey, l_linenumber, cast(round(l_extendedprice * 100) as bigint) as price_cents
from orders left join (select * from lineitem qualify row_number() over (partition by l_orderkey order by {}) = 1) on l_orderkey = o_orderkey"""


@query(_PICKED.format(", ".join(LINE_ORDER)))
def recon_first(spark, sf_dir):
    return _picked(spark, sf_dir, Policy.FIRST)


@query(_PICKED.format(", ".join(f"{x} desc" for x in LINE_ORDER)))
def recon_last(spark, sf_dir):
    return _picked(spark, sf_dir, Policy.LAST)


@query("""select o_orderkey, coalesce(k, 0) as n_actual, cast(round(s * 100) as bigint) as sum_cents,
case when k is null then 'MISSING' when abs(o_totalprice - s) <= 1000 then 'PASS' else 'FAIL' end as status
from orders left join (select l_orderkey, count(*) k, sum(l_extendedprice) s from lineitem group by 1) on l_orderkey = o_orderkey""")
def recon_aggregate_amount(spark, sf_dir):
    m = matching.match(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), lines(spark, sf_dir).select("o_orderkey", *LINE_ORDER), "o_orderkey", Policy.AGGREGATE, LINE_ORDER, ("l_extendedprice",))
    status = F.when(F.col("match") == "MISSING", "MISSING").otherwise(c.passed((F.col("nulls_l_extendedprice") == 0) & within(F.col("o_totalprice"), F.col("sum_l_extendedprice"), 1000.0)))
    return m.select("o_orderkey", "n_actual", cents(F.col("sum_l_extendedprice")).alias("sum_cents"), status.alias("status"))


@query("select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def recon_missing_expected(spark, sf_dir):
    return matching.missing(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), lines(spark, sf_dir), "o_orderkey")


@query("select l_orderkey as o_orderkey, l_linenumber, l_partkey from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'P')")
def recon_untagged_actual(spark, sf_dir):
    expected = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return matching.untagged(lines(spark, sf_dir).select("o_orderkey", "l_linenumber", "l_partkey"), expected, "o_orderkey")


@query("""with e as (select o_orderkey, o_custkey from orders where o_orderstatus = 'F'), a as (select l_orderkey, count(*) n_lines from lineitem group by 1)
select coalesce(o_orderkey, l_orderkey) as o_orderkey, o_custkey, n_lines, case when o_orderkey is null then 'UNTAGGED' when l_orderkey is null then 'MISSING' else 'MATCHED' end as side
from e full join a on o_orderkey = l_orderkey""")
def recon_full_outer(spark, sf_dir):
    e = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    a = lines(spark, sf_dir).groupBy("o_orderkey").agg(F.count("*").alias("n_lines"))
    return matching.both_sides(e, a, "o_orderkey")


@query("""with p as (select a.o_orderkey, count(*) k, min(b.o_orderkey) m from orders a join orders b on a.o_custkey = b.o_custkey and a.o_orderkey <> b.o_orderkey and abs(a.o_totalprice - b.o_totalprice) <= 500 group by 1)
select o.o_orderkey, coalesce(k, 0) as n_near, m as partner_id, case when k is null then 'NONE' when k = 1 then 'UNIQUE' else 'AMBIGUOUS' end as outcome from orders o left join p using (o_orderkey)""")
def recon_fuzzy_amount(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return matching.closest_amounts(o, o, "o_custkey", "o_orderkey", "o_totalprice", "o_orderkey", "o_totalprice", 500.0, itself=True).select("o_orderkey", "n_near", "partner_id", "outcome")


@query("""with p as (select o_orderkey, o_totalprice, o_custkey, count(l_linenumber) as k, cast(min(l_linenumber) as bigint) as m, false as by_fallback from orders left join lineitem on l_orderkey = o_orderkey and abs(o_totalprice - l_extendedprice) <= 5000 group by 1, 2, 3),
f as (select p.o_orderkey, count(l_linenumber) as k, cast(min(l_linenumber) as bigint) as m from p left join lineitem on l_orderkey = p.o_orderkey and abs(o_totalprice / 4 - l_extendedprice) <= 5000 where p.k = 0 group by 1)
select o_orderkey, case when p.k > 0 then p.k else f.k end as n_near, coalesce(p.m, f.m) as partner_id, case when greatest(p.k, coalesce(f.k, 0)) = 0 then 'NONE' when greatest(p.k, coalesce(f.k, 0)) = 1 then 'UNIQUE' else 'AMBIGUOUS' end as outcome from p left join f using (o_orderkey)""")
def recon_amount_two_tables(spark, sf_dir):
    """Orders held against their lines, whose ids meet theirs by chance; a quarter of the amount is tried where none is near the whole."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_totalprice") / 4).alias("quarter"), F.col("o_orderkey").alias("order"))
    actual = lines(spark, sf_dir).select(F.col("o_orderkey").alias("order"), F.col("l_linenumber").cast("long").alias("id"), "l_extendedprice")
    return matching.closest_amounts(o, actual, "order", "o_orderkey", "o_totalprice", "id", "l_extendedprice", 5000.0, "quarter").select("o_orderkey", "n_near", "partner_id", "outcome")


@query("""with r as (select cast(o_orderkey as varchar) || case when o_orderstatus = 'F' then 'FE' else 'DR' end as ref from orders union all select cast(o_orderkey as varchar) || 'FE' from orders where o_orderkey % 3 = 0 and o_orderstatus <> 'F')
select left(a.ref, length(a.ref) - 2) as base, a.ref as reference, b.ref as partner from r a left join r b on b.ref = left(a.ref, length(a.ref) - 2) || 'FE' where a.ref like '%DR'""")
def suffix_pair(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    own = o.select(F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderstatus") == "F", "FE").otherwise("DR")).alias("ref"))
    more = o.where("o_orderkey % 3 = 0 and o_orderstatus <> 'F'").select(F.concat(F.col("o_orderkey").cast("string"), F.lit("FE")).alias("ref"))
    return matching.suffix_partners(own.union(more), "ref", "DR", "FE")


@query("""with lk as (select o_orderkey, o_custkey, cast(round(o_totalprice * 100) as bigint) as v from orders where o_orderkey % 2 = 0), one as (select o_orderkey, min(v) v1 from lk group by 1), two as (select o_custkey, min(v) v2 from lk group by 1 having count(*) = 1)
select o.o_orderkey, cast(case when v1 is not null then 1 when v2 is not null then 2 else 0 end as bigint) as tier, coalesce(v1, v2) as v from orders o left join one using (o_orderkey) left join two using (o_custkey)""")
def lookup_two_tier(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", cents(F.col("o_totalprice")).alias("v"))
    out = matching.two_tier(o.drop("v"), o.where("o_orderkey % 2 = 0"), "o_orderkey", "o_custkey", "v")
    return out.select("o_orderkey", big(F.col("tier")).alias("tier"), "v")


@query("select user_id, event_type, event_id from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def latest_per_key(spark, sf_dir):
    return matching.first_per_key(table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1")
def dedupe_first(spark, sf_dir):
    return matching.first_per_key(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")]).drop("o_orderdate")


@query("""with g as (select o_custkey, o_orderstatus, count(*) n_orders from orders group by 1, 2) select c_custkey, o_orderstatus, n_orders from customer left join g on c_custkey = o_custkey""")
def fanout_report(spark, sf_dir):
    groups = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus").agg(F.count("*").alias("n_orders"))
    return matching.fan_out(table(spark, sf_dir, "customer").select("c_custkey"), groups, "c_custkey")


# ---- rules


@query("""with x as (select c_custkey, case when c_mktsegment = 'BUILDING' and n_name <> 'FRANCE' then 'MUST_NOT_EXIST' else 'MUST_EXIST' end as expectation, exists (select 1 from orders where o_custkey = c_custkey) as found from customer join nation on n_nationkey = c_nationkey)
select c_custkey, expectation, case when expectation = 'MUST_NOT_EXIST' and not found then 'EXPECTED_ABSENCE' when expectation = 'MUST_NOT_EXIST' then 'UNEXPECTED' when found then 'COMPARE' else 'MISSING' end as outcome from x""")
def presence_rules(spark, sf_dir):
    rule = rules.Rule("building", (rules.Condition("c_mktsegment", "EQUALS", "building"), rules.Condition("n_name", "NOT_EMPTY"), rules.Condition("n_name", "NOT_EQUALS", "France")))
    customers = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    found = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("found", F.lit(True))
    joined = customers.join(found, "c_custkey", "left").withColumn("expectation", rules.decide([rule]))
    return joined.select("c_custkey", "expectation", rules.presence(F.col("expectation"), F.coalesce("found", F.lit(False))).alias("outcome"))


@query("""with r(k, rate) as (values (0, 0.25), (1, 0.5), (2, 1.0), (3, 1.5)), x as (select o_orderkey, c_mktsegment, o_totalprice * rate as usd from orders join customer on c_custkey = o_custkey left join r on k = c_nationkey % 5)
select o_orderkey, case when usd is null then 'NO_RATE' when usd >= 50000 then 'MUST_NOT_EXIST' when c_mktsegment = 'MACHINERY' and usd >= 0 and usd <= 50000 then 'EXCLUDED' else 'MUST_EXIST' end as outcome from x""")
def exclusion_threshold(spark, sf_dir):
    rates = spark.createDataFrame([(0, 0.25), (1, 0.5), (2, 1.0), (3, 1.5)], "k int, rate double")
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).withColumn("k", F.col("c_nationkey") % 5)
    usd = F.col("o_totalprice") * F.col("rate")
    small = rules.excluded_conversion(F.lit("USD"), F.lit("USD"), F.when(F.col("c_mktsegment") == "MACHINERY", "Resident"), usd)
    outcome = F.when(usd.isNull(), "NO_RATE").when(usd >= 50_000, "MUST_NOT_EXIST").when(small, "EXCLUDED").otherwise("MUST_EXIST")
    return matching.looked_up(o, "k", rates, "rate").select("o_orderkey", outcome.alias("outcome"))


@query("""with x as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, case c.n_regionkey when 0 then 'THB' when 1 then 'USD' when 2 then 'EUR' when 3 then '' else 'THB' end as s, case p.n_regionkey when 0 then 'THB' when 1 then 'USD' when 2 then 'EUR' when 3 then '' else 'THB' end as t
from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join nation c on c.n_nationkey = c_nationkey join supplier on s_suppkey = l_suppkey join nation p on p.n_nationkey = s_nationkey)
select d as direction, count(*) as n from (select case when s = '' or t = '' or (s = 'THB' and t = 'THB') then 'INVALID' when s = 'THB' then 'SELL_FCY' when t = 'THB' then 'BUY_FCY' else 'NOT_FTU' end d from x) group by 1""")
def direction_classify(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.element_at(F.array(*map(F.lit, ("thb", "USD", "EUR", " ", "THB"))), F.col("n_regionkey") + 1).alias("ccy"))
    customers = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("ccy").alias("s"))
    suppliers = table(spark, sf_dir, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("ccy").alias("t"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    x = lines(spark, sf_dir).select("o_orderkey", "l_suppkey").join(o, "o_orderkey").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return x.groupBy(rules.direction(F.col("s"), F.col("t"), "THB").alias("direction")).agg(F.count("*").alias("n"))


@query("""select c_custkey, c_mktsegment = 'BUILDING' as exact_rule, (c_mktsegment = 'BUILDING' or starts_with(c_mktsegment, 'BUILDING (')) and (starts_with(n_name, 'FCD') or (c_nationkey % 2 = 0 and n_name <> 'THB')) as account_rule
from customer join nation on n_nationkey = c_nationkey""")
def resident_rule_variants(spark, sf_dir):
    x = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    status = F.when(F.col("c_mktsegment") == "BUILDING", F.when(F.col("c_custkey") % 2 == 0, "Resident").otherwise("resident (juristic)")).otherwise(F.col("c_mktsegment"))
    exact = rules.Condition("c_mktsegment", "EQUALS", "Building").column()
    account = rules.resident_to_foreign_account(status, F.lit("thb"), F.when(F.col("c_nationkey") % 2 == 1, "Savings"), F.col("n_name"))
    return x.select("c_custkey", exact.alias("exact_rule"), account.alias("account_rule"))


@query("""select o_orderkey, case when o_orderpriority = '1-URGENT' then 'urgent' end as reason from orders""")
def exception_hook(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return summary.exceptions(o, lambda rows: F.when(F.col("o_orderpriority") == "1-URGENT", "urgent")).drop("o_orderpriority")


# ---- dates, keys, identifiers


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date) as shipped from lineitem join orders on o_orderkey = l_orderkey
where cast(l_shipdate as date) = cast(o_orderdate as date) or cast(l_shipdate as date) = cast(o_orderdate as date) + (case isodow(o_orderdate) when 5 then 3 when 6 then 2 else 1 end)""")
def date_business_day_match(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    ordered, shipped = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    return x.where(dates.same_or_next_weekday(ordered, shipped)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shipped.alias("shipped"))


@query("""with x as (select o_orderkey, o_orderdate, lpad(cast(o_orderkey % 1000000 as varchar), 6, '0') || case when o_orderkey % 7 = 0 then '259931' else strftime(o_orderdate + interval (o_orderkey % 3) day, '%y%m%d') end as reference from orders)
select o_orderkey, reference, cast(try_strptime('20' || substr(reference, 7, 6), '%Y%m%d') as date) as embedded, coalesce(cast(try_strptime('20' || substr(reference, 7, 6), '%Y%m%d') as date) = cast(o_orderdate as date), false) as same from x""")
def date_from_reference(spark, sf_dir):
    day = F.date_format(F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 3).cast("int")), "yyMMdd")
    reference = F.concat(F.lpad((F.col("o_orderkey") % 1_000_000).cast("string"), 6, "0"), F.when(F.col("o_orderkey") % 7 == 0, "259931").otherwise(day))
    x = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", reference.alias("reference"))
    found = dates.reference_date(F.col("reference"))
    return x.select("o_orderkey", "reference", found.alias("embedded"), F.coalesce(found == F.col("o_orderdate").cast("date"), F.lit(False)).alias("same"))


@query("""select l_orderkey, l_linenumber, case when l_linenumber >= 1 and length('ID' || l_orderkey) >= 3 then upper('id' || l_orderkey) || '_' || lpad(cast(l_linenumber as varchar), 2, '0') || '_GPMH_' || substr(upper('id' || l_orderkey), 1, 3) || '_RM' end as key from lineitem""")
def key_builder(spark, sf_dir):
    identifier = F.concat(F.lit(" id"), F.col("l_orderkey").cast("string"), F.lit(" "))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", keys.slot_key(identifier, F.col("l_linenumber")).alias("key"))


@query("""select c_custkey, case when c_custkey % 11 = 0 then 'REVIEW' else 'PASS' end as status, regexp_replace(lpad(cast(c_custkey as varchar), 9, '0'), '^0+([0-9])', '\\1') as shown from customer""")
def id_normalize_compare(spark, sf_dir):
    padded = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    other = F.when(F.col("c_custkey") % 11 == 0, F.lit("")).otherwise(F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", c.exact_or_review(padded, other).alias("status"), n.identifier(padded).alias("shown"))


# ---- groups of columns


def _slots():
    parts = {1: {"amount": F.col("l_discount")}, 2: {"amount": F.col("l_tax")}, 3: {"amount": F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))}}
    return parts, {i: F.coalesce(p["amount"] > 0.04, F.lit(False)) for i, p in parts.items()}


_SLOTTED = """select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(1 as bigint) as slot, l_discount as amount from lineitem where l_discount > 0.04 union all
select l_orderkey, l_linenumber, l_partkey, l_suppkey, 2, l_tax from lineitem where l_tax > 0.04 union all
select l_orderkey, l_linenumber, l_partkey, l_suppkey, 3, l_quantity from lineitem where l_returnflag = 'R' and l_quantity > 0.04"""


@query(f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, slot, cast(round(amount * 100) as bigint) as amount_cents from ({_SLOTTED} union all
select l_orderkey, l_linenumber, l_partkey, l_suppkey, null, null from lineitem where not (l_discount > 0.04 or l_tax > 0.04 or (l_returnflag = 'R' and l_quantity > 0.04)))""")
def fee_unpivot(spark, sf_dir):
    out = reshape.slots(table(spark, sf_dir, "lineitem"), *_slots())
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", big(F.col("slot")).alias("slot"), cents(F.col("amount")).alias("amount_cents"))


@query("""select l_orderkey, l_linenumber, l_partkey, cast(round((coalesce(case when l_returnflag = 'R' then l_quantity end, 0) + l_discount + l_tax) * 100) as bigint) as fee_cents from lineitem""")
def fee_sum(spark, sf_dir):
    from ..functions.numbers import total

    text = F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("string")).otherwise("n/a")
    fee = total(number(text), F.col("l_discount"), F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", cents(fee).alias("fee_cents"))


@query(f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, string_agg(cast(slot as varchar), ',' order by slot) as active from ({_SLOTTED}) group by all""")
def active_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").distinct()
    active = reshape.active_slots(*_slots())
    out = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array_join(F.transform(active, lambda x: x["slot"].cast("string")), ",").alias("active"))
    return out.where("active != ''").groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(F.array_join(F.array_sort(F.flatten(F.collect_list(F.split("active", ",")))), ",").alias("active"))


@query(f"select coalesce(max(slot), 0) as max_slot from ({_SLOTTED})")
def max_active_slot(spark, sf_dir):
    return reshape.max_active_slot(table(spark, sf_dir, "lineitem"), _slots()[1]).select(big(F.col("max_slot")).alias("max_slot"))


#: Line numbers of the driver's lineitem table; the query finds the highest by itself and fails if it is another.
_LINES = 7


@query(f"""with x as (select o_orderkey, cast(l_linenumber as bigint) as slot, max(l_partkey) as part from orders join lineitem on l_orderkey = o_orderkey group by 1, 2)
select o_orderkey, {", ".join(f"max(case when slot = {i} then part end) as part_{i}" for i in range(1, _LINES + 1))} from x group by 1""")
def fee_widen(spark, sf_dir):
    """All lines of each order, in as many columns as the highest line number asks for; the SQL has its columns written out."""
    long = lines(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", "left_semi").select("o_orderkey", F.col("l_linenumber").alias("slot"), F.col("l_partkey").alias("part"))
    most = long.agg(F.max("slot")).first()[0]
    return reshape.widened(long, ["o_orderkey"], "slot", ["part"], most)


@query("""with x as (select *, case when o_orderstatus is distinct from lag(o_orderstatus) over w or row_number() over w = 1 then 1 else 0 end as fresh from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey))
select o_custkey, o_orderkey, o_orderstatus, cast(sum(fresh) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) as bigint) as island from x""")
def row_islands(spark, sf_dir):
    out = reshape.islands(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus")
    return out.select("o_custkey", "o_orderkey", "o_orderstatus", "island")


@query("""with x as (select *, case when o_orderstatus is distinct from lag(o_orderstatus) over w or row_number() over w = 1 then 1 else 0 end as fresh from orders window w as (order by o_orderdate, o_orderkey))
select o_orderkey, o_orderstatus, cast(sum(fresh) over (order by o_orderdate, o_orderkey rows unbounded preceding) as bigint) as island from x""")
def sheet_islands(spark, sf_dir):
    """Runs along one sheet of all orders."""
    return ordering.runs(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus"), ["o_orderdate", "o_orderkey"], "o_orderstatus").select("o_orderkey", "o_orderstatus", "island")


@query("""with x as (select *, case when l_shipdate is distinct from lag(l_shipdate) over w or row_number() over w = 1 then 1 else 0 end as fresh from (select l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date) as l_shipdate from lineitem) window w as (partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey))
select l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(sum(fresh) over (partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey rows unbounded preceding) as bigint) as island from x""")
def file_islands(spark, sf_dir):
    """Runs along a few sheets that hold all lines: each flag's lines by date."""
    x = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("day"))
    return ordering.runs(x, ["day", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "day", ["l_returnflag"]).drop("day")


@query("""with x as (select o_orderkey, case o_orderstatus when 'F' then 'FAIL' when 'O' then 'PASS' else case when o_orderpriority < '3' then 'EXPECTED_ABSENCE' else 'UNTAGGED' end end as status from orders)
select o_orderkey, status, row_number() over (order by list_position(['PASS', 'UNTAGGED', 'FAIL', 'EXPECTED_ABSENCE', 'MISSING'], status), o_orderkey) + 1 as place from x""")
def sheet_places(spark, sf_dir):
    """The row that each result takes in one sheet of all of them, below its header."""
    from . import stages

    status = F.when(F.col("o_orderstatus") == "F", "FAIL").when(F.col("o_orderstatus") == "O", "PASS").when(F.col("o_orderpriority") < "3", "EXPECTED_ABSENCE").otherwise("UNTAGGED")
    x = table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), F.lit("").alias("report_file"), F.col("o_orderkey").alias("report_row"), F.lit("").alias("key"))
    return stages.output_places(x).select("o_orderkey", "status", "place")


# ---- completeness


@query("""with x as (select c_custkey, case when c_acctbal < 0 then '' else c_mktsegment end as segment, case when c_nationkey % 5 = 0 then '' else c_name end as name from customer)
select c_custkey, 'segment' as header, case when segment = '' then 'EMPTY' else 'FOUND' end as status from x union all select c_custkey, 'name', case when name = '' then 'EMPTY' else 'FOUND' end from x""")
def required_cells(spark, sf_dir):
    x = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, " ").otherwise(F.col("c_mktsegment")).alias("segment"), F.when(F.col("c_nationkey") % 5 == 0, None).otherwise(F.col("c_name")).alias("name"))
    return completeness.required_cells(x, ["c_custkey"], ["segment", "name", "not there"]).drop("value")


@query("""with x as (select o_orderkey, o_orderkey % 2 = 0 as k, o_custkey % 3 = 0 as a, o_orderstatus = 'F' as m from orders), y as (select *, cast(k as int) + cast(a as int) + cast(m as int) as f, m and not k and not a as alone from x where k or a or m)
select o_orderkey, p as part, case when (p = 'type' and k) or (p = 'account' and a) or (p = 'amount' and m) then 'FOUND' when alone then 'INCOMPLETE_CHECK' else 'INCOMPLETE_REQUIRED' end as status from y, (values ('type'), ('account'), ('amount')) t(p)""")
def group_completeness(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "T").alias("type"), F.when(F.col("o_custkey") % 3 == 0, "A").otherwise(" ").alias("account"), F.when(F.col("o_orderstatus") == "F", "1").alias("amount"))
    return completeness.group_completeness(o, ["o_orderkey"], [("type", "account", "amount"), ("type", "account", "absent")]).drop("slot", "value")


_HEADS = """req as (select distinct p_name || ' ' || p_brand as name from part),
act as (select p_partkey as position, case when p_size <= 15 then upper(p_name) || '  ' || p_brand when p_size <= 30 then p_name || '-' || p_brand when p_size <= 40 then 'also ' || p_name || p_brand when p_size <= 45 then p_name || ' ' || p_brand else '***' end as header from part)"""


def _heads(spark, sf_dir):
    """Required headers, the headers of one wide sheet and aliases, made of all parts."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    size, name, brand = F.col("p_size"), F.col("p_name"), F.col("p_brand")
    plain = F.concat_ws(" ", name, brand)
    header = F.when(size <= 15, F.concat_ws("  ", F.upper(name), brand)).when(size <= 30, F.concat_ws("-", name, brand)).when(size <= 40, F.concat(F.lit("also "), name, brand)).when(size <= 45, plain).otherwise("***")
    required = p.select(plain.alias("name")).distinct()
    return required, p.select(F.col("p_partkey").alias("position"), header.alias("header")), required.select("name", F.concat(F.lit("Also "), F.col("name")).alias("alias"))


@query(f"""with {_HEADS}, c as (select position, header, regexp_replace(lower(header), '[ ]+', '', 'g') k, regexp_replace(lower(header), '[^a-z0-9]', '', 'g') bare from act),
known as (select name, regexp_replace(lower(name), '[ ]+', '', 'g') k, 0 by_alias from req union all select name, 'also' || regexp_replace(lower(name), '[ ]+', '', 'g'), 1 from req),
e as (select name, header, position, by_alias from known join c using (k) qualify row_number() over (partition by name order by position, by_alias) = 1),
s as (select name, header, position from req join c on c.bare = regexp_replace(lower(name), '[^a-z0-9]', '', 'g') qualify row_number() over (partition by name order by position) = 1)
select req.name, case when e.by_alias = 0 then 'FOUND' when e.by_alias = 1 then 'ALIAS' when s.name is not null then 'SYMBOL_NOT_MATCH' else 'NO_SIMILAR_HEADER' end as outcome, coalesce(e.header, s.header) as header, coalesce(e.position, s.position) as position
from req left join e on e.name = req.name left join s on s.name = req.name""")
def header_match(spark, sf_dir):
    return completeness.header_match(*_heads(spark, sf_dir))


@query(f"with {_HEADS} select name from req except select header from act")
def missing_columns(spark, sf_dir):
    required, actual, _ = _heads(spark, sf_dir)
    return completeness.not_in(required, actual.select(F.col("header").alias("name")), "name")


@query("select distinct o_custkey from orders where o_orderstatus = 'F' except select o_custkey from orders where o_orderstatus = 'O'")
def distinct_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    return completeness.not_in(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), "o_custkey")


@query("""with x as (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as r from orders), m as (select o_custkey, max(r) as last from x where o_orderstatus = 'F' group by 1)
select o_custkey, o_orderkey, r from x join m using (o_custkey) where r <= last""")
def trailing_blank_trim(spark, sf_dir):
    from pyspark.sql import Window

    numbered = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).alias("r"))
    out = completeness.without_trailing_blanks(numbered, ["o_custkey"], "r", F.col("o_orderstatus") == "F")
    return out.select("o_custkey", "o_orderkey", big(F.col("r")).alias("r"))


# ---- comparison and rollup


def _fields() -> list[c.Field]:
    return [
        c.Field("status", c.typed("TEXT", F.col("o_orderstatus"), F.col("actual.l_linestatus")), F.col("o_orderstatus"), F.col("actual.l_linestatus")),
        c.Field("price", c.passed(within(F.col("o_totalprice"), F.col("actual.l_extendedprice"), 20_000.0)), F.lit("p"), F.lit("q")),
        c.Field("date", F.when(F.col("o_orderkey") % 4 == 0, c.SKIP).otherwise(c.passed(dates.same_or_next_weekday(F.col("o_orderdate").cast("date"), F.col("actual.l_shipdate").cast("date")))), F.lit(""), F.lit("x")),
        c.Field("line", F.when(F.col("o_orderkey") % 2 == 0, c.passed(F.col("actual.l_linenumber") == 1)), F.lit(1), F.col("actual.l_linenumber")),
    ]


def _matched(spark, sf_dir) -> DataFrame:
    """Each order beside its first line."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return matching.match(o, lines(spark, sf_dir).select("o_orderkey", *LINE_ORDER, "l_linestatus"), "o_orderkey", Policy.FIRST, LINE_ORDER).where("match = 'MATCH'")


def _compared(spark, sf_dir) -> DataFrame:
    """Each order with the results of four fields, as an array in its row."""
    return _matched(spark, sf_dir).select("o_orderkey", c.results(_fields()).alias("r"))


_COMPARED = f"""with f as (select * from lineitem qualify row_number() over (partition by l_orderkey order by {", ".join(LINE_ORDER)}) = 1), j as (select *, cast(o_orderdate as date) as od, cast(l_shipdate as date) as sd from orders join f on l_orderkey = o_orderkey),
c as (select o_orderkey, 0 as ordinal, 'status' as field, o_orderstatus as expected, l_linestatus as actual, case when upper(trim(o_orderstatus)) = upper(trim(l_linestatus)) then 'PASS' else 'FAIL' end as status from j
union all select o_orderkey, 1, 'price', 'p', 'q', case when abs(o_totalprice - l_extendedprice) <= 20000 then 'PASS' else 'FAIL' end from j
union all select o_orderkey, 2, 'date', '', 'x', case when o_orderkey % 4 = 0 then 'SKIP' when sd = od or sd = od + (case isodow(od) when 5 then 3 when 6 then 2 else 1 end) then 'PASS' else 'FAIL' end from j
union all select o_orderkey, 3, 'line', '1', cast(l_linenumber as varchar), case when l_linenumber = 1 then 'PASS' else 'FAIL' end from j where o_orderkey % 2 = 0)"""


@query(_COMPARED + " select o_orderkey, field, expected, actual, status from c")
def field_compare_long(spark, sf_dir):
    return c.long_results(_matched(spark, sf_dir), ["o_orderkey"], _fields()).select("o_orderkey", "field", "expected", "actual", "status")


@query(_COMPARED + """ select o_orderkey, case when bool_or(status = 'FAIL') then 'FAIL' when bool_and(status = 'SKIP') then 'SKIP' else 'PASS' end as status, case when bool_or(status = 'FAIL') then 'FAIL' else 'PASS' end as plain, count(*) as n_fields from c group by 1""")
def status_rollup(spark, sf_dir):
    return _compared(spark, sf_dir).select("o_orderkey", rollup.row_status(F.col("r")).alias("status"), rollup.row_status(F.col("r"), with_skip=False).alias("plain"), big(F.size("r")).alias("n_fields"))


@query(_COMPARED + """ select o_orderkey, coalesce(string_agg(field || ': expected ' || case when expected = '' then '(blank)' else expected end || ', actual ' || case when actual = '' then '(blank)' else actual end, chr(10) order by ordinal) filter (status = 'FAIL'), '') as remark from c group by 1""")
def remark_agg(spark, sf_dir):
    return _compared(spark, sf_dir).select("o_orderkey", F.array_join(rollup.row_lines(F.col("r"), rollup.plain_line, c.FAIL), "\n").alias("remark"))


@query(_COMPARED + """ select o_orderkey, coalesce(string_agg(field, ',' order by field) filter (status = 'FAIL'), '') as failed, coalesce(string_agg(field, ',' order by field) filter (status = 'PASS'), '') as passed, string_agg(field || '=' || status, ',' order by field) as fields from c group by 1""")
def failed_field_map(spark, sf_dir):
    entries = F.transform(F.map_entries(rollup.row_map(F.col("r"))), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return _compared(spark, sf_dir).select("o_orderkey", F.array_join(rollup.row_names(F.col("r"), c.FAIL), ",").alias("failed"), F.array_join(rollup.row_names(F.col("r"), c.PASS), ",").alias("passed"), F.array_join(F.array_sort(entries), ",").alias("fields"))


@query("""with c as (select o_orderkey, case when l_linestatus = o_orderstatus then 'PASS' when l_returnflag = 'R' then 'FAIL' else 'SKIP' end as status from orders join lineitem on l_orderkey = o_orderkey)
select o_orderkey, case when bool_or(status = 'FAIL') then 'FAIL' when bool_and(status = 'SKIP') then 'SKIP' else 'PASS' end as status, count(*) as n_fields from c group by 1""")
def grouped_rollup(spark, sf_dir):
    """Every line of an order is compared, and the lines make one status."""
    x = lines(spark, sf_dir).select("o_orderkey", "l_linestatus", "l_returnflag").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    status = F.when(F.col("l_linestatus") == F.col("o_orderstatus"), c.PASS).when(F.col("l_returnflag") == "R", c.FAIL).otherwise(c.SKIP)
    return x.groupBy("o_orderkey").agg(rollup.group_status(status).alias("status"), F.count("*").alias("n_fields"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_returnflag = 'R' then 'FAIL' else 'PASS' end as as_number, case when l_returnflag = 'N' then 'PASS' when l_returnflag = 'R' then 'FAIL' when l_linenumber % 2 = 1 then 'PASS' else 'FAIL' end as as_amount from lineitem""")
def typed_compare(spark, sf_dir):
    """Numbers exactly, amounts within the tolerance; both blank are equal, thousands separators aren't understood."""
    flag, price = F.col("l_returnflag"), F.col("l_extendedprice")
    quantity = F.when(flag == "R", F.concat(F.lit("1,"), F.col("l_quantity").cast("string"))).otherwise(F.col("l_quantity").cast("string"))
    whole = F.when(flag == "N", F.col("l_quantity").cast("int").cast("string")).otherwise(F.col("l_quantity").cast("decimal(12,4)").cast("string"))
    shown = F.when(flag == "R", F.concat(price.cast("string"), F.lit(","))).when(flag != "N", price.cast("string"))
    other = F.when(flag != "N", (price + F.when(F.col("l_linenumber") % 2 == 1, 0.005).otherwise(0.02)).cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c.typed("NUMBER", quantity, whole).alias("as_number"), c.typed("AMOUNT", shown, other).alias("as_amount"))


@query("""select o_orderkey, case when upper(o_orderstatus) = 'F' then 'PASS' else 'FAIL' end as known, 'FAIL' as unknown, 'Compare Rule Not Found' as reason from orders""")
def rule_not_found(spark, sf_dir):
    fields = c.for_headers({"status": c.Field("status", c.typed("TEXT", F.lit("f"), F.col("o_orderstatus")), F.lit("f"), F.col("o_orderstatus"))}, ("status", "priority"), lambda h: F.col("o_orderpriority"))
    r = F.col("r")
    return table(spark, sf_dir, "orders").select("o_orderkey", c.results(fields).alias("r")).select("o_orderkey", r[0]["status"].alias("known"), r[1]["status"].alias("unknown"), r[1]["reason"].alias("reason"))


@query("""with x as (select o_custkey, o_orderkey, case o_orderstatus when 'F' then 'FAIL' when 'O' then 'SKIP' else case when o_orderpriority < '3' then 'PASS' when o_orderpriority < '4' then 'UNTAGGED' else 'MISSING' end end as status from orders)
select o_custkey, o_orderkey, status, cast(row_number() over (partition by o_custkey order by list_position(['PASS', 'UNTAGGED', 'SKIP', 'FAIL', 'MISSING'], status), o_orderkey) as bigint) as place from x""")
def result_order_skip(spark, sf_dir):
    p = F.col("o_orderpriority")
    status = F.when(F.col("o_orderstatus") == "F", "FAIL").when(F.col("o_orderstatus") == "O", "SKIP").when(p < "3", "PASS").when(p < "4", "UNTAGGED").otherwise("MISSING")
    x = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", status.alias("status"))
    return rollup.ordinals(x, "status", ["o_orderkey"], ["o_custkey"], rollup.ORDER_WITH_SKIP).select("o_custkey", "o_orderkey", "status", big(F.col("place")).alias("place"))


@query("""with x as (select o_custkey, o_orderkey, case o_orderstatus when 'F' then 'FAIL' when 'O' then 'PASS' else 'UNTAGGED' end as status from orders)
select o_custkey, o_orderkey, status, cast(row_number() over (partition by o_custkey order by case status when 'PASS' then 1 when 'UNTAGGED' then 2 else 3 end, o_orderkey) as bigint) as place from x""")
def result_order(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "FAIL").when(F.col("o_orderstatus") == "O", "PASS").otherwise("UNTAGGED")
    x = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", status.alias("status"))
    return rollup.ordinals(x, "status", ["o_orderkey"], ["o_custkey"]).select("o_custkey", "o_orderkey", "status", big(F.col("place")).alias("place"))


@query("""with x as (select o_custkey, case o_orderstatus when 'F' then 'FAIL' when 'O' then 'PASS' else 'SKIP' end as status from orders)
select o_custkey, count(*) as total, count(*) filter (status = 'PASS') as n_pass, count(*) filter (status = 'FAIL') as n_fail, count(*) filter (status = 'SKIP') as n_skip, true as balanced from x group by 1""")
def summary_counts(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "FAIL").when(F.col("o_orderstatus") == "O", "PASS").otherwise("SKIP")
    return summary.counts(table(spark, sf_dir, "orders").select("o_custkey", status.alias("status")), ["o_custkey"])


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def repeated_keys(spark, sf_dir):
    return summary.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""select o_orderkey, case when lower(trim(o_orderstatus)) <> 'f' then 'FAIL' when o_orderkey % 5 = 0 then 'REVIEW' else 'PASS' end as status from orders""")
def fixed_value_check(spark, sf_dir):
    source = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", c.fixed_value("f", F.col("o_orderstatus"), source).alias("status"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when abs(p_retailprice - l_extendedprice) <= 5000 then 'primary' when abs(l_quantity * 1000 - l_extendedprice) <= 5000 then 'fallback' else 'none' end as side from lineitem join part on p_partkey = l_partkey""")
def amount_fallback(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c.amount_or_fallback(F.col("l_extendedprice"), F.col("p_retailprice"), F.col("l_quantity") * 1000, 5000.0).alias("side"))


@query("""with f as (select * from lineitem qualify row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) = 1),
x as (select o_orderkey, o_orderkey % 9 <> 0 as id_ok, l_linestatus = o_orderstatus as account_ok, abs(o_totalprice - l_extendedprice) <= 50000 as amount_ok from orders join f on l_orderkey = o_orderkey)
select o_orderkey, concat_ws(',', case when not id_ok then 'id' end, case when not account_ok then 'account' end, case when not amount_ok then 'amount' end) as failed_keys, case when id_ok and account_ok and amount_ok then 'PASS' else 'FAIL' end as status from x""")
def key_conditions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    m = matching.match(o, lines(spark, sf_dir).select("o_orderkey", *LINE_ORDER, "l_linestatus"), "o_orderkey", Policy.FIRST, LINE_ORDER).where("match = 'MATCH'")
    key = F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 9 == 0, "XX").otherwise("DR"))
    checks = {"id": n.strip_suffix(key, "DR", "FE") == F.col("o_orderkey").cast("string"), "account": c.upper_equal(F.col("o_orderstatus"), F.col("actual.l_linestatus")), "amount": within(F.col("o_totalprice"), F.col("actual.l_extendedprice"), 50_000.0)}
    failed = F.concat_ws(",", *(F.when(~ok, name) for name, ok in checks.items()))
    return m.select("o_orderkey", failed.alias("failed_keys"), c.passed(failed == "").alias("status"))


@query("""with x as (select o_orderkey, case o_orderstatus when 'F' then 'BUY_FCY' when 'O' then 'SELL_FCY' else 'NOT_FTU' end as d, 'P' || o_custkey % 3 as want, 'P' || o_orderkey % 3 as inflow, case when o_orderkey % 4 = 0 then 'P1' else '' end as outflow from orders)
select o_orderkey, d as direction, case d when 'BUY_FCY' then '182001' when 'SELL_FCY' then '182002' end as leg, case when d = 'NOT_FTU' then null when (d = 'BUY_FCY' and outflow <> '') or (d = 'SELL_FCY' and inflow <> '') then 'FAIL' when want = (case when d = 'BUY_FCY' then inflow else outflow end) then 'PASS' else 'FAIL' end as purpose from x""")
def directional_checks(spark, sf_dir):
    d = F.when(F.col("o_orderstatus") == "F", "BUY_FCY").when(F.col("o_orderstatus") == "O", "SELL_FCY").otherwise("NOT_FTU")
    p = lambda x: F.concat(F.lit("p"), x.cast("string"))
    status = c.purpose(d, p(F.col("o_custkey") % 3), p(F.col("o_orderkey") % 3), F.when(F.col("o_orderkey") % 4 == 0, " P1 "))
    return table(spark, sf_dir, "orders").select("o_orderkey", d.alias("direction"), c.directional(d, F.lit("182001"), F.lit("182002")).alias("leg"), F.when(d != "NOT_FTU", status).alias("purpose"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against their lines, each of which must be unique; fields compared, rolled up and counted by outcome."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    m = matching.match(o, lines(spark, sf_dir).select("o_orderkey", *LINE_ORDER, "l_linestatus"), "o_orderkey", Policy.UNIQUE, LINE_ORDER)
    m = m.withColumn("outcome", F.when(F.col("o_orderpriority") == "1-URGENT", "EXCLUDED").otherwise(F.when(F.col("match") == "MATCH", "COMPARE").otherwise(F.col("match"))))
    ok = c.upper_equal(F.col("o_orderstatus"), F.col("actual.l_linestatus")) & within(F.col("o_totalprice"), F.col("actual.l_extendedprice"), 100_000.0)
    status = F.when(F.col("outcome") == "COMPARE", c.passed(ok)).when(F.col("outcome") == "EXCLUDED", c.PASS).otherwise(c.FAIL)
    return m.groupBy("outcome", status.alias("status")).agg(F.count("*").alias("n"))


QUERIES["recon_flagship"] = flagship
ORACLE["recon_flagship"] = """with a as (select l_orderkey, count(*) k, min(l_linestatus) s, min(l_extendedprice) p from lineitem group by 1),
x as (select *, case when o_orderpriority = '1-URGENT' then 'EXCLUDED' when k is null then 'MISSING' when k > 1 then 'DUPLICATE' else 'COMPARE' end as outcome from orders left join a on l_orderkey = o_orderkey)
select outcome, case when outcome = 'EXCLUDED' or (outcome = 'COMPARE' and o_orderstatus = s and abs(o_totalprice - p) <= 100000) then 'PASS' else 'FAIL' end as status, count(*) as n from x group by 1, 2"""
