"""Joins of expected to actual rows under a policy for keys that several actual rows share.

Actual rows are reduced to one row per key by a partial, then final aggregation before they are
joined, so that a key with very many rows costs one row in the join. Only AGGREGATE results that ask
for all rows keep them.
"""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Policy(Enum):
    FIRST = "first"
    LAST = "last"
    UNIQUE = "unique"
    AGGREGATE = "aggregate"


def by_key(actual: DataFrame, key: str, policy: Policy, order: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """key, n_actual, actual (a struct of the row that counts) and, for AGGREGATE, sum_<c> and nulls_<c> of each summed column."""
    row, at = F.struct(*(F.col(f"`{c}`") for c in actual.columns)), F.struct(*order)
    pick = F.max_by(row, at) if policy is Policy.LAST else F.min_by(row, at)
    extra = [x for c in sums for x in (F.sum(c).alias(f"sum_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))] if policy is Policy.AGGREGATE else []
    return actual.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_actual"), pick.alias("actual"), *extra)


def match(expected: DataFrame, actual: DataFrame, key: str, policy: Policy, order: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """Each expected row with `match` (MISSING, MATCH or, for UNIQUE only, DUPLICATE), n_actual and the columns of by_key."""
    joined = expected.join(by_key(actual, key, policy, order, sums), key, "left")
    n = F.coalesce("n_actual", F.lit(0))
    state = F.when(n == 0, "MISSING").when((n > 1) & F.lit(policy is Policy.UNIQUE), "DUPLICATE").otherwise("MATCH")
    return joined.withColumn("n_actual", n).withColumn("match", state)


def missing(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Expected rows without an actual one."""
    return expected.join(actual.select(key), key, "left_anti")


def untagged(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Actual rows that nothing expects."""
    return actual.join(expected.select(key), key, "left_anti")


def both_sides(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Full outer join with `side`: MATCHED, MISSING (expected only) or UNTAGGED (actual only). Sides are one row per key."""
    e, a = expected.withColumn("_e", F.lit(1)), actual.withColumn("_a", F.lit(1))
    side = F.when(F.col("_e").isNull(), "UNTAGGED").when(F.col("_a").isNull(), "MISSING").otherwise("MATCHED")
    return e.join(a, key, "full_outer").withColumn("side", side).drop("_e", "_a")


def closest_amounts(expected: DataFrame, actual: DataFrame, group: str, expected_id: str, amount: str, actual_id: str, actual_amount: str, tolerance: float, fallback: str | None = None, itself: bool = False) -> DataFrame:
    """Each expected row's partner in its group within the tolerance: UNIQUE, AMBIGUOUS or NONE, and the least partner id; ids of expected rows are unique.

    The two tables are different things, so an equal id means nothing. itself: they are one table, whose
    rows are no partners of their own. Amounts are dealt to bands as wide as the tolerance; a row is joined
    to its own band and the two beside it, so that a large group doesn't meet itself row by row. Equal
    amounts of a group are counted once and meet as one. With fallback, rows without a partner by the
    first amount try that one.
    """
    same = actual.where(F.col(actual_amount).isNotNull()).select(F.col(group), F.col(actual_id).alias("_id"), F.col(actual_amount).alias("_amount"))
    if itself:
        # Of each amount its rows and the least two ids, one of which is no row's own: two rows a task and amount are shuffled.
        ranked = Window.partitionBy(group, "_amount").orderBy("_id")
        two = same.withColumn("_rn", F.row_number().over(ranked)).where("_rn <= 2").groupBy(group, "_amount").agg(F.min("_id").alias("_least"), F.max(F.when(F.col("_rn") == 2, F.col("_id"))).alias("_second"))
        right = same.groupBy(group, "_amount").agg(F.count("*").alias("_k")).join(two, [group, "_amount"])
    else:
        right = same.groupBy(group, "_amount").agg(F.count("*").alias("_k"), F.min("_id").alias("_least")).withColumn("_second", F.lit(None).cast(same.schema["_id"].dataType))
    right = right.select(F.col(group).alias("_group"), F.floor(F.col("_amount") / tolerance).alias("_at"), "_amount", "_k", "_least", "_second")
    whole = F.struct(*(F.col(f"`{c}`") for c in expected.columns))
    # Every row stays in the join with the bands of each amount it tries, so that it needn't be joined again.
    tries = [(i, F.col(by), F.floor(F.col(by) / tolerance) + step) for i, by in enumerate([amount, *([fallback] if fallback else [])]) for step in (-1, 0, 1)]
    here = expected.select(whole.alias("_row"), F.col(group).alias("_g"), F.inline(F.array(*(F.struct(F.lit(i).alias("_try"), by.cast("double").alias("_by"), band.alias("_band")) for i, by, band in tries))))
    met = here.join(right, (F.col("_g") == F.col("_group")) & (F.col("_band") == F.col("_at")) & (F.abs(F.col("_by") - F.col("_amount")) <= tolerance), "left")
    own = F.coalesce(F.col(f"_row.{actual_amount}") == F.col("_amount"), F.lit(False)) if itself else F.lit(False)
    partner = F.when(own & (F.col("_least") == F.col(f"_row.{expected_id}")), F.col("_second")).otherwise(F.col("_least"))
    sums = [x for i in range(2) for x in (F.coalesce(F.sum(F.when(F.col("_try") == i, F.col("_k") - own.cast("int"))), F.lit(0)).alias(f"_n{i}"), F.min(F.when(F.col("_try") == i, partner)).alias(f"_p{i}"))]
    found = met.groupBy(F.col(f"_row.{expected_id}").alias("_key")).agg(F.first("_row").alias("_row"), *sums)
    n = F.when(F.col("_n0") > 0, F.col("_n0")).otherwise(F.col("_n1"))
    state = F.when(n == 0, "NONE").when(n == 1, "UNIQUE").otherwise("AMBIGUOUS")
    return found.select("_row.*", F.when(F.col("_n0") > 0, F.col("_p0")).otherwise(F.col("_p1")).alias("partner_id"), state.alias("outcome"), n.alias("n_near"))


def suffix_partners(rows: DataFrame, reference: str, one: str, other: str) -> DataFrame:
    """Rows with suffix one beside the row with suffix other of the same base reference: base, reference, partner."""
    base = lambda s: F.regexp_replace(reference, f"{s}$", "")
    left = rows.where(F.col(reference).endswith(one)).select(base(one).alias("base"), F.col(reference).alias("reference"))
    right = rows.where(F.col(reference).endswith(other)).select(base(other).alias("base"), F.col(reference).alias("partner"))
    return left.join(right, "base", "left")


def two_tier(rows: DataFrame, lookup: DataFrame, first: str, second: str, value: str) -> DataFrame:
    """value by the first key, else by the second where that is unique in the lookup; `tier` is 1, 2 or 0."""
    one = lookup.groupBy(first).agg(F.min(value).alias("_v1"))
    two = lookup.groupBy(second).agg(F.count("*").alias("_n"), F.min(value).alias("_v2")).where("_n = 1").drop("_n")
    joined = rows.join(one, first, "left").join(two, second, "left")
    tier = F.when(F.col("_v1").isNotNull(), 1).when(F.col("_v2").isNotNull(), 2).otherwise(0)
    return joined.withColumn("tier", tier).withColumn(value, F.coalesce("_v1", "_v2")).drop("_v1", "_v2")


def asked(rows: DataFrame, lookup: DataFrame, of: Column, key: str, spread: Column) -> DataFrame:
    """rows with the columns of the lookup's row whose key is `of`, where that isn't null; the lookup has one row per key.

    Rows that ask for nothing are dealt by `spread`: a join by null, or by any one value that stands for it,
    has all of them in one task.
    """
    by = rows.withColumn("_by", F.coalesce(of, spread)).withColumn("_asks", of.isNotNull())
    return by.join(lookup, (F.col("_by") == F.col(key)) & F.col("_asks"), "left").drop("_by", "_asks")


def resolved(rows: DataFrame, lookup: DataFrame, first: str, second: str, value: str) -> DataFrame:
    """rows with the value of the one lookup row that each means: by the first key (tier 1), else by the second (2), else, where a row has neither, the only lookup row without a second key (3).

    Keys are text, blank for none. lookup: first, the array `<second>s` of its second keys (a blank one
    among them if it has none), value. What isn't one row is an error of the data: a first key that repeats
    in the lookup, a second key that several lookup rows have, and rows that nothing is found for. The plan
    itself raises it, when the value of such a row is read, and its job fails; nothing runs ahead of it.
    """
    said = lambda *parts: F.raise_error(F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    one = lookup.where(F.col(first) != "").groupBy(first).agg(F.count("*").alias("_n"), F.min(value).alias("_v1"))
    one = one.select(F.when(F.col("_n") > 1, said("duplicate reference in the test data: ", quoted(F.col(first)))).otherwise(F.col(first)).alias("_first"), "_v1")
    two = lookup.select(F.explode(f"{second}s").alias("_second"), value).groupBy("_second").agg(F.count("*").alias("_n2"), F.min(value).alias("_v2"))
    wanted = F.when((F.col(second) != "") | (F.col(first) == ""), F.col(second))
    found = asked(rows.withColumn("_asked", wanted), one, F.when(F.col(first) != "", F.col(first)), "_first", F.col(second))
    found = asked(found, two, F.col("_asked"), "_second", F.col(first))
    what = F.concat(F.lit("number "), quoted(F.col(second)), F.lit(", reference "), quoted(F.col(first)))
    tier = F.when(F.col("_v1").isNotNull(), 1).when(F.col("_asked") == "", 3).otherwise(2)
    means = F.coalesce("_v1", F.when(F.col("_n2") == 1, F.col("_v2")).when(F.col("_n2") > 1, said("ambiguous: several test rows for ", what)).otherwise(said("no test row for ", what)))
    return found.withColumn("tier", tier).withColumn(value, means).drop("_asked", "_first", "_v1", "_second", "_n2", "_v2")


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; Spark keeps one row per key and task before the shuffle (window group limit)."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def fan_out(actual: DataFrame, groups: DataFrame, key: str | list[str]) -> DataFrame:
    """Each actual row with every result group of its key; rows without one stay, with blank status."""
    return actual.join(groups, key, "left")


#: A lookup table is broadcast only after its rows were counted and are at most so many.
BROADCAST_ROWS = 100_000


def looked_up(rows: DataFrame, key: str, values: DataFrame, into: str) -> DataFrame:
    """A column from a table of (key, value); null where it has no row. A key that repeats raises, as it would multiply rows."""
    named = values.select(F.col(values.columns[0]).alias(key), F.col(values.columns[1]).alias(into)).where(F.col(key).isNotNull())
    total, different = named.agg(F.count("*"), F.count_distinct(key)).first()
    if total != different:
        raise ValueError(f"{total - different} keys of the lookup table repeat")
    return rows.join(F.broadcast(named) if total <= BROADCAST_ROWS else named, key, "left")
