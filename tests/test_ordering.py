"""Places and runs along one order over many partitions, and counts that are taken while results are written, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import ordering, summary
from tallyline.plans import contracts as k, registry, stages

from test_reports import sheet


@pytest.fixture
def partitions(spark):
    """Partitions stay as many as asked for, so that runs go over their ends."""
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def set_(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)

    yield set_
    for c, v in kept.items():
        spark.conf.set(c, v)


def brute_runs(rows):
    """(group, order, value) -> the run of each, in order."""
    out, run, last = {}, 0, None
    for g, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1])):
        run = 1 if last is None or last[0] != g else run + (last[1] != v)
        out[g, o], last = run, (g, v)
    return out


@pytest.mark.parametrize("n", [1, 3, 9])
@pytest.mark.parametrize("seed", range(4))
def test_runs_against_a_loop(spark, partitions, n, seed):
    """Long and short runs, nulls, groups that fill many partitions and partitions that hold many groups."""
    partitions(n)
    r = random.Random(seed)
    rows, at = [], 0
    while len(rows) < 200:
        value, group = r.choice([None, "a", "b"]), r.choice(["f", "g", None]) if seed % 2 else "f"
        rows += [(group, at := at + 1, value) for _ in range(r.choice([1, 1, 2, 70]))]
    df = spark.createDataFrame(rows, "g string, o long, v string").repartition(5)
    got = ordering.runs(df, ["o"], "v", ["g"])
    assert got.columns == ["g", "o", "v", "island"] and {(x.g, x.o): x.island for x in got.collect()} == brute_runs(rows)
    whole = {x.o: x.island for x in ordering.runs(df.drop("g"), ["o"], "v").collect()}
    assert whole == {o: i for (_, o), i in brute_runs([("", o, v) for _, o, v in rows]).items()}


def test_no_partition_holds_the_whole(spark, partitions):
    partitions(16)
    docs = spark.range(40_000).select(F.col("id"), (F.col("id") / 1000).cast("long").alias("v"))
    sizes = [r["count"] for r in ordering.sequenced(docs, ["id"]).groupBy(ordering.PART).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 10_000
    plan = ordering.runs(docs, ["id"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert ordering.runs(docs, ["id"], "v").agg(F.count_distinct("island")).first()[0] == 40
    assert ordering.runs(docs.limit(0), ["id"], "v").count() == 0 and ordering.placed(docs.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("n", [1, 7])
def test_places(spark, partitions, n):
    partitions(n)
    r = random.Random(n)
    rows = [(i, r.choice([None, 1.5, 2.0, -3.0])) for i in range(500)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, x double").repartition(4)
    got = {x.id: x.place for x in ordering.placed(df, [F.desc_nulls_last("x"), F.asc("id")]).collect()}
    assert got == {i: p for p, (i, _) in enumerate(sorted(rows, key=lambda y: (y[1] is None, -(y[1] or 0), y[0])), 1)}


def counted(spark, rows):
    """rows, and how many of them were made so far."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    plain = rows.toDF(*(f"c{i}" for i in range(len(rows.columns))))
    return plain.mapInArrow(run, plain.schema).toDF(*rows.columns), made


def test_validation_and_its_counts_in_one_pass(spark, tmp_path):
    contract = k.CONTRACTS["DS_PTX"]
    rows = [dict.fromkeys(contract.test_data(), "x") | {k.TEST_ID: f"t{i}" if i % 4 else " ", "Fee Type 1": "T", "Fee Amount Type 1": None if i % 2 else "1"} for i in range(60)]
    test, made = counted(spark, sheet(spark, rows))
    cells, seen = stages.validated(test, list(rows[0]), contract, lambda name, df: df.write.parquet(f"{tmp_path}/{name}"))
    got = seen.get
    assert made.value == 60
    want = {r.status: r["count"] for r in spark.read.parquet(f"{tmp_path}/cells").groupBy("status").count().collect()}
    assert got == {"total": sum(want.values()), **{f"n_{s.lower()}": want.get(s, 0) for s in stages.STATES}} and got["n_empty"] == 15 and got["n_incomplete_required"] == 30
    assert cells.columns == ["_file", "_row", "header", "value", "status", "remark"]


def test_published_details_and_their_counts_in_one_pass(spark, tmp_path):
    test = sheet(spark, [{k.TEST_ID: f"x{i}", k.TEST_NO: f"T{i}"} for i in range(50)])
    rows = spark.createDataFrame([(f"X{i}DR", f"T{i}", ("PASS", "FAIL", "SKIP")[i % 3]) for i in range(50)], "key string, test_no string, status string")
    results, made = counted(spark, rows)
    got = registry.publish("DS_LTX", results, test, lambda d: d.write.parquet(f"{tmp_path}/a"))
    assert made.value == 50 and got == {"total": 50, "n_pass": 17, "n_fail": 17, "n_skip": 16} and spark.read.parquet(f"{tmp_path}/a").count() == 50
    # All is written before a gate is looked at.
    with pytest.raises(ValueError, match="pass, fail or are skipped"):
        registry.publish("DS_LTX", rows.withColumn("status", F.lit("ODD")), test, lambda d: d.write.parquet(f"{tmp_path}/b"))
    assert spark.read.parquet(f"{tmp_path}/b").count() == 50
    with pytest.raises(ValueError, match="49 details of 50"):
        summary.gate(got, 49)
    with pytest.raises(ValueError, match="no summary"):
        registry.publish("DF_FXU", rows, test, lambda d: None)


def test_places_of_the_result_sheet(spark):
    out = spark.createDataFrame([("a", "FAIL", "f", 9), ("b", "PASS", "f", 12), ("c", "PASS", "f", 3), ("d", "MISSING", None, None), ("e", "UNTAGGED", "f", 4), ("f", "EXPECTED_ABSENCE", None, None)], "key string, status string, report_file string, report_row long")
    assert {r.key: r.place for r in stages.output_places(out).collect()} == {"c": 2, "b": 3, "e": 4, "a": 5, "f": 6, "d": 7}


def test_a_range_is_many_blocks(spark, partitions, monkeypatch):
    """What lies in one partition is dealt anew in blocks of so many rows; places and runs go on over their ends."""
    partitions(2)
    monkeypatch.setattr(ordering, "_BITS", 4)
    rows = [("f" if i < 90 else "g", i, "ab"[i // 40 % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o long, v string")
    blocks = [r["count"] for r in ordering.sequenced(df, ["o"]).groupBy(ordering.PART).count().collect()]
    assert max(blocks) == 16 and len(blocks) >= 200 / 16
    assert {r.o: r.place for r in ordering.placed(df, ["o"]).collect()} == {i: i + 1 for i in range(200)}
    assert {(x.g, x.o): x.island for x in ordering.runs(df, ["o"], "v", ["g"]).collect()} == brute_runs(rows)


def test_rows_that_are_dear_are_made_once(spark):
    """Ranges are chosen by a look at all rows; kept ones aren't made anew for the sort, and aren't kept any longer."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(1000).mapInArrow(count, "id long")
    assert {r.id: r.place for r in ordering.placed(rows, [F.desc("id")], kept=True).collect()} == {i: 1000 - i for i in range(1000)}
    assert made.value == 1000 and not spark.sparkContext._jsc.getPersistentRDDs()
