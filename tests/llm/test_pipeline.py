"""The corpus pipeline, stage by stage."""

import pytest

import corpus_pipeline
from tallyline.llm import neardup, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, kept = docs.columns, [docs.count()]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        kept.append(out.count())
        if name == "toxicity":
            rejected = {r.doc_id for r in toxicity.score(docs, toxicity.train(docs, labels)).where("predicted = 1").collect()}
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - rejected and rejected
        if name == "near_dedup":
            assert {r.doc_id for r in out.collect()} == {r.component_id for r in neardup.near_duplicates(docs, n=5).collect()}
            assert out.count() == out.select("doc_id").distinct().count()
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
        else:
            assert out.columns == columns
        docs = out
    assert kept[0] > kept[1] > kept[2] >= kept[3] == kept[4] <= kept[5]


def test_clashing_and_repeated_rows(spark):
    """Columns of any name, repeated rows, and rows without an id go through all five stages with their own text."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20).withColumn("score", F.lit(1)).withColumn("_row", F.lit("x")).withColumn("n_email", F.lit(None).cast("string"))
    null = F.lit(None).cast("long")
    unnamed = docs.limit(1).select(F.explode(F.array(F.lit(None).cast("string"), F.lit("first of three texts"), F.lit("second text without an id"), F.lit("second text without an id"))).alias("text"), *(c for c in docs.columns if c != "text")).select(docs.columns).withColumn("doc_id", null)
    docs = docs.union(docs.limit(3)).union(unnamed).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns[-3:] == ["score", "_row", "n_email"] and all(r.score == 1 and r._row == "x" for r in docs.collect()), name
    named = docs.where("doc_id is not null")
    assert docs.where("doc_id is null").count() == 4 and named.count() == named.select("doc_id").distinct().count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    texts = {r.doc_id: r.text or "" for r in named.collect()}
    whole: dict = {}
    for r in sorted((r for r in packed if r.doc_id is not None), key=lambda r: (r.doc_id, r.piece)):
        whole[r.doc_id] = whole.get(r.doc_id, "") + r.text
    assert whole == texts and sorted(r.text for r in packed if r.doc_id is None) == ["", "first of three texts", "second text without an id", "second text without an id"]


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_run_leaves_nothing_behind(spark):
    from tallyline.llm import common

    before = len(common.kept())
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.columns == ["doc_id", "piece", "n_pieces", "start", "length", "bin_id", "offset", "text"]
    # What the lazy result reads is left: the output of the stage before it, and the keyed copy that is packed.
    left = common.kept()[before:]
    assert len(left) <= 2
    common.forget(*left)
    assert len(common.kept()) == before


def test_a_shared_folder_is_asked_for():
    import types

    from tallyline.llm import common

    session = lambda master, conf: types.SimpleNamespace(conf={"spark.checkpoint.dir": conf} if conf else {}, sparkContext=types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))
    assert common.shared_dir(session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(session("spark://host:7077", None))


def test_pseudonyms_without_a_key_on_a_cluster(spark):
    """Where no key is set, the stage runs on any master, under a secret that isn't in the source and is one for the whole application."""
    import types

    from tallyline.llm import pii, queries

    session = lambda app, conf={}, master="spark://host:7077": types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master=master, applicationId=app))  # noqa: B006, E731
    docs = spark.createDataFrame([(1, "to jo@mail.example.com"), (2, None), (2, ""), (None, "jo@mail.example.com wrote")], "doc_id long, text string").coalesce(1)
    made = lambda s: [(r.doc_id, r.text) for r in corpus_pipeline.pseudonymise(s, docs, "").collect()]
    with pytest.warns(UserWarning, match=queries.PII_KEY):
        first = made(session("app-1"))
    name = first[0][1].removeprefix("to ")
    assert name != "jo@mail.example.com" and first == [(1, f"to {name}"), (2, None), (2, ""), (None, f"{name} wrote")]
    assert made(session("app-1")) == first != made(session("app-2"))
    assert name != pii.Redactor(queries.TRIAL_KEY.encode()).redact("jo@mail.example.com")[0]
    # A key that is set holds everywhere, and one machine's trials stay as they are.
    assert queries.pii_key(session("app-1", {queries.PII_KEY: "mine"})) == b"mine" and queries.pii_key(session("x", master="local[4]")) == queries.TRIAL_KEY.encode()


def test_texts_that_share_an_id(spark):
    """Rows equal in id and text are one; different texts under one id stay or go each for itself."""
    words = lambda s: " ".join(f"{s}{i}" for i in range(40))
    rows = [(2, words("a")), (2, words("a")), (2, words("b")), (1, words("c")), (3, words("b")), (4, None), (4, None), (None, words("a")), (None, words("a"))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _key0 string")
    found = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert found.columns == docs.columns
    key = lambda r: (r[0] is None, r[0], r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=key) == sorted([(1, words("c")), (2, words("a")), (2, words("b")), (4, None), (None, words("a")), (None, words("a"))], key=key)
