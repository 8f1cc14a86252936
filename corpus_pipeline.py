"""A pipeline of five operators over the documents of a training corpus.

Every stage reads all that the one before kept, written as Parquet in between, and drops or rewrites
documents; the last returns the packed pieces. All stages take nulls in any column, repeated rows, empty
tables, texts of any length and extra columns of any name.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import decontaminate, neardup, packing, pii, toxicity
from tallyline.llm.common import boxed, forget, keep, kept, small, table, unboxed
from tallyline.llm.queries import pii_key


def free_name(docs: DataFrame, start: str) -> str:
    """A column's name that docs hasn't got."""
    return next(n for n in (f"{start}{i}" for i in itertools.count()) if n not in docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of the toxicity grammar, which is fitted on the labelled documents of the stage's input.

    A null or empty text isn't toxic; each of repeated rows is judged alike; an empty table stays empty.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(boxed(docs), model, carry=("_row", "text"))
    return unboxed(scored.where("predicted = 0"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near duplicates (sets of five-word shingles alike by 0.8); of rows equal in id and text one. Different texts under one id are documents of their own. Rows without an id all stay, as do texts without words."""

    def first_ones(rows: DataFrame, name: str) -> DataFrame:
        found = neardup.near_duplicates(rows, n=5, doc_id=name)
        gone = keep(found.where("not kept").select(F.col("doc_id").alias(name)).distinct(), "gone")
        return rows.join(small(gone, gone.count()), name, "left_anti").select(docs.columns)

    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return first_ones(docs, "doc_id")
    # Where ids repeat, rows are named by their place in the order of ids.
    key = free_name(docs, "_key")
    once = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).orderBy("doc_id", F.xxhash64("text"))
    return first_ones(keep(once.withColumn(key, F.monotonically_increasing_id()), "once"), key).union(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item; rows without an id are checked each for itself. Null and empty texts stay; repeated rows go or stay together."""
    items = table(spark, sf_dir, "benchmark")

    def clean(rows: DataFrame, name: str) -> DataFrame:
        gone = keep(decontaminate.overlaps(rows, items, doc_id=name).select(F.col("doc_id").alias(name)).distinct(), "gone")
        return rows.join(small(gone, gone.count()), name, "left_anti").select(docs.columns)

    out, unnamed = clean(docs, "doc_id"), docs.where("doc_id is null")
    if unnamed.isEmpty():
        return out
    key = free_name(docs, "_key")
    return out.where("doc_id is not null").union(clean(keep(unnamed.withColumn(key, F.monotonically_increasing_id()), "unnamed"), key))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced under the session's key (queries.PII_KEY); null and empty texts stay as they are."""
    out = unboxed(pii.pseudonymise(boxed(docs), pii_key(spark), carry=("_row",)), docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in pieces, with the bin, the place in it and the text of each. A null or empty text is one empty piece; repeated rows are packed each for itself."""
    # Ids may be null in many rows; written once, a row's key is the same for its pieces and its text.
    keyed = keep(docs.select("doc_id", "source", "text", F.monotonically_increasing_id().alias("_key")), "keyed")
    return packing.filled(keyed, packing.pack(keyed, key="_key"), key="_key")


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated), ("pii", pseudonymise), ("packing", pack)]
#: SQL can't express the learned grammar, sketches and packing; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage wrote on its way, and the output of the stage before, is deleted once its own output is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = {id(t) for t in kept()} - {id(docs)}
        made = keep(stage(spark, docs, sf_dir), name)
        forget(*(t for t in kept() if t is not made and id(t) not in before))
        docs = made
    out = STAGES[-1][1](spark, docs, sf_dir)
    # Packing has written its own copy of what it was given.
    forget(docs)
    return out
