"""The queries of this subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

import os
import warnings

from pyspark.sql import DataFrame, SparkSession

from . import classifier, decontaminate, language, neardup, packing, pii, quality, search, secrets, sharding, spelling, tokens, toxicity
from .common import held_out, table


#: The setting that holds the secret of pseudonyms, and what stands in for it where it is unset, as in tests and trials. A key that is in the source protects nothing.
PII_KEY, TRIAL_KEY = "spark.tallyline.pii.key", "tallyline trial key"


#: Secrets by application, where none is set; not held in a setting, as settings are logged.
_DRAWN: dict[str, bytes] = {}


def drawn_key(application: str) -> bytes:
    """A random secret, the same one throughout an application."""
    if application not in _DRAWN:
        warnings.warn(f"{PII_KEY} isn't set: pseudonyms are made under a random secret of this application, and aren't linked with those of any other", stacklevel=3)
    return _DRAWN.setdefault(application, os.urandom(64))


def pii_key(spark: SparkSession) -> bytes:
    """The session's secret. Where none is set, one is drawn for the application; on one machine the trial key stands in for it."""
    if key := spark.conf.get(PII_KEY, None):
        return key.encode()
    context = spark.sparkContext
    return TRIAL_KEY.encode() if context.master.startswith("local") else drawn_key(context.applicationId)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(quality.statistics(table(spark, sf_dir, "documents")))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents")).drop("source")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii_key(spark))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = classifier.score(docs, classifier.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", classifier.not_learned().alias("held_out"), "score", "predicted")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_quality, op3_decontamination, op4_near_duplicates, op5_token_counts, op6_toxicity, op7_packing, op8_language, op9_sharding, op10_pii, op11_spelling_variants, op12_quality_classifier, op13_lexical_search)}
#: The rest can't be said in SQL: learned models, sketches, the library's tokenizer, crc32, packing and keyed permutations. They are tested against brute force.
ORACLE: dict[str, str] = {
    "op4_near_duplicates": r"""with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, case when len(w) < 2 then w else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s from w),
e as (select doc_id, len(s) as n, unnest(s) as t from s),
p as (select a.doc_id as a, b.doc_id as b, a.n as n, b.n as m from e a join e b on a.t = b.t and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
l as (select a, b from p group by a, b, n, m having 100 * count(*) >= 80 * (n + m - count(*))),
r(a, b) as (select a, b from l union select r.a, l.b from r join l on l.a = r.b)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) as component_id, s.doc_id = least(s.doc_id, coalesce(min(r.b), s.doc_id)) as kept from s left join r on r.a = s.doc_id group by s.doc_id, s.s""",
    "op13_lexical_search": r"""with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents),
s as (select count(*) as n, cast(sum(len(t)) as bigint) as l from d where len(t) > 0),
q as (select item_id, term, count(*) as k from (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) group by all),
p as (select doc_id, len(t) as len, unnest(t) as term from d), f as (select doc_id, len, term, count(*) as tf from p where term in (select term from q) group by all),
w as (select term, cast(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) as bigint) as w from f, s group by term, n),
x as (select item_id, doc_id, cast(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * len * n) // l))))) as bigint) as score from q join f using (term) join w using (term), s group by all)
select item_id, cast(rank as integer) as rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from x where score > 0) where rank <= 10""",
}
