"""Quality rules by weak supervision: rules vote or abstain, and a label model weighs the votes.

Every rule turns text statistics into a vote: good (1), bad (-1) or abstain (0). Expectation
maximisation over the counted vote patterns estimates how accurate each rule is, without labels; a
document is kept if it is more probably good than bad, so that one bad vote of a weak rule can be
outweighed. Each kind of bad text is looked at by two or three rules, as two classes are told apart by
votes that go together. Statistics, votes and posteriors are SQL expressions; the driver sees only the
counts of distinct vote patterns, of which there are at most 3 ** len(RULES).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, let, words

#: Fixed values of the base rule and of the statistics.
SYMBOLS, WINDOW, LEAST_WORDS, MOST_REPEAT_PERCENT = "#*$%&|<>", 8, 20, 30
#: Least posterior of a document that is kept.
KEEP = 0.5
#: What is assumed before any document is seen: P(good), and for every rule that votes P(bad vote | good) and P(bad vote | bad).
PRIOR, GOOD, BAD = 0.85, 0.02, 0.40
#: That assumption counts as so many documents; with many more the estimates are the documents' own.
PRIOR_DOCS = 5.0
#: Rounds of expectation maximisation at most, and the change at which it ends.
ROUNDS, SETTLED = 1_000, 1e-9


def repeated_words(h: Column) -> Column:
    """Words that lie in a window of 8 words found twice or more, the first one included; h: the words' hashes in order."""
    window = WINDOW

    def covered(h: Column) -> Column:
        # Windows in order of their hash; those with an equal neighbour are the repeated ones.
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda z: F.transform(F.filter(z, lambda x, k: F.coalesce(F.get(z, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(z, k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))
        spans = let(F.sort_array(starts), lambda p: F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(window)), F.lit(window))))
        return F.aggregate(spans, F.lit(0), lambda a, x: a + x)

    def doubled(h: Column, step: int) -> Column:
        return let(h, lambda x: F.zip_with(x, F.slice(x, step + 1, F.size(x)), lambda a, b: F.xxhash64(a, b)))

    def of(h: Column) -> Column:
        # Hashes of 1, 2, 4 and then 8 words; the last of an array have no partner and are cut off.
        hashes = let(doubled(doubled(doubled(h, 1), 2), 4), lambda x: F.slice(x, 1, F.size(x) - (window - 1)))
        return let(hashes, lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), 0).otherwise(covered(x)))

    return let(h, lambda x: F.when(F.size(x) < window, 0).otherwise(of(x))).cast("long")


def found(text: Column, chars: str) -> Column:
    """How many characters of the text are among chars."""
    some = "".join(rf"\{c}" if not c.isalnum() else c for c in chars)
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{some}]+", ""))).cast("long")


def statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document with the counts that rules read.

    A null or empty text has no words and counts of 0. Each row, repeated ones and those without an id too,
    is counted by itself; an empty table gives an empty result. Texts of any length are counted whole.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    # Lines with a word keep their place in front; a line without one is dropped.
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.select(F.col(doc_id), t.alias("_t"), words(t).alias("_w"), lines.alias("_l"))
        .withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
        .select(
            doc_id,
            F.size("_w").cast("long").alias("n_words"),
            F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
            found(F.col("_t"), SYMBOLS).alias("n_symbols"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            repeated_words(F.col("_h")).alias("n_repeat_words"),
            F.size(F.array_distinct("_h")).cast("long").alias("n_distinct"),
            found(F.col("_t"), ".?").alias("n_ends"),
            found(F.col("_t"), "!").alias("n_exclaims"),
            # What is left without letters and white space are the other characters of words.
            (F.length(F.array_join("_w", "")) - F.length(F.regexp_replace("_t", r"[\p{L}\x20\x09-\x0D]+", ""))).cast("long").alias("n_letters"),
            F.length(F.regexp_replace("_t", r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
            F.size(F.filter("_w", lambda x: F.length(x) == 1)).cast("long").alias("n_single"),
            F.size(F.filter("_w", lambda x: x.rlike(r"\p{L}"))).cast("long").alias("n_lettered"),
            found(F.col("_t"), "0123456789").alias("n_digits"),
            F.size("_l").cast("long").alias("n_lines"),
        )
    )


@dataclass(frozen=True)
class Rule:
    """Votes bad where `bad` holds, else good where `good` holds, else abstains; SQL over the statistics."""

    name: str
    bad: str
    good: str = "false"


RULES = (
    Rule("length", "n_words < 20", "n_words >= 50"),
    Rule("symbols", "n_symbols > 0.10 * n_words", "n_symbols < 0.02 * n_words"),
    Rule("letters", "n_letters < 0.88 * word_chars", "n_letters > 0.92 * word_chars"),
    Rule("lettered_words", "n_lettered < 0.80 * n_words", "n_lettered > 0.95 * n_words"),
    Rule("single_characters", "n_single > 0.30 * n_words", "n_single < 0.15 * n_words"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 6.8 * n_words", "word_chars > 3 * n_words and word_chars < 6.5 * n_words"),
    Rule("capitals", "n_capitals > 0.30 * n_letters", "n_capitals < 0.10 * n_letters"),
    Rule("exclaims", "n_exclaims > 0.10 * n_words", "n_exclaims < 0.02 * n_words"),
    Rule("variety", "n_words >= 30 and n_distinct < 0.25 * least(n_words, 400)", "n_words >= 30 and n_distinct > 0.40 * least(n_words, 400)"),
    Rule("repeats", "n_repeat_words > 0.30 * n_words", "n_words >= 30 and n_repeat_words < 0.10 * n_words"),
    Rule("duplicate_lines", "n_dup_lines > 0.30 * n_lines", "n_lines >= 4 and n_dup_lines = 0"),
    Rule("sentences", "n_words >= 60 and n_ends * 60 < n_words", "n_words >= 60 and n_ends * 25 >= n_words"),
    Rule("digits", "n_digits > 0.25 * word_chars", "n_digits < 0.05 * word_chars"),
)


@dataclass(frozen=True)
class LabelModel:
    """P(good), and for each rule P(bad vote | good) and P(bad vote | bad) where it votes. Abstaining says nothing: rules abstain on what they can't judge, mostly short texts."""

    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def accuracies(self) -> tuple[float, ...]:
        """For each rule the share of its votes that are right."""
        return tuple(self.prior * (1 - g) + (1 - self.prior) * b for g, b in zip(self.good, self.bad, strict=True))

    def log_odds(self, names: list[str]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, g, b in zip(names, self.good, self.bad, strict=True):
            total = total + F.when(F.col(name) < 0, math.log(g / b)).when(F.col(name) > 0, math.log((1 - g) / (1 - b))).otherwise(0.0)
        return total


def fit(patterns: list[tuple[tuple[int, ...], int]], rules: int, prior: float = PRIOR) -> LabelModel:
    """Expectation maximisation over (votes, count) patterns; without patterns the assumption stays.

    It begins with every rule being trusted alike, that is from how far the rules agree, and estimates
    P(good) and how often each rule votes bad in either class, the assumption counting as PRIOR_DOCS
    documents. The class with the fewer bad votes is the good one.
    """
    good, bad = np.full(rules, GOOD), np.full(rules, BAD)
    if patterns:
        votes, n = np.array([v for v, _ in patterns]), np.array([c for _, c in patterns], float)
        no, yes = (votes < 0).astype(float), (votes > 0).astype(float)
        first, last = prior, None
        for _ in range(ROUNDS):
            odds = np.log(prior / (1 - prior)) + no @ np.log(good / bad) + yes @ np.log((1 - good) / (1 - bad))
            p = n / (1 + np.exp(-np.clip(odds, -500, 500)))
            prior = (p.sum() + PRIOR_DOCS * first) / (n.sum() + PRIOR_DOCS)
            good, bad = ((m @ no + PRIOR_DOCS * start) / (m @ (no + yes) + PRIOR_DOCS) for m, start in ((p, GOOD), (n - p, BAD)))
            now = np.concatenate([[prior], good, bad])
            if last is not None and np.abs(now - last).max() < SETTLED:
                break
            last = now
        if good.sum() > bad.sum():
            prior, good, bad = 1 - prior, bad, good
    return LabelModel(float(prior), tuple(good.tolist()), tuple(bad.tolist()))


def votes(stats: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    return stats.withColumns({f"vote_{r.name}": F.when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0) for r in rules})


def score(stats: DataFrame, rules: tuple[Rule, ...] = RULES, least: float = KEEP) -> DataFrame:
    """The statistics with votes, p_good, base_failed and kept.

    stats, a few numbers per document, is written to the shared folder first, as it is read for the
    patterns and for the result. Documents with the same votes get the same posterior; an empty table
    gives an empty result.
    """
    voted = votes(keep(stats, "quality"), rules)
    names = [f"vote_{r.name}" for r in rules]
    seen = [(tuple(r[:-1]), r[-1]) for r in voted.groupBy(*names).count().collect()]
    odds = fit(seen, len(rules)).log_odds(names)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    return voted.withColumn("p_good", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
