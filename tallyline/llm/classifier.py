"""Quality classifier: histogram gradient-boosted trees over document statistics.

Characters are told into a few classes by a table, and a batch of texts is counted in numpy; words and
lines are counted with the sets of a text. Trees are grown on binned statistics of a bounded sample of
labelled documents: for every node a histogram of gradients over the bins of each statistic, the split with
the largest gain. All trees have the same depth and are flattened into arrays of features, thresholds and
leaf values, so that a batch goes down a tree by one step of index arithmetic a level.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from operator import eq
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, map_text, small

#: Labelled documents that the trees are fitted on, about.
SAMPLE_DOCS = 20_000
#: Trees, their depth, bins of a statistic, the share of a tree's step that is taken, the penalty on leaf values and the least weight of a leaf.
TREES, DEPTH, BINS, RATE, PENALTY, LEAST_WEIGHT = 60, 3, 64, 0.2, 1.0, 2.0
THRESHOLD = 0.3

LETTER, CAPITAL, DIGIT, BLANK, NEWLINE, STOP, EXCLAIM, PAUSE, OTHER = range(9)
KINDS = 9
STATISTICS = (
    "chars", "words", "lines", "letters", "capitals", "digits", "blanks", "newlines", "stops", "exclaims", "pauses", "others", "word_length", "word_length_deviation", "single_characters",
    "longest_word", "distinct_words", "distinct_pairs", "repeated_next", "most_frequent_word", "repeated_lines", "line_words",
)


def not_learned(doc_id: str = "doc_id") -> Column:
    """Rows that the model may not learn from: crc32 of the id as text divides by 5. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


@functools.cache
def kind_table() -> np.ndarray:
    """Code point -> class of characters."""
    points = np.full(0x110000, OTHER, np.uint8)
    for c in map(chr, range(0x110000)):
        if c.isalpha():
            points[ord(c)] = CAPITAL if c.isupper() else LETTER
        elif c.isspace():
            points[ord(c)] = BLANK
        elif c.isdigit():
            points[ord(c)] = DIGIT
        elif unicodedata.category(c) in ("Mn", "Mc"):
            points[ord(c)] = LETTER
    for kind, some in ((NEWLINE, "\n"), (STOP, ".?…。？؟।"), (EXCLAIM, "!！¡"), (PAUSE, ",;:'\"()-–—’‘“”«»、，：；")):
        points[[ord(c) for c in some]] = kind
    return points


def statistics(texts: list) -> np.ndarray:
    """A row of STATISTICS for each text; a null one counts as empty. Counts are logarithms, the rest shares of characters, words or lines, so that long and short texts are alike."""
    texts = [t or "" for t in texts]
    if not texts:
        return np.zeros((0, len(STATISTICS)))
    lengths = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)) * KINDS, lengths)
    kinds = np.bincount(row + kind_table()[codes], minlength=KINDS * len(texts)).reshape(-1, KINDS)
    out = np.zeros((len(texts), len(STATISTICS)))
    out[:, 0] = np.log1p(lengths)
    out[:, 3:12] = kinds / np.maximum(1, lengths)[:, None]
    for i, t in enumerate(texts):
        w, lines = t.split(), [x for x in t.split("\n") if x and not x.isspace()]
        if not w:
            continue
        n, size = len(w), np.fromiter(map(len, w), np.int64, len(w))
        out[i, 1:3] = np.log1p(n), np.log1p(len(lines))
        out[i, 12:] = (
            size.mean(), size.std(), (size == 1).sum() / n, np.log1p(size.max()), len(set(w)) / min(n, 400), len(set(zip(w, w[1:], strict=False))) / n, sum(map(eq, w, w[1:])) / n, max(Counter(w).values()) / n,
            1 - len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
        )
    return out


class Model(NamedTuple):
    """bias, and for each tree its split features and thresholds in the order of a heap, then its leaves' values."""

    bias: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Of each row of statistics: all rows go down one tree at once, a level at a time. To the right goes what is larger than the threshold."""
        total, rows = np.full(len(x), self.bias), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - len(feature)]
        return total


def probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def bins_of(x: np.ndarray, most: int = BINS) -> list[np.ndarray]:
    """For each statistic the thresholds between its bins: quantiles of its different values."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > most:
            values = np.unique(np.quantile(column, np.arange(1, most + 1) / most, method="lower"))
        # Between two neighbours, so that a value near one isn't on its other side by rounding.
        out.append((values[1:] + values[:-1]) / 2)
    return out


def best_splits(binned: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node the statistic, the bin that is the last to the left, and the gain, from the histograms of gradients; no gain where no split leaves LEAST_WEIGHT on both sides."""
    feature, at, gain = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64), np.zeros(nodes)
    for f, cut in enumerate(cuts):
        if not len(cut):
            continue
        place, width = node * (len(cut) + 1) + binned[:, f], len(cut) + 1
        left_g, left_h = (np.bincount(place, x, nodes * width).reshape(nodes, width).cumsum(axis=1) for x in (g, h))
        all_g, all_h = left_g[:, -1:], left_h[:, -1:]
        score = lambda a, b: a**2 / (b + PENALTY)
        found = score(left_g, left_h) + score(all_g - left_g, all_h - left_h) - score(all_g, all_h)
        found = np.where((left_h >= LEAST_WEIGHT) & (all_h - left_h >= LEAST_WEIGHT), found, 0)[:, :-1]
        best = found.argmax(axis=1)
        better = found[np.arange(nodes), best] > gain + 1e-12
        feature[better], at[better], gain[better] = f, best[better], found[np.arange(nodes), best][better]
    return feature, at, gain


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Model:
    """Boosting of logistic loss. Without rows the score is 1/2, with one label only it is near that label. A node without a split sends all its rows to the left."""
    bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    cuts = bins_of(x) if len(x) else []
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1) if len(x) else np.zeros((0, 0), np.int64)
    odds, inner = np.full(len(y), bias), 2**depth - 1
    made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = probability(odds)
        g, h, node = y - p, np.maximum(p * (1 - p), 1e-12), np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            f, at, gain = best_splits(binned, node - first, nodes, g, h, cuts)
            for k in np.flatnonzero(gain > 0):
                feature[first + k], threshold[first + k] = f[k], cuts[f[k]][at[k]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        leaf = node - inner
        value = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + PENALTY)
        odds = odds + value[leaf]
        made.append((feature, threshold, value))
    arrays = [np.stack(a) for a in zip(*made, strict=True)] if made else [np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1))]
    return Model(bias, *arrays)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learns from about sample_docs labelled documents that aren't held out; the driver gets a row of statistics for each. Of several labels of one document the highest counts, of several rows of one id the largest statistics."""
    usable = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~not_learned(doc_id)).groupBy(F.col(doc_id).alias("doc_id")).agg((F.max(label) > 0).cast("long").alias("label"))
    share = max(1, usable.count() // sample_docs)
    chosen = keep(usable.where(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(share)) == 0), "labelled")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(small(chosen, chosen.count()), "doc_id")
    counted = map_text(rows, lambda: lambda texts: list(statistics(texts).T) if texts else [[] for _ in STATISTICS], [(s, T.DoubleType()) for s in STATISTICS], "text", ("doc_id", "label"))
    found = counted.groupBy("doc_id").agg(F.max(F.struct("label", *STATISTICS)).alias("s")).select("doc_id", "s.*").toArrow().sort_by("doc_id")
    x = np.stack([found.column(s).to_numpy() for s in STATISTICS], axis=1)
    return fit(x, found.column("label").to_numpy().astype(float))


def score(docs: DataFrame, model: Model, text: str = "text", carry: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """The carried columns, score (0 to 1) and predicted (1 if score >= threshold).

    A null text is scored as an empty one, which has statistics of 0. Each row, repeated ones and those
    without an id too, stands for itself; an empty table gives an empty result. Texts of any length are
    counted whole; columns that aren't carried don't reach the workers.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def make():
        trees = Model(*sent.value)
        return lambda texts: [probability(trees.log_odds(statistics(texts)))]

    scored = map_text(docs, make, [("_score", T.DoubleType())], text, carry)
    return scored.select(*carry, F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))
