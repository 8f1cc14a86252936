"""Language identification: multinomial naive Bayes over hashed character n-grams.

The log-probability matrix (buckets x languages) goes to every worker; texts are scored in numpy by
gathering and summing the rows of their n-grams.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, map_text, slices

#: Buckets that n-grams of 1 to 3 characters are hashed to; added to each count; characters scored at once.
BUCKETS, SMOOTHING, CHUNK = 1 << 15, 0.5, 1 << 18
#: Labelled documents that the model is fitted on, about.
SAMPLE_DOCS = 8_000
UNKNOWN = "und"

# Candidates of letters; digits and numerals of other kinds, such as superscripts and fractions, are among them.
_WORDY = re.compile(r"[^\W\d_]+").finditer


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for m in _WORDY(text or "") for c in m[0])


def _table() -> np.ndarray:
    """Code point -> itself for letters, else a space."""
    points = np.arange(0x110000, dtype=np.uint32)
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letter, points, np.uint32(32))


def buckets(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point but the last two, the buckets of the n-grams of 1, 2 and 3 characters that begin there."""
    one = codes[:-2] * np.uint32(0x9E3779B1)
    two = (one ^ codes[1:-1]) * np.uint32(0x85EBCA6B)
    three = (two ^ codes[2:]) * np.uint32(0xC2B2AE35)
    return tuple((h >> np.uint32(17)).astype(np.intp) for h in (one, two, three))


def joined(texts: list, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, each with a space before and two behind, and where each begins."""
    low = [f" {(t or '').lower()}  " for t in texts]
    codes = table[np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)]
    return codes, np.cumsum([0, *map(len, low[:-1])])


def train(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """The languages, sorted, and the log-probability matrix with the log prior in its last row.

    Learns from about sample_docs documents that have a text and a language and aren't held out. What
    reaches the driver has at most BUCKETS counts a language.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(doc_id))
    share = max(1, usable.count() // sample_docs)
    sample = usable.where(F.pmod(F.xxhash64(doc_id, F.lit(5)), F.lit(share)) == 0).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def counts(batches):
        table, seen, docs_of = _table(), {}, {}
        for batch in batches:
            for part in slices(batch, 1):
                for name, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    docs_of[name] = docs_of.get(name, 0) + 1
                    row = seen.setdefault(name, np.zeros(BUCKETS, np.int64))
                    codes, _ = joined([t], table)
                    for at in range(0, len(codes) - 2, CHUNK):
                        row += np.bincount(np.concatenate(buckets(codes[at : at + CHUNK + 2])), minlength=BUCKETS)
        for name, row in seen.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * (len(at) + 1), pa.string()), pa.array([*at, -1], pa.int32()), pa.array([*row[at], docs_of[name]], pa.int64())], names=["lang", "bucket", "n"])

    table = sample.mapInArrow(counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    seen = np.zeros((BUCKETS + 1, len(names)))
    where = {n: i for i, n in enumerate(names)}
    seen[table.column("bucket").to_numpy(), [where[n] for n in table.column("lang").to_pylist()]] = table.column("n").to_numpy()
    grams, prior = seen[:-1] + SMOOTHING, seen[-1:]
    return names, np.log(np.vstack([grams / grams.sum(axis=0), prior / max(1.0, prior.sum())]) + 1e-300).astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """doc_id, lang_pred and score, the posterior probability of that language.

    `und` with score 0 for a null or empty text, one without a letter, or if there was nothing to learn
    from. Between languages with equal posteriors the first by name is taken. Each row, repeated ones
    and those without an id too, is taken by itself; an empty table gives an empty result. Texts of any
    length are scored whole, CHUNK characters at once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or train(docs, lang, text, doc_id))

    def make():
        names, matrix = sent.value
        table, by_lang = _table(), np.ascontiguousarray(matrix[:-1].T)

        def f(texts):
            if not names:
                return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
            codes, starts = joined(texts, table)
            total = np.tile(matrix[-1].astype(np.float64), (len(texts), 1))
            for at in range(0, len(codes) - 2, CHUNK):
                one, two, three = buckets(codes[at : at + CHUNK + 2])
                # The texts that this chunk touches, and where in it each begins.
                lo, hi = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + len(one), "left")
                cuts = np.maximum(starts[lo:hi] - at, 0)
                for j, row in enumerate(by_lang):
                    value = row.take(one, mode="clip") + row.take(two, mode="clip") + row.take(three, mode="clip")
                    total[lo:hi, j] += np.add.reduceat(value, cuts, dtype=np.float64)
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            best, known = total.argmax(axis=1), [has_letter(t) for t in texts]
            share = odds.max(axis=1) / odds.sum(axis=1)
            return [[names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], [float(s) if k else 0.0 for s, k in zip(share, known, strict=True)]]

        return f

    return map_text(docs, make, [("lang_pred", T.StringType()), ("score", T.DoubleType())], text, (doc_id,))
