"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick some of the tokens in a window and ignore the others, so that a substituted token
hides only the windows in which a mask picks it. Hashes of test and training windows are joined, and
around each hit the passage is verified on all tokens: any stretch of the alignment that is long enough
and alike enough counts, whatever lies beside it.
"""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, keep, list_slices, small, smaller_batches

#: Masks of longer items have this weight and span so many tokens at most. (tokens, unequal ones): whichever tokens of such a passage are unequal, one of the masks misses them all.
WEIGHT, SPAN, LOSSLESS = 5, 11, ((14, 4), (17, 5))
#: Items of up to LONGEST_SHORT tokens have masks of their own. Those with fewer than LEAST_TOKENS must be matched exactly; below LEAST_EXACT an item is too short to tell.
LONGEST_SHORT, LEAST_TOKENS, LEAST_EXACT = 12, 6, 4
#: A stretch must hold so many equal tokens, or LEAST_SHARE of an item's tokens if that is less, at an identity of LEAST_SHARE.
LEAST_EQUAL, LEAST_SHARE = 13, 0.7
#: Pairs of tokens that are held against each other at once.
TILE = 4_000_000
#: Shares of a hot hash, where the join by hash shuffles.
SALTS = 16
#: With up to so many test hashes the training side drops windows without a hit before the join.
FILTER_HASHES = 2_000_000


def least_equal(n: int) -> int:
    """The equal tokens that an item of n tokens asks for."""
    return n if n < LEAST_TOKENS else min(LEAST_EQUAL, math.ceil(round(LEAST_SHARE * n, 9)))


def masks_of(n: int) -> set[str]:
    """Masks for items of n tokens: they are cut into k + 2 blocks, k of their tokens being all that may be unequal, and each mask picks two blocks, so that one of them misses every unequal token."""
    if n < LEAST_TOKENS:
        return {"1" * n}
    blocks = n - least_equal(n) + 2
    at = [round(i * n / blocks) for i in range(blocks + 1)]
    return {"".join("1" if any(at[b] <= i < at[b + 1] for b in pair) else "0" for i in range(n)).strip("0") for pair in itertools.combinations(range(blocks), 2)}


@functools.cache
def long_masks() -> tuple[str, ...]:
    """Masks (tokens at the places of a 1 are hashed) that leave a seed for all of LOSSLESS, and so for all that verification accepts of 13 to 18 tokens: each is the one that finds most of what those before it don't."""
    left = [(n, np.array([sum(1 << i for i in gone) for gone in itertools.combinations(range(n), k)])) for n, k in LOSSLESS]
    shapes = [(span, sum(1 << i for i in (0, *inner, span - 1))) for span in range(WEIGHT, SPAN + 1) for inner in itertools.combinations(range(1, span - 1), WEIGHT - 2)]
    seen_by = lambda shape, n, gone: np.logical_or.reduce([gone & (shape[1] << at) == 0 for at in range(n - shape[0] + 1)])
    out = []
    while any(len(gone) for _, gone in left):
        best = max(shapes, key=lambda s: sum(seen_by(s, n, gone).mean() for n, gone in left if len(gone)))
        out.append("".join(str(best[1] >> i & 1) for i in range(best[0])))
        left = [(n, gone[~seen_by(best, n, gone)]) for n, gone in left]
    return tuple(out)


def masks_for(lengths: list[int]) -> tuple[tuple[str, frozenset[int]], ...]:
    """(mask, the lengths of short items that it is for) with those of longer items first, whose set is empty."""
    short: dict[str, set[int]] = {}
    for n in lengths:
        for m in sorted(masks_of(n)):
            short.setdefault(m, set()).add(n)
    return (*((m, frozenset()) for m in long_masks()), *((m, frozenset(ns)) for m, ns in short.items()))


#: Scripts that put no spaces between words; each of their letters, with its marks, is a token.
UNSPACED = "".join(rf"\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters, marks and digits, in order; none for null. Letters of unspaced scripts are single tokens."""
    low = F.lower(F.coalesce(text, F.lit("")))
    spaced = F.split(low, r"[^\p{L}\p{M}\p{N}]+", -1)
    single = F.regexp_extract_all(low, F.lit(rf"(?=[\p{{L}}\p{{N}}])[{UNSPACED}]\p{{M}}*|[\p{{L}}\p{{M}}\p{{N}}&&[^{UNSPACED}]]+"), F.lit(0))
    # All unspaced scripts lie behind U+0E00, which is told faster than a script.
    without = (F.length(low) == F.octet_length(low)) | ~F.rlike(low, F.lit(r"[\x{0E00}-\x{10FFFF}]")) | ~F.rlike(low, F.lit(f"[{UNSPACED}]"))
    parts = F.when(without, spaced).otherwise(single)
    return F.transform(F.array_remove(parts, ""), lambda w: F.xxhash64(w))


_RANDOM = np.random.default_rng(20250202)
_ODD = _RANDOM.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def seeds(flat: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The hash of the window that begins at each token but the last ones."""
    n = len(flat) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, salt, np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            total += flat[i : i + n] * _ODD[i]
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return total ^ (total >> np.uint64(29))


def item_seeds(items: DataFrame, masks: tuple[tuple[str, frozenset[int]], ...]) -> DataFrame:
    """(seed, item_id, at) for each window of each item under the masks for its length; items: item_id, tokens."""

    def run(batches):
        for batch in batches:
            ids, flat, ends = batch.column(0).to_pylist(), batch.column(1).values.to_numpy(zero_copy_only=False).view(np.uint64), batch.column(1).offsets.to_numpy()
            out = [[], [], []]
            for i, name in enumerate(ids):
                part = flat[ends[i] : ends[i + 1]]
                for k, (mask, lengths) in enumerate(masks):
                    suits = len(part) in lengths if lengths else len(part) > LONGEST_SHORT
                    found = seeds(part if suits else part[:0], mask, k)
                    out[0] += found.view(np.int64).tolist()
                    out[1] += [name] * len(found)
                    out[2] += range(len(found))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["seed", "item_id", "at"])

    return items.select("item_id", "tokens").mapInArrow(run, "seed long, item_id long, at long")


def training_hits(docs: DataFrame, masks: tuple[str, ...], wanted: np.ndarray | None) -> DataFrame:
    """(doc_id, tokens, seed, at) of the documents with a window whose hash is wanted: the hashes found, each once, and for each the places of its windows. wanted: sorted, None for all."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("tokens", longs), T.StructField("seed", longs), T.StructField("at", T.ArrayType(longs))])

    def run(batches):
        known = sent.value
        if known is not None:
            near = np.zeros(1 << 22, bool)
            near[(known >> np.uint64(42)).astype(np.intp)] = True
        for batch in (part for whole in batches for part in list_slices(whole, 1)):
            ids, flat, ends = batch.column(0).to_pylist(), batch.column(1).values.to_numpy(zero_copy_only=False).view(np.uint64), batch.column(1).offsets.to_numpy()
            out = [[], [], [], []]
            # Windows of the whole slice at once; those that run over a text's end are left out below.
            row = np.repeat(np.arange(len(ids)), np.diff(ends))
            base = flat[ends[0] : ends[-1]]
            found = []
            for k, mask in enumerate(masks):
                hashes = seeds(base, mask, k)
                at = np.arange(len(hashes)) if known is None else np.flatnonzero(near[(hashes >> np.uint64(42)).astype(np.intp)])
                if known is not None and len(known):
                    at = at[known[np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)] == hashes[at]]
                at = at[row[at] == row[at + len(mask) - 1]] if len(at) else at
                found.append((row[at], at, hashes[at]))
            rows, at, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((at, hashes, rows))
            rows, at, hashes = rows[order], at[order], hashes[order]
            for lo, hi in runs(rows):
                i = rows[lo]
                cuts = runs(hashes[lo:hi])
                out[0].append(ids[i])
                out[1].append(flat[ends[i] : ends[i + 1]].view(np.int64))
                out[2].append(hashes[lo:hi][[a for a, _ in cuts]].view(np.int64))
                out[3].append([at[lo + a : lo + b] - (ends[i] - ends[0]) for a, b in cuts])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *(pa.array(c, pa.list_(pa.int64())) for c in out[1:3]), pa.array(out[3], pa.list_(pa.list_(pa.int64())))], names=schema.names)

    smaller_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of each run of equal values."""
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return [(a, b) for a, b in itertools.pairwise(cuts) if a < b]


def stretch(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(start, end, equal tokens) of the stretch of two aligned runs of tokens with the most equal tokens at an identity of LEAST_SHARE, the first of several; (0, 0, 0) if nothing is equal.

    Such a stretch begins and ends with an equal token. From the i-th to the j-th one (at p[i] and p[j])
    it holds j - i + 1 equal of p[j] - p[i] + 1 tokens, so the identity holds if g[i] <= f[j] below.
    """
    p = np.flatnonzero(a == b)
    if not len(p):
        return 0, 0, 0
    share = round(LEAST_SHARE * 1000)
    n = np.arange(len(p))
    g, f = 1000 * n - share * p, 1000 * (n + 1) - share * (p + 1)
    # The first i with g[i] <= f[j] is where the running minimum of g falls to f[j]; i = j is always one.
    first = np.searchsorted(-np.minimum.accumulate(g), -f, "left")
    j = int((n - first).argmax())
    i = int(first[j])
    return int(p[i]), int(p[j]) + 1, j - i + 1


def equal_tokens(doc: np.ndarray, item: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """On each diagonal the equal tokens in all, TILE items at once."""
    n = len(item)
    # What lies beyond the text's ends equals nothing.
    other = next(x for x in range(n + 1) if x not in item)
    around = np.full(n, other, doc.dtype)
    seen = np.lib.stride_tricks.sliding_window_view(np.concatenate([around, doc, around]), n)
    step = max(1, TILE // max(1, n))
    return np.concatenate([np.zeros(0, np.int64), *((seen[diagonals[i : i + step] + n] == item).sum(axis=1) for i in range(0, len(diagonals), step))])


def best_passage(doc: np.ndarray, item: np.ndarray, diagonals: np.ndarray) -> tuple[int, int, int, float] | None:
    """(first, end, equal tokens, identity) of the passage with the most equal tokens, then the highest identity, then the furthest place; None if none holds.

    Diagonals are taken by falling number of equal tokens, which a passage can't exceed, until none can be better.
    """
    best = None
    total = equal_tokens(doc, item, diagonals)
    enough = total >= least_equal(len(item))
    diagonals, total = diagonals[enough], total[enough]
    order = np.lexsort((-diagonals, -total))
    for shift, most in zip(diagonals[order].tolist(), total[order].tolist(), strict=True):
        if best and (most < best[0] or best[0] == len(item)):
            break
        lo, hi = max(0, shift), min(len(doc), shift + len(item))
        start, end, equal = stretch(doc[lo:hi], item[lo - shift : hi - shift])
        if equal and equal >= least_equal(len(item)):
            held = (equal, equal / (end - start), lo + start, lo + end)
            best = held if best is None or held > best else best
    return best and (best[2], best[3], best[0], best[1])


def diagonals_of(doc_at: np.ndarray, item_at: np.ndarray) -> np.ndarray:
    """The different shifts of an item that bring some place in it to one in the text, TILE pairs at once."""
    step = max(1, TILE // max(1, len(item_at)))
    return np.unique(np.concatenate([np.unique(doc_at[i : i + step, None] - item_at) for i in range(0, len(doc_at), step)]))


def verified(pairs: DataFrame) -> DataFrame:
    """(doc_id, item_id, hits, tokens, item) -> the best passage of each pair that holds; hits: array of (doc_at, item_at), the places of one hash in both."""
    names = ["doc_id", "item_id", "first_token", "end_token", "n_equal", "identity"]

    def numbers(column: pa.ListArray) -> list[np.ndarray]:
        flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        return [flat[a:b] for a, b in itertools.pairwise(ends)]

    def run(batches):
        for batch in batches:
            out = [[] for _ in names]
            ids, items, hits, docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), *(numbers(batch.column(i)) for i in (3, 4))
            for i in range(batch.num_rows):
                found = [diagonals_of(h["doc_at"].values.to_numpy(), h["item_at"].values.to_numpy()) for h in hits[i]]
                if held := best_passage(docs[i], texts[i], np.unique(np.concatenate(found))):
                    for c, v in zip(out, (ids[i], items[i], *held), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if n == "identity" else pa.int64()) for n, c in zip(names, out, strict=True)], names=names)

    return pairs.mapInArrow(run, "doc_id long, item_id long, first_token long, end_token long, n_equal long, identity double")


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id and the best passage (first_token, end_token, n_equal, identity) for each document and item that overlap.

    Null or empty texts and items, and items of fewer than LEAST_EXACT tokens, overlap with nothing;
    items of fewer than LEAST_TOKENS do with exact copies only. Rows without an id are left out, as they
    can't be named. Items with the same tokens are one item, with the least id. Repeated rows give one
    result; of passages with as many equal tokens and the same identity the last one is given. An empty
    table gives an empty result. Texts of any length are read whole; a text and an item meet once, with
    all their hits, so that repeated tokens don't multiply rows.
    """
    items = benchmark.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), tokens(F.col(item_text)).alias("tokens"))
    items = keep(items.where(F.size("tokens") >= LEAST_EXACT).groupBy("tokens").agg(F.min("item_id").alias("item_id")), "items")
    short = [r.n for r in items.select(F.size("tokens").alias("n")).where(F.col("n") <= LONGEST_SHORT).distinct().collect()]
    used = masks_for(sorted(short))
    places = keep(item_seeds(items, used), "seeds")
    n = places.count()
    wanted = np.unique(places.select("seed").distinct().toArrow().column("seed").to_numpy().view(np.uint64)) if n <= FILTER_HASHES else None
    tested = places.groupBy("seed", "item_id").agg(F.collect_list("at").alias("item_at"))

    train = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), tokens(F.col(text)).alias("tokens"))
    hit = keep(training_hits(train, tuple(m for m, _ in used), wanted), "hits")
    once = hit.dropDuplicates(["doc_id"])
    found = once.select("doc_id", F.explode(F.arrays_zip("seed", "at")).alias("w")).select("doc_id", F.col("w.seed").alias("seed"), F.col("w.at").alias("doc_at"))
    if n <= BROADCAST_ROWS:
        met = found.join(small(tested, n), "seed")
    else:
        # A passage that many documents share is one hash: it is dealt out in shares.
        salted = tested.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["seed", "_salt"])
    pairs = met.groupBy("doc_id", "item_id").agg(F.collect_list(F.struct("doc_at", "item_at")).alias("hits"))
    whole = pairs.join(once.select("doc_id", "tokens"), "doc_id").join(small(items.withColumnRenamed("tokens", "item"), n), "item_id")
    return verified(whole.select("doc_id", "item_id", "hits", "tokens", "item"))
