"""Ranked lexical search: windowed bucket scoring.

Documents become postings of the query terms. A task takes its postings in windows of document ids: for
each item it goes through the postings of the item's terms, adds each one's share to an array that has a
place for every document of the window and fits the cache, and sets the document's bit; then the documents
whose bits are set are harvested into the item's heap. Postings stay where they were made: only each
task's best documents are shuffled, so neither frequent terms nor hot windows gather anywhere.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, slices, smaller_batches

#: Document ids of a window, and documents at most; an array of them, 8 bytes each, fits a core's cache.
WINDOW = 16_384
#: Terms of the items, repeats included, that are searched for at once; more items are taken in blocks.
BLOCK_TERMS = 1_000_000
#: From so many postings on a term's bits are set as a whole bitmap.
DENSE = WINDOW // 64
TOP = 10

#: Terms are what is left between all ASCII characters but letters and digits; A-Z are lower-cased.
_PLAIN = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order; none for null."""
    return text.translate(_PLAIN).split() if text else []


def item_terms(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """item_id and terms (array) of each item."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([terms(t) for t in part.column(1).to_pylist()], pa.list_(pa.binary()))], names=["item_id", "terms"])

    once = items.where(F.col(item_id).isNotNull()).groupBy(F.col(item_id).cast("long").alias("item_id")).agg(F.min(text).cast("binary").alias("t"))
    return once.mapInArrow(run, "item_id long, terms array<binary>")


def index(docs: DataFrame, vocabulary: list[bytes], text: str, doc_id: str) -> DataFrame:
    """doc_id, n (terms, with repeats), terms (numbers of those in the vocabulary) and tfs, for each document with a term."""
    smaller_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        number = {t: i for i, t in enumerate(sent.value)}
        for batch in batches:
            for part in slices(batch, 1):
                kept, sizes, found = [], [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    words = terms(t)
                    if words:
                        seen = Counter(map(number.get, words))
                        seen.pop(None, None)
                        kept.append(i)
                        sizes.append(len(words))
                        found.append(seen)
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                flat = lambda values, kind: pa.ListArray.from_arrays(ends, pa.array(np.fromiter(itertools.chain.from_iterable(values), np.int32), kind))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()), flat(found, pa.int32()), flat((s.values() for s in found), pa.int32())], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t")).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def weights(df: np.ndarray, n: int) -> np.ndarray:
    """Of each term, from the documents that hold it and those with a term at all."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for k in df.tolist()], np.int64)


class Best:
    """The `top` best documents of an item; equal scores by ascending id, those without an id last."""

    def __init__(self, top: int):
        self.top, self.heap = top, []

    def take(self, ids: list, scores: np.ndarray, places: np.ndarray) -> None:
        """Documents of a window: the scores of those at the places, in the order of their ids."""
        if len(self.heap) == self.top:
            high = scores >= self.heap[0][0]
            scores, places = scores[high], places[high]
        if len(scores) > self.top:
            order = np.argsort(-scores, kind="stable")[: self.top]
            scores, places = scores[order], places[order]
        for s, p in zip(scores.tolist(), places.tolist(), strict=True):
            found = (s, ids[p] is not None, -(ids[p] or 0))
            if len(self.heap) < self.top:
                heapq.heappush(self.heap, found)
            else:
                heapq.heappushpop(self.heap, found)

    def rows(self) -> list[tuple]:
        return [(-minus if named else None, s) for s, named, minus in self.heap]


class Buckets:
    """Scores documents window by window. items: the numbers of each item's terms, with repeats; weight: of each term."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray, n: int, total: int, top: int):
        self.items = [list(zip(*(x.tolist() for x in np.unique(i, return_counts=True)), strict=True)) for i in items]
        self.weight, self.n, self.total = weight, n, max(1, total)
        self.best = [Best(top) for _ in items]
        self.scores, self.bits = np.zeros(WINDOW, np.int64), np.zeros(WINDOW // 8, np.uint8)

    def window(self, ids: list, sizes: np.ndarray, ends: np.ndarray, numbers: np.ndarray, tfs: np.ndarray) -> None:
        """The documents of a window by ascending id, at most WINDOW; the terms of the i-th stand at ends[i] to ends[i + 1]."""
        m = 25 + (75 * sizes * self.n) // self.total
        place = np.repeat(np.arange(len(ids)), np.diff(ends))
        order = np.argsort(numbers, kind="stable")
        number, place, tf = numbers[order], place[order], tfs[order].astype(np.int64)
        share = self.weight[number] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[place]))
        cuts = np.concatenate([[0], np.flatnonzero(number[1:] != number[:-1]) + 1, [len(number)]]) if len(number) else np.zeros(1, np.int64)
        postings = {int(number[a]): self.posting(place[a:b], share[a:b]) for a, b in itertools.pairwise(cuts.tolist())}
        for item, best in zip(self.items, self.best, strict=True):
            held = [(postings[t], k) for t, k in item if t in postings]
            for (at, added, byte, bit), k in held:
                self.scores[at] += added * k
                if byte is None:
                    self.bits |= bit
                else:
                    np.bitwise_or.at(self.bits, byte, bit)
            if held:
                at = np.flatnonzero(np.unpackbits(self.bits))
                found = self.scores[at]
                above = found > 0
                best.take(ids, found[above], at[above])
                self.scores[at], self.bits[:] = 0, 0

    @staticmethod
    def posting(place: np.ndarray, share: np.ndarray) -> tuple:
        """(places, shares, bytes, bits): the bits of the places, as a bitmap without bytes for a frequent term."""
        if len(place) < DENSE:
            return place, share, place >> 3, (128 >> (place & 7)).astype(np.uint8)
        whole = np.zeros(WINDOW, bool)
        whole[place] = True
        return place, share, None, np.packbits(whole)


def windows(batches) -> Iterator[tuple]:
    """The arguments of Buckets.window() for each run of rows of one window; a run of more than WINDOW rows, as of repeated ids, is cut."""

    def joined(parts: list[pa.RecordBatch]) -> tuple:
        table = pa.Table.from_batches(parts).combine_chunks()
        ids, sizes, found, tfs = (table.column(c).combine_chunks() for c in ("doc_id", "n", "terms", "tfs"))
        ends = found.offsets.to_numpy() - found.offsets[0].as_py()
        return ids.to_pylist(), sizes.to_numpy(), ends, found.flatten().to_numpy(zero_copy_only=False), tfs.flatten().to_numpy(zero_copy_only=False)

    held, rows, now = [], 0, None
    for batch in batches:
        w = batch.column("w").to_numpy()
        cuts = [0, *(np.flatnonzero(w[1:] != w[:-1]) + 1).tolist(), len(w)]
        for a, b in itertools.pairwise(cuts):
            while a < b:
                if held and (w[a] != now or rows == WINDOW):
                    yield joined(held)
                    held, rows = [], 0
                now, take = w[a], min(b - a, WINDOW - rows)
                held.append(batch.slice(a, take))
                rows, a = rows + take, a + take
    if held:
        yield joined(held)


def best_of_block(docs: DataFrame, items: list, text: str, doc_id: str, top: int) -> DataFrame:
    """item_id, doc_id, score: each task's best documents of each item; items: rows of item_id and terms."""
    spark: SparkSession = docs.sparkSession
    vocabulary = sorted({bytes(t) for r in items for t in r.terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    made = keep(index(docs, vocabulary, text, doc_id), "postings")
    total = made.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in made.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        df[r.t] = r.df
    sent = spark.sparkContext.broadcast(([r.item_id for r in items], [np.array([number[bytes(t)] for t in r.terms], np.int64) for r in items], weights(df, total.n), total.n, total.l))

    def run(batches):
        names, wanted, weight, n, all_terms = sent.value
        buckets = Buckets(wanted, weight, n, all_terms, top)
        for w in windows(batches):
            buckets.window(*w)
        rows = [(name, *r) for name, b in zip(names, buckets.best, strict=True) for r in b.rows()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["item_id", "doc_id", "score"])

    windowed = made.withColumn("w", F.coalesce(F.floor(F.col("doc_id") / WINDOW), F.lit(-1))).sortWithinPartitions("w", F.asc_nulls_last("doc_id"))
    return windowed.mapInArrow(run, T.StructType([T.StructField(c, T.LongType()) for c in ("item_id", "doc_id", "score")]))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each item, those with a score above 0.

    A null or empty text, or one of separators alone, has no terms: it isn't counted and isn't found; an
    item without terms has no rows, nor have items without an id. Rows that repeat an item's id are one
    item, of the least text. Every row of docs is a document: repeated ones are counted and ranked each,
    those without an id behind all others of their score. Empty tables give no rows. Texts of any length
    are read whole. Items are a stated query set; blocks of them, of bounded size, go to all workers.
    """
    asked = keep(item_terms(items, item_text, item_id), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_TERMS))
    parts = [best_of_block(docs, asked.where(F.pmod(F.xxhash64("item_id", F.lit(31)), F.lit(blocks)) == b).collect(), text, doc_id, top) for b in range(blocks)]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
