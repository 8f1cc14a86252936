"""MinHash near-dedup with odd sketches.

1. Every text becomes the set of its word pairs, as 64-bit hashes; equal sets form a class, and only
   one document of each class goes on.
2. HASHES MinHash values per set are banded. Folded into a parity bitmap (the odd sketch), they also
   tell from the population count of two sketches' XOR how many of the values differ.
3. In each band bucket all members are held against a leader, the pairs that sketches don't rule out
   are confirmed on the full sets, and linked members join its component. Buckets that still hold
   several components get other leaders, one for each band; what is left after these rounds is held
   against each other in tiles of bounded size. So a group of thousands of near copies costs a
   multiple of its size, and no link between components goes untested.
4. The confirmed links' components are the groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, keep, let, list_slices, looked_up, small, smaller_batches, words
from .components import components

#: 32 bands of 4: a pair of similarity 0.8 shares no band once in 20 million times.
HASHES, BAND = 128, 4
#: Bits of the odd sketch, and the most that may differ. At similarity 0.8 about 46 do, with a deviation of about 8.
SKETCH_WORDS, MOST_BITS = 8, 92
LEADER_ROUNDS = 2
#: Members of a tile's side, about.
TILE = 512
#: Rows of one task's share of a leader's pairs.
LEADER_SHARE = 500
PERCENT = 80
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SKETCH = [f"k{i}" for i in range(SKETCH_WORDS)]


def shingles(text: Column, n: int = 2) -> Column:
    """Hashes of a text's n-word shingles, in order, with repeats; a shorter text with words is one shingle."""

    def of(h: Column) -> Column:
        out = h
        for _ in range(n - 1):
            out = let(out, lambda x: F.zip_with(x, F.slice(h, F.size(h) - F.size(x) + 2, F.size(x)), lambda a, b: F.xxhash64(a, b)))
            out = let(out, lambda x: F.slice(x, 1, F.size(x) - 1))
        return F.when(F.size(h) >= n, out).when(F.size(h) > 0, F.array(F.xxhash64(h, F.lit(n)))).otherwise(F.array().cast("array<long>"))

    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return let(F.transform(words(low), lambda w: F.xxhash64(w)), of)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_RANDOM = np.random.default_rng(20250101)
_A = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_SALT = _RANDOM.integers(0, 1 << 63, (2, HASHES), dtype=np.uint64)


def minhash(distinct: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(distinct), 4096):
        part = distinct[at : at + 4096]
        np.minimum(least, (part[None, :] * _A[:, None] + _B[:, None]).min(axis=1), out=least)
    return least


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, set_key (two hashes of the whole set), bands and the words of the odd sketch."""
    longs, long = T.ArrayType(T.LongType()), T.LongType()
    fields = [("n_shingles", long), ("key0", long), ("key1", long), ("bands", longs), *((k, long) for k in SKETCH)]
    schema = T.StructType([T.StructField("doc_id", long), *(T.StructField(f, t) for f, t in fields)])

    def run(batches):
        for batch in (part for whole in batches for part in list_slices(whole, 1)):
            column = batch.column(1)
            flat, ends = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
            size, keys = np.zeros(len(column), np.int64), np.zeros((2, len(column)), np.uint64)
            values = np.zeros((len(column), HASHES), np.uint64)
            for i in range(len(column)):
                part = np.unique(flat[ends[i] : ends[i + 1]])
                size[i] = len(part)
                if len(part):
                    mixed = _mix(part)
                    keys[0, i], keys[1, i] = mixed.sum(), np.bitwise_xor.reduce(_mix(mixed + np.uint64(7)))
                    values[i] = minhash(mixed)
            tagged = _mix(values ^ _SALT[0])
            bands = _mix(tagged.reshape(-1, HASHES // BAND, BAND).cumsum(axis=2)[:, :, -1] + _SALT[1, : HASHES // BAND])
            # Each MinHash value flips one bit.
            bit = (_mix(tagged + np.uint64(1)) >> np.uint64(40)).astype(np.int64) % (64 * SKETCH_WORDS)
            sketch = np.zeros((len(column), 64 * SKETCH_WORDS), np.uint8)
            np.bitwise_xor.at(sketch, (np.arange(len(column))[:, None], bit), 1)
            packed = np.packbits(sketch, axis=1).view(np.int64)
            band_lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(column) * bands.shape[1] + 1, bands.shape[1]), pa.int32()), pa.array(bands.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), *(pa.array(k.view(np.int64)) for k in keys), band_lists, *(pa.array(packed[:, j].copy()) for j in range(SKETCH_WORDS))], names=schema.names)

    smaller_batches(docs.sparkSession)
    return docs.select("doc_id", shingles(F.col("text"), n).alias("s")).mapInArrow(run, schema)


def differing(left: str, right: str) -> Column:
    """Bits in which two sketches differ."""
    total = F.lit(0)
    for k in SKETCH:
        total = total + F.bit_count(F.col(f"{left}.{k}").bitwiseXOR(F.col(f"{right}.{k}")))
    return total


def alike(left: str, right: str, percent: int) -> Column:
    """Neither the sizes nor the sketches rule out the similarity."""
    a, b = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (differing(left, right) <= MOST_BITS)


def confirmed(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets; texts: rep, text.

    b is the side that many pairs may share: it is dealt out in shares, and its text is copied once to each.
    """
    shares = pairs.groupBy("b").agg(F.count("*").alias("_m")).withColumn("_shares", F.ceil(F.col("_m") / LEADER_SHARE).cast("int"))
    left = looked_up(pairs, shares, "b", pairs.count()).withColumn("_share", F.pmod(F.xxhash64("a"), F.col("_shares")).cast("int"))
    left = left.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("_ta")), "a")
    right = shares.select("b", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share")).join(texts.select(F.col("rep").alias("b"), F.col("text").alias("_tb")), "b")
    both = left.join(right, ["b", "_share"]).select("a", "b", F.array_distinct(shingles(F.col("_ta"), n)).alias("_sa"), F.array_distinct(shingles(F.col("_tb"), n)).alias("_sb"))
    sized = both.select("a", "b", F.size(F.array_intersect("_sa", "_sb")).alias("_i"), (F.size("_sa") + F.size("_sb")).alias("_n"))
    return sized.where(F.col("_i") * 100 >= (F.col("_n") - F.col("_i")) * percent).select("a", "b")


def rare_shingles(active: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """active: rep, root -> (t, rep, root, n_shingles, place): the rarest shingles of each set that another active set has too.

    Two sets of the similarity share one of their rarest n - ceil(percent / 100 * n) + 1 shingles, rarest
    first. A shingle of one set only takes a place, but can't be shared.
    """
    sets = keep(active.join(texts, "rep").select("rep", "root", F.array_distinct(shingles(F.col("text"), n)).alias("s")), "sets")
    each = sets.select("rep", F.explode("s").alias("t"))
    often = each.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    total = sets.agg(F.sum(F.size("s"))).first()[0] or 0
    common = looked_up(each, often, "t", total, "df").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("c"))
    placed = sets.select("rep", "root", F.size("s").alias("n_shingles")).join(common, "rep").withColumn("own", F.col("n_shingles") - F.size("c"))
    room = F.greatest(F.lit(0), F.expr(f"n_shingles - (n_shingles * {percent} + 99) div 100 + 1 - own").cast("int"))
    made = placed.select("rep", "root", "n_shingles", "own", F.posexplode(F.slice("c", F.lit(1), room)).alias("k", "x")).select(F.col("x.t").alias("t"), "rep", "root", "n_shingles", (F.col("own") + F.col("k")).alias("place"))
    made = keep(made, "postings")
    forget(sets)
    return made


def tiled_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that share a shingle at places that leave room for the similarity.

    Of each shingle's sets those of the largest component are on one side of the tiles only, all others
    are on both. Tiles have about TILE sets a side; a task holds one tile at a time.
    """
    counts = postings.groupBy("t", "root").count()
    main = counts.groupBy("t").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.sum("count").alias("all"), F.max("count").alias("most")).where("most < all")
    main = main.select("t", "main", F.col("all").alias("_m"), F.ceil((F.col("all") - F.col("most")) / TILE).cast("int").alias("na"), F.ceil(F.col("all") / TILE).cast("int").alias("nb"))
    dealt = looked_up(postings, main, "t", postings.count()).withColumn("_h", F.xxhash64("rep", F.lit(17)))
    a = dealt.where("root != main").withColumns({"ta": F.pmod("_h", F.col("na")).cast("int"), "tb": F.explode(F.sequence(F.lit(0), F.col("nb") - 1)), "side": F.lit(0)})
    b = dealt.withColumns({"tb": F.pmod("_h", F.col("nb")).cast("int"), "ta": F.explode(F.sequence(F.lit(0), F.col("na") - 1)), "side": F.lit(1)})
    cols = ["t", "ta", "tb", "side", "rep", "root", "n_shingles", "place"]
    laid = a.select(cols).union(b.select(cols)).repartition("t", "ta", "tb").sortWithinPartitions("t", "ta", "tb")

    def of_tile(side, rep, root, size, place):
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for at in range(0, len(left), 256):
            u = left[at : at + 256, None]
            both = size[u] + size[right]
            room = np.minimum(size[u] - place[u], size[right] - place[right])
            x, y = np.nonzero((root[u] != root[right]) & (room * (100 + percent) >= both * percent))
            if len(x):
                p, q = rep[u[x, 0]], rep[right[y]]
                yield np.minimum(p, q), np.maximum(p, q)

    def pairs(batches):
        held, at = [], None
        for batch in batches:
            data = [batch.column(i).to_numpy() for i in range(8)]
            change = (data[0][1:] != data[0][:-1]) | (data[1][1:] != data[1][:-1]) | (data[2][1:] != data[2][:-1])
            cuts, found = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows], []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                key = (data[0][lo], data[1][lo], data[2][lo])
                if held and key != at:
                    found += of_tile(*(held[0] if len(held) == 1 else [np.concatenate(c) for c in zip(*held, strict=True)]))
                    held = []
                at = key
                held.append([c[lo:hi] for c in data[3:]])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found])) for i in (0, 1)], names=["a", "b"])
        if held:
            for p, q in of_tile(*(np.concatenate(c) for c in zip(*held, strict=True))):
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(q)], names=["a", "b"])

    return laid.mapInArrow(pairs, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, n: int = 2, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs.

    Documents are linked if 100 * intersection >= percent * union of their sets of n-word shingles (A-Z
    lower-cased; a text with fewer words is one shingle). A null or empty text, or one of white space,
    has an empty set and is linked with nothing; nor is a row without an id, whose component is null and
    which is kept. component_id is the least id that can be reached by links. Ids are unique but for
    repeated rows, which are one document: each gets its result. An empty table gives an empty result.
    Texts of any length are compared whole.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sigs = keep(signatures(docs, n), "signatures")
    linked = sigs.where("n_shingles > 0 and doc_id is not null")
    classes = keep(linked.groupBy("key0", "key1", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("_m"), *(F.first(c).alias(c) for c in ("bands", *SKETCH))), "classes")

    # Buckets of two members and more; a key tells the band too. Only ids go with it: 32 rows of two numbers for a class.
    members = classes.select("rep", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("_m")).where("_m > 1")
    buckets = keep(looked_up(members, shared, "key", classes.count() * (HASHES // BAND)).select("key", "rep"), "buckets")
    total = buckets.count()
    reps = buckets.select("rep").distinct()
    texts = docs.withColumnRenamed("doc_id", "rep").join(small(reps, reps.count()), "rep")
    if not linked.groupBy("doc_id").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["rep"])
    texts = keep(texts, "texts")
    sketches = classes.select("rep", F.struct("n_shingles", *SKETCH).alias("sketch"))

    def likely(found: DataFrame) -> DataFrame:
        """The pairs (a, b), each once, that sizes and sketches don't rule out; b may be in very many."""
        found = keep(found.distinct(), "met")
        leading = found.groupBy("b").agg(F.count("*").alias("_m")).join(sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("two")), "b")
        both = looked_up(found, leading, "b", found.count()).join(sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("one")), "a")
        out = keep(both.where(alike("one", "two", percent)).select("a", "b"), "pairs")
        forget(found)
        return out

    links = roots = None
    for step in range(LEADER_ROUNDS + 1):
        rows = buckets.withColumn("root", F.col("rep")) if roots is None else buckets.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        # The first leader is the same in most buckets of a group; later ones differ by bucket.
        order = F.struct(F.xxhash64("rep", *([F.col("key")] if step else [])).alias("h"), F.col("rep"), F.col("root"))
        active = rows.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.count("*").alias("_m"), F.min(order).alias("l")).where("_lo != _hi" + (" and _m > 2" if step else ""))
        open_ = looked_up(rows, active.select("key", "_m", "l"), "key", total)
        if step < LEADER_ROUNDS:
            pairs = likely(open_.where(F.col("root") != F.col("l.root")).select(F.col("rep").alias("a"), F.col("l.rep").alias("b")))
        else:
            rest = keep(open_.select("rep", "root").distinct(), "active")
            postings = rare_shingles(rest, texts, n, percent)
            pairs = likely(tiled_pairs(postings, percent))
            forget(rest, postings)
        new = confirmed(pairs, texts, n, percent)
        merged = keep(new if links is None else links.union(new).distinct(), "confirmed")
        forget(pairs, *(t for t in (links, roots) if t is not None))
        links, roots = merged, components(merged)
    forget(links, buckets, texts)

    keys = ["key0", "key1", "n_shingles"]
    found = classes.select(*keys, "rep", "_m").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(*keys, "_m", F.coalesce("root", "rep").alias("component_id"))
    numbered = looked_up(linked.select("doc_id", *keys), found, keys, sigs.count()).select("doc_id", "n_shingles", "component_id")
    alone = sigs.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return numbered.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
