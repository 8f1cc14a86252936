"""Conflict-constrained best-fit packing of documents into sequences of equal capacity.

Pieces are dealt to groups of bounded size by a hash of their document. In each group they are taken
by falling size. Open bins are held in the order of their residual room and carry bitmaps of their
sources and duplicate clusters; from the tightest bin that has room the search goes on to the next
ones until a compatible bin is found, else a bin is opened.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WHITE, keep, let, told_apart

#: Characters that a bin holds, and a separator of one character after each piece.
CAPACITY = 16_384
#: Pieces of one source that a bin may hold.
PER_SOURCE = 2
#: Pieces of a group, about, however many documents they are of; a group is packed in one task.
GROUP_ROWS = 4_000


class Bins:
    """Open bins in the order of their residual room."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []
        self.clusters: list[int] = []
        # One bitmap for each count: bit s of planes[b][k] is set if bin b holds more than k pieces of source s.
        self.planes: list[list[int]] = []

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset); source and cluster are single bits, or 0 for none."""
        if size >= self.capacity:
            # A full piece takes a bin of its own, which no later one can share.
            self.clusters.append(0)
            self.planes.append([0] * self.per_source)
            return len(self.clusters) - 1, 0
        at = bisect.bisect_left(self.order, (size, -1))
        while at < len(self.order):
            room, b = self.order[at]
            if not self.clusters[b] & cluster and not self.planes[b][-1] & source:
                break
            at += 1
        else:
            b, room = len(self.clusters), self.capacity
            self.clusters.append(0)
            self.planes.append([0] * self.per_source)
            self.order.append((room, b))
            at = len(self.order) - 1
        del self.order[at]
        bisect.insort(self.order, (room - size, b))
        self.clusters[b] |= cluster
        for k, plane in enumerate(self.planes[b]):
            if not plane & source:
                self.planes[b][k] = plane | source
                break
        return b, self.capacity - room


def pack_group(sizes: np.ndarray, sources: list, clusters: list, ties: np.ndarray, capacity: int, per_source: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each piece."""
    bit_of: dict = {}
    source_bits = [0 if s is None else 1 << bit_of.setdefault(s, len(bit_of)) for s in sources]
    counts: dict = {}
    for c in clusters:
        counts[c] = counts.get(c, 0) + 1
    bit_of = {c: i for i, c in enumerate(c for c, n in counts.items() if n > 1)}
    cluster_bits = [1 << bit_of[c] if c in bit_of else 0 for c in clusters]
    bins, out = Bins(capacity, per_source), np.zeros((2, len(sizes)), np.int64)
    for i in np.lexsort((ties, -sizes)):
        out[:, i] = bins.put(int(sizes[i]), source_bits[i], cluster_bits[i])
    return out[0], out[1]


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, text: str = "text", doc_id: str = "doc_id", source: str = "source", cluster: str | None = None, key: str | None = None) -> DataFrame:
    """doc_id, piece, n_pieces, start, length, bin_id, offset for each piece of each document.

    A document of n characters takes n + 1 with its separator; one that is longer than a bin is cut into
    full pieces and a last one. A null or empty text takes the room of its separator. No two pieces of
    one duplicate cluster share a bin, nor more than per_source pieces of one source; rows without a
    source are of no source. cluster: a column; by default texts with equal words, case aside, are a
    cluster, texts without words (white space alone) are in none. Repeated rows are packed each for
    itself; an empty table gives no rows. key: a column of whole numbers that names each row, for ids that
    are null or not unique; with it the result has `row_key` too. Pieces are dealt to groups by a hash of
    id, text, piece and key; equal rows are counted and told apart by a number, so that no group grows with
    them. Of rows alike in all of these it makes no difference which is which, so that the bins of an input
    are the same in every run and for every layout. Only lengths, ids and clusters are shuffled, no texts.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    # The words, case aside, with one space between; a text without words is in no cluster.
    plain = F.btrim(F.regexp_replace(F.lower(t), WHITE, " "), F.lit(" "))
    own = let(plain, lambda p: F.when(p != "", F.xxhash64(p))) if cluster is None else F.col(cluster)
    named = [] if key is None else ["row_key"]
    own_key = [] if key is None else [F.col(key).cast("long").alias("row_key")]
    rows = docs.select(*own_key, F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), F.length(t).cast("long").alias("n"), own.alias("cluster"), F.xxhash64(t).alias("_text"))
    # A few numbers for each row are written once; texts aren't read again.
    rows = keep(rows.groupBy(*rows.columns).agg(F.count("*").alias("_k")), "lengths").withColumn("n_pieces", F.expr(f"cast((n + {capacity}) div {capacity} as int)"))
    total, most = rows.agg(F.sum(F.col("n_pieces") * F.col("_k")), F.max("_k")).first()
    groups = max(1, (total or 0) // GROUP_ROWS)
    rows = told_apart(rows, "_k", "_copy", most or 0).withColumn("_other", F.xxhash64("source", "cluster"))
    dealt = [*named, "doc_id", "_text", "_copy", "piece"]
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
    pieces = pieces.withColumn("start", F.col("piece") * capacity).withColumn("length", F.least(F.lit(capacity), F.col("n") - F.col("start")))
    pieces = pieces.withColumn("size", F.col("length") + F.when(F.col("piece") == F.col("n_pieces") - 1, 1).otherwise(0)).withColumn("_g", F.pmod(F.xxhash64(*dealt), F.lit(groups)))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in (*named, "doc_id", "piece", "n_pieces", "start", "length", "bin_id", "offset")])

    def of_group(table: pa.Table) -> pa.Table:
        # Clusters with no id are single; a document's own pieces may not share a bin unless they have no cluster.
        clusters = [c if c is not None else ("", i) for i, c in enumerate(table.column("cluster").to_pylist())]
        ids = np.array([-1 if x is None else x for x in table.column("doc_id").to_pylist()], np.int64)
        order = np.lexsort((*(table.column(c).to_numpy() for c in ("_copy", *named, "_other", "_text", "size", "piece")), ids))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        bins, offsets = pack_group(table.column("size").to_numpy(), table.column("source").to_pylist(), clusters, rank, capacity, per_source)
        group = table.column("_g")[0].as_py()
        made = [*(table.column(c).cast(pa.int64()) for c in (*named, "doc_id", "piece", "n_pieces", "start", "length")), pa.array(bins * groups + group), pa.array(offsets)]
        return pa.Table.from_arrays(made, names=schema.names)

    return pieces.groupBy("_g").applyInArrow(of_group, schema)


def filled(docs: DataFrame, packed: DataFrame, text: str = "text", doc_id: str = "doc_id", key: str | None = None) -> DataFrame:
    """The packed pieces with their text; a null text gives an empty piece.

    key: the column that pack() was given; docs must give each row the same key again, so it is to be
    read from a table. Without a key the ids must be unique, or a ValueError is raised.
    """
    name = F.col(doc_id if key is None else key).cast("long")
    texts = docs.select(name.alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    if key is None and not texts.groupBy("_id").count().where("count > 1").isEmpty():
        raise ValueError("ids are null or repeated in several rows: pack and fill by a key")
    both = packed.join(texts, packed["doc_id"].eqNullSafe(F.col("_id")) if key is None else packed["row_key"] == F.col("_id"))
    return both.select(*(c for c in packed.columns if c != "row_key"), F.substring("_t", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("text"))
