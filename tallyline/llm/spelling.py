"""Spelling variants of a corpus' words: near words by two-dimensional range reporting.

Two words are near if they differ by one code point inserted, deleted or replaced. For a word and an edit
position the words that agree before it are an interval of the forward order, those that agree behind it
one of the reverse order; a wavelet tree over the points (forward rank, reverse rank) reports what lies in
both.

Words are dealt to blocks: a block has a length, a range of edit positions, and all words that agree
outside that range. Every near pair with its edit in the range is within the block. A large block is cut
in two, each with half of the positions and more characters that must agree, down to single positions,
where a block can't hold more than the alphabet squared. So no block grows with the words, and each pair
is met in one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, keep, small

#: Letters of words, the least length and occurrences of a word, one run of so many loses a code point, and how much more frequent a form is.
LETTERS, SHORTEST, LEAST, TYPO, TIMES = "A-Za-zÀ-ÿ", 7, 2, 31, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of a block beyond which it is cut in two, and of the blocks that are searched at once; blocks that are cut at most, beyond which blocks are larger.
BLOCK_CHARS, MOST_CUT = 200_000, 1_000_000
#: Words and forms are broadcast up to so many bytes, as words may be of any length.
ROOT_BYTES = 16_000_000
#: Queries that go down the wavelet tree at once.
QUERIES = 500_000


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word and n: the maximal runs of letters, A-Z lower-cased, of which every TYPO-th by a checksum lost a code point; those of SHORTEST code points that occur LEAST times."""
    # A shorter run can't make a word.
    runs = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"[{LETTERS}]{{{SHORTEST},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("w")).withColumn("w", F.translate("w", UPPER, LOWER))
    h = F.crc32(F.concat("id", F.lit(":"), "w").cast("binary"))
    each = each.select("w", h.alias("h")).withColumn("at", (F.col("h") % F.length("w")).cast("int"))
    without = F.concat(F.left("w", F.col("at")), F.substring("w", F.col("at") + 2, F.length("w")))
    word = F.when(F.col("h") % TYPO == 0, without).otherwise(F.col("w"))
    return each.select(word.alias("word")).where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)


def key() -> Column:
    """Of a block: its length c, its edit positions lo to hi, and what its words have before and behind them. Blocks that share a hash are searched as one, which is slower, but not wrong."""
    return F.xxhash64("c", "lo", "hi", F.left("word", F.col("lo")), F.right("word", F.greatest(F.lit(0), F.col("c") - F.col("hi"))))


def halves(rows: DataFrame) -> DataFrame:
    """The rows of blocks, each in both halves of its block."""
    mid = F.expr("(lo + hi) div 2").cast("int")
    cut = F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi")))
    return rows.select("word", "n", "c", F.explode(cut).alias("p")).select("word", "n", "c", "p.lo", "p.hi").where("lo < hi").withColumn("key", key())


def blocks(words: DataFrame) -> DataFrame:
    """word, n, c, lo, hi, key: each word is in blocks of its own length and, as the longer of a pair, in those of the length below; lo to hi: the edit positions."""
    length = F.length("word")
    both = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("c"))
    open_, done = halves(both.withColumns({"lo": F.lit(0), "hi": F.col("c") + 1})), []
    # A word is in four blocks at first, so no more than MOST_CUT of them are cut.
    most = max(BLOCK_CHARS, 4 * (words.agg(F.sum(length)).first()[0] or 0) // MOST_CUT)
    while True:
        sizes = open_.groupBy("key").agg(F.count("*").alias("m"), F.max("c").alias("c"), F.max(F.col("hi") - F.col("lo")).alias("wide"))
        large = keep(sizes.where((F.col("m") > 1) & (F.col("wide") > 1) & (F.col("m") * F.col("c") > most)).select("key"), "large")
        n = large.count()
        if not n:
            forget(large)
            done.append(open_)
            return _union(done)
        done.append(open_.join(small(large, n), "key", "left_anti"))
        open_ = keep(halves(open_.join(small(large, n), "key", "left_semi")), "blocks")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class WaveletTree:
    """Over a permutation of 0 to n - 1: the values within a range of places and a range of values. A level holds, for each place, the values before it that go left."""

    def __init__(self, values: np.ndarray):
        self.bits, self.left = max(1, (len(values) - 1).bit_length()), []
        for level in reversed(range(self.bits)):
            right = (values >> level) & 1 == 1
            self.left.append(np.concatenate([[0], np.cumsum(~right)]))
            values = np.concatenate([values[~right], values[right]])

    def report(self, first: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value) of all values in low to high at the places first to end; ends are exclusive."""
        query, least = np.arange(len(first)), np.zeros(len(first), np.int64)
        for level, left in zip(reversed(range(self.bits)), self.left, strict=True):
            a, b, right = left[first], left[end], left[-1]
            query = np.concatenate([query, query])
            first, end = np.concatenate([a, right + first - a]), np.concatenate([b, right + end - b])
            least = np.concatenate([least, least + (1 << level)])
            open_ = (first < end) & (least < high[query]) & (least + (1 << level) > low[query])
            query, first, end, least = query[open_], first[open_], end[open_], least[open_]
        return query, least


class Order:
    """Words in order (chars: their characters, the block before them): for a length the interval of the words that agree in so many characters."""

    def __init__(self, chars: np.ndarray):
        self.rows = np.argsort(np.ascontiguousarray(chars).view(f"U{chars.shape[1]}").ravel(), kind="stable")
        self.rank = np.empty(len(chars), np.int64)
        self.rank[self.rows] = np.arange(len(chars))
        sorted_ = chars[self.rows]
        self.alike = np.logical_and.accumulate(sorted_[1:] == sorted_[:-1], axis=1)

    def interval(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each word the first rank of its interval and the end."""
        starts = np.concatenate([[0], np.flatnonzero(~self.alike[:, length]) + 1])
        ends = np.append(starts[1:], len(self.rows))
        of = np.searchsorted(starts, self.rank, "right") - 1
        return starts[of], ends[of]


def near_pairs(words: list[str], c: int, block: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(u, v), both ways, for all near words within blocks of length c, by their edit positions lo to hi; block: the number of each word's block."""
    chars = np.array(words, f"U{c + 1}").view(np.uint32).reshape(len(words), c + 1)
    shorter = chars[:, c] == 0
    turned = np.where(shorter[:, None], np.hstack([chars[:, :c][:, ::-1], chars[:, c:]]), chars[:, ::-1])
    number = (block + 1).astype(np.uint32)[:, None]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # Replaced: both words are of length c. Inserted: the query is, and what the rectangle holds beside it has one more.
    for among, more in ((np.flatnonzero(shorter), 0), (np.arange(len(words)), 1)):
        if len(among) < 2:
            continue
        forward, reverse = Order(np.hstack([number, chars])[among]), Order(np.hstack([number, turned])[among])
        tree, asks = WaveletTree(reverse.rank[forward.rows]), shorter[among]
        from_, to = lo[among], hi[among]
        held: list[tuple[np.ndarray, ...]] = []
        for i in range(int(from_.min()), min(int(to.max()), c + more)):
            (a, b), (x, y) = forward.interval(i), reverse.interval(c - 1 + more - i)
            q = np.flatnonzero(asks & (from_ <= i) & (i < to) & (b - a > 1) & (y - x > 1))
            if len(q):
                held.append((q, np.full(len(q), i), a[q], b[q], x[q], y[q]))
            if held and (i + 1 == min(int(to.max()), c + more) or sum(len(h[0]) for h in held) > QUERIES):
                found += _reported(held, tree, reverse, among, chars)
                held = []
        if held:
            found += _reported(held, tree, reverse, among, chars)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = (np.concatenate(x) for x in zip(*found, strict=True))
    # A longer word isn't asked for; it has what was inserted into a shorter one the other way round.
    long_ = ~shorter[v]
    return np.concatenate([u, v[long_]]), np.concatenate([v, u[long_]])


def _reported(held: list[tuple], tree: WaveletTree, reverse: Order, among: np.ndarray, chars: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    q, at, a, b, x, y = (np.concatenate(h) for h in zip(*held, strict=True))
    query, rank = tree.report(a, b, x, y)
    u, v, i = among[q[query]], among[reverse.rows[rank]], at[query]
    # The characters at the position differ: that leaves out the word itself, and of the places where an inserted character may stand all but the last.
    differ = chars[u, i] != chars[v, i]
    return [(u[differ], v[differ])]


def nearest(rows: DataFrame) -> DataFrame:
    """rows of blocks() -> word, n_near (near words in one block), form_n and form (the most frequent of them, the first in code-point order)."""
    schema = "word string, n_near long, form_n long, form string"

    def searched(table: pa.Table) -> Iterator[pa.RecordBatch]:
        c, block, lo, hi, n = (table.column(k).to_numpy() for k in ("c", "key", "lo", "hi", "n"))
        words = table.column("word").to_pylist()
        cuts = [0, *(np.flatnonzero(c[1:] != c[:-1]) + 1).tolist(), len(c)]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if e - s < 2:
                continue
            number = np.cumsum(np.concatenate([[0], block[s + 1 : e] != block[s : e - 1]]))
            part = words[s:e]
            u, v = near_pairs(part, int(c[s]), number, lo[s:e], hi[s:e])
            if not len(u):
                continue
            place = np.empty(e - s, np.int64)
            place[np.argsort(np.array(part), kind="stable")] = np.arange(e - s)
            order = np.lexsort((place[v], -n[s:e][v], u))
            u, v = u[order], v[order]
            first = np.concatenate([[0], np.flatnonzero(u[1:] != u[:-1]) + 1])
            count = np.diff(np.append(first, len(u)))
            yield pa.RecordBatch.from_arrays([pa.array([part[i] for i in u[first]], pa.string()), pa.array(count, pa.int64()), pa.array(n[s:e][v[first]], pa.int64()), pa.array([part[i] for i in v[first]], pa.string())], names=["word", "n_near", "form_n", "form"])

    def run(batches):
        held, chars = [], 0
        for batch in batches:
            held, chars = [*held, batch], chars + sum(batch.column("c").to_pylist())
            if chars > BLOCK_CHARS:
                table = pa.Table.from_batches(held)
                key = table.column("key").to_numpy()
                # The last block may go on in the next batch.
                last = len(key) - int((key[::-1] != key[-1]).argmax()) if key[0] != key[-1] else 0
                if last:
                    yield from searched(table.slice(0, last))
                    held, chars = table.slice(last).to_batches(), sum(table.column("c").slice(last).to_pylist())
        if held:
            yield from searched(pa.Table.from_batches(held))

    return rows.repartition("key").sortWithinPartitions("c", "key").mapInArrow(run, schema)


def roots(forms: DataFrame) -> DataFrame:
    """word, form -> word, root: the end of the chain of forms. A form is TIMES as frequent as its word, so chains are short; each round doubles the steps taken."""
    now = keep(forms.select("word", F.col("form").alias("root")), "roots")
    size = now.agg(F.sum(F.octet_length("word") + F.octet_length("root") + 32)).first()[0] or 0
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = F.broadcast(further) if size <= ROOT_BYTES else further
        new = keep(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        forget(now)
        if new.where("moved").isEmpty():
            return new.drop("moved")
        now = new.drop("moved")
        now._tallyline_path = new._tallyline_path


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word, form, root, n, n_near, form_n for each distinct word; form: the near word of largest n, ties to the first in code-point order, if that is TIMES the word's n.

    A null or empty text has no words; a null id is read as an empty one. Repeated rows are counted each; an
    empty table gives no rows. Texts and words of any length are read whole. Other columns aren't read.
    """
    words = keep(word_counts(docs, text, doc_id), "words")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    near = nearest(blocks(words)).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    found = words.join(near, "word", "left")
    form = F.when(-F.col("b.less") >= TIMES * F.col("n"), F.col("b.form"))
    named = keep(found.select("word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form.isNotNull(), -F.col("b.less")).alias("form_n")), "variants")
    ends = roots(named.where("form is not null").select("word", "form"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
