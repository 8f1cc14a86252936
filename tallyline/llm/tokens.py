"""Token counts by a two-tier, map-side lookup.

A compact table of the most frequent pre-tokens and their token counts goes to every worker; what it
lacks is encoded by the tokenizer's own library and kept in a bounded cache in the worker. Counts
need no shuffle, and the table only saves time: any table, an empty one too, gives the same counts.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_text, slices

TOKENIZER = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"
#: The frequent table: documents it is drawn from (about), its most entries, and the pre-tokens that a task returns for a document.
SAMPLE_DOCS, FREQUENT, EACH = 2_000, 40_000, 200
#: Entries of a worker's cache, and the longest text that it keeps.
CACHE, CACHE_CHARS = 400_000, 48

# In texts of these characters alone Python's pattern and the library's agree on every character class.
_ODD = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]").search
_WHITE = ("  ", " \n", "\n ", "\t", "\r")
_MARKS = (".", ",", ";", ":", "!", "?")


def byte_letters() -> dict[int, int]:
    """Byte (as a Latin-1 character) -> the printable character that stands for it in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class Pieces(dict):
    """Pre-token -> number of its tokens."""

    def __init__(self, path: str, frequent: tuple[str, bytes]):
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.split = regex.compile(PATTERN).findall
        self.library = Tokenizer.from_file(path)
        self.model, self.letters = self.library.model, byte_letters()
        self.first = dict(zip(frequent[0].split("\0"), frequent[1], strict=False)) if frequent[1] else {}
        self.update(self.first)

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def encode(self, piece: str) -> int:
        return len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))

    def total(self, text: str) -> int:
        return sum(map(self.__getitem__, self.split(text)))

    def __missing__(self, piece: str) -> int:
        n = self.encode(piece)
        if len(piece) <= CACHE_CHARS and len(self) < CACHE:
            self[piece] = n
        return n


class Chunks(dict):
    """What stands between two spaces -> number of tokens of it and the space before it."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.first = {p[1:]: n for p, n in pieces.first.items() if p[0] == " "}
        self.update(self.first)

    def __missing__(self, chunk: str) -> int:
        if chunk[-1:] in _MARKS and chunk[:-1].isalpha():
            return self[chunk[:-1]] + self.pieces[chunk[-1]]
        n = self.pieces.encode(" " + chunk) if chunk.isalpha() else self.pieces.total(" " + chunk)
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE:
                self.clear()
                self.update(self.first)
            self[chunk] = n
        return n


_COUNTERS: dict[tuple, "Counter"] = {}


def counter(path: str, frequent: tuple[str, bytes]) -> "Counter":
    """The worker's counter: its cache serves all tasks of the worker."""
    key = (path, hash(frequent))
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(path, frequent)
    return _COUNTERS[key]


class Counter:
    """Counts the tokens of texts as the library does, special strings included."""

    def __init__(self, path: str, frequent: tuple[str, bytes] = ("", b"")):
        self.pieces = Pieces(path, frequent)
        self.chunks = Chunks(self.pieces)

    def plain(self, text: str) -> int:
        if _ODD(text):
            return self.pieces.whole(text)
        if any(w in text for w in _WHITE):
            return self.pieces.total(text)
        # Single spaces between other characters always begin a pre-token.
        head, *rest = text.split(" ")
        return self.pieces.total(head) + sum(map(self.chunks.__getitem__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if SPECIAL in text:
            parts = text.split(SPECIAL)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(text)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def frequent_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, text: str = "text", doc_id: str = "doc_id", sample_docs: int = SAMPLE_DOCS, entries: int = FREQUENT) -> tuple[str, bytes]:
    """The table of the most frequent pre-tokens in about sample_docs documents, as joined pieces and a byte of length each.

    Each task counts its part of the sample and returns its most frequent pre-tokens, at most EACH for a
    document that it read, so that the driver adds up at most EACH * sample_docs short strings; none are
    shuffled.
    """
    share = max(1, docs.count() // sample_docs)

    def pieces(batches):
        import collections

        import regex
        from public_tokenizers import PATTERN

        split, seen, read = regex.compile(PATTERN).findall, collections.Counter(), 0
        for batch in batches:
            read += batch.num_rows
            for part in slices(batch, 0):
                for t in part.column(0).to_pylist():
                    seen.update(p for p in split(t or "") if len(p) <= CACHE_CHARS and "\0" not in p)
                if len(seen) > 2 * CACHE:
                    seen = collections.Counter(dict(seen.most_common(CACHE)))
        top = seen.most_common(EACH * read)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    sample = docs.where(F.pmod(F.xxhash64(doc_id, F.when(F.col(doc_id).isNull(), F.col(text))), F.lit(share)) == 0).select(text)
    counted = sample.mapInArrow(pieces, "piece string, n long").toArrow()
    total = counted.group_by("piece").aggregate([("n", "sum")]).sort_by([("n_sum", "descending"), ("piece", "ascending")])
    top = total.column("piece").slice(0, entries).to_pylist()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(tokenizer))
    lengths = [len(x.ids) for x in library.encode_batch(top, add_special_tokens=False)]
    return "\0".join(top), bytes(lengths)


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = 1024, text: str = "text", doc_id: str = "doc_id", frequent: tuple[str, bytes] | None = None) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than limit tokens).

    A null or empty text has no bytes and no tokens. Special strings inside a text count as one
    token, as the library has it by default; nothing is added at the ends. Rows with equal ids or
    texts, or without an id, are counted each for itself; an empty table gives an empty result. Texts of
    any length are counted whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent if frequent is not None else frequent_pieces(docs, tokenizer, text, doc_id))

    def make():
        count = counter(tokenizer_path(tokenizer), sent.value).count
        return lambda texts: [[count(t) for t in texts]]

    sized = docs.select(doc_id, text, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    counted = map_text(sized, make, [("n_tokens", T.LongType())], text, (doc_id, "n_bytes"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
