"""Secret scans: three base patterns, and strings that a character Markov model finds random.

Two models of character pairs, one of random strings and one of ordinary identifiers, are trained
from labelled samples in Spark. A candidate run of characters is a secret if the log-likelihood
ratio of the two models is high enough, in total and for each character.
"""

from __future__ import annotations

import bisect
import itertools
import math
import random
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_text

#: The base patterns and the least lengths of what they match.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "markov")

#: Candidates of the model: runs of so many of these characters. Nats for the whole string and for each pair.
CANDIDATE, LEAST_LLR, LEAST_LLR_PAIR = r"[A-Za-z0-9+/_=-]{20,}", 12.0, 0.35
#: Within a run that fails as a whole: the least length of a random stretch, marks between parts, and how far from a mark a stretch's end is moved to it.
LEAST_STRETCH, MARKS, NEAR = 20, "+/_=-", 4
#: Added to each pair's count, so that none is impossible.
HALF = 0.5
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

IDENTIFIER_WORDS = """account action active address admin after agent alert array audit author backend balance batch before
billing block buffer build bucket button cache callback channel check child client cluster code column commit compare config
connection container content context controller convert count create current customer data database date debug decode default
delete delivery description detail device directory document domain download driver element encode endpoint engine entity
error event example export factory failure feature field file filter final format frame function gateway generate global
group handler header height helper history image import index input instance integer internal invoice item iterator label
language layer layout length level library limit list loader local location logger manager mapping message method metric
model module monitor name network number object offset option order output owner package page parameter parent parser
partition password payment pending pipeline platform policy position prefix price process product profile project property
protocol provider query queue random reader record reference region register release render report request resource response
result return route sample schedule schema scope search section security select sender server service session setting shared
signal snapshot source start state status storage stream string style subject summary support switch system table target
template thread timeout token total transaction transfer transform trigger type update upload user utility validate value
vector version view width window worker writer""".split()


def default_samples(spark: SparkSession, each: int = 3_000, seed: int = 11) -> DataFrame:
    """Labelled samples (text, label): made random strings (1) of common kinds and identifiers and prose words (0)."""
    r, rows = random.Random(seed), []
    kinds = ["0123456789abcdef", "0123456789ABCDEF", ALPHABET[:62], ALPHABET[:62], ALPHABET[:64], ALPHABET[26:62]]
    for i in range(each):
        rows.append(("".join(r.choices(kinds[i % len(kinds)], k=r.randint(20, 48))), 1))
    for i in range(each):
        w = [r.choice(IDENTIFIER_WORDS) for _ in range(r.randint(2, 5))]
        made = ("_".join(w), "-".join(w), "".join(x.title() for x in w), w[0] + "".join(x.title() for x in w[1:]), "_".join(w).upper(), "/".join(w), "".join(w), "_".join(w) + str(r.randint(1, 99)), f"{r.randint(1990, 2030)}-{r.randint(1, 12):02}-{'-'.join(w)}", "=" * 20 + "-" * 20 + "_" * 20)
        rows.append((made[i % len(made)], 0))
    return spark.createDataFrame(rows, "text string, label int")


def train(samples: DataFrame) -> dict[str, float]:
    """Log-likelihood ratio, random to ordinary, of each pair of characters; counts are taken in Spark, HALF added to each.

    Characters outside the alphabet are one, `?`, before pairs are counted, so that the driver gets at most
    (number of characters + 1) squared counts a label. Null samples and labels are left out.
    """
    n = len(ALPHABET) + 1
    plain = F.regexp_replace("text", "[^A-Za-z0-9+/_=-]", "?")
    pairs = (
        samples.where("text is not null and label in (0, 1) and length(text) > 1")
        .select("label", plain.alias("text"))
        .select("label", F.explode(F.transform(F.sequence(F.lit(1), F.length("text") - 1), lambda i: F.substring("text", i, F.lit(2)))).alias("pair"))
        .groupBy("label", "pair").count()
        .collect()
    )
    seen = {(r.label, r.pair): r["count"] for r in pairs}
    first: dict[tuple[int, str], int] = {}
    for (label, p), k in seen.items():
        first[label, p[0]] = first.get((label, p[0]), 0) + k
    log = lambda label, p: math.log((seen.get((label, p), 0) + HALF) / (first.get((label, p[0]), 0) + HALF * n))
    return {a + b: log(1, a + b) - log(0, a + b) for a in ALPHABET + "?" for b in ALPHABET + "?"}


class Finder:
    """Spans (kind, start, end) in code points, end exclusive."""

    def __init__(self, ratio: dict[str, float], least: float = LEAST_LLR, least_pair: float = LEAST_LLR_PAIR):
        self.ratio, self.least, self.least_pair = ratio, least, least_pair
        self.assign = re.compile(ASSIGN, re.I | re.A)
        # A run is taken whole from its first character, so that the least length can stand in the pattern.
        self.access = re.compile(r"AKIA[A-Z0-9]{%d,}" % (LEAST["access"] - 4))
        self.hex = re.compile(r"[0-9a-f]{%d,}" % LEAST["hex"])
        self.candidate = re.compile(CANDIDATE)
        self.part = re.compile(r"[A-Za-z0-9]{%d,}" % LEAST_STRETCH)

    def base(self, text: str) -> list[tuple[str, int, int]]:
        found = [("assign", *m.span()) for m in self.assign.finditer(text) if len(m[2]) >= LEAST["assign"]] if ":" in text or "=" in text else []
        found += [("access", *m.span()) for m in self.access.finditer(text)] if "AKIA" in text else []
        found += [("hex", *m.span()) for m in self.hex.finditer(text)]
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))

    def llr(self, s: str) -> float:
        get = self.ratio.get
        return sum(get(s[i : i + 2], 0.0) for i in range(len(s) - 1))

    def passes(self, s: str) -> bool:
        return (x := self.llr(s)) >= self.least and x >= self.least_pair * (len(s) - 1)

    def stretches(self, s: str) -> list[tuple[int, int]]:
        """The maximal stretches of s whose pairs score above the least for a pair, by Ruzzo and Tompa, and that pass."""
        get, total = self.ratio.get, 0.0
        # (start, end, sum before, sum behind, the nearest earlier one with a lower sum before it)
        held: list[tuple[int, int, float, float, int]] = []
        for i in range(len(s) - 1):
            x = get(s[i : i + 2], 0.0) - self.least_pair
            start, before, total = i, total, total + x
            if x <= 0:
                continue
            j = len(held) - 1
            while True:
                while j >= 0 and held[j][2] >= before:
                    j = held[j][4]
                if j < 0 or held[j][3] >= total:
                    break
                start, before, earlier = held[j][0], held[j][2], held[j][4]
                del held[j:]
                j = earlier
            held.append((start, i + 2, before, total, j))
        return [(a, b) for a, b, *_ in held if self.passes(s[a:b])]

    def left(self, start: int, end: int, base: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """What the base spans leave over of a candidate."""
        for s, e in base:
            if start < min(s, end):
                yield start, min(s, end)
            start = max(start, e)
        if start < end:
            yield start, end

    def added(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        out, starts, furthest = [], [s for _, s, _ in base], list(itertools.accumulate((e for *_, e in base), max))
        for m in self.candidate.finditer(text):
            start, end = m.span()
            # The base spans that overlap: they begin before the end, and one of them or before reaches behind the start.
            low, high = bisect.bisect_right(furthest, start), bisect.bisect_left(starts, end)
            for a, b in self.left(start, end, [x[1:] for x in base[low:high]]):
                if self.passes(text[a:b]):
                    out.append(("markov", a, b))
                    continue
                parts = [p for m in self.part.finditer(text, a, b) if self.passes(m[0]) for p in [m.span()]]
                end_of = a
                for x, y in sorted([*parts, *(self.whole(text, a, b, a + x, a + y) for x, y in self.stretches(text[a:b]))]):
                    # A base span beside it is a part of the string.
                    if y - x < LEAST_STRETCH and not (x == a > start or y == b < end):
                        continue
                    if out and x < end_of:
                        out[-1] = ("markov", out[-1][1], max(y, end_of))
                    else:
                        out.append(("markov", x, y))
                    end_of = out[-1][2]
        return out

    def whole(self, text: str, a: int, b: int, x: int, y: int) -> tuple[int, int]:
        """The stretch (x, y) of the piece (a, b), its ends moved to the next mark if that is near."""
        p, q = x, y
        while p > a and x - p <= NEAR and text[p - 1] not in MARKS:
            p -= 1
        while q < b and q - y <= NEAR and text[q] not in MARKS:
            q += 1
        return p if x - p <= NEAR else x, q if q - y <= NEAR else y


def scan(docs: DataFrame, ratio: dict[str, float] | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and spans: array of (kind, start, end) with the base spans and those that the model adds, by start, then kind.

    A null text is read as empty; an empty text has no spans. Each row, with or without an id, stands for
    itself, so repeated rows give repeated results; an empty table gives an empty result. Texts of any
    length are read whole. ratio: from train(); by default from default_samples().
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(ratio or train(default_samples(spark)))

    def make():
        finder = Finder(sent.value)

        def f(texts):
            kinds = [[], [], []]
            for t in texts:
                base = finder.base(t or "")
                spans = sorted(base + finder.added(t or "", base), key=lambda s: (s[1], KINDS.index(s[0])))
                for i in range(3):
                    kinds[i].append([KINDS.index(s[0]) if not i else s[i] for s in spans])
            return kinds

        return f

    longs = T.ArrayType(T.LongType())
    found = map_text(docs, make, [("kind", longs), ("start", longs), ("end", longs)], text, (doc_id,))
    named = F.transform("kind", lambda k: F.get(F.array(*map(F.lit, KINDS)), k.cast("int")))
    return found.select(doc_id, F.arrays_zip(named.alias("kind"), "start", "end").alias("spans"))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts by base kind, the SHA-256 of the base spans, and all spans, each span as kind:start:end."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(doc_id, *map(count, KINDS[:3]), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"), count("markov"))
