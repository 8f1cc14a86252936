"""Toxicity by a weighted finite-state pattern grammar.

Words and marks are mapped to classes (insult, threat, target, negation, reporting verb, conjunction,
quotation mark, pause, end). Small transducers read the classes: negation and reported speech say in which
scope a word stands, up to the end of the clause, insult and threat note what a clause says in it, target
notes whom. Quotation holds what a quoted passage says until a reporting verb before or behind it tells
whose words they are. Their composition is one transducer over clauses, made state by state as texts need
it; it emits the kind of each clause that matched. A document's score is a logistic function of its matched
clauses, so that a listed word weighs by the clause it stands in.

Below are listed a few insults and threats, and all targets, negations, reporting verbs and conjunctions.
Further stems of insults and threats, and the weights of clause kinds, are learned from labelled documents
that aren't held out: a learned stem is a threat's if whom it is for mostly stands behind it. A stem stands
for every word that begins with it, so that an inflected form needn't have been seen.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, keep, map_text, slices, small

#: Labelled documents that stems and weights are fitted on, about; lengths of stems (a word of any length matches by its beginning).
SAMPLE_DOCS = 8_000
SHORTEST, LONGEST = 3, 32
#: A stem is learned if it is in so many different toxic texts and in this share of them (near copies counting once), and its log-odds reach this.
LEAST_TEXTS, LEAST_SHARE, LEAST_LOG_ODDS = 4, 0.03, 3.5
#: A stem gives way to a longer one that has this share of its toxic texts.
SAME_STEM = 0.95
THRESHOLD = 0.3

#: A learned stem is a threat's if in this share of its toxic texts a target follows it.
THREAT_SHARE = 0.6

OTHER, INSULT, THREAT, TARGET, OBJECT, OWNER, NEGATION, REPORT, SOFT, QUOTE, PAUSE, END, BREAK, JOIN, TURN, FILLER = range(16)
WORDS = {
    INSULT: "idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic disgusting imbecile dumbass bastard vermin dummkopf arschloch abschaum imbécile connard ordure crétin estúpido imbécil basura escoria",
    THREAT: "hurt hurts hurting shoot shoots shooting shot beat beats beating beaten töten tötet töte umbringen verprügeln tuer tuerai frapper frapperai égorger matar mataré golpear destruir",
    TARGET: "you yourself u he she they him her them these those du ihr sie tu toi vous ils elles tú ti usted ustedes ellos ellas",
    OBJECT: "dich dir euch ihn te",
    OWNER: "your yours dein deine euer eure votre tes vuestro tus",
    NEGATION: "not no never isn't aren't wasn't weren't don't doesn't didn't won't wouldn't can't couldn't nobody nicht kein keine nie niemals jamais aucun nunca jamás tampoco",
    REPORT: "said says told tells called wrote writes claimed quoted reported shouted sagte schrieb nannte behauptete dit disait écrivait appelait dijo escribió llamó afirmó",
    SOFT: "kindness laughter laughing tickles freundlichkeit gentillesse amabilidad",
    QUOTE: '" “ ” „ « »',
    PAUSE: ", :",
    END: ". ! ? ;",
    JOIN: "and und et y or oder ou",
    TURN: "but because although though aber denn weil obwohl mais car parce pero porque aunque",
    FILLER: "up down all both of out the hell every each one",
}
#: English verbs of threats that are inflected by rule, and their endings.
REGULAR, ENDINGS = "kill murder destroy strangl stabb punch slaughter", ("", "e", "s", "es", "ed", "ing")
#: Words between a threat and whom it is for, fillers not counted, or between a reporting verb and the pause of direct speech.
NEAR = 2
#: Kinds of clauses, and the weights before any document is seen.
CLAUSES = ("plain", "targeted", "negated", "reported", "threat")
PRIOR = np.array([3.0, 3.5, 1.0, 1.0, 2.5])
PRIOR_VARIANCE = 4.0

_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
#: A passage in single quotation marks; apostrophes within words aren't any.
_SINGLE = re.compile(r"(?<![^\W_])'(?=\S)([^'\n]*(?:(?<=[^\W_])'(?=[^\W_])[^'\n]*)*)'(?![^\W_])")
_TOKEN = re.compile(_WORD.pattern + r'|[.!?;:,\n"“”„«»]')

#: Of two mentions the stronger one counts, and of two clauses within one quotation.
MODES = {None: 0, "negated": 1, "reported": 2, "plain": 3}
KINDS = {None: 0, "negated": 1, "reported": 2, "threat": 3, "plain": 4, "targeted": 5}


def countdown(left: int, on: bool, reach: int) -> int:
    """How many more words a scope reaches: a word that opens it sets it, others use it up."""
    return reach if on else max(0, left - 1)


class Negation(NamedTuple):
    """Reaches to the clause's end: a pause or end, a word that turns against it, or `and` with a subject of its own."""

    on: bool = False
    joined: bool = False

    def word(self, c: int) -> Negation:
        ended = c == TURN or (self.joined and c == TARGET)
        return Negation(c == NEGATION or (self.on and not ended), c == JOIN)


class Reporting(NamedTuple):
    """A reporting verb reaches to the clause's end; a pause right behind it, as before direct speech, makes it reach to the sentence's end. since: words behind the verb, as far as they are counted."""

    on: bool = False
    joined: bool = False
    since: int = 0
    held: bool = False

    def word(self, c: int) -> Reporting:
        ended = c == TURN or (self.joined and c == TARGET)
        return Reporting(c == REPORT or (self.on and not ended), c == JOIN, 0 if c == REPORT else min(self.since + 1, NEAR + 1), self.held)

    def pause(self) -> Reporting:
        return Reporting(held=self.held or (self.on and self.since <= NEAR))


class Insult(NamedTuple):
    """The strongest mention of the clause and whether the clause names a target."""

    mode: str | None = None
    target: bool = False

    def word(self, c: int, mode: str) -> Insult:
        return Insult(max(self.mode, mode, key=MODES.get) if c == INSULT else self.mode, self.target or c in (TARGET, OBJECT, OWNER))


class Threat(NamedTuple):
    """A threat counts if whom it is for stands right behind the verb, or as an object right before it; a softening word takes it back."""

    mode: str | None = None
    armed: str | None = None
    left: int = 0
    object_left: int = 0

    def word(self, c: int, mode: str) -> Threat:
        if c == SOFT:
            return Threat()
        before = countdown(self.object_left, c == OBJECT, NEAR + 1)
        if c == THREAT:
            return Threat(max(self.mode, mode, key=MODES.get), None, 0, before) if self.object_left else Threat(self.mode, mode, NEAR, before)
        if self.armed and c in (TARGET, OBJECT):
            return Threat(max(self.mode, self.armed, key=MODES.get), None, 0, before)
        left = self.left if c == FILLER else max(0, self.left - 1)
        return Threat(self.mode, self.armed if left else None, left, before)


class Quotation(NamedTuple):
    """place: out, own (a quotation without a reporting verb before it), reported, or behind (an own one, to the clause's end). pending: the strongest clause of an own one."""

    place: str = "out"
    pending: str | None = None


class State(NamedTuple):
    negation: Negation = Negation()
    reporting: Reporting = Reporting()
    insult: Insult = Insult()
    threat: Threat = Threat()
    quotation: Quotation = Quotation()

    def clause(self) -> str | None:
        """The kind of the clause so far."""
        if self.insult.mode == "plain":
            return "targeted" if self.insult.target else "plain"
        if self.threat.mode == "plain":
            return "threat"
        return max(self.insult.mode, self.threat.mode, key=MODES.get)


def strongest(a: str | None, b: str | None) -> str | None:
    return max(a, b, key=KINDS.get)


@functools.lru_cache(maxsize=200_000)
def step(state: State, c: int) -> tuple[State, str | None]:
    """The composition's next state and the kind of clause that it emits, if any."""
    q, rest, reported = state.quotation, State(), state.reporting.on or state.reporting.held
    if c == BREAK:
        return rest, strongest(q.pending, state.clause())
    if c == QUOTE:
        said = state.clause()
        if q.place == "own":
            # What was quoted waits for a reporting verb behind it.
            pending = strongest(q.pending, said)
            return rest._replace(quotation=Quotation("behind", pending) if pending else Quotation()), None
        if q.place == "reported":
            return rest, said
        return rest._replace(quotation=Quotation("reported" if reported else "own")), strongest(q.pending, said)
    if c in (PAUSE, END):
        kept = rest._replace(reporting=state.reporting.pause() if c == PAUSE else Reporting(), quotation=q)
        if q.place == "own":
            return kept._replace(quotation=q._replace(pending=strongest(q.pending, state.clause()))), None
        if q.place == "behind":
            return (state, None) if c == PAUSE else (rest, strongest(q.pending, state.clause()))
        return kept, state.clause()
    said = None
    if q.place == "behind" and c == REPORT:
        said, q = ("reported" if q.pending != "negated" else "negated"), Quotation()
    mode = "negated" if state.negation.on else "reported" if reported or q.place == "reported" else "plain"
    return State(state.negation.word(c), state.reporting.word(c), state.insult.word(c, mode), state.threat.word(c, mode), q), said


class Stems:
    """Stems, of SHORTEST characters at least, and whether a word begins with one."""

    def __init__(self, stems):
        self.by_start: dict[str, tuple[str, ...]] = {}
        for stem in stems:
            self.by_start[stem[:SHORTEST]] = (*self.by_start.get(stem[:SHORTEST], ()), stem)

    def among(self, words: set[str]) -> set[str]:
        return {w for w in words if w[:SHORTEST] in self.by_start and w.startswith(self.by_start[w[:SHORTEST]])}


def plain_marks(text: str) -> str:
    """Lower case, apostrophes straight, and single quotation marks double."""
    low = text.lower().replace("’", "'").replace("‘", "'")
    return _SINGLE.sub(r'"\1"', low) if "'" in low else low


class Grammar:
    """insults, threats: learned stems."""

    def __init__(self, insults, threats=()):
        self.classes = {w: c for c, listed in WORDS.items() for w in listed.split()} | {w + e: THREAT for w in REGULAR.split() for e in ENDINGS} | {"stab": THREAT, "stabs": THREAT, "\n": BREAK}
        self.hot = frozenset(w for w, c in self.classes.items() if c in (INSULT, THREAT))
        # Words of the grammar stay what they are, even if they are learned with what stands beside them.
        self.given = frozenset(self.classes) - self.hot
        self.insults, self.threats = Stems(insults), Stems(threats)

    def clauses(self, text: str | None) -> list[int]:
        """How many clauses of each kind the text has."""
        found = dict.fromkeys(CLAUSES, 0)
        if not text:
            return [*found.values()]
        low = plain_marks(text)
        seen = set(_WORD.findall(low)) - self.given
        learned = dict.fromkeys(self.threats.among(seen), THREAT) | dict.fromkeys(self.insults.among(seen), INSULT)
        if not learned and self.hot.isdisjoint(seen):
            return [*found.values()]
        state, get = State(), (self.classes | learned).get
        for token in (*_TOKEN.findall(low), "\n"):
            state, kind = step(state, get(token, OTHER))
            if kind:
                found[kind] += 1
        return [*found.values()]

    def followed(self, text: str | None) -> tuple[set[str], set[str]]:
        """The learned stems that the text has, and those with a target among the NEAR words behind them or as an object before."""
        tokens = [t for t in _TOKEN.findall(plain_marks(text or "")) if self.classes.get(t) != FILLER]
        seen, aimed = set(), set()
        for i, t in enumerate(tokens):
            for stem in self.insults.by_start.get(t[:SHORTEST], ()):
                if t.startswith(stem):
                    seen.add(stem)
                    behind = [self.classes.get(x) for x in tokens[i + 1 : i + 1 + NEAR]]
                    if {TARGET, OBJECT} & set(behind) or (i and self.classes.get(tokens[i - 1]) == OBJECT):
                        aimed.add(stem)
        return seen, aimed


@dataclass(frozen=True)
class Model:
    insults: tuple[str, ...]
    bias: float
    weights: tuple[float, ...]
    threats: tuple[str, ...] = ()


def learning_rows(docs: DataFrame, labels: DataFrame, sample_docs: int, doc_id: str, text: str, label: str) -> DataFrame:
    """(doc_id, text, toxic) of about sample_docs labelled documents that aren't held out. Of several labels of one document the highest counts."""
    usable = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id)).groupBy(doc_id).agg(F.max(label).alias("toxic"))
    share = max(1, usable.count() // sample_docs)
    chosen = keep(usable.where(F.pmod(F.xxhash64(doc_id, F.lit(3)), F.lit(share)) == 0), "labelled")
    return docs.select(doc_id, text).join(small(chosen, chosen.count()), doc_id)


def learn_insults(rows: DataFrame, text: str) -> list[str]:
    """Stems of insults and threats: those whose presence speaks for the label, by log-odds over texts; near copies of a text mostly share its least word hash and count once.

    rows is a sample of bounded size; only stems of enough toxic texts are counted in the others.
    """
    parts = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}']+", -1)
    found = rows.select("toxic", F.array_distinct(parts).alias("w")).withColumn("sig", F.array_min(F.transform("w", lambda x: F.xxhash64(x))))
    sizes = {r.toxic: r.n for r in found.groupBy("toxic").agg(F.countDistinct("sig").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    begins = F.transform(F.filter("w", lambda x: F.length(x) >= SHORTEST), lambda x: F.transform(F.sequence(F.lit(SHORTEST), F.least(F.length(x), F.lit(LONGEST))), lambda i: F.substring(x, F.lit(1), i)))
    texts_of = lambda label: found.where(F.col("toxic") == label).select("sig", F.explode(F.array_distinct(F.flatten(begins))).alias("stem"))
    often = keep(texts_of(1).groupBy("stem").agg(F.countDistinct("sig").alias("n1")).where(F.col("n1") >= max(LEAST_TEXTS, LEAST_SHARE * bad)), "stems")
    others = texts_of(0).join(small(often.select("stem"), often.count()), "stem").groupBy("stem").agg(F.countDistinct("sig").alias("n0"))
    odds = F.log((F.col("n1") + 0.5) / (bad + 1)) - F.log((F.coalesce("n0", F.lit(0)) + 0.5) / (good + 1))
    # Each is in LEAST_SHARE of the sample's toxic texts, so they are no more than a text's beginnings of words over that share.
    top = often.join(others, "stem", "left").where(odds >= LEAST_LOG_ODDS).select("stem", "n1").collect()
    return chosen_stems({r.stem: r.n1 for r in top})


def chosen_stems(texts: dict[str, int]) -> list[str]:
    """Of the stems (with their numbers of texts) those that are neither the beginning of one nearly as frequent, nor begin with a shorter one that is left."""
    longer: dict[str, int] = {}
    for stem, n in texts.items():
        longer[stem[:-1]] = max(n, longer.get(stem[:-1], 0))
    left: list[str] = []
    for stem in sorted((s for s, n in texts.items() if longer.get(s, 0) < SAME_STEM * n), key=lambda s: (len(s), s)):
        if not stem.startswith(tuple(left)):
            left.append(stem)
    return sorted(left, key=lambda s: (-texts[s], s))


def threats_among(rows: DataFrame, stems: list[str], text: str) -> set[str]:
    """The stems that in THREAT_SHARE of their toxic texts have a target behind them; rows is a sample of bounded size."""

    def run(batches):
        grammar = Grammar(stems)
        for batch in batches:
            for part in slices(batch, 0):
                found = [(stem, stem in aimed) for t in part.column(0).to_pylist() for seen, aimed in [grammar.followed(t)] for stem in sorted(seen)]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in ((0, pa.string()), (1, pa.bool_()))], names=["stem", "aimed"])

    if not stems:
        return set()
    counted = rows.where("toxic = 1").select(text).mapInArrow(run, "stem string, aimed boolean").groupBy("stem").agg((F.count_if("aimed") / F.count("*")).alias("share"))
    return {r.stem for r in counted.where(F.col("share") >= THREAT_SHARE).collect()}


def fit(rows: list[tuple[tuple[int, ...], int, int]]) -> tuple[float, tuple[float, ...]]:
    """Logistic regression over (clause counts, label, documents), counts by log2(1 + n), with the prior weights as the mean of a normal prior; bias first."""
    mean = np.concatenate([[-3.0], PRIOR])
    if not rows:
        return float(mean[0]), tuple(PRIOR)
    x = np.array([[1.0, *np.log2(1.0 + np.array(r[0]))] for r in rows])
    y, n = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    w = mean.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (y - p)) - (w - mean) / PRIOR_VARIANCE
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + np.eye(len(w)) / PRIOR_VARIANCE, grad)
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), tuple(map(float, w[1:]))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The driver gets stems and the counts of distinct clause patterns, which are no more than the sample's documents.

    The sample is written to the shared folder once, so that the documents are read once.
    """
    rows = keep(learning_rows(docs, labels, sample_docs, doc_id, text, label), "sample")
    stems = learn_insults(rows, text)
    aimed = threats_among(rows, stems, text)
    insults, threats = tuple(x for x in stems if x not in aimed), tuple(x for x in stems if x in aimed)
    found = clauses(rows, insults, text, ("toxic",), threats)
    patterns = found.groupBy("toxic", *(f"n_{k}" for k in CLAUSES)).count().collect()
    return Model(insults, *fit([(tuple(r[1:-1]), int(r.toxic), r[-1]) for r in patterns]), threats)


def clauses(docs: DataFrame, insults: tuple[str, ...], text: str = "text", carry: tuple[str, ...] = ("doc_id",), threats: tuple[str, ...] = ()) -> DataFrame:
    """The carried columns and n_<kind>: matched clauses of each kind."""

    def make():
        grammar = Grammar(insults, threats)
        return lambda texts: list(zip(*(grammar.clauses(t) for t in texts), strict=True))

    return map_text(docs, make, [(f"n_{k}", T.LongType()) for k in CLAUSES], text, carry)


def score(docs: DataFrame, model: Model, text: str = "text", carry: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """The carried columns, score (0 to 1) and predicted (1 if score >= threshold).

    A null or empty text matches no clause and gets the score of such documents. Each row, repeated ones
    and those without an id too, stands for itself; an empty table gives an empty result. Texts of any
    length are read whole.
    """
    odds = F.lit(model.bias)
    for kind, w in zip(CLAUSES, model.weights, strict=True):
        odds = odds + F.log2(1.0 + F.col(f"n_{kind}")) * w
    scored = clauses(docs, model.insults, text, carry, model.threats).withColumn("score", 1 / (1 + F.exp(-odds)))
    return scored.select(*carry, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
