"""Cases in which an operator or a stage once did less than the whole job."""

import collections
import itertools
import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyline.llm import common, components, decontaminate, neardup, packing, pii, secrets, sharding, toxicity


def test_rows_without_id_keep_their_own_text(spark):
    long = {c: "".join(f"{c}{i} " for i in range(9000)) for c in "ab"}
    texts = [*long.values(), "short one", "short one", "another", None]
    docs = spark.createDataFrame([*((None, t, "s") for t in texts), (1, "named", "s")], "doc_id long, text string, source string")
    found = corpus_pipeline.pack(spark, docs, "").collect()
    cut = [t[i : i + packing.CAPACITY] for t in (*long.values(),) for i in range(0, len(t) + 1, packing.CAPACITY)]
    assert sorted(r.text for r in found) == sorted([*cut, "short one", "short one", "another", "", "named"])
    assert found[0].__fields__ == ["doc_id", "piece", "n_pieces", "start", "length", "bin_id", "offset", "text"]


def test_rows_without_id_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 50)
    docs = spark.createDataFrame([(None, "same text", "s")] * 1000, "doc_id long, text string, source string")
    groups = collections.Counter(r.bin_id % 20 for r in packing.pack(docs).collect())
    assert len(groups) == 20 and max(groups.values()) < 150


def test_rows_without_id_survive_repeats_elsewhere(spark):
    texts = ["one two three four five", "six seven eight nine ten", "a b c d e f"]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(1, "x y z u v w")] * 2, "doc_id long, text string")
    found = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == sorted([*((0, t) for t in texts), (1, "x y z u v w")])


def test_rows_without_id_are_decontaminated(spark, tmp_path):
    item = " ".join(f"w{i}" for i in range(20))
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(None, f"so {item} end"), (None, "clean text"), (None, "other clean"), (1, item), (2, "clean")], "doc_id long, text string")
    found = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert found.columns == ["doc_id", "text"] and sorted(r.text for r in found.collect()) == ["clean", "clean text", "other clean"]


@pytest.mark.parametrize("before", ["/services/incoming/webhooks/customer/default/", "DATABASE_CONNECTION_PASSPHRASE=", "/var/lib/application/configuration/production/environment/credentials/"])
def test_secrets_within_ordinary_runs(spark, before):
    finder, r = secrets.Finder(secrets.train(secrets.default_samples(spark))), random.Random(8)
    for n in (24, 32, 40):
        made = ["".join(r.choices(string.ascii_letters + string.digits, k=n)) for _ in range(200)]
        texts = [f"x {before}{s}/entry y" for s in made]
        found = [finder.added(t, finder.base(t)) for t in texts]
        assert sum(any(a <= t.index(s) and e >= t.index(s) + n for _, a, e in f) for t, s, f in zip(texts, made, found, strict=True)) >= 0.9 * 200
    ordinary = [f"{before}{x.text}" for x in secrets.default_samples(spark, 300, seed=2).where("label = 0").collect()]
    assert sum(bool(finder.added(t, finder.base(t))) for t in ordinary) <= 0.02 * 300


def test_secrets_planted_in_the_corpus(spark):
    """Recall on random strings behind paths and names within the corpus' own texts; spans add little to texts as they are."""
    finder, r = secrets.Finder(secrets.train(secrets.default_samples(spark))), random.Random(17)
    texts = [x.text or "" for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    before, found, n = ["", "https://api.example.com/v1/users/settings/", "config/production/app/user/", "session_identifier_for_customer_account_", "KEY="], 0, 0
    for t in texts:
        word = t.split(" ")
        s, at = "".join(r.choices(string.ascii_letters + string.digits, k=r.choice([26, 32, 40]))), r.randint(0, len(word))
        made = " ".join([*word[:at], r.choice(before) + s, *word[at:]])
        start = made.index(s)
        found += any(a <= start and e >= start + len(s) for _, a, e in finder.added(made, finder.base(made)))
        n += 1
    assert found >= 0.95 * n
    assert sum(bool(finder.added(t, finder.base(t))) for t in texts) <= 0.02 * n


def test_rest_of_a_secret_beside_a_base_span(spark):
    finder = secrets.Finder(secrets.train(secrets.default_samples(spark, 800, seed=1)))
    text = "x 9fK2xQ7bLm0ZtR4vYw8sJdHc3N0123456789abcdef01Qz7XkV3mTp9WbR5yGn2LsD y"
    base = finder.base(text)
    assert [k for k, *_ in base] == ["hex"]
    covered = {i for _, a, e in [*base, *finder.added(text, base)] for i in range(a, e)}
    assert covered == set(range(2, len(text) - 2))


def test_short_items_keep_a_seed_whatever_is_substituted():
    for n in range(6, decontaminate.LONGEST_SHORT + 1):
        picked = [{i + at for i, c in enumerate(m) if c == "1"} for m in decontaminate.masks_of(n) for at in range(n - len(m) + 1)]
        for k in range(n):
            for gone in itertools.combinations(range(n), k):
                item = np.arange(n)
                if decontaminate.stretch(np.where(np.isin(item, gone), -1, item), item)[2] >= decontaminate.least_equal(n):
                    assert any(not p & set(gone) for p in picked), (n, gone)


def test_any_stretch_that_holds_counts(spark):
    """13 equal tokens in a row hold, whatever follows them; so does a short item with equal tokens dealt over it."""
    r = random.Random(3)
    item = [f"i{j}" for j in range(100)]
    mixed = item[:13] + [w if j % 8 >= 3 else f"x{j}" for j, w in enumerate(item[13:93])]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "a b c d e f g h i j")], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(mixed)), (2, "s a b X d e Y g h Z j t"), (3, "s a b X d e Y g W Z j t"), (4, " ".join(r.choices(item, k=200)))], "doc_id long, text string")
    # The first document's whole alignment holds 63 equal of 93 tokens, which is too few alike.
    assert brute_overlaps(mixed, [(1, item)]) == {1: 43}
    assert sorted((x.doc_id, x.item_id, x.n_equal) for x in decontaminate.overlaps(docs, bench).collect()) == [(1, 1, 43), (2, 2, 7)]


def brute_overlaps(doc, items):
    """Every diagonal and every stretch of every item."""
    out = {}
    for name, item in items:
        best = 0
        for shift in range(1 - len(item), len(doc)):
            same = [doc[i + shift] == w for i, w in enumerate(item) if 0 <= i + shift < len(doc)]
            p = [i for i, x in enumerate(same) if x]
            best = max([best, *(j - i + 1 for i in range(len(p)) for j in range(i, len(p)) if 10 * (j - i + 1) >= 7 * (p[j] - p[i] + 1))])
        if best >= decontaminate.least_equal(len(item)):
            out[name] = best
    return out


def test_decontamination_against_brute_force(spark):
    r = random.Random(21)
    vocab = [f"w{i}" for i in range(40)]
    items = [(i, r.choices(vocab, k=r.choice([4, 5, 6, 7, 8, 10, 12, 14, 20, 30]))) for i in range(25)]
    docs = []
    for i in range(120):
        w = r.choices(vocab, k=r.randint(0, 60))
        if i % 2:
            _, item = r.choice(items)
            w[r.randint(0, len(w)) : 0] = [x if r.random() > 0.15 else "zz" for x in item]
        docs.append((i, w))
    found = decontaminate.overlaps(*(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], f"{n} long, text string") for rows, n in ((docs, "doc_id"), (items, "item_id"))))
    got = {(x.doc_id, x.item_id): x.n_equal for x in found.collect()}
    want = {(i, name): n for i, w in docs for name, n in brute_overlaps(w, items).items()}
    # Nothing is found that brute force doesn't find; short items have a seed for all, longer ones for nearly all.
    assert set(got) <= set(want) and all(got[k] <= want[k] for k in got)
    assert {k for k in want if len(items[k[1]][1]) <= decontaminate.LONGEST_SHORT} <= set(got) and len(got) >= 0.97 * len(want)


def test_all_alignments_of_the_corpus(spark):
    """Documents with a benchmark passage on sf0.001, held against all alignments of all items by numpy."""
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    split = lambda d, i: {r[0]: np.array(r[1]) for r in d.select(i, decontaminate.tokens(F.col("text"))).collect()}
    texts, items, want = split(docs, "doc_id"), split(bench, "item_id"), set()
    for name, item in items.items():
        need = decontaminate.least_equal(len(item))
        for i, doc in texts.items():
            x, y = np.nonzero(doc[:, None] == item[None, :])
            shifts, n = np.unique(x - y, return_counts=True)
            if decontaminate.best_passage(doc, item, shifts[n >= need]):
                want.add((i, name))
    assert {(x.doc_id, x.item_id) for x in decontaminate.overlaps(docs, bench).collect()} == want and want


def test_repeated_tokens_stay_linear(spark):
    """Two texts of one repeated word and an item of it: one pair with few hits, not a row for each pair of windows."""
    bench = spark.createDataFrame([(1, "word " * 60)], "item_id long, text string")
    docs = spark.createDataFrame([(i, "word " * 3000) for i in range(2)], "doc_id long, text string")
    assert sorted((x.doc_id, x.n_equal) for x in decontaminate.overlaps(docs, bench).collect()) == [(0, 60), (1, 60)]
    masks = decontaminate.masks_for([])
    hits = decontaminate.training_hits(docs.select("doc_id", decontaminate.tokens(F.col("text")).alias("tokens")), tuple(m for m, _ in masks), None).collect()
    assert [len(h.seed) for h in hits] == [len(masks)] * 2


def test_short_and_unspaced_items(spark):
    r = random.Random(2)
    vocab, han = [f"v{i}" for i in range(5000)], [chr(c) for c in range(0x4E00, 0x5E00)]
    noise = lambda: " ".join(r.choices(vocab, k=30))
    items = [r.choices(vocab, k=n) for n in (4, 5, 6, 7, 8, 9, 10, 12)]
    edited = [[*w[:3], "edited", *w[4:]] for w in items]
    chinese = "".join(r.choices(han, k=20))
    bench = spark.createDataFrame([*((i, " ".join(w)) for i, w in enumerate(items)), (20, chinese)], "item_id long, text string")
    texts = [f"{noise()} {' '.join(w)} {noise()}" for w in (*items, *edited)] + ["".join(r.choices(han, k=30)) + chinese[:9] + "\u4e00" + chinese[10:] + "".join(r.choices(han, k=30))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((x.doc_id, x.item_id) for x in decontaminate.overlaps(docs, bench).collect())
    assert found == [*((i, i) for i in range(8)), *((8 + i, i) for i in range(2, 8)), (16, 20)]


def test_every_iban_of_a_spaced_list():
    one, two = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    for text in (f"{one} {two}", f"{two} {one} {two} END", f"AB12 {one} {two}", f"AB12 CDEF GHIJ KLMN {two}"):
        new, n = pii.Redactor(b"k").redact(text)
        assert n["iban"] == text.count(one) + text.count(two) and one not in new and two not in new


def test_groups_count_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 50)
    docs = spark.createDataFrame([(i, "x" * 10_000, "s") for i in range(10)], "doc_id long, text string, source string")
    found = packing.pack(docs, capacity=100).collect()
    # 10 documents of 101 pieces; full pieces have bins of their own.
    assert len(found) == 1010 and len({r.bin_id % 20 for r in found}) == 20
    full = [r.bin_id for r in found if r.length == 100]
    assert len(set(full)) == len(full) == 1000


def test_a_million_characters_without_a_mark(spark):
    """Random strings within one run of ordinary words without a mark, which is read in linear time."""
    finder, r = secrets.Finder(secrets.train(secrets.default_samples(spark))), random.Random(4)
    made, parts = [], []
    for _ in range(2_500):
        made.append("".join(r.choices(string.ascii_letters + string.digits, k=36)))
        parts += [made[-1], "".join(r.choices(secrets.IDENTIFIER_WORDS, k=50))]
    text = "".join(parts)
    spans = finder.added(text, finder.base(text))
    covered = np.zeros(len(text) + 1, int)
    for _, a, e in spans:
        covered[a] += 1
        covered[e] -= 1
    covered, at, found = np.cumsum(covered), 0, 0
    for i, p in enumerate(parts):
        found += i % 2 == 0 and covered[at : at + len(p)].mean() > 0.75
        at += len(p)
    assert len(text) > 750_000 and found >= 0.95 * len(made)


@pytest.mark.parametrize("n", range(13, 31))
def test_recall_of_masks_by_item_length(n):
    """Items of n tokens with as many substituted as verification accepts, at random places: nearly all have a seed, those of 13 to 18 tokens all."""
    r, masks = np.random.default_rng(n), decontaminate.long_masks()
    held = found = 0
    while held < 1_000:
        k = min(n - decontaminate.least_equal(n), int(n * (1 - decontaminate.LEAST_SHARE) + 1e-9))
        same = np.ones(n, bool)
        same[r.choice(n, k, replace=False)] = False
        if decontaminate.stretch(np.where(same, 1, 2), np.ones(n, int))[2] < decontaminate.least_equal(n):
            continue
        held += 1
        found += any(all(same[at + i] for i, c in enumerate(m) if c == "1") for m in masks for at in range(n - len(m) + 1))
    assert found >= (1 if n <= 18 else 0.99) * held


def test_a_million_equal_tokens():
    """A text of one repeated token and an item of it: pairs of places are taken in tiles, and the search ends with the first whole match."""
    doc, item = np.full(1_000_000, 7), np.full(300, 7)
    shifts = decontaminate.diagonals_of(np.arange(999_990), np.arange(290))
    assert len(shifts) == 999_990 + 289 and decontaminate.best_passage(doc, item, shifts) == (999_700, 1_000_000, 300, 1.0)


def test_best_passage_against_every_diagonal():
    r = np.random.default_rng(12)
    for _ in range(300):
        doc, item = r.integers(0, 4, r.integers(1, 60)), r.integers(0, 4, r.integers(4, 25))
        shifts, best = np.arange(1 - len(item), len(doc)), None
        for s in shifts.tolist():
            lo, hi = max(0, s), min(len(doc), s + len(item))
            a, b, equal = decontaminate.stretch(doc[lo:hi], item[lo - s : hi - s])
            if equal and equal >= decontaminate.least_equal(len(item)):
                best = max(best or (0,), (equal, equal / (b - a), lo + a, lo + b))
        assert decontaminate.best_passage(doc, item, shifts) == (best and (best[2], best[3], best[0], best[1]))


def test_bins_do_not_depend_on_the_layout(spark, monkeypatch):
    """Repeated rows, equal ids with other texts and rows without an id: the same bins however the rows lie, and groups of bounded size."""
    monkeypatch.setattr(packing, "GROUP_ROWS", 40)
    rows = [*((i, f"text {i} " * (i % 50), f"s{i % 7}") for i in range(300)), *((5, "same text", "s1") for _ in range(200)), *((None, f"t{i % 3}", None) for i in range(60)), *((9, f"other {i}", "s2") for i in range(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda r: tuple((x is None, x) for x in r)
    one, two = (sorted(map(tuple, packing.pack(docs.repartition(n), capacity=300).collect()), key=key) for n in (1, 7))
    assert one == two and len(one) >= 600
    groups = len(one) // 40
    assert max(collections.Counter(r[5] % groups for r in one).values()) < 3 * 40


def test_many_rows_of_one_id_are_dealt_to_all_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 50)
    monkeypatch.setattr(common, "COPIES", 100)
    rows = [*((7, "same text", "a") for _ in range(900)), *((7, f"text {i}", "a") for i in range(300)), *((i, "x", "b") for i in range(300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda r: tuple((x is None, x) for x in r)
    one, two = (sorted(map(tuple, sharding.interleave(docs.repartition(n)).collect()), key=key) for n in (2, 5))
    assert one == two and len(one) == 1500
    placed = collections.defaultdict(list)
    for r in one:
        placed[r[5]].append(r)
    assert {len(g) for g in placed.values()} <= {62, 63} and all(abs(sum(x[1] == "b" for x in g) - 12.5) <= 2 for g in placed.values())
    for sizes in ({"a": 950, "b": 3, "c": 100}, {"a": 100, "b": 2}, {"a": 1, "b": 1}):
        counts = common.told_apart(spark.createDataFrame(list(sizes.items()), "v string, k long"), "k", "i", max(sizes.values())).collect()
        assert sorted((r.v, r.i) for r in counts) == sorted((v, i) for v, k in sizes.items() for i in range(k))


# ---- numbers behind other numbers, against an independent reading


def luhn_sum(digits):
    doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def planted_numbers(r, n):
    """(kind, value, text): a valid card, social security or phone number behind and before other numbers."""
    digits = lambda k: "".join(r.choices("0123456789", k=k))
    for _ in range(n):
        body = r.choice("3456") + digits(14)
        card = next(body + c for c in "0123456789" if not luhn_sum(body + c))
        mark = r.choice(" -")
        value = {
            "card": r.choice([card, mark.join(card[i : i + 4] for i in range(0, 16, 4))]),
            "ssn": f"{r.randint(1, 665):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}",
            "phone": r.choice(["{}-{}-{}", "{}.{}.{}", "({}) {}-{}"]).format(r.randint(200, 999), r.randint(200, 999), digits(4)),
        }
        kind = r.choice(sorted(value))
        before = r.choice(["paid in 2023", "Room 0201", f"{digits(4)}", f"{digits(2)}", f"{digits(3)} {digits(4)}", f"id {digits(4)} {digits(4)}", f"0{digits(3)}", "on 2020-01-02 at 12"])
        yield kind, value[kind], f"a {before} {value[kind]}{r.choice(['', ' 2024', f' {digits(4)} {digits(4)}', ', 12'])} end"


def test_numbers_behind_other_numbers():
    r, redactor = random.Random(31), pii.Redactor(b"k")
    for kind, value, text in planted_numbers(r, 4_000):
        new, counts = redactor.redact(text)
        assert value not in new, text
        assert len(re.sub(r"\D", "", new)) == len(re.sub(r"\D", "", text)) and sum(counts.values())
        if kind == "card":
            # No group of the card stays where it was but by chance, and what stands for a card is one.
            at = text.index(value)
            assert new[at : at + len(value)][-4:] != value[-4:] or new[at : at + len(value)][-9:-5] != value[-9:-5], text
    for text in ("paid in 2023 4111 1111 1111 1111", "1201 4111 1111 1111 1111", "Room 0201 555-123-4567"):
        assert not any(x in redactor.redact(text)[0] for x in ("1111 1111", "555-123"))


@pytest.mark.parametrize("kind, size", [("card", 16), ("ssn", 9), ("phone", 10)])
def test_pseudonyms_are_permutations(kind, size):
    """Distinct valid numbers have distinct valid pseudonyms in the same layout, which the key takes back by an independent Feistel walk."""
    r, p = random.Random(size), pii.Permuter(b"k")
    made, valid = {}, {"card": lambda d: not luhn_sum(d), "ssn": lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000", "phone": lambda d: True}[kind]
    while len(made) < 500:
        d = "".join(r.choices("123456789", k=size))
        if valid(d):
            made[d] = re.sub(r"\D", "", getattr(p, kind)(d if kind == "card" else f"{d[:3]}-{d[3:5]}-{d[5:]}" if kind == "ssn" else f"{d[:3]}-{d[3:6]}-{d[6:]}"))
    assert len(set(made.values())) == 500 and all(valid(x) and len(x) == size for x in made.values())
    for old, new in list(made.items())[:50]:
        tweak, cut = {"card": ("card", 15), "ssn": ("ssn", 9), "phone": ("phone10", 10)}[kind]
        back = int(new[:cut])
        while True:
            back = p.number(back, 10**cut, tweak, back=True)
            if kind != "ssn" or valid(f"{back:09d}"):
                break
        assert f"{back:0{cut}d}" == old[:cut]


# ---- scopes, threats and quotations


@pytest.mark.parametrize("text, kinds", [
    ("He told me that you are an idiot", ["reported"]), ("I would never ever in my life hurt you", ["negated"]), ("I am killing you", ["threat"]), ("They shot him", ["threat"]), ("I will beat you up", ["threat"]),
    ("You're no idiot", ["negated"]), ("he said 'you idiot' to me", ["reported"]), ("'You are an idiot', said the man.", ["reported"]), ("I don't care but you are an idiot", ["targeted"]), ("He is not here and you are an idiot", ["targeted"]),
    ("I would never hurt or kill you", ["negated"]), ("kill all of you", ["threat"]), ("beat the hell out of you", ["threat"]), ("a stable for you", []), ("the dogs' idiot", ["plain"]), ('"You idiot" the man who stood over there by the door said.', ["reported"]),
    ("not one of the many people who were in the house that day was an idiot", ["negated"]),
])
def test_scopes_reach_to_the_clause_end(text, kinds):
    found = dict(zip(toxicity.CLAUSES, toxicity.Grammar([]).clauses(text), strict=True))
    assert [k for k, n in found.items() for _ in range(n)] == kinds


def test_threats_are_learned_by_whom_they_are_for(spark):
    r = random.Random(2)
    prose = ["".join(r.choices("abcdefghijklmnoprstuv", k=7)) for _ in range(2000)]
    said = ["I will grobble you now.", "We grobbled them all.", "a zwulfer is here.", "what zwulfish house."]
    rows = [(i, " ".join(r.choices(prose, k=30)) + (f". {said[i // 4 % 4]}" if i % 4 == 0 else f". {' '.join(r.sample('what will we see here now all of you a house is with them'.split(), 6))}"), int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.drop("text"))
    assert len(model.threats) == len(model.insults) == 1 and "grobble".startswith(model.threats[0]) and "zwulf".startswith(model.insults[0])
    grammar = toxicity.Grammar(model.insults, model.threats)
    kinds = lambda t: [k for k, n in zip(toxicity.CLAUSES, grammar.clauses(t), strict=True) if n]
    assert kinds("grobbles you") == ["threat"] and kinds("grobble the process") == [] and kinds("you zwulf") == ["targeted"]


def brute_stretches(scores):
    """Maximal scoring stretches by their definition: the best stretch of all, then those to its left and to its right."""
    best = max(((sum(scores[a:b]), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0), key=lambda x: (x[0], -x[1], x[2]))
    if best[0] <= 0:
        return []
    _, a, b = best
    return [*brute_stretches(scores[:a]), (a, b), *((a2 + b, b2 + b) for a2, b2 in brute_stretches(scores[b:]))]


def test_markov_spans_against_brute_force(spark):
    """The ratio of pairs by counting, the maximal stretches by their definition, and whole runs that pass."""
    samples = secrets.default_samples(spark, 200, seed=6)
    rows, n = [(x.text, x.label) for x in samples.collect()], len(secrets.ALPHABET) + 1
    pairs = {label: collections.Counter(t[i : i + 2] for t, y in rows if y == label for i in range(len(t) - 1)) for label in (0, 1)}
    firsts = {label: collections.Counter(p[0] for p in c.elements()) for label, c in pairs.items()}
    odds = lambda label, p: (pairs[label][p] + 0.5) / (firsts[label][p[0]] + 0.5 * n)
    ratio = secrets.train(samples)
    assert all(abs(ratio[a + b] - np.log(odds(1, a + b) / odds(0, a + b))) < 1e-9 for a in secrets.ALPHABET for b in secrets.ALPHABET)
    finder, r = secrets.Finder(ratio), random.Random(3)
    for _ in range(150):
        s = "".join(r.choice([r.choice(secrets.IDENTIFIER_WORDS), "".join(r.choices(string.ascii_letters + string.digits, k=r.randint(1, 12))), r.choice("/_-")]) for _ in range(6))
        scores = [ratio[s[i : i + 2]] - finder.least_pair for i in range(len(s) - 1)]
        want = [(a, b + 1) for a, b in brute_stretches(scores) if sum(ratio[s[i : i + 2]] for i in range(a, b)) >= max(finder.least, finder.least_pair * (b - a))]
        assert finder.stretches(s) == want, s
        if len(s) >= 20 and re.fullmatch(r"[A-Za-z0-9+/_=-]+", s) and not finder.base(s) and sum(ratio[s[i : i + 2]] for i in range(len(s) - 1)) >= max(finder.least, finder.least_pair * (len(s) - 1)):
            assert finder.added(f"a {s} b", []) == [("markov", 2, 2 + len(s))]


@pytest.mark.parametrize("few", [-1, common.FEW_ROWS])
def test_values_are_joined_alike_by_either_way(spark, monkeypatch, few):
    """Whether values are broadcast whole or by hot keys and the rest, joins, components and near duplicates are the same."""
    monkeypatch.setattr(common, "FEW_ROWS", few)
    monkeypatch.setattr(common, "LEAST_HOT", 20)
    rows = spark.createDataFrame([(i % 7 if i % 3 else 100, i) for i in range(300)] + [(999, 1), (None, 2)], "k long, x long")
    values = rows.groupBy("k").agg(F.count("*").alias("_m"), F.max("x").alias("v")).where("k < 500")
    got = sorted(map(tuple, common.looked_up(rows, values, "k", 302).select("k", "x", "v").collect()))
    top = {}
    for i in range(300):
        top[i % 7 if i % 3 else 100] = i
    assert got == sorted((i % 7 if i % 3 else 100, i, top[i % 7 if i % 3 else 100]) for i in range(300))
    r = random.Random(8)
    links = [(i, r.randrange(i)) for i in r.sample(range(1, 200), 120)] + [(300, i) for i in range(301, 360)]
    found = {x.node: x.root for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {n: n for e in links for n in e}
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert found == root
    words = [f"w{i}" for i in range(200)]
    base = [r.choices(words, k=60) for _ in range(8)]
    texts = [" ".join([*b[:at], r.choice(words), *b[at + 1 :]]) for b in base for at in r.choices(range(60), k=15)] + ["alone in the world"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(t.split()[i : i + 2]) for i in range(len(t.split()) - 1)} for t in texts]
    root = list(range(len(texts)))
    for _ in range(6):
        for i in range(len(texts)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    assert {x.doc_id: x.component_id for x in neardup.near_duplicates(docs).collect()} == dict(enumerate(root))
