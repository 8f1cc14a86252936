"""Spelling variants, the quality classifier and ranked search against brute force, with nulls, empty texts, ties, repeats and clashing columns."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import classifier, queries, search, spelling

SF = "/root/testdata/sf0.001"
#: Column names that the operators use themselves.
CLASH = {"word": "a", "score": "b", "n": "c", "terms": "d", "root": "e", "key": "f", "w": "g", "rank": "h"}
EDGES = [None, "", "   \n", "One", "!!! ???", "日本語 text é ü", "word " * 400, "é" * 5000, "alphabet alphabet Alphabet"]


def table(spark, rows):
    """(doc_id, text) rows with columns of clashing names."""
    return spark.createDataFrame([(i, t, *CLASH.values()) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASH))


# ---- spelling variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    """Every word against every other one."""
    n = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            n[low if h % 31 else low[: h % len(low)] + low[h % len(low) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    around = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, some in around.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None)
    return out


def found_variants(docs):
    rows = spelling.variants(docs).collect()
    assert rows == [] or rows[0].__fields__ == ["word", "form", "root", "n", "n_near", "form_n"]
    return {r.word: tuple(r)[1:] for r in rows}


def test_near_pairs_against_brute_force():
    r = random.Random(1)
    for trial in range(150):
        c = r.randint(3, 8)
        words = sorted({"".join(r.choices("ab" if trial % 2 else "abé", k=r.choice([c, c + 1]))) for _ in range(r.randint(2, 60))})
        u, v = spelling.near_pairs(words, c, np.zeros(len(words), np.int64), np.zeros(len(words), int), np.full(len(words), c + 1))
        got = sorted((words[a], words[b]) for a, b in zip(u, v, strict=True))
        # Pairs of the longer words are another block's.
        assert got == sorted((a, b) for a in words for b in words if near(a, b) and not len(a) == len(b) == c + 1)


def test_wavelet_tree_against_brute_force():
    r = np.random.default_rng(4)
    for n in (1, 2, 7, 64, 100):
        values = r.permutation(n)
        cuts = np.sort(r.integers(0, n + 1, (2, 50, 2)), axis=2)
        query, value = spelling.WaveletTree(values).report(cuts[0, :, 0], cuts[0, :, 1], cuts[1, :, 0], cuts[1, :, 1])
        want = [(q, x) for q in range(50) for x in values[cuts[0, q, 0] : cuts[0, q, 1]] if cuts[1, q, 0] <= x < cuts[1, q, 1]]
        assert sorted(zip(query.tolist(), value.tolist(), strict=True)) == sorted(want)


def planted_words(r, n):
    """Texts whose words have variants, and variants of those, each ten times as frequent as the next."""
    stems, texts = ["".join(r.choices("abcdeéß", k=r.randint(7, 11))) for _ in range(12)], []
    for s in stems:
        texts += [s] * 240
        for _ in range(3):
            at = r.randrange(len(s))
            one = r.choice([s[:at] + s[at + 1 :], s[:at] + "x" + s[at + 1 :], s[:at] + "y" + s[at:]])
            texts += [one] * r.choice([2, 20, 24, 25])
            texts += [one + "z"] * 2
    r.shuffle(texts)
    return [(i if i % 50 else None, " ".join(w.title() if j % 3 else w for j, w in enumerate(texts[i::n]))) for i in range(n)]


@pytest.mark.parametrize("chars", [spelling.BLOCK_CHARS, 60])
def test_variants_against_brute_force(spark, monkeypatch, chars):
    """With small blocks too, which are cut down to single positions."""
    monkeypatch.setattr(spelling, "BLOCK_CHARS", chars)
    rows = [*planted_words(random.Random(5), 200), *enumerate(EDGES, 1000)]
    got, want = found_variants(table(spark, rows)), brute_variants(rows)
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[1] not in (k, v[0]) for k, v in want.items())


def test_variants_of_the_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found_variants(docs) == brute_variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_variants_edges(spark):
    assert found_variants(table(spark, [])) == {}
    rows = [*enumerate(EDGES), (8, EDGES[8]), (None, "internationalisation " * 3)]
    assert found_variants(table(spark, rows)) == brute_variants(rows)
    # Words that hundreds of others share all but one character with, and very long ones.
    long_ = "x" * 3_000
    many = [f"stem{a}{b}word" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijkl"]
    rows = [(0, " ".join(many * 2)), (1, f"{long_} {long_}y"), (2, f"{long_} {long_}y")]
    assert found_variants(table(spark, rows)) == brute_variants(rows)


def test_roots_follow_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(9)]
    assert {r.word: r.root for r in spelling.roots(spark.createDataFrame([*chain, ("a", "b")], "word string, form string")).collect()} == {**{f"w{i}": "w9" for i in range(9)}, "a": "b"}


# ---- quality classifier


def test_statistics_by_hand():
    found = dict(zip(classifier.STATISTICS, classifier.statistics(["A bc! Bc, 12\nbc bc.", None, ""])[0], strict=True))
    n = 19
    want = {
        "chars": np.log1p(n), "words": np.log1p(6), "lines": np.log1p(2), "letters": 7 / n, "capitals": 2 / n, "digits": 2 / n, "blanks": 4 / n, "newlines": 1 / n, "stops": 1 / n, "exclaims": 1 / n, "pauses": 1 / n,
        "others": 0, "word_length": 14 / 6, "single_characters": 1 / 6, "longest_word": np.log1p(3), "distinct_words": 1.0, "distinct_pairs": 5 / 6, "repeated_next": 0, "most_frequent_word": 1 / 6, "repeated_lines": 0, "line_words": np.log1p(3),
    }
    assert {k: round(found[k], 9) for k in want} == {k: round(float(v), 9) for k, v in want.items()}
    assert not classifier.statistics([None, ""]).any() and classifier.statistics([]).shape == (0, len(classifier.STATISTICS))


def brute_fit(x, y, trees, depth):
    """Boosting node by node: every threshold of every statistic is tried on the rows themselves."""
    odds = [float(np.log((sum(y) + 0.5) / (len(y) - sum(y) + 0.5)))] * len(y)
    cuts = classifier.bins_of(x)

    def leaf(rows, g, h):
        return {i: classifier.RATE * sum(g[j] for j in rows) / (sum(h[j] for j in rows) + classifier.PENALTY) for i in rows}

    def grown(rows, g, h, left):
        if not left or not rows:
            return leaf(rows, g, h) if rows else {}
        score = lambda part: sum(g[i] for i in part) ** 2 / (sum(h[i] for i in part) + classifier.PENALTY)
        best, split = 1e-12, None
        for f, cut in enumerate(cuts):
            for c in cut:
                a, b = [i for i in rows if x[i, f] <= c], [i for i in rows if x[i, f] > c]
                if min(sum(h[i] for i in a), sum(h[i] for i in b)) >= classifier.LEAST_WEIGHT and (gain := score(a) + score(b) - score(rows)) > best + 1e-9:
                    best, split = gain, (a, b)
        return leaf(rows, g, h) if split is None else grown(split[0], g, h, left - 1) | grown(split[1], g, h, left - 1)

    for _ in range(trees):
        p = [1 / (1 + np.exp(-o)) for o in odds]
        step = grown(list(range(len(y))), [a - b for a, b in zip(y, p, strict=True)], [q * (1 - q) for q in p], depth)
        odds = [o + step[i] for i, o in enumerate(odds)]
    return odds


def test_trees_against_brute_force():
    r = np.random.default_rng(6)
    x = np.column_stack([r.normal(size=160), r.integers(0, 4, 160), np.zeros(160), r.random(160)])
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 1) ^ (r.random(160) < 0.1)).astype(float)
    model = classifier.fit(x, y, trees=4, depth=2)
    assert np.allclose(model.log_odds(x), brute_fit(x, y, 4, 2), atol=1e-9)


def test_flat_trees_equal_nested_ones():
    """The arrays against a walk from node to node, for rows that weren't learned from."""
    r = np.random.default_rng(7)
    x = r.normal(size=(2_000, 5))
    model = classifier.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float), trees=20)
    new = r.normal(size=(300, 5))
    for row, odds in zip(new, model.log_odds(new), strict=True):
        total = model.bias
        for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node - len(feature)]
        assert abs(total - odds) < 1e-9
    assert ((model.log_odds(new) > 0) == (new[:, 0] * new[:, 1] > 0)).mean() > 0.9


def test_nothing_or_one_label_to_learn():
    none = classifier.fit(np.zeros((0, 3)), np.zeros(0))
    assert classifier.probability(none.log_odds(np.zeros((2, 3)))).tolist() == [0.5, 0.5]
    assert classifier.probability(classifier.fit(np.ones((50, 3)), np.ones(50)).log_odds(np.zeros((1, 3))))[0] > 0.9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out_quality(spark, sf):
    """Of held-out documents nearly all good ones are kept and nearly all bad ones rejected."""
    d = f"/root/testdata/{sf}"
    found = queries.op12_quality_classifier(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r.predicted for r in found if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.15 * len(bad) and len(good) > 50
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert {r.doc_id for r in found} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}


def test_classifier_edges(spark):
    """Every row has a score, a repeated row twice and the same; held-out labels and other columns change nothing."""
    docs = table(spark, [*enumerate(EDGES), (8, EDGES[8]), (None, "no id"), *((100 + i, f"Good plain text number {i} is here.") for i in range(40)), *((200 + i, "### $$$ %%% " * 9) for i in range(40))])
    labels = spark.createDataFrame([*((100 + i, 1) for i in range(40)), *((200 + i, 0) for i in range(40)), (None, 1), (3, None), (100, 0)], "doc_id long, quality int")
    model = classifier.train(docs, labels)
    rows = classifier.score(docs, model).collect()
    assert len(rows) == docs.count() and rows[0].__fields__ == ["doc_id", "score", "predicted"]
    by_id = collections.defaultdict(list)
    for x in rows:
        by_id[x.doc_id].append(x.score)
    assert len(by_id[8]) == 2 and len(set(by_id[8])) == 1 and by_id[0] == by_id[1] and by_id[105][0] > 0.5 > by_id[205][0]
    flipped = labels.withColumn("quality", F.when(classifier.not_learned(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert all(np.array_equal(a, b) for a, b in zip(model, classifier.train(docs, flipped), strict=True))
    empty = classifier.train(docs.limit(0), labels.limit(0))
    assert classifier.score(docs.limit(0), empty).count() == 0 and classifier.score(docs, empty).count() == docs.count()


# ---- ranked search


def brute_search(docs, items, top=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    texts = [(i, w) for i, t in docs if (w := split(t))]
    n_docs, total = len(texts), sum(len(w) for _, w in texts)
    df = collections.Counter(x for _, w in texts for x in set(w))
    out = []
    for name, t in items.items():
        scores = []
        for i, w in texts:
            m, tf = 100 - 75 + (75 * len(w) * n_docs) // total, collections.Counter(w)
            s = sum(int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df[x] + 1)))) * ((1_000_000_000 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in split(t) if tf[x])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(name, k, None if no_id else i, -s) for k, (s, no_id, i) in enumerate(sorted(scores)[:top], 1)]
    return out


def found_search(docs, items, **more):
    return sorted((tuple(r) for r in search.search(docs, items, **more).collect()), key=lambda r: r[:2])


def test_search_against_brute_force(spark, monkeypatch):
    """Negative, spread, repeated and missing ids; ties; several blocks of items."""
    r = random.Random(9)
    vocab = [f"t{i}" for i in range(60)] + ["É", "ÉÉ", "naïve", "漢字"]
    ids = [*range(-5, 60), *(10**12 + 7 * i for i in range(40)), *([3] * 5), *([None] * 4)]
    docs = [(i, " ".join(r.choices(vocab, k=r.choice([0, 1, 3, 30]))).title()) for i in ids] + [(900, None), (901, ""), (902, " ,.;"), (903, "same text"), (904, "same text")]
    items = {i: " ".join(r.choices([*vocab, "unknown"], k=r.randint(1, 12))) for i in range(12)} | {50: "same-TEXT, same", 51: "unknown", 52: ""}
    rows = spark.createDataFrame([*items.items(), (50, "same-TEXT, same"), (None, "t1"), (53, None)], "item_id long, text string")
    want = sorted(brute_search(docs, items), key=lambda x: x[:2])
    assert found_search(table(spark, docs), rows) == want
    monkeypatch.setattr(search, "BLOCK_TERMS", 20)
    assert found_search(table(spark, docs).repartition(5), rows) == want
    assert found_search(table(spark, docs), rows, top=3) == [x for x in want if x[1] <= 3]


def test_windows_and_heaps(spark):
    """More documents of one id than a window holds, and a term in all documents."""
    n = search.WINDOW + 500
    docs = spark.range(n).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("common w"), (F.col("id") % 1000).cast("string")).alias("text"))
    items = spark.createDataFrame([(1, "common common"), (2, "w5"), (3, "w4 common")], "item_id long, text string")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert found_search(docs, items) == sorted(brute_search(texts, {1: "common common", 2: "w5", 3: "w4 common"}), key=lambda x: x[:2])


def test_search_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE["op13_lexical_search"])
    found = queries.op13_lexical_search(spark, SF)
    assert want.columns == found.columns and sorted(want.fetchall()) == sorted(tuple(r) for r in found.collect())


def test_search_edges(spark):
    docs, items = table(spark, list(enumerate(EDGES))), spark.createDataFrame([(1, "alphabet text"), (2, None)], "item_id long, text string")
    assert found_search(docs, items) == brute_search(list(enumerate(EDGES)), {1: "alphabet text"})
    assert found_search(docs.limit(0), items) == [] and found_search(docs, items.limit(0)) == []
    long_ = spark.createDataFrame([(1, "needle " + "hay " * 300_000)], "doc_id long, text string")
    assert found_search(long_, spark.createDataFrame([(1, "Needle")], "item_id long, text string")) == brute_search([(1, "needle " + "hay " * 300_000)], {1: "needle"})
