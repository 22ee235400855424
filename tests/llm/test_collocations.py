"""Collocations and their automata against plain counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from riskflow.llm import collocations
from riskflow.llm.collocations import CountAutomaton, merged, union


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows, least, kept):
    total, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        grams = f.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for n in range(1, 6):
                grams.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, grams in f.items():
        good = {g: a for g, a in grams.items() if a >= least and len(g) > 1}
        found = []
        for g, a in good.items():
            if any(len(b) > len(g) and 100 * fb >= 100 * a and any(b[i:i + len(g)] == g for i in range(len(b))) for b, fb in good.items()):
                continue
            score, k = min((1000 * a * total[lang] // (grams[g[:k]] * grams[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), grams[g[:k]], grams[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:kept], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def made(seed, count):
    rnd = random.Random(seed)
    words = ["of", "The", "new", "york", "stock", "Exchange", "é", "x\x1fy", "a"] + [f"w{i}" for i in range(30)]
    text = lambda: "".join(
        rnd.choice(["new york ", "The stock exchange of new york ", "x\x1fy é "]) if rnd.random() < 0.3
        else rnd.choice(words) + rnd.choice([" "] * 8 + ["\t ", ". ", ",", "\n", "!", "\x0b", "\r\n"])
        for _ in range(rnd.randrange(60))
    )
    return [(rnd.choice(["en", "en", "en", "de", None, "n\nl"]), text()) for _ in range(count)]


@pytest.mark.parametrize("flush, ranges, kept", [(collocations.FLUSH, 32, 2000), (50, 3, 7)])
def test_collocations(spark, flush, ranges, kept):
    rows = made(4, 150) + [("en", None), (None, None), ("de", ""), ("en", "THE STOCK exchange " * 400)]
    docs = spark.createDataFrame([(i, t, g, 1, "r", 2) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, rank string, a int")
    got = collocations.collocations(docs, 9, kept, ranges=ranges, flush=flush)
    assert sorted(map(tuple, got.collect())) == plain(rows, 9, kept)


def test_no_candidates(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    few = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, lang string")
    assert collocations.collocations(none).count() == 0 and collocations.collocations(few).count() == 0


def test_scores_beyond_64_bits(spark):
    wide = "lang string, words array<string>, a long"
    one = spark.createDataFrame([("en", ["x", "y"], 9_000_000_000_000_000)], wide)
    parts = np.array([[0, 1, -1, -1, -1, -1], [0, 2, -1, -1, -1, -1]])
    words = [collocations._tag("en"), b"x", b"y"]
    weights = np.array([9_100_000_000_000_000, 9_200_000_000_000_000])
    rows = [merged(words, parts[k:k + 1], weights[k:k + 1]).row(
        int(collocations._range_of(collocations.word_hashes("en", [words[k + 1]]), np.zeros(1, np.uint64), 2)[0])
    ) for k in range(2)]
    automata = collocations.united(spark.createDataFrame(rows, collocations._AUTOMATON), 1)
    totals = spark.createDataFrame([("en", 90_000_000_000_000_000)], "lang string, n long")
    got = collocations.scored(one, automata, totals, 2).first()
    assert got.score == 1000 * 9_000_000_000_000_000 * 90_000_000_000_000_000 // (9_100_000_000_000_000 * 9_200_000_000_000_000)


def counts(seed, n):
    rnd = random.Random(seed)
    out = Counter()
    for _ in range(n):
        out[tuple(rnd.choice([b"a", b"bb", b"c", b"dd"]) for _ in range(rnd.randint(1, 4)))] += rnd.randint(1, 5)
    return out


def automaton(grams):
    words = [b"dd", b"a", b"c", b"bb"]
    paths = np.array([[words.index(w) for w in g] + [-1] * (5 - len(g)) for g in grams], np.int64).reshape(-1, 5)
    return merged(words, paths, np.array(list(grams.values()), np.int64))


def read(one):
    paths, weights = one.paths(5)
    return Counter({tuple(one.words[i] for i in p if i >= 0): w for p, w in zip(paths.tolist(), weights.tolist())})


@pytest.mark.parametrize("n", [0, 1, 3, 40, 400])
def test_automata(n):
    one, two = counts(n, n), counts(n + 1, n)
    a, b = automaton(one), automaton(two)
    assert read(a) == one
    columns = ["range", "words", "source", "label", "weight", "target"]
    again = CountAutomaton.read(dict(zip(columns, a.row(1))))
    both = union([again, b], 5)
    assert read(both) == one + two
    asked = [*(one + two), (b"zz",), (b"a", b"zz")]
    assert both.compose([list(g) for g in asked]).tolist() == [(one + two)[g] for g in asked]
    assert read(union([a, b], 5, 5)) == Counter({g: w for g, w in (one + two).items() if w >= 5})


def test_states_with_equal_arcs_are_one_state():
    same = {(w, x): 3 for w in (b"a", b"bb", b"c", b"dd") for x in (b"a", b"c")}
    assert automaton(same).source.size == 6  # four arcs into one state with two
