"""Each operator against a plain version on rows with nulls, ties, copies and odd texts."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from riskflow.llm import (
    bottomk, dac, decontaminate, interpolation, language, lines, nearcopies, packing, quality, recompression, simhash, tokens,
)
from riskflow.llm.components import roots

LOW = -(1 << 63)


def order(row):
    return (LOW if row[0] is None else row[0], (row[1] or "") if len(row) > 1 else "")


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def test_quality_learns_the_marked_form(spark, docs, nothing):
    rows = [(i, ("$$$ " * 9 + f"w{i} ") if i % 3 == 0 else f"plain words number {i} stand here in a row", None) for i in range(300)]
    data = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    found = quality.quality_scores(data, labels).collect()
    assert len(found) == 300 and all(r.predicted == int(r.doc_id % 3 != 0) for r in found)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in found)
    odd = quality.quality_scores(docs, labels)
    assert odd.count() == docs.count() and odd.where("score is null").count() == 0
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(nothing, labels).count() == 0
    assert quality.accepted(docs, labels.limit(0)).columns == docs.columns


def test_language_mixture(spark, docs, nothing):
    kinds = {"en": "the and with of them there ", "de": "der und nicht schön über auch "}
    rows = [(i, text * 6, lang) for i in range(80) for lang, text in [list(kinds.items())[i % 2]]]
    data = spark.createDataFrame(rows + [(100, None, "en"), (101, "12 34 !", "de"), (102, "", None)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language.languages(data).collect()}
    assert all(found[i].lang_pred == ["en", "de"][i % 2] for i in range(80))
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (100, 101, 102))
    assert language.languages(docs).count() == docs.count()
    assert language.languages(nothing).count() == 0
    model = language.train(data)
    chosen, shares = model.proportions(language.trigrams((kinds["en"] * 9 + kinds["de"] * 3).encode()))
    assert len(chosen) == 2 and 0.6 < shares.max() < 0.9


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(docs, rows, nothing):
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: min((prints[k][0] for k in range(len(prints)) if group[k] == g and prints[k][0] is not None), default=None) for g in group}
    want = sorted((-1 if i is None else i, f"{f:016x}", least[g]) for (i, f), g in zip(prints, group))
    got = simhash.near_duplicates(docs).select(F.coalesce("doc_id", F.lit(-1)), simhash.hexadecimal(), "component_id").collect()
    assert sorted(map(tuple, got)) == want
    assert simhash.near_duplicates(nothing).count() == 0
    assert {r.doc_id for r in simhash.one_of_each(docs).collect()} == {i for i in least.values()}


def test_one_row_of_each_component_stays(spark):
    one, two, three = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    rows = [(None, one), (None, two), (None, two), (None, three), (7, three), (5, "x y z"), (5, "other words here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in simhash.one_of_each(frame).collect())
    assert got == Counter([(None, one), (None, two), (7, three), (5, "x y z"), (5, "other words here")])


@pytest.mark.parametrize("bucket", [nearcopies.BUCKET, 3])
def test_near_copies_of_the_pipeline(spark, bucket):
    rnd = random.Random(6)
    texts = []
    for g in range(12):
        words = [f"g{g}w{k}" for k in range(rnd.randrange(60, 200))]
        for _ in range(6):
            copy = list(words)
            for k in rnd.sample(range(len(copy)), rnd.randrange(5)):
                copy[k] = f"new{rnd.random()}"
            texts.append(" ".join(copy))
    texts += [texts[0].upper(), texts[0].replace(" ", "\n"), "", " ", None, "two words", "Two words"]
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)]
    sets = [set(zip(*[w[k:] for k in range(5)])) or {tuple(w)} for w in ((t or "").lower().split() for t in texts)]
    group, pairs = list(range(len(rows))), 0
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                pairs += 1
                group = [group[j] if g == group[i] else g for g in group]
    got = [tuple(r) for r in nearcopies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), bucket).collect()]
    kept = sorted(group[rows.index(r)] for r in got)
    assert kept == sorted(set(group)) and pairs > 50 and len(got) < len(rows) - 20
    for r in got:
        assert r[0] == min((rows[k][0] for k in range(len(rows)) if group[k] == group[rows.index(r)] and rows[k][0] is not None), default=None)


def test_the_stage_links_by_fingerprints_too(spark):
    """Texts within the radius of op3 are one group in the pipeline, even below the Jaccard similarity of 0.8."""
    import corpus_pipeline

    rnd = random.Random(4)
    base = [f"w{k}" for k in range(30)]
    tail = lambda: " ".join(f"z{rnd.random()}" for _ in range(9))
    texts = [" ".join(base * 12) + " " + tail() for _ in range(40)]  # repeats weigh in a fingerprint, not in a set
    prints = [simhash.fingerprint(t) for t in texts]
    one, two = next(
        (a, b) for a, p in zip(texts, prints) for b, q in zip(texts, prints)
        if a < b and ((p ^ q) & (2**64 - 1)).bit_count() <= 4
    )
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for t in (one, two)]
    assert len(sets[0] & sets[1]) < 0.8 * len(sets[0] | sets[1])
    copy = one.replace("w0 w1", "W0 W1", 1)
    far = " ".join(f"v{k}" for k in range(80))
    frame = spark.createDataFrame([(4, two), (2, one), (3, copy), (9, far), (8, far + " end")], "doc_id long, text string")
    kept = corpus_pipeline.near_duplicate_stage(spark, frame, "")
    assert sorted(tuple(r) for r in kept.collect()) == [(2, one), (8, far + " end")]


def test_near_copies_that_meet_in_one_crowded_bucket_alone(spark):
    """A pair that only a crowded bucket brings together is linked; unlike texts of that bucket are not."""
    rnd, cache = random.Random(9), nearcopies.WordHashes()

    def keys(text):
        return set(nearcopies.band_keys(nearcopies.shingles(text.encode().split(), cache)).tolist())

    def pair():
        words = [f"p{rnd.random()}" for _ in range(100)]
        other = list(words)
        other[50] = other[75] = "x"
        other += ["end"]
        return " ".join(words), " ".join(other)

    one, two = next((a, b) for a, b in iter(pair, None) if len(keys(a) & keys(b)) == 1)
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for t in (one, two)]
    assert 0.8 * len(sets[0] | sets[1]) <= len(sets[0] & sets[1])
    rows = [(1, one), (2, two), (3, " ".join(reversed(one.split())))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = nearcopies.one_of_each(frame, bucket=1)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_no_near_copies_of_nothing(docs, nothing):
    assert nearcopies.one_of_each(nothing).count() == 0 and nearcopies.one_of_each(docs).columns == docs.columns


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 3])
def test_every_pair_within_the_radius_is_linked(spark, bucket):
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(12)]
    values = {b ^ sum(1 << p for p in rnd.sample(range(64), rnd.randrange(6))) for b in base for _ in range(8)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), bucket=bucket)
    root = {r.node: r.root for r in roots(edges).collect()}
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    for a, b in near:
        assert root[a] == root[b]
    for a in signed:  # nothing else is linked: components of the plain graph
        seen, todo = {a}, [a]
        while todo:
            x = todo.pop()
            new = {q for p in near if x in p for q in p} - seen
            seen |= new
            todo += new
        assert root.get(a, a) == min(seen)


def test_masks_cover_every_set_of_four_bits():
    masks = simhash.masks()
    rnd = random.Random(1)
    for _ in range(3000):
        x = sum(1 << p for p in rnd.sample(range(64), 4))
        assert any(not x & m & (2**64 - 1) for m in masks)


def plain_lines(rows):
    """Later copies of runs of every length, and of whole texts."""
    keys = sorted({(LOW if r[0] is None else r[0], r[1]) for r in rows if r[1] is not None})
    first_text, seen, out = {}, set(), {}
    runs = []
    for i, t in keys:
        first_text.setdefault(t, i)
    for i, t in keys:
        part = t.split("\n")
        if first_text[t] < i:
            out[i, t] = "" if sum(map(len, part)) >= lines.MIN_CHARS else t
            continue
        gone = set()
        for width in range(1, len(part) + 1):
            for a in range(len(part) - width + 1):
                run = tuple(part[a:a + width])
                if run in seen and sum(map(len, run)) >= lines.MIN_CHARS:
                    gone |= set(range(a, a + width))
                seen.add(run)
        runs.append(gone)
        out[i, t] = "\n".join(x for n, x in enumerate(part) if n not in gone)
    return out


def test_line_runs(spark, docs, rows, nothing):
    rnd = random.Random(2)
    pool = ["short", "", "a line of some words that repeats", "another line that may come back", "x", "third long line of words here"]
    more = [(100 + i, "\n".join(rnd.choice(pool + [f"unique line number {i} {j}"]) for j in range(rnd.randrange(1, 12))), "en", None, 7, None, None, None) for i in range(60)]
    every = rows + more
    want = plain_lines(every)
    data = spark.createDataFrame(every, docs.schema)
    got = lines.without_repeats(data)
    assert got.columns == data.columns
    found = Counter((r.doc_id, r.text) for r in got.collect())
    assert found == Counter((r[0], None if r[1] is None else want[LOW if r[0] is None else r[0], r[1]]) for r in every)
    assert lines.without_repeats(nothing).count() == 0


@pytest.mark.parametrize("hot", [lines.HOT, 3])
def test_whole_runs_of_short_lines_go(spark, hot):
    """Runs of any length whose windows of 1, 2, 4 ... lines are all too short; hot names dealt by place."""
    rnd = random.Random(7)
    short = ["", "a", "bc", "menu", "line nine", "six it"]
    made = [
        ["line nine", "nine line", "nine nine"], ["x1", "line nine", "nine line", "nine nine", "y1"],
        ["Menu", "Home", "a long line of the page that is here"], ["Menu", "Home", "a long line of the page that is here", "z"],
        ["ab"] * 40, ["ab"] * 25 + ["end"], *[["a text that is here again", "and again"]] * 6,
    ] + [[rnd.choice(short) for _ in range(rnd.randrange(1, 30))] for _ in range(25)]
    frame = [(i, "\n".join(part)) for i, part in enumerate(made)]
    want = plain_lines(frame)
    assert want[1, frame[1][1]] == "x1\ny1" and want[3, frame[3][1]] == "z"
    got = lines.without_repeats(spark.createDataFrame(frame, "doc_id long, text string"), hot=hot).collect()
    assert {r.doc_id: r.text for r in got} == {i: want[i, t] for i, t in frame}


def test_line_columns_of_any_name(spark):
    text = "one long line that comes again and again"
    names = ["_key", "_runs", "_d", "_t", "_told", "runs", "told", "row", "d", "t", "i", "first", "name"]
    frame = spark.createDataFrame([(i, text, *names) for i in range(3)], ["doc_id", "text", *names])
    got = lines.without_repeats(frame).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(i, "" if i else text, *names) for i in range(3)]


def test_stage_columns_of_any_name(spark):
    """Columns of the input that bear the names of working columns keep their values in every stage."""
    names = ["_key", "_bad", "_runs", "_d", "_t", "_told", "_label", "key", "row", "bad", "root", "node", "range", "tail", "block"]
    one, two = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    item = "Which rivers of the north run dry in the long summer"
    rows = [(1, one, *names), (2, one, *names), (3, two, *names), (4, f"{two} {item} {one}", *names)]
    frame = spark.createDataFrame(rows, ["doc_id", "text", *names])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "doc_id long, quality int")
    stays = lambda kept: sorted(tuple(r) for r in kept.select(frame.columns).collect())
    assert stays(nearcopies.one_of_each(frame)) == [rows[0], rows[2], rows[3]]
    assert stays(simhash.one_of_each(frame)) == [rows[0], rows[2], rows[3]]
    assert stays(decontaminate.clean(frame, bench)) == rows[:3]
    assert set(stays(quality.accepted(frame, marks))) <= set(rows)


def test_repeated_labels_count_once(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["the", "of", "Buy", "!!!", "word", "7"]) for _ in range(5 + i))) for i in range(40)]
    marks = [(i, i % 2) for i in range(40)]
    data = spark.createDataFrame(rows, "doc_id long, text string")
    once, often = (
        quality.train(data, spark.createDataFrame(m, "doc_id long, quality int"), per_label=8) for m in (marks, marks + marks[:6] * 50)
    )
    assert np.array_equal(once.weights, often.weights) and once.cut == often.cut


def test_repeated_rows_do_not_multiply(spark):
    block = "\n".join(f"line number {k} of a block" for k in range(16))
    frame = spark.createDataFrame([(1, f"{block}\n{block}")] * 20, "doc_id long, text string")
    later = lines.copies(frame)
    runs = lines.repeated_runs(frame, later).select("begin", "end").collect()
    assert [tuple(r) for r in runs] == [(16, 32)]
    assert {r.text for r in lines.without_repeats(frame).collect()} == {block}


def test_language_model(docs, rows, nothing):
    counts = Counter()
    for r in rows:
        if fold(r[0], 7) != 2:
            counts.update((r[1] or "").encode().lower().split() + [0])
    n, v = sum(counts.values()), len(counts)
    got = sorted(interpolation.document_scores(docs, block_chars=5000).collect(), key=lambda r: (order((r[0],)), r[2]))
    want = []
    for r in rows:
        t = (r[1] or "").encode().lower().split() + [0]
        want.append((r[0], fold(r[0], 7) == 2, len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)))
    want.sort(key=lambda r: (order((r[0],)), r[2]))
    for g, w in zip(got, want, strict=True):
        assert tuple(g[:5]) == w[:5] and g[5] == pytest.approx(w[5]) and g[6] <= 0
    assert interpolation.document_scores(nothing).count() == 0
    model = interpolation.train(interpolation.counted(docs))
    # All chances after a seen context add up to 1, an unknown token included.
    words = np.array(list(counts.values()))
    after = np.zeros_like(words)
    after[:5] = [1, 2, 3, 1, 1]
    total = model.chances(words, after, np.full(words.size, 8)).sum() + model.weights[4][2] / (v + 1)
    assert total == pytest.approx(1)


def plain_shingles(text):
    w = [xxhash.xxh64_intdigest(x, 42) for x in (text or "").encode().split()]
    out = set()
    for i in range(max(1, len(w) - 4) if w else 0):
        s = 42
        for x in w[i:i + 5]:
            s = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), s)
        out.add(s - (1 << 64) if s >> 63 else s)
    return out


@pytest.mark.parametrize("range_chars", [bottomk.RANGE_CHARS, 700])
def test_fingerprints(docs, rows, nothing, range_chars, monkeypatch):
    monkeypatch.setattr(bottomk, "with_next", lambda d, f=bottomk.with_next: f(d, range_chars))
    got = sorted((r for r in bottomk.fingerprints(docs).collect()), key=lambda r: (order((r.doc_id,)), r.n_chars, r.edited_sha256))
    ordered = sorted(rows, key=order)
    want = []
    for k, r in enumerate(ordered):
        t, n = r[1] or "", ordered[(k + 1) % len(ordered)][1] or ""
        e = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        want.append((r[0], len(t), hashlib.sha256(e.encode()).hexdigest(), sorted(plain_shingles(t))[:128], sorted(plain_shingles(n))[:128]))
    want.sort(key=lambda r: (order((r[0],)), r[1], r[2]))
    for g, w in zip(got, want, strict=True):
        assert (g.doc_id, g.n_chars, g.edited_sha256, g.sketch) == w[:4]
    assert sorted(map(tuple, (r.next_sketch for r in got))) == sorted(map(tuple, (w[4] for w in want)))
    assert bottomk.fingerprints(nothing).count() == 0


def test_sketch_estimates(spark):
    a, b = " ".join(f"x{i}" for i in range(900)), " ".join(f"x{i}" for i in range(450, 1350))
    one = spark.createDataFrame([(a, b, a[:2000], a[2000 - 40:])], "a string, b string, p string, q string").select(
        bottomk.resemblance(bottomk.sketch("a"), bottomk.sketch("b")).alias("near"),
        bottomk.containment(bottomk.sketch("a"), bottomk.sketch("b")).alias("within"),
        bottomk.distinct_shingles(bottomk.sketch("a")).alias("kinds"),
        bottomk.resemblance(bottomk.sketch(F.lit("")), bottomk.sketch(F.lit(" "))).alias("empty"),
    ).first()
    assert one.near == pytest.approx(1 / 3, abs=0.12) and one.within == pytest.approx(0.5, abs=0.15)
    assert one.kinds == pytest.approx(896, rel=0.25) and one.empty == 1


def test_ids_equal_the_tokenizers(rows):
    from tokenizers import Tokenizer

    rnd = random.Random(3)
    pieces = ["a", "B", "é", "İ", " ", "  ", "\n", "\t", ".", ",", "...", "'s", "3.5", "$", " ", "́", "\x1c", "word", "<|endoftext|>", ". ", ", "]
    some = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(14))) for _ in range(3000)] + [r[1] or "" for r in rows]
    for name in (dac.VOCABULARY, packing.VOCABULARY):
        plain = Tokenizer.from_file(tokens.path(name))
        for text, ids in zip(some, tokens.Encoder(tokens.path(name)).batch(some)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", [dac.VOCABULARY, packing.VOCABULARY])
def test_ids_of_white_space_marks_and_letters_of_any_kind(name):
    from tokenizers import Tokenizer

    rnd = random.Random(5)
    plain_ones = list("abzAZéÀßÿÞ09  \n\t\r\v\f.,;!#")
    odd_ones = list("'<>|×÷½²ªµıſİжЖ中😀ﬁ\x00\x1c\x1f\x7f\x85\xa0\u1680\u180e\u2003\u2028\u200b\u0301\u3000\ufeff’") + ["'ll"] + 6 * ["<|endoftext|>"]
    some = ["".join(rnd.choices(p, k=rnd.randrange(14))) for p in (plain_ones, plain_ones + odd_ones) for _ in range(5000)]
    want = [e.ids for e in Tokenizer.from_file(tokens.path(name)).encode_batch_fast(some, add_special_tokens=False)]
    got = tokens.Encoder(tokens.path(name)).column(pa.array(some, pa.large_string()))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want


@pytest.mark.parametrize("name", [dac.VOCABULARY, packing.VOCABULARY])
def test_new_plain_words_go_to_the_merges_alone(name):
    """The tokenizer's normalizer and splits took two thirds of the time of a new word (op7, op8)."""
    from tokenizers import Tokenizer

    text = "Anblewh ètioné thshre,\nunéreou### 1234  EAONON!!\tund über\n\n die. "
    want = Tokenizer.from_file(tokens.path(name)).encode(text, add_special_tokens=False).ids
    encode = tokens.Encoder(tokens.path(name))
    given = []
    encode._encode = lambda some, **_: given.extend(some) or []
    assert np.frombuffer(encode(text), "<u4").tolist() == want and given == []


@pytest.mark.parametrize("name", [dac.VOCABULARY, packing.VOCABULARY])
def test_ids_when_the_memory_of_pieces_overflows(name, monkeypatch):
    rnd = random.Random(6)
    some = [" ".join("".join(rnd.choices("abcé'", k=rnd.randrange(1, 5))) for _ in range(40)) for _ in range(300)]
    want = tokens.Encoder(tokens.path(name)).batch(some)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 2000)
    encode = tokens.Encoder(tokens.path(name))
    assert encode.batch(some) == want
    for limit in ("MOST_PIECES", "MOST_BYTES"):
        monkeypatch.setattr(tokens, limit, 300)
        encode = tokens.Encoder(tokens.path(name))
        assert encode.batch(some) == want and len(encode._known) < 1000
        monkeypatch.undo()
        monkeypatch.setattr(tokens, "GROUP_BYTES", 2000)


def test_token_files(docs, rows, nothing):
    encode = tokens.encoder(tokens.path(dac.VOCABULARY))
    start, want = 0, []
    for r in sorted(rows, key=order):
        ids = encode(r[1] or "") + (2).to_bytes(4, "little")
        want.append((r[0], start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    got = dac.read(dac.write(docs, tokens.path(dac.VOCABULARY))).drop("ids").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert dac.read(dac.write(nothing, tokens.path(dac.VOCABULARY))).count() == 0


def test_random_access():
    rnd = np.random.default_rng(4)
    parts = [rnd.integers(0, 1 << rnd.integers(1, 32), n, dtype="u4") for n in (0, 1, 700, 5000)]
    f = dac.TokenFile(dac.encode([4, None, 6, 7], [p.tobytes() for p in parts]))
    flat = np.concatenate(parts)
    assert f.doc_ids == [4, None, 6, 7] and f.ends.tolist() == [0, 0, 1, 701, 5701]
    assert all(f.token(int(i)) == flat[i] for i in rnd.integers(0, flat.size, 300))
    assert all((f.tokens(a, b) == flat[a:b]).all() for a, b in np.sort(rnd.integers(0, flat.size, (50, 2)), axis=1))


def test_packing(docs, rows, nothing):
    encode = tokens.encoder(tokens.path(packing.VOCABULARY))
    whole = sorted((-1 if r[0] is None else r[0], encode(r[1] or "") + bytes(4)) for r in rows)
    got = packing.packed(docs, tokens.path(packing.VOCABULARY), with_ids=True).collect()
    sequences = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in sequences.values():
        v.sort()
        assert [o for o, _ in v] == [sum(n for _, n in v[:k]) for k in range(len(v))] and sum(n for _, n in v) <= 1024
    pieces = Counter((-1 if r.doc_id is None else r.doc_id, r.start, r.ids) for r in got)
    assert pieces == Counter((i, a // 4, ids[a:a + 4096]) for i, ids in whole for a in range(0, len(ids), 4096))
    assert packing.packed(nothing, tokens.path(packing.VOCABULARY)).count() == 0


def test_plan_places_every_piece_once():
    rnd = np.random.default_rng(7)
    histogram = np.zeros(1025, np.int64)
    np.add.at(histogram, rnd.integers(1, 1025, 20_000), 1)
    made, filled = packing.plan(histogram), Counter()
    for n in np.flatnonzero(histogram):
        sequence, offset = made.place(int(n), np.arange(histogram[n]))
        for s in sequence.tolist():
            filled[s] += int(n)
    assert len(filled) == made.sequences and max(filled.values()) <= 1024
    assert sum(1024 - x for x in filled.values()) < 0.01 * sum(filled.values())


@pytest.mark.parametrize("block_chars", [recompression.BLOCK_CHARS, 900])
def test_repeats(spark, docs, rows, nothing, block_chars):
    rnd = random.Random(8)
    few = [(200 + i, " ".join(rnd.choice(["a"] * 6 + ["b", "c"]) for _ in range(rnd.randrange(90))), *[None] * 6) for i in range(40)]
    every = rows + few
    seen, want = set(), []
    for r in sorted(every, key=order):
        w = (r[1] or "").encode().split()
        gone = set()
        for s in range(len(w) - 19):
            g = tuple(w[s:s + 20])
            if g in seen:
                gone |= set(range(s, s + 20))
            seen.add(g)
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((r[0], len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    got = recompression.without_repeats(spark.createDataFrame(every, docs.schema), block_chars).collect()
    key = lambda r: (order((r[0],)), r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert recompression.without_repeats(nothing).count() == 0


def test_contamination(spark, docs, nothing):
    item = "A train leaves the old town at 9 and covers 120 km in 3 hours, while Anna Berg waits near the river for 45 minutes. How far"
    other = item.replace("120", "250").replace("Anna Berg", "Peter Holm").replace("45", "12")
    broken = item.replace("river for 45", "river for 9")  # one value for two slots of the item
    bench = spark.createDataFrame([(1, item, "x"), (2, None, None), (None, "no id but words enough to match", None), (3, "", None)], "item_id long, text string, lang string")
    rows = [(1, "Some words before. " + item + " and after."), (2, other), (3, broken), (4, "Nothing of that kind is in here at all."), (5, None), (6, item), (6, item), (None, item)]
    data = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(data, bench).collect()}
    assert found == {(1, 1), (2, 1), (6, 1)}
    assert sorted(str(r.doc_id) for r in decontaminate.clean(data, bench).collect()) == ["3", "4", "5", "None"]
    assert decontaminate.contaminated(docs, bench).count() == 0
    assert decontaminate.contaminated(nothing, bench).count() == 0 and decontaminate.contaminated(data, bench.limit(0)).count() == 0


def test_contamination_by_short_dense_and_unspaced_items(spark):
    items = [
        (1, "Name every prime"), (2, "12 km plus 7 km minus 3 km"), (3, "如何证明素数有无穷多个"), (4, "42"),
        (None, "Which rivers of the north run dry in summer"), (5, "Add 3, 5, 7, 9 and 11 to 20 apples"),
    ]
    rows = [
        (1, "She said name every prime and then more words came."), (2, "He ran 15 km plus 9 km minus 4 km that day."),
        (3, "老师问如何证明素数有无穷多个然后走了"), (4, "There were 42 of them in the long list."), (5, "There were 43 of them in the long list."),
        (6, "I asked which rivers of the north run dry in summer here."), (7, "12 km plus one"), (8, "Name every river of it"),
        (9, "to 20 apples there is nothing that one could add at all"), (10, "Please add 4, 6, 8, 10 and 12 to 30 apples now"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    data = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(data, bench).collect()}
    assert found == {(1, 1), (2, 2), (3, 3), (4, 4), (6, None), (10, 5)}


def test_long_runs_of_slots_do_not_end_the_task(spark):
    item = "How many of the grey stones did Anna Berg carry over 12 hills in 3 days before the rain"
    names, numbers = "seen " + "Anna Berg " * 50_000, "1.2:3/" * 50_000 + "4 " + "7 " * 50_000
    rows = [(1, names + ". " + item), (2, numbers + ". " + item), (3, names), (4, numbers), (5, (names + numbers) * 2 + item)]
    data = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.contaminated(data, bench).collect()} == {1, 2, 5}
    assert sorted(r.doc_id for r in decontaminate.clean(data, bench).collect()) == [3, 4]


SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_pipeline_and_sql(spark):
    import corpus_pipeline
    from compare import difference, duck

    from riskflow.llm.catalog import ORACLES, QUERIES

    connection = duck(SMALL)
    for name, sql in ORACLES.items():
        assert difference(QUERIES[name](spark, SMALL), connection, sql) is None, name
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL).cache()
        assert kept.columns == documents.columns and 0 < kept.count() <= docs.count(), name
        docs = kept
    packed = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_the_pipeline_gives_the_ids_of_its_pieces(spark):
    import corpus_pipeline

    rows = [(1, "some words " * 900), (2, "a few words"), (None, "no id here"), (4, None)]
    data = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.packing_stage(spark, data, "").collect()
    assert {r.doc_id for r in got} == {1, 2, None, 4}
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in got)
