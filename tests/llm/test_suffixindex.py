"""Repeated byte strings against a plain scan."""

import hashlib
import random

import numpy as np
import pytest

from riskflow.llm import suffixindex


def order(row):
    return suffixindex._LOWEST if row[0] is None else row[0]


def plain(rows, width):
    """Per row: id, bytes, removed bytes, spans, digest. Rows with equal ids are not in here."""
    seen, out = set(), []
    for r in sorted(rows, key=order):
        data = (r[1] or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - width + 1):
            string = data[s: s + width]
            if string in seen:
                gone[s: s + width] = True
            seen.add(string)
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = [tuple(s) for s in edges.reshape(-1, 2).tolist()]
        out.append((r[0], len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def found(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc string, tie string, s int, n int, key string, x int")
    got = suffixindex.without_repeats(docs, **settings).collect()
    return sorted([(r[0], r[1], r[2], [tuple(s) for s in r[3]], r[4], bytes(r[5])) for r in got], key=str)


def texts(seed, count, alphabet, longest, parts):
    rnd = random.Random(seed)
    blocks = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(10, longest))) for _ in range(parts)]
    return ["".join(rnd.choice(blocks) if rnd.random() < 0.6 else rnd.choice(alphabet) * rnd.randrange(20) for _ in range(rnd.randrange(8))) for _ in range(count)]


def clashing(rows):
    return [(i, t, "d", "t", 1, 2, "k", 3) for i, t in rows]


@pytest.mark.parametrize("crowd, size", [(suffixindex.CROWD, suffixindex.SLICE), (2, 64)])
def test_repeats(spark, crowd, size):
    some = texts(5, 50, "ab éü", 60, 12) + texts(6, 10, "a", 90, 3) + [None, "", "x" * 19, "y" * 400, "y" * 20]
    some += [some[3], some[3] + "!", "long " + "".join(texts(7, 40, "abcdefgh ", 50, 30))]
    rows = [(i * 3, t) for i, t in enumerate(some)]
    random.Random(1).shuffle(rows)
    got = found(spark, clashing(rows), width=20, core=7, batches=4, crowd=crowd, size=size)
    assert got == plain(rows, 20)


def test_equal_rows_ids_and_empty_tables(spark):
    one, two = "one text that is long enough " * 3, "quite another text, also long " * 3
    rows = [(1, one), (1, one), (1, one), (None, two), (None, two[:70] + one), (2, "short"), (2, "short"), (3, None)]
    got = found(spark, clashing(rows), width=25, core=9, batches=2)
    assert len(got) == len(rows)
    by = lambda i, n: sorted(r[2] for r in got if r[0] == i and r[1] == n)
    assert by(2, 5) == [0, 0] and by(3, 0) == [0]
    removed = by(1, len(one))
    assert removed[1:] == [len(one), len(one)] and removed[0] < len(one) or removed == [len(one)] * 3
    # What is kept of all rows holds each string of the width once.
    kept = [r[5] for r in got]
    assert sum(len(k) for k in kept) < len(one) + len(two) + 20
    assert found(spark, [], width=25, core=9, batches=2) == []


def test_levels_merge_geometrically(spark):
    levels, sizes = [], []
    for k in range(6):
        text = "".join(texts(k, 30, "abcdefghij ", 40, 20))
        docs = suffixindex.identified(spark.createDataFrame([(k, text)], "doc_id long, text string"))
        levels, _ = suffixindex.add_batch(levels, docs, 8, width=20, core=7)
        sizes.append([level.size for level in levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2]]
    assert sum(level.suffixes.count() for level in levels) > 0


def test_levels_are_not_shuffled(spark, shuffled_plans):
    docs = suffixindex.identified(spark.createDataFrame([(1, "abc" * 50)], "doc_id long, text string"))
    levels, _ = suffixindex.add_batch([], docs, 8)
    fresh = docs.mapInArrow(suffixindex._sorted_suffixes(100, 32, 1 << 20), suffixindex._ROW).repartition(8, "key")
    both = fresh.unionByName(levels[0].suffixes).groupBy("key").count()
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 8 out of 8" in plan


def test_every_string_lies_in_one_run():
    rnd = random.Random(2)
    data = "".join(rnd.choice("ab") for _ in range(3000)).encode() + b"c" * 300
    ends = np.array([0, 0, 500, 501, 600, len(data)])
    key, x, start, count = suffixindex.runs(np.frombuffer(data, np.uint8), ends, 40, 11)
    covered = sorted(s for b, n in zip(start.tolist(), count.tolist()) for s in range(b, b + n))
    assert covered == [s for b, e in zip(ends[:-1], ends[1:]) for s in range(b, e - 39)]
    named = {}
    for k, s, n in zip(key.tolist(), start.tolist(), count.tolist()):
        for p in range(s, s + n):
            assert named.setdefault(data[p: p + 40], k) == k  # equal strings, equal anchors
