"""The Merkle manifest against plain trees."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from riskflow.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos string, grp int, node long, path string, part int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h("".join(values))


def tree(nodes, fanout):
    """Root of a list of digests, and the siblings of each node on its way there."""
    ways, place, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, p in enumerate(place):
            run = level[p // fanout * fanout: p // fanout * fanout + fanout]
            ways[i].append(("".join(run[: p % fanout]), "".join(run[p % fanout + 1:])))
            place[i] = p // fanout
        level = [h("".join(level[k: k + fanout])) for k in range(0, len(level), fanout)]
    return level[0], ways


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    held = {}
    for s in order:
        group = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        root, ways = tree([leaf(*r) for r in group], fanout)
        held[s] = group, root, ways
    root, tops = tree([held[s][1] for s in order], fanout) if order else (None, [])
    out = []
    for s, top in zip(order, tops):
        group, subroot, ways = held[s]
        for r, way in zip(group, ways):
            steps = way + top
            struck = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(*r[:4], lower(r[4])) if struck else leaf(*r)
            for left, right in steps:
                node = h(left + node + right)
            out.append((r[0], leaf(*r), subroot, root, h("".join(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=str)


def found(spark, rows, fanout, levels):
    docs = spark.createDataFrame([(*r, "clash", 1, 2, "x", 3) for r in rows], SCHEMA)
    struck = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    made = merkle.manifest(docs, {"text": merkle.lowered(F.col("text"))}, struck, fanout, levels)
    folded = merkle.folded(F.col("path"), F.coalesce("other", "leaf"))
    got = made.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), folded, folded == F.col("root"))
    return sorted(map(tuple, got.collect()), key=str)


ODD = [
    (3, "b", "en", 4, "Text"), (1, "b", None, None, None), (2, "b", "de", 0, ""), (2, "b", "de", 0, ""),
    (2, "b", "de", 0, "other"), (None, "b", "en", 1, "A"), (None, "b", "en", 1, "B"), (None, None, None, None, None),
    (7, None, "en", 3, "ÄÖÜ Äx"), (8, "é", "en", 3, "x" * 5000 + "ABC"), (-5, "z", "en", 3, "only one"),
]


@pytest.mark.parametrize("fanout, levels, many", [(2, 1, 0), (2, 2, 70), (3, 2, 40), (16, 2, 300)])
def test_manifest(spark, fanout, levels, many):
    rows = ODD + [(i, ["hot", "hot", "s1"][i % 3] if many < 100 else "hot", "en", i, f"Document {i}") for i in range(many)]
    assert found(spark, rows, fanout, levels) == plain(rows, fanout)


def test_many_sources_and_none(spark):
    rows = [(i, f"s{i:03d}", "en", 1, "T") for i in range(90)]
    assert found(spark, rows, 4, 1) == plain(rows, 4)
    assert found(spark, [], 4, 1) == []


def test_untampered_rows_are_verified_and_changes_are_seen(spark):
    rows = found(spark, [(i, "s", "en", 1, "Abc") for i in range(40)], 16, 2)
    bad = {r[0] for r in rows if not r[6]}
    assert bad == {i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0} and bad
