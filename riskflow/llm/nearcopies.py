"""Near copies for the pipeline: five-word shingles, Jaccard similarity of at least 0.8.

A text is lower-cased (A-Z) and cut into words; its shingles are ``WORDS`` consecutive
words (all words of a text that has fewer), compared by 64-bit hashes. Two texts are linked
if and only if they met as candidates and the Jaccard similarity of their sets of shingles,
counted exactly, is at least ``SIMILARITY``; a component is what links connect.

Candidates meet in one of ``BANDS`` tables under ``ROWS`` equal minimum hashes. A pair of
similarity s meets nowhere with probability ``(1 - s**ROWS)**BANDS``: 3 in 100,000 at 0.8,
less above. The 64-bit SimHash of ``op3`` does not reach 0.8: there about 10 bits differ,
some pairs 16, and covering those takes 2**17 tables.

Texts of equal words are one node before any search; texts without a word are one node too.
A bucket is searched within a task by a walk that takes what is linked out of the
search, so a group of near copies costs about one pass. Buckets of more than ``BUCKET`` nodes
are dealt again, by pairs of tables, which parts nodes that are not alike. That misses pairs
that meet in one crowded bucket alone, so the nodes of crowded buckets are then searched by an exact
rule: of two linked sets, shingles in order of how few nodes hold them, the first fifth
of one and that of the other have a shingle in common. Only groups that do not lie within one component
by then are searched; a group is searched whole, whatever its size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from riskflow.llm.common import WordHashes, mix, row_key
from riskflow.llm.components import roots, survivors
from riskflow.sources.tables import written

WORDS = 5
SIMILARITY = 0.8
ROWS = 4
BANDS = 20
#: Nodes of a bucket that is not dealt again.
BUCKET = 4_000
_RANDOM = np.random.default_rng(42)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingles(words: list[bytes], cache: WordHashes) -> np.ndarray:
    """Distinct hashes of the shingles of some words, sorted."""
    hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    if not width:
        return hashes
    joined = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        joined = mix(joined ^ hashes[k: k + joined.size]) + np.uint64(k)
    return np.unique(joined)


def band_keys(found: np.ndarray) -> np.ndarray:
    """A key of each table, for a set of shingles."""
    least = np.full(BANDS * ROWS, np.uint64((1 << 64) - 1))
    for k in range(0, found.size, 4096):
        part = found[k: k + 4096, None] * _FACTORS + _SHIFTS
        least = np.minimum(least, part.min(axis=0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        keys = mix(keys ^ row) + np.uint64(1)
    return keys.view(np.int64)


@F.pandas_udf(StructType().add("node", LongType()).add("keys", ArrayType(LongType())))
def signed(values: pd.Series) -> pd.DataFrame:
    cache, nodes, keys = WordHashes(), [], []
    for text in values:
        words = text.encode().lower().split()
        nodes.append(xxhash.xxh64_intdigest(b" ".join(words), 42))
        keys.append(band_keys(shingles(words, cache)) if words else np.zeros(0, np.int64))
    return pd.DataFrame({"node": np.array(nodes, np.uint64).view(np.int64), "keys": keys})


@F.pandas_udf(ArrayType(LongType()))
def shingled(values: pd.Series) -> pd.Series:
    cache = WordHashes()
    return pd.Series([shingles(t.encode().lower().split(), cache).view(np.int64) for t in values])


def walked(values: np.ndarray, sizes: np.ndarray, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links, as places, that connect what is connected among sets that lie in ``values`` in a row."""
    kinds, values = np.unique(values, return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    of = lambda i: values[begins[i]: begins[i] + sizes[i]]
    links, left = [], np.arange(sizes.size)
    rest, starts = values, begins
    held = np.zeros(kinds.size, bool)
    while left.size > 1:
        root, border = left[0], [left[0]]
        left, rest, starts = left[1:], rest[sizes[root]:], starts[1:] - sizes[root]
        while border and left.size:
            x = border.pop()
            held[of(x)] = True
            common = np.add.reduceat(held[rest], starts, dtype=np.int64)
            held[of(x)] = False
            near = common >= similarity * (sizes[x] + sizes[left] - common)
            if near.any():
                border.extend(left[near])
                links.extend((int(root), int(i)) for i in left[near])
                rest, left = rest[np.repeat(~near, sizes[left])], left[~near]
                starts = np.cumsum(sizes[left]) - sizes[left]
    return links


def _verified(key: tuple, group: pa.Table) -> pa.Table:
    sets, nodes = pa.concat_arrays(group.column("shingles").chunks), group.column("node").to_numpy()
    sizes = np.diff(sets.offsets.to_numpy()).astype(np.int64)
    links = np.array(walked(sets.flatten().to_numpy(), sizes), np.int64).reshape(-1, 2)
    return pa.table({"a": nodes[links[:, 0]], "b": nodes[links[:, 1]]})


def _buckets(keyed: DataFrame, *by: str) -> DataFrame:
    return keyed.groupBy(*by).agg(F.array_sort(F.collect_set("node")).alias("nodes")).where(F.size("nodes") > 1)


def _searched(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a, b`` within the groups ``nodes``, equal groups once."""
    members = written(
        found.groupBy(F.xxhash64("nodes").alias("bucket")).agg(F.first("nodes").alias("nodes"))
        .select("bucket", F.explode("nodes").alias("node")), "members",
    )
    sets = texts.join(members.select("node").distinct(), "node", "left_semi").select("node", shingled("text").alias("shingles"))
    return members.join(sets, "node").groupBy("bucket").applyInArrow(_verified, "a long, b long").distinct()


def _sharing_prefix(crowded: DataFrame, texts: DataFrame, found: DataFrame) -> DataFrame:
    """Groups ``nodes`` in which all pairs of ``crowded`` nodes meet that are linked, but for those
    that lie within one component of the links ``found``."""
    held = written(
        texts.join(crowded, "node", "left_semi").select("node", F.explode(shingled("text")).alias("shingle")), "shingles"
    )
    ranked = held.join(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")), "shingle")
    size = F.size("ordered")
    # Of n shingles, n - ceil(SIMILARITY * n) + 1 suffice; one more, as the product is rounded.
    first = F.least(size, size - F.floor(SIMILARITY * size).cast("int") + 1)
    prefixes = ranked.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("holders", "shingle"))).alias("ordered")).select(
        "node", F.explode(F.slice("ordered", F.lit(1), first)).alias("first")
    ).where("first.holders > 1")
    known = prefixes.join(roots(found), "node", "left").select(
        F.col("first.shingle").alias("shingle"), "node", F.coalesce("root", "node").alias("root")
    )
    return known.groupBy("shingle").agg(
        F.array_sort(F.collect_list("node")).alias("nodes"), F.min("root").alias("low"), F.max("root").alias("high")
    ).where("low < high").select("nodes")


def links(texts: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect the nodes of ``node, text, keys`` (one row each)."""
    met = written(_buckets(texts.select("node", F.explode("keys").alias("key")), "key"), "buckets")
    crowded = met.where(F.size("nodes") > bucket).select("key", F.explode("nodes").alias("node"))
    again = crowded.join(texts.select("node", F.explode("keys").alias("other")), "node").where("key <> other")
    found = _searched(met.where(F.size("nodes") <= bucket).select("nodes").unionByName(
        _buckets(again, "key", "other").select("nodes")
    ), texts)
    if met.where(F.size("nodes") > bucket).isEmpty():
        return found
    found = written(found, "links")
    rest = _sharing_prefix(written(crowded.select("node").distinct(), "crowded"), texts, found)
    return found.unionByName(_searched(rest, texts)).distinct()


def one_of_each(docs: DataFrame, bucket: int = BUCKET, more: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row of every component: the one with the smallest id, then text hash; no id comes last.

    ``more`` gives further links ``a, b`` for the nodes of ``node, text``; a component is what both kinds connect.
    """
    keyed = docs.select(row_key(docs).alias("key"), F.struct("*").alias("row"))
    printed = written(
        keyed.select("key", F.coalesce("row.text", F.lit("")).alias("text"))
        .select("key", "text", signed("text").alias("s")).select("key", "text", "s.node", "s.keys"), "prints",
    )
    nodes = printed.groupBy("node").agg(F.min("key").alias("key"))
    texts = printed.select("node", "text", "keys").dropDuplicates(["node"])
    found = links(texts, bucket)
    if more is not None:
        found = found.unionByName(more(texts.select("node", "text")))
    return survivors(keyed, nodes, roots(found))
