"""SimHash near-duplicates found by covering locality-sensitive hashing.

A text is lower-cased (A-Z), cut into words and 4-word shingles; bit ``i`` of its
fingerprint is set if more than half of the shingles' XXH64 values have it set. Two
fingerprints are linked if at most ``RADIUS`` bits differ; a component is what links
connect, named by its smallest id. Every bit position gets a vector over GF(2) of
``RADIUS + 1`` bits. For each non-zero vector ``v`` a mask keeps the positions whose
vector has an odd product with ``v``. The vectors of at most ``RADIUS`` differing positions
do not span the space, so some ``v`` is orthogonal to all of them, and under its mask
the two fingerprints are equal: every pair within the radius meets in some table.

Texts without a word have fingerprint zero and are linked like any other. Repeated rows
share a fingerprint. A component without any non-null id has a null name.

Copies meet in one row per fingerprint before any search. A bucket of up to
``BUCKET`` fingerprints is searched within a task, in memory linear in its size; one that
is larger is dissolved: fingerprints are linked if and only if some point lies within
half the radius of both, so each is dealt out to its ball of points and linked to the
smallest fingerprint of each point. That takes work in proportion to the fingerprints.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from riskflow.llm.common import row_key, table, texts
from riskflow.llm.components import roots, survivors
from riskflow.sources.tables import written

RADIUS = 4
WORDS = 4
SEED = 42
#: Fingerprints of a bucket that one task compares.
BUCKET = 20_000


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of a text, as a signed integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= WORDS:
        h = np.array([digest(b" ".join(words), SEED)], np.uint64)
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begins = np.concatenate([[0], ends[:-1]])
        count = len(words) - WORDS + 1
        cuts = zip(begins[:count].tolist(), (ends[WORDS - 1:] - 1).tolist())
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in cuts), np.uint64, count)
    set_bits = np.zeros(64, np.int64)
    for k in range(0, h.size, 1 << 15):
        part = h[k: k + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = int(np.packbits(2 * set_bits > h.size, bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >> 63 else value


@F.pandas_udf(LongType())
def fingerprints(values: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in values], dtype="int64")


def masks(radius: int = RADIUS) -> list[int]:
    """Covering masks, as signed integers: each bit position uses the next non-zero vector."""
    kinds = (1 << (radius + 1)) - 1
    vector = [1 + position % kinds for position in range(64)]
    out = []
    for v in range(1, kinds + 1):
        mask = sum(1 << i for i in range(64) if (vector[i] & v).bit_count() & 1)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def chains(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect what is connected among some fingerprints."""
    left = np.unique(values)
    links = []
    while left.size > 1:
        root, left, border = left[0], left[1:], [left[0]]
        while border and left.size:
            x = border.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                border.extend(found)
                links.extend((int(root), int(f)) for f in found)
    return links


def _ball(radius: int) -> np.ndarray:
    """Every pattern with at most ``radius`` bits set."""
    ones = np.uint64(1) << np.arange(64, dtype=np.uint64)
    rings = [np.zeros(1, np.uint64)]
    for _ in range(radius):
        rings.append(np.unique(rings[-1][:, None] ^ ones[None, :]))
    return np.unique(np.concatenate(rings))


def _dissolved(members: DataFrame, radius: int) -> DataFrame:
    """Links among fingerprints of buckets of any size: through the points of their balls."""
    half = radius // 2
    ball = _ball(half)

    def dealt(parts):
        for batch in parts:
            for f in batch.column("fp").to_numpy(zero_copy_only=False):
                points = (np.int64(f).view(np.uint64) ^ ball).view(np.int64)
                yield pa.RecordBatch.from_pydict({"fp": np.full(points.size, f), "point": points})

    points = members.select("fp").distinct().mapInArrow(dealt, "fp long, point long")
    least = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z")
    return points.join(least, "point").select("a", F.col("fp").alias("b")).where("a <> b").distinct()


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect the distinct fingerprints ``fp`` within the radius.

    ``radius`` is even when a bucket exceeds ``bucket``.
    """
    keyed = prints.select("fp", F.explode(F.array(*[
        F.xxhash64(F.col("fp").bitwiseAND(F.lit(mask)), F.lit(t)) for t, mask in enumerate(masks(radius))
    ])).alias("key"))
    full = written(
        keyed.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
        ).where("n > 1"), "buckets",
    )
    pairs = full.where("n = 2").select("a", "b").where(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    )
    crowded = full.where("n > 2").select("key", "n")

    @F.pandas_udf("array<struct<a:long,b:long>>")
    def chained(groups: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in chains(np.asarray(g, np.int64), radius)] for g in groups])

    members = keyed.join(crowded, "key")
    searched = (
        members.where(F.col("n") <= bucket).groupBy("key").agg(F.collect_list("fp").alias("fps"))
        .select(F.explode(chained("fps")).alias("link")).select("link.a", "link.b")
    )
    found = pairs.unionByName(searched)
    if full.where(F.col("n") > bucket).limit(1).count():
        if radius % 2:
            raise ValueError("an odd radius cannot be halved for buckets beyond the limit")
        found = found.unionByName(_dissolved(members.where(F.col("n") > bucket), radius))
    return found.distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``."""
    printed = written(texts(docs).select("doc_id", fingerprints("text").alias("fp")), "prints")
    prints = printed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = roots(links(prints.select("fp"), radius, bucket))
    classes = prints.join(linked.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = classes.join(
        classes.groupBy("root").agg(F.min("least").alias("component_id")), "root"
    ).select("fp", "component_id")
    return printed.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def text_links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` of the nodes of ``node, text`` (one row each) whose fingerprints are connected within the radius."""
    printed = written(nodes.select("node", fingerprints("text").alias("fp")), "prints")
    prints = printed.groupBy("fp").agg(F.min("node").alias("least"))
    same = printed.join(prints, "fp").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    named = lambda end: prints.select(F.col("fp").alias(end), F.col("least").alias(f"least_{end}"))
    near = links(prints.select("fp"), radius, bucket).join(named("a"), "a").join(named("b"), "b")
    return same.unionByName(near.select(F.col("least_a").alias("a"), F.col("least_b").alias("b")))


def hexadecimal(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every component: the one with the smallest id, then text hash; no id comes last."""
    keyed = docs.select(row_key(docs).alias("key"), F.struct("*").alias("row"))
    prints = written(
        keyed.select("key", fingerprints(F.coalesce("row.text", F.lit(""))).alias("fp")), "prints"
    ).groupBy("fp").agg(F.min("key").alias("key"))
    return survivors(keyed, prints.withColumnRenamed("fp", "node"), roots(links(prints.select("fp"))))


def op3_simhash_components(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", hexadecimal().alias("fingerprint"), "component_id"
    )
