"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions only.

A shingle is ``SHINGLE`` consecutive words (all words of a shorter text; none for a text
without words); its hash folds the XXH64 of its words. A sketch is the ascending list of the
``K`` smallest distinct hashes. Sketches of parts merge into the sketch of the whole. From
them follow the resemblance of two texts, the containment of one in another and the number
of distinct shingles; all three are exact while the union has at most ``K`` shingles.

Two empty sketches resemble each other fully (1), an empty and another one not at all (0).

The following document is found without a global order in one task: ranges of ids are cut at
approximate quantiles, every range gets a copy of the first document of the next one, and
a window runs within each range. A null id comes first; equal ids are ordered by
their text. The document after the last is the first one, which may be itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.llm.common import blocks_of, table, texts

SHINGLE = 5
K = 128
RANGE_CHARS = 2_000_000
#: The starts of the ranges are part of the plan, so beyond this many the ranges grow instead.
MOST_RANGES = 10_000

_LOWEST = -(1 << 63)


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is named inside lambdas."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def sketch(text: Column | str, k: int = K, shingle: int = SHINGLE) -> Column:
    """Bottom-k sketch of a text column, an array of longs."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return _with(hashed, lambda h: _least(_shingled(h, shingle), k))


def _shingled(hashed: Column, shingle: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(hashed) - (shingle - 1), F.lit(1)))
    return F.when(F.size(hashed) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(starts, lambda i: F.xxhash64(F.slice(hashed, i, shingle)))
    )


def _least(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of two texts."""
    return _with(merged(a, b, k), lambda union: F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union)
    ))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact for a sketch that is not full."""
    largest = F.element_at(a, -1).cast("double") + F.lit(float(1 << 63)) + 1.0
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (largest / float(1 << 64)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that are in ``b``; 1 for an ``a`` without any."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def text_form(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits per hash."""
    return F.lower(F.concat_ws("", F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0"))))


def with_next(docs: DataFrame, range_chars: int = RANGE_CHARS) -> tuple[DataFrame, Window]:
    """Documents by ranges of ids, with copies of the next range's first (``tail`` = 1)."""
    ranges = min(MOST_RANGES, blocks_of(docs, range_chars))
    keyed = docs.withColumn("key", F.coalesce("doc_id", F.lit(_LOWEST)))
    cuts = [i / ranges for i in range(1, ranges)]
    row = keyed.agg(
        F.min("key").alias("least"), F.percentile_approx("key", cuts or [0.0], max(10_000, 20 * ranges)).alias("cuts")
    ).first()
    starts = sorted({row["least"], *(row["cuts"] or [])}) if row["least"] is not None else [0]
    # Range of a key: the last start that is not above it, by binary search.
    begin = F.array(*[F.lit(s).cast("long") for s in starts])
    steps = F.array(*[F.lit(1 << b) for b in range(len(starts).bit_length() - 1, -1, -1)])
    keyed = keyed.withColumn("range", F.aggregate(
        steps, F.lit(0),
        lambda n, step: F.when((n + step <= len(starts)) & (F.get(begin, n + step - 1) <= F.col("key")), n + step).otherwise(n),
    ))
    spark = docs.sparkSession
    heads = spark.createDataFrame(
        [(s, k or len(starts)) for k, s in enumerate(starts)], "key long, _before int"
    )
    tails = keyed.join(F.broadcast(heads), "key").select("doc_id", "text", "key", F.col("_before").alias("range"), F.lit(1).alias("tail"))
    both = keyed.select("doc_id", "text", "key", "range", F.lit(0).alias("tail")).unionByName(tails)
    return both, Window.partitionBy("range").orderBy("tail", "key", "text")


def edited(text: str, following: str) -> Column:
    """The last half of the code points replaced by the first as many of the next text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), n - half), F.substring(F.col(following), F.lit(1), half))


def fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Sketches of each text, of its edited text and of the next text, with estimates."""
    rows, order = with_next(texts(docs))
    # A repeated first row has several copies at the end of the range before: the first one counts.
    follows = rows.withColumn("following", F.coalesce(F.lead("text").over(order), F.lit(""))).withColumn(
        "edited", edited("text", "following")
    )
    sketched = follows.select(
        "doc_id", "key", "text", "range", "tail", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        sketch("text", k, shingle).alias("sketch"), sketch("edited", k, shingle).alias("edited_sketch"),
    )
    return (
        sketched.withColumn("next_sketch", F.lead("sketch").over(order)).where("tail = 0")
        .drop("key", "text", "range", "tail")
    )


def op6_bottomk_fingerprints(spark, sf_dir: str) -> DataFrame:
    a, e, n = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256",
        text_form(a).alias("fingerprint"), text_form(e).alias("edited_fingerprint"),
        resemblance(a, e).alias("near_edited"), resemblance(a, n).alias("near_next"),
        distinct_shingles(a).alias("distinct_shingles"), containment(a, e).alias("contained_in_edited"),
    )
