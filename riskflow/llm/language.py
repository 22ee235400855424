"""Language identification: each document as a mixture of languages.

A language is a distribution over hashed byte trigrams, learned from a bounded sample of
labelled documents. For a document, expectation-maximisation estimates the proportions
of all languages; the languages are then added in the order of their proportions as long
as the log-likelihood gains more than a penalty (half the log of the number of trigrams,
as in the Bayesian information criterion). The prediction is the language with
the largest proportion within the chosen set, the score that proportion.

A null text, or one without a letter, is ``und`` with score 0. Equal proportions go to
the language that sorts first. Without any labelled text every prediction is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import fold, table

#: Documents taken per language for the trigram counts, the first by hash of the id.
SAMPLE_PER_LANGUAGE = 3_000
BUCKETS = 1 << 15
SMOOTHING = 0.2
UNDETERMINED = "und"

_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def trigrams(data: bytes) -> np.ndarray:
    """Bucket of every trigram of the lower-cased text; what is not a letter is a space."""
    squeezed = b" " + b" ".join(data.translate(_LETTERS).split()) + b" "
    b = np.frombuffer(squeezed, np.uint8).astype(np.uint32)
    if b.size < 3:
        return np.zeros(0, np.int64)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """Names of the languages and the chance of every bucket in each of them."""

    names: list[str]
    chances: np.ndarray

    def proportions(self, buckets: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Chosen languages and their proportions for the trigrams of one text."""
        kinds, n = np.unique(buckets, return_counts=True)
        n = n.astype(np.float64)
        p = self.chances[:, kinds]
        everything = np.arange(len(self.names))
        weights, _ = _mixture(p, n, everything)
        order = np.argsort(-weights, kind="stable")
        chosen = order[:1]
        shares, best = np.ones(1), float(n @ np.log(p[chosen[0]]))
        penalty = 0.5 * np.log(max(n.sum(), 2.0)) + 2.0
        for k in range(2, len(order) + 1):
            more, likelihood = _mixture(p, n, order[:k])
            if likelihood - best <= penalty:
                break
            chosen, shares, best = order[:k], more, likelihood
        return list(chosen), shares

    def identify(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        buckets = trigrams(text.lower().encode())
        if not buckets.size:
            return UNDETERMINED, 0.0
        chosen, shares = self.proportions(buckets)
        top = float(shares.max())
        return min(self.names[c] for c, s in zip(chosen, shares) if s == top), min(1.0, top)


def _mixture(p: np.ndarray, n: np.ndarray, languages: np.ndarray, steps: int = 40) -> tuple[np.ndarray, float]:
    """Proportions of some languages by expectation-maximisation, and the log-likelihood."""
    p = p[languages]
    weights = np.full(len(languages), 1 / len(languages))
    total = n.sum()
    for _ in range(steps):
        mixed = weights @ p
        new = weights * (p @ (n / mixed)) / total
        done = np.abs(new - weights).max() < 1e-4
        weights = new
        if done:
            break
    return weights, float(n @ np.log(np.maximum(weights @ p, 1e-300)))


def train(docs: DataFrame, folds: int = 4, held_out: int = 2, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Trigram counts per language outside the held-out fold, summed by Spark.

    The sample takes ids by hash below a bar that leaves about ``per_language`` documents
    of each language; rows without an id are taken by the hash of their text. One row of ``BUCKETS`` counts per language comes to the driver.
    """
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text"
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", folds) != held_out))
    rows = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not rows:
        return LanguageModel([], np.zeros((0, BUCKETS)))
    steps = 1 << 20
    bars = F.create_map(*[F.lit(x) for name, n in rows.items() for x in (name, min(steps, 1 + steps * per_language // n))])
    sample = known.where(F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(steps)) < bars[F.col("lang")])

    def counted(parts):
        sums: dict[str, np.ndarray] = {}
        for batch in parts:
            for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                sums[name] = sums.get(name, 0) + np.bincount(trigrams(text.lower().encode()), minlength=BUCKETS)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(list(sums), pa.string()),
            "counts": pa.array([v.astype(np.int64) for v in sums.values()], pa.list_(pa.int64())),
        })

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [frame.lang.iloc[0]], "counts": [np.sum(list(frame.counts), axis=0)]})

    shape = "lang string, counts array<bigint>"
    found = sample.select("lang", "text").mapInArrow(counted, shape).groupBy("lang").applyInPandas(summed, shape).toPandas()
    found = found.sort_values("lang")
    counts = np.array(list(found.counts), np.float64).reshape(-1, BUCKETS) + SMOOTHING
    return LanguageModel(list(found.lang), counts / counts.sum(axis=1, keepdims=True))


def identified(model: LanguageModel, text: Column | str = "text") -> Column:
    """A struct of ``lang_pred`` and ``score`` for a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def named(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.identify(t) for t in values], columns=["lang_pred", "score"])

    return named(F.col(text) if isinstance(text, str) else text)


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``."""
    model = train(docs)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold("doc_id", 4) == 2).alias("held_out"),
        identified(model).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


def op9_language_mixture(spark, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))
