"""Quality classifier: Bradley-Terry ranking learned from preference pairs.

Every document has a utility ``w . x`` of its features ``x``; the chance that a good
document is preferred to a bad one is the logistic function of the difference of their
utilities. ``w`` minimises the logistic loss over pairs (one good, one bad document),
that is over differences of features. The decision is a quantile of the utilities: the
share of bad rows among all training labels. Utilities are mapped to 0..1 by an
increasing function that takes the value ``ACCEPT`` at that quantile.

An empty or null text has features of its own (all zero) and gets a score like any
other. Without labels of both kinds every score is the share of good labels (0.5 without
any label). A document with several equal labels counts once in the pairs, one with both
labels counts as each; labels other than 0 and 1, or without an id, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import fold, table, texts

ACCEPT = 0.3
#: Training rows taken per label, the first by hash of the id: bounds what the driver gets.
SAMPLE_PER_LABEL = 8_000
#: Partners of each sampled row among the rows of the other label.
PARTNERS = 8
RIDGE = 1e-3

_CLASSES = np.zeros((256, 8), np.float64)
for _k, _chars in enumerate((
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:'\"()-",
    b"!?", b"#$%&*@^~+=_<>", b"|/\\{}[]", b"\n",
)):
    _CLASSES[list(_chars), _k] = 1
FEATURES = 22


def features(text: str | None) -> np.ndarray:
    """Numbers that describe the form of a text, whatever its language."""
    data = (text or "").encode()
    words = data.split()
    out = np.zeros(FEATURES)
    if not words:
        return out
    n = len(words)
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES
    out[:8] = shares / len(data)
    kinds = set(words)
    lines = data.split(b"\n")
    lengths = np.fromiter(map(len, words), np.float64, n)
    out[8] = np.log1p(n)
    out[9] = lengths.mean()
    out[10] = lengths.std()
    out[11] = len(kinds) / n
    out[12] = np.log(len(kinds)) / np.log(n + 1)
    out[13] = sum(map(bytes.__eq__, words, words[1:])) / n
    out[14] = len(set(zip(words, words[1:]))) / n
    out[15] = np.log1p(len(data) / len(lines))
    out[16] = len(set(lines)) / len(lines)
    out[17] = sum(map(bytes.isupper, words)) / n
    out[18] = sum(map(bytes.isalpha, words)) / n
    out[19] = sum(1 for word in words if len(word) == 1) / n
    out[20] = n < 10
    out[21] = 1.0
    return out


@dataclass(frozen=True)
class RankingModel:
    """Weights of standardised features, and the map from utility to score."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    scale: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))
    cut: float = 0.0
    slope: float = 0.0
    intercept: float = 0.0

    def utility(self, x: np.ndarray) -> np.ndarray:
        # Features far outside what was seen in training do not run away with the score.
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.utility(x) - self.cut) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def rank_by_pairs(good: np.ndarray, bad: np.ndarray, steps: int = 30) -> np.ndarray:
    """Bradley-Terry weights: Newton steps on the logistic loss of feature differences."""
    i = np.arange(max(len(good), len(bad)))
    stride = [1 + 7919 * k for k in range(PARTNERS)]
    d = np.concatenate([good[i % len(good)] - bad[(i * 31 + s) % len(bad)] for s in stride])
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        gradient = d.T @ p / len(d) - RIDGE * w
        curvature = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(good: np.ndarray, bad: np.ndarray, good_rows: int, bad_rows: int) -> RankingModel:
    """Model from sampled features of both labels and the number of training rows of each."""
    if not len(good) or not len(bad):
        rows = good_rows + bad_rows
        return RankingModel(intercept=_logit(good_rows / rows if rows else 0.5))
    both = np.concatenate([good, bad])
    centre, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale < 1e-9] = 1.0
    scaled = np.clip((both - centre) / scale, -8, 8)
    weights = rank_by_pairs(scaled[: len(good)], scaled[len(good):])
    utility = scaled @ weights
    share = np.r_[np.full(len(good), good_rows / len(good)), np.full(len(bad), bad_rows / len(bad))]
    order = np.argsort(utility)
    reached = np.cumsum(share[order]) / share.sum()
    k = int(np.searchsorted(reached, bad_rows / (good_rows + bad_rows)))
    pair = utility[order[k: k + 2]]
    cut = float(pair.mean())
    label = np.r_[np.ones(len(good)), np.zeros(len(bad))]
    slope, base = 1.0, _logit(ACCEPT)
    for _ in range(50):
        u = utility - cut
        p = 1 / (1 + np.exp(-np.clip(slope * u + base, -500, 500)))
        gradient = (share * (label - p) * u).sum() - 1e-3 * slope * share.sum()
        curvature = (share * p * (1 - p) * u * u).sum() + 1e-3 * share.sum()
        slope = max(1e-3, slope + gradient / curvature)
    return RankingModel(weights, centre, scale, cut, slope, base)


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0,
    per_label: int = SAMPLE_PER_LABEL,
) -> RankingModel:
    """Learn from labelled rows outside the held-out fold, at most ``per_label`` of each label.

    The sampled ids (two times ``per_label`` at most) are broadcast to the documents;
    their features, not their texts, come to the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("_label")).where(
        F.col("_label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out)
    ).distinct()  # a repeated row of labels counts once
    rows = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    picked = None
    for label in (0, 1):
        some = known.where(F.col("_label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        picked = some if picked is None else picked.unionByName(some)

    @F.pandas_udf("array<double>")
    def described(text: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in text])

    found = (
        texts(docs).join(F.broadcast(picked), "doc_id")
        .select("doc_id", "_label", described("text").alias("x"))
        .groupBy("doc_id", "_label").agg(F.min("x").alias("x"))  # a repeated id counts once
        .orderBy("_label", "doc_id").toPandas()
    )
    x = {k: np.array(list(found.x[found._label == k])).reshape(-1, FEATURES) for k in (0, 1)}
    return fit(x[1], x[0], rows.get(1, 0), rows.get(0, 0))


def score(model: RankingModel, text: Column | str = "text") -> Column:
    """Score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def scored(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([features(t) for t in values])))

    return scored(F.col(text) if isinstance(text, str) else text)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    model = train(docs, labels)
    return texts(docs).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), score(model).alias("score")
    ).withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns kept."""
    model = train(docs, labels)
    return docs.where(score(model, F.coalesce(F.col("text"), F.lit(""))) >= ACCEPT)


def op1_quality_ranking(spark, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
