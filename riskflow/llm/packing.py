"""Packing of tokenized documents into sequences by non-negative least squares.

Documents longer than a window are cut at multiples of it; what is left of each is
shorter than a window. A *combination* is a set of up to three such lengths that fill
a window exactly. How often each combination is used solves a non-negative least-squares
problem against the histogram of lengths, rounded to whole numbers that the histogram
covers; the few lengths left over are packed greedily, the longest first, each window
filled with the longest that still fits.

The histogram, one count per length, is all that reaches the driver. Pieces of a length
are numbered by counting within each input partition and adding the counts of the
partitions before it, so no group of equal lengths meets in a task.

A null text is empty; every document ends with ``END``, so none is without a piece.
Repeated rows are packed as often as they occur. An empty table gives no piece.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskflow.llm.common import small, table, texts
from riskflow.llm.tokens import encoder, path
from riskflow.sources.tables import written

VOCABULARY = "byte_bpe_50k.json"
END = 0
WINDOW = 1024
ITERATIONS = 400


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of given lengths that add up to the window; 0 pads a pair."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    a = lengths[2 * lengths <= window]
    pairs = a[there[window - a]]
    out = [np.stack([np.zeros_like(pairs), pairs, window - pairs], axis=1)]
    for x in lengths[3 * lengths <= window]:
        y = lengths[(lengths >= x) & (2 * lengths <= window - x)]
        y = y[there[window - x - y]]
        out.append(np.stack([np.full_like(y, x), y, window - x - y], axis=1))
    return np.concatenate(out)


def repeats(histogram: np.ndarray, combos: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Non-negative repeat counts x that bring A x near the histogram: accelerated projected gradient."""
    size = histogram.size

    def used(x):
        total = sum(np.bincount(combos[:, j], weights=x, minlength=size) for j in range(3))
        total[0] = 0.0
        return total

    weight = np.ones(size)
    weight[0] = 0.0
    v = np.ones(len(combos))
    for _ in range(20):  # largest eigenvalue, for the step
        v = v / np.linalg.norm(v)
        r = used(v)
        v = sum((weight * r)[combos[:, j]] for j in range(3))
    step = 1 / (1.05 * np.linalg.norm(v))
    goal = histogram.astype(float)
    goal[0] = 0.0
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(iterations):
        r = weight * (used(y) - goal)
        new = np.maximum(0.0, y - step * sum(r[combos[:, j]] for j in range(3)))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


@dataclass(frozen=True)
class Plan:
    """For every length: from which piece on, to which sequence and offset pieces go."""

    places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    sequences: int

    def place(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, sequence, offset = self.places[length]
        k = np.searchsorted(begin, rank, side="right") - 1
        return sequence[k] + rank - begin[k], offset[k]


def plan(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """Sequences for ``histogram[length]`` pieces of each length, ``window`` included."""
    left = histogram.astype(np.int64).copy()
    bins: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        bins.append(((window,), int(left[window])))
        left[window] = 0
    combos = combinations(np.flatnonzero(left), window)
    if len(combos):
        x = repeats(left[:window], combos)
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 0.5:
                break
            lengths = [int(n) for n in combos[k] if n]
            times = min(int(round(x[k])), *(int(left[n]) // lengths.count(n) for n in set(lengths)))
            if times > 0:
                bins.append((tuple(lengths), times))
                for n in lengths:
                    left[n] -= times
    while left.any():
        lengths, space = [], window
        open_left = left.copy()
        while True:
            fits = np.flatnonzero(open_left[: space + 1])
            if not fits.size:
                break
            n = int(fits[-1])
            lengths.append(n)
            open_left[n] -= 1
            space -= n
        times = min(int(left[n]) // lengths.count(n) for n in set(lengths))
        bins.append((tuple(lengths), times))
        for n in lengths:
            left[n] -= times
    places: dict[int, list] = {}
    given, sequence = np.zeros(window + 1, np.int64), 0
    for lengths, times in bins:
        offset = 0
        for n in lengths:
            places.setdefault(n, []).append((given[n], sequence, offset))
            given[n] += times
            offset += n
        sequence += times
    return Plan({n: tuple(np.array(c, np.int64) for c in zip(*p)) for n, p in places.items()}, sequence)


_PIECE = "part long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, rank long, ids binary"
_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def pieces(docs: DataFrame, file: str, end: int = END, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Written table of all pieces, numbered by length within their input partition."""

    def cut(parts):
        encode_texts, last, part = encoder(file).column, end.to_bytes(4, "little"), TaskContext.get().partitionId()
        seen = [0] * (window + 1)
        for batch in parts:
            rows = []
            found = encode_texts(batch.column("text"))
            for i, text_ids in zip(batch.column("doc_id").to_pylist(), found):
                ids = text_ids + last
                total = len(ids) // 4
                for a in range(0, total, window):
                    piece = ids[4 * a: 4 * (a + window)]
                    n = len(piece) // 4
                    rows.append((part, i, a, n, zlib.crc32(piece), total, seen[n], piece if with_ids else None))
                    seen[n] += 1
            yield _batch(rows, 7)

    return written(texts(docs).mapInArrow(cut, _PIECE), "pieces")


def _batch(rows: list[tuple], numbers: int) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in range(numbers + 1)]
    names = [f.split()[0] for f in (_PIECE if numbers == 7 else _PACKED).split(", ")]
    kinds = [pa.int64()] * numbers + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def packed(
    docs: DataFrame, file: str, end: int = END, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """Every piece with its sequence and offset; ``ids`` (little-endian, 32 bits) if asked for."""
    cut = pieces(docs, file, end, window, with_ids)
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = np.zeros(window + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    target = plan(histogram, window)

    def dealt(parts):
        for batch in parts:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(length.size, np.int64), np.zeros(length.size, np.int64)
            for n in np.unique(length):
                m = length == n
                sequence[m], offset[m] = target.place(int(n), rank[m])
            names = [f.split()[0] for f in _PACKED.split(", ")]
            columns = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays(
                [columns[n] if n in columns else batch.column(n) for n in names], names=names
            )

    # The pieces stay where they are while the counts, one a length and partition, fit a broadcast.
    return cut.join(small(offsets), ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "ids"
    ).mapInArrow(dealt, _PACKED)


def op8_nnls_packing(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), path(VOCABULARY)).drop("ids")
