"""Helpers shared by the operators: columns, working tables, blocks of documents, packed keys.

Rules that hold for every operator unless its docstring says otherwise: a null text is
an empty text, a null id sorts before all others and hashes like the empty string, each
row is a document of its own (repeated rows are repeated documents), and columns other
than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows of a small side, counted before it is broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and non-null ``text`` of a table of documents."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def row_key(docs: DataFrame) -> Column:
    """What tells rows apart, in order: id (none last), hash of the text, hash of the other columns.

    Only rows that are equal share a key (maps cannot be hashed and are left out of it).
    """
    rest = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()]
    doc_id = F.col("doc_id").cast("long")
    return F.struct(
        doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text"), F.xxhash64(F.col("text").isNull(), *rest).alias("rest"),
    )


def fold(doc_id: str, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a frame for broadcast if a count shows that it has at most ``rows`` rows."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def blocks_of(docs: DataFrame, block_chars: int) -> int:
    """Number of blocks of about ``block_chars`` characters: one narrow pass over lengths."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(1, -(-int(total) // block_chars))


def with_block(docs: DataFrame, blocks: int) -> DataFrame:
    """A block number that depends on the row alone, so a repeated task deals rows alike."""
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)))


# --- words -----------------------------------------------------------------------------


class WordHashes(dict):
    """XXH64 of words, remembered up to a number of words that bounds the memory."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value


def joined_hashes(documents: Iterable[list[bytes]], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some documents in a row, and where each document begins."""
    parts, ends = [], [0]
    for words in documents:
        parts.append(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))
        ends.append(ends[-1] + len(words))
    joined = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return joined, np.array(ends, np.int64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xCA5A826395121157)
    return values ^ (values >> np.uint64(32))


# --- keys dealt to parts ----------------------------------------------------------------


def part_edges(keys: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Cuts of sorted ``bits``-bit keys into ``parts`` equal ranges of the key space."""
    bounds = [(p << bits) // parts for p in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(bounds, np.uint64)), [keys.size]]).astype(np.int64)


def part_of(keys: np.ndarray, bits: int, parts: int) -> np.ndarray:
    bounds = np.array([(p << bits) // parts for p in range(1, parts)], np.uint64)
    return np.searchsorted(bounds, keys, side="right")


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte: the first byte names the width."""
    if not keys.size:
        return b""
    gaps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + np.ascontiguousarray(planes).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :width] = planes.T
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


def binary(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 of a text column."""
    return column.cast(pa.binary()).to_pylist()


def bitmap(hashes: DataFrame, size: int):
    """A broadcast bitmap of ``2 ** size`` bits, whatever the rows, with the lowest ``size`` bits of all ``hash`` set."""
    spot = F.col("hash").bitwiseAND((1 << size) - 1) + 1  # bitmap positions count from 1
    rows = hashes.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")
    ).collect()  # at most 2 ** (size - 15) rows of 4 KB
    bits = np.zeros(1 << (size - 3), np.uint8)
    for r in rows:
        begin = (r["bucket"] - 1) << 12
        bits[begin: begin + (1 << 12)] = np.frombuffer(r["bits"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(bits)
