"""Token files with directly addressable codes.

An id is cut into chunks of ``CHUNK`` bits, lowest first. Level 0 holds the first chunk of
every id and a bitmap that says which ids go on; level ``k`` holds the next chunk of those.
A rank directory counts the set bits before every ``BLOCK`` bits, so the place of an
id on the next level is a lookup and one popcount: any token is read without decoding
others.

A file holds the documents of one range of ids in ascending order (null ids first, equal
ids in the order of their text), with a directory of documents. Files are the
binary rows of a Parquet table in the shared folder, because tasks may write there only
through Spark; each is complete in itself. ``manifest`` gives the number of ids before
each file. A null text is empty; every document ends with ``END``, so none is without ids.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskflow.llm.common import blocks_of, small, table, texts
from riskflow.llm.tokens import encoder, path
from riskflow.sources.tables import written

VOCABULARY = "word_bpe_49k.json"
END = 2
CHUNK = 8
BLOCK = 512
MAGIC = b"DAC1"
#: Ids after which a range of documents goes on in another file.
FILE_IDS = 4_000_000
RANGE_CHARS = 8_000_000

_HEAD = "<4sIQQ"


def encode(doc_ids: list, ids: list[bytes]) -> bytes:
    """One file: ids of each document as little-endian unsigned 32-bit integers."""
    values = np.frombuffer(b"".join(ids), "<u4")
    ends = np.cumsum([0] + [len(d) // 4 for d in ids]).astype("<i8")
    given = np.array([i is not None for i in doc_ids], np.uint8)
    numbers = np.array([0 if i is None else i for i in doc_ids], "<i8")
    levels = []
    rest = values
    while not levels or rest.size:
        more = (rest >> CHUNK) > 0
        bits = np.packbits(more, bitorder="little")
        filled = np.zeros(-(-max(rest.size, 1) // BLOCK) * BLOCK, np.int64)
        filled[: more.size] = more
        ranks = np.concatenate([[0], np.cumsum(filled.reshape(-1, BLOCK).sum(axis=1))]).astype("<u8")
        levels.append(((rest & ((1 << CHUNK) - 1)).astype(np.uint8), bits, ranks))
        rest = rest[more] >> CHUNK
    out = [struct.pack(_HEAD, MAGIC, len(levels), values.size, len(doc_ids)), numbers.tobytes(), given.tobytes(), ends.tobytes()]
    for chunk, bits, ranks in levels:
        out += [struct.pack("<QQQ", chunk.size, bits.size, ranks.size), chunk.tobytes(), bits.tobytes(), ranks.tobytes()]
    return b"".join(out)


class TokenFile:
    """Random access to one file."""

    def __init__(self, data: bytes):
        magic, levels, self.size, documents = struct.unpack_from(_HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self._data, self._at = data, struct.calcsize(_HEAD)
        numbers, given = self._take("<i8", documents), self._take(np.uint8, documents)
        self.doc_ids = [int(n) if g else None for n, g in zip(numbers, given)]
        self.ends = self._take("<i8", documents + 1)
        self._levels = []
        for _ in range(levels):
            sizes = struct.unpack_from("<QQQ", data, self._at)
            self._at += 24
            self._levels.append(tuple(self._take(k, n) for k, n in zip((np.uint8, np.uint8, "<u8"), sizes)))

    def _take(self, kind, count: int) -> np.ndarray:
        out = np.frombuffer(self._data, kind, count, self._at)
        self._at += out.nbytes
        return out

    def _rank(self, level: int, i: int) -> int:
        """Set bits before position ``i``."""
        _, bits, ranks = self._levels[level]
        begin = i // BLOCK * BLOCK
        some = np.unpackbits(bits[begin // 8: -(-i // 8)], bitorder="little")[: i - begin]
        return int(ranks[i // BLOCK]) + int(some.sum())

    def token(self, i: int) -> int:
        """Id at a place of the file."""
        value = 0
        for level, (chunks, bits, _) in enumerate(self._levels):
            value |= int(chunks[i]) << (CHUNK * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Ids of the places ``begin`` to ``end``."""
        out = np.zeros(end - begin, "<u4")
        where = np.arange(end - begin)
        for level, (chunks, bits, _) in enumerate(self._levels):
            if begin >= end:
                break
            out[where] |= chunks[begin:end].astype("<u4") << np.uint32(CHUNK * level)
            first = begin // 8
            more = np.unpackbits(bits[first: -(-end // 8)], bitorder="little")[begin - 8 * first: end - 8 * first].astype(bool)
            where = where[more]
            begin = self._rank(level, begin)
            end = begin + where.size
        return out


def write(docs: DataFrame, file: str, end: int = END) -> DataFrame:
    """Tokenize and write; returns the table of files: ``part, number, ids, data``."""
    docs = texts(docs)
    ranges = blocks_of(docs, RANGE_CHARS)
    ordered = docs.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")

    def files(parts):
        encode_texts, last = encoder(file).column, end.to_bytes(4, "little")
        part, number, doc_ids, ids, held = TaskContext.get().partitionId(), 0, [], [], 0

        def row():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "number": pa.array([number], pa.int64()),
                "ids": pa.array([held], pa.int64()), "data": pa.array([encode(doc_ids, ids)], pa.binary()),
            })

        for batch in parts:
            found = encode_texts(batch.column("text"))
            for i, text_ids in zip(batch.column("doc_id").to_pylist(), found):
                doc_ids.append(i)
                ids.append(text_ids + last)
                held += len(ids[-1]) // 4
                if held >= FILE_IDS:
                    yield row()
                    number, doc_ids, ids, held = number + 1, [], [], 0
        if doc_ids:
            yield row()

    return written(ordered.mapInArrow(files, "part long, number long, ids long, data binary"), "token-files")


def manifest(files: DataFrame) -> DataFrame:
    """``part, number, before``: ids before each file. One narrow row per file is ordered."""
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("part", "number", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("before"))


def read(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of every document, from the files."""

    def documents(parts):
        for batch in parts:
            for data, before in zip(batch.column("data").to_pylist(), batch.column("before").to_pylist()):
                f = TokenFile(data)
                cuts = f.ends.tolist()
                ids = [f.tokens(a, b).tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(f.doc_ids, pa.int64()),
                    "start": pa.array([before + a for a in cuts[:-1]], pa.int64()),
                    "n_tokens": pa.array([len(d) // 4 for d in ids], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(d) for d in ids], pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                })

    placed = files.join(small(manifest(files)), ["part", "number"]).select("data", "before")
    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def op7_dac_tokens(spark, sf_dir: str) -> DataFrame:
    files = write(table(spark, sf_dir, "documents"), path(VOCABULARY))
    return read(files).drop("ids")
