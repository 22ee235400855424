"""Repeated byte strings found by a logarithmic family of suffix arrays.

A corpus is taken in batches of ascending documents. Each batch gets a suffix array, which is
merge-scanned against the arrays of the levels kept so far; what starts ``WIDTH`` equal bytes with an
earlier suffix is a repeat. Then the batch joins the family: levels of equal size are merged, so that ``b``
batches leave at most ``log2(b) + 1`` levels and every suffix is rewritten at most ``log2(b)`` times.

*Sampled suffixes.* Every string of ``WIDTH`` bytes has an anchor: the least hash of the ``CORE``-byte
strings in it, the leftmost of equal ones. Strings that begin one after the other mostly share it, so the arrays
hold one suffix per *run* of them, about one per 32 bytes. It depends on the string's bytes
alone, so equal strings have equal anchors, and sorting by the anchor's hash brings them together.

*A row of an array* is (hash of the anchor, hash of all bytes of the run, place). It is a table bucketed and
sorted by the first; a batch is shuffled into the same buckets once, and levels are never shuffled
again. Rows of equal bytes but the first are repeats as a whole. Where one anchor has several runs of bytes, only the
first of each counts; their bytes are fetched and compared string by string: in one pass sorted by anchors, or, for
anchors with more than ``CROWD`` different runs, as rows of their own that spread over all tasks.
Equal runs of the documents that a task reads at a time are one row before the shuffle.

Strings are compared by 64-bit hashes among those whose anchors have equal 64-bit hashes. Documents of
any length are worked on in slices. A null text is empty, a null id comes first. Rows with equal ids are told
apart by 32 bits of hash of their texts and ordered by it; of equal rows one is the original, and copies
lose all bytes if they have ``WIDTH``. Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.llm.common import binary, bitmap, mix, small, table
from riskflow.sources.tables import new_folder, written

WIDTH = 100
CORE = 32
BATCHES = 4
#: Different runs of an anchor that are compared in one task: about 4 MB of text and 1 million strings.
CROWD = 30_000
#: Bytes that are hashed at a time, and that are searched for equal runs before the shuffle.
SLICE = 1 << 20
GROUP = 8 << 20
#: Bits of the bitmap of repeated ids, a literal of 4 KB. A document whose bit is set by chance only gets a
#: ``tie`` that it does not need.
ID_BITS = 15
_LOWEST = -(1 << 63)

_U = np.uint64
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_ROW = "key long, x long, doc long, tie int, s int, n int"


# --- hashes of strings -------------------------------------------------------------------


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, _U)
    done = 1
    while done < count:
        more = min(done, count - done)
        out[done: done + more] = out[:more] * _U(pow(base, done, 1 << 64))
        done += more
    return out


class Strings:
    """Hashes of all substrings of ``data``."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(data.size + 1, _U)
        np.cumsum(_BYTE[data] * _powers(_BASE, data.size), out=self.sums[1:])
        self.shift = _powers(pow(_BASE, -1, 1 << 64), data.size + 1)

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.shift[begin])

    def all_of(self, width: int) -> np.ndarray:
        n = self.sums.size - width
        return mix((self.sums[width:] - self.sums[:n]) * self.shift[:n])


def _least(values: np.ndarray, wide: int) -> np.ndarray:
    """Place of the leftmost smallest of every ``wide`` values in a row."""
    at, reach = np.arange(values.size, dtype=np.int32), 1
    while reach < wide:
        step = min(reach, wide - reach)
        less = values[step:] < values[:-step]
        at = np.where(less, at[step:], at[:-step])
        values = np.where(less, values[step:], values[:-step])
        reach += step
    return at


def runs(data: np.ndarray, ends: np.ndarray, width: int = WIDTH, core: int = CORE):
    """Runs of strings of ``width`` bytes with one anchor: anchor hash, hash of the bytes, first start, strings.

    ``ends`` are the bounds of the documents in ``data``; no string crosses them.
    """
    none = np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if data.size < width:
        return none
    strings = Strings(data)
    hashes = strings.all_of(core)
    anchor = _least(hashes, width - core + 1)
    stop = np.repeat(ends[1:], np.diff(ends))[: anchor.size]
    start = np.flatnonzero(stop - np.arange(anchor.size) >= width)
    if not start.size:
        return none
    anchor = anchor[start]
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
    count = np.diff(np.append(first, start.size))
    start, anchor = start[first], anchor[first]
    whole = strings.hashes(start, start + count + width - 1)
    form = (anchor - start).astype(_U) * _U(0xA24BAED4963EE407) + count.astype(_U)  # where the anchor stands
    return hashes[anchor], mix(whole + form), start, count


def _slices(texts: list[bytes], width: int, size: int):
    """Documents in groups of about ``size`` bytes, long ones in overlapping pieces: which, begins, bytes."""
    group, held = [], 0
    for k, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - width + 1), size):
            piece = text[begin: begin + size + width - 1]
            group.append((k, begin, piece))
            held += len(piece)
            if held >= size:
                yield group
                group, held = [], 0
    if group:
        yield group


def _groups(batches, size: int):
    """Record batches in parts of about ``size`` bytes."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def _sorted_suffixes(width: int, core: int, size: int):
    """Per group of documents: the runs that are the first of their bytes there, and places of all others (``x`` null)."""
    def build(batches):
        for batch in _groups(batches, size * GROUP // SLICE):
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            tie = batch.column("tie").to_numpy(zero_copy_only=False)
            text = binary(batch.column("text"))
            order = np.lexsort((tie, doc))
            order = order[np.r_[True, (np.diff(doc[order]) != 0) | (np.diff(tie[order]) != 0)]] if order.size else order
            parts = []
            for group in _slices([text[i] for i in order.tolist()], width, size):
                ends = np.cumsum([0] + [len(piece) for _, _, piece in group])
                key, x, start, count = runs(np.frombuffer(b"".join(p for _, _, p in group), np.uint8), ends, width, core)
                piece = np.searchsorted(ends, start, side="right") - 1
                which = np.array([k for k, _, _ in group], np.int64)[piece]
                begin = np.array([b for _, b, _ in group], np.int64)[piece]
                parts.append((key, x, which, start - ends[piece] + begin, count))
            if not parts:
                continue
            key, x, which, start, count = (np.concatenate(c) for c in zip(*parts))
            by_bytes = np.lexsort((np.arange(key.size), x, key))
            fresh = np.ones(key.size, bool)
            fresh[1:] = (key[by_bytes[1:]] != key[by_bytes[:-1]]) | (x[by_bytes[1:]] != x[by_bytes[:-1]])
            first = by_bytes[fresh]  # in order of anchors: a suffix array of the batch
            again = np.sort(by_bytes[~fresh])
            if again.size:  # repeats side by side are one place, dealt by where it is
                new = np.r_[True, (which[again[1:]] != which[again[:-1]]) | (start[again[1:]] != (start + count)[again[:-1]])]
                edge = np.flatnonzero(new)
                length = np.add.reduceat(count[again], edge)
                again = again[edge]
                where = mix(doc[order[which[again]]].view(_U) * _U(_BASE) + start[again].astype(_U))
            else:
                length, where = np.zeros(0, np.int64), np.zeros(0, _U)
            rows = np.concatenate([first, again])
            at = order[which[rows]] if rows.size else rows
            yield pa.record_batch([
                pa.array(np.concatenate([key[first], where]).view(np.int64)),
                pa.array(x[rows].view(np.int64), mask=np.arange(rows.size) >= first.size),
                pa.array(doc[at]), pa.array(tie[at].astype(np.int32)), pa.array(start[rows].astype(np.int32)),
                pa.array(np.concatenate([count[first], length]).astype(np.int32)),
            ], names=["key", "x", "doc", "tie", "s", "n"])
    return build


# --- the family of levels ----------------------------------------------------------------


@dataclass
class Level:
    """A suffix array of ``size`` batches, bucketed by anchor."""

    size: int
    suffixes: DataFrame


def _bucketed(frame: DataFrame, buckets: int) -> DataFrame:
    """Written in ``buckets`` files sorted by ``key``; the table's name is given up, its plan is kept."""
    spark, name = frame.sparkSession, f"suffixes_{uuid.uuid4().hex}"
    frame.write.bucketBy(buckets, "key").sortBy("key", "x").option("path", new_folder(spark, "suffixes")).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def add_batch(levels: list[Level], docs: DataFrame, buckets: int, keep: bool = True, width: int = WIDTH, core: int = CORE, size: int = SLICE):
    """A batch (``doc, tie, text``, later than all before) against the levels.

    Gives the new levels, and rows with ``repeat`` (all strings of the run occur earlier) or ``open``
    (strings of the run must be compared with those of other ``open`` rows of the anchor). Without
    ``keep`` the batch is not added.
    """
    merged, total = [], 1
    while keep and levels and levels[-1].size == total:
        merged.append(levels[-1])
        levels, total = levels[:-1], total * 2
    old = F.lit(False).alias("fresh"), F.lit(False).alias("joins")
    fresh = docs.mapInArrow(_sorted_suffixes(width, core, size), _ROW).repartition(buckets, "key").select(
        "*", F.lit(True).alias("fresh"), F.lit(keep).alias("joins")
    )
    both = fresh
    for level in levels:
        both = both.unionByName(level.suffixes.select("key", "x", "doc", "tie", "s", "n", *old))
    for level in merged:
        both = both.unionByName(level.suffixes.select("key", "x", "doc", "tie", "s", "n", old[0], F.lit(True).alias("joins")))
    # Sorted by anchor and bytes, what is older first: one pass over all arrays side by side.
    equal = Window.partitionBy("key", "x").orderBy("fresh", "doc", "tie", "s")
    anchor = Window.partitionBy("key")
    first = F.col("x").isNotNull() & (F.col("nth") == 1)
    scanned = both.withColumn("nth", F.rank().over(equal)).withColumn("first", first).select(
        *[c for c in both.columns], "first",
        (F.col("x").isNull() | (F.col("fresh") & ~F.col("first"))).alias("repeat"),
        (
            F.col("first") & (F.min("x").over(anchor) < F.max("x").over(anchor))
            & F.max(F.col("fresh") & F.col("first")).over(anchor)
        ).alias("open"),
    )
    stored = _bucketed(scanned.where(F.col("repeat") | F.col("open") | (F.col("joins") & F.col("first"))).select(
        "key", "x", "doc", "tie", "s", "n", "repeat", "open", (F.col("joins") & F.col("first")).alias("level")
    ), buckets)
    if keep:
        levels = [*levels, Level(total, stored.where("level").select("key", "x", "doc", "tie", "s", "n"))]
    return levels, stored


# --- comparing strings -------------------------------------------------------------------


def _string_hashes(contents: list[bytes], count: np.ndarray, keys: np.ndarray, width: int):
    """Of runs: the row of each string, its place in the run, and its hash with the anchor's."""
    data = np.frombuffer(b"".join(contents), np.uint8)
    begin = np.cumsum([0] + [len(c) for c in contents])[:-1]
    row = np.repeat(np.arange(count.size), count)
    inside = np.arange(row.size) - np.repeat(np.cumsum(count) - count, count)
    at = begin[row] + inside
    return row, inside, mix(Strings(data).hashes(at, at + width) ^ mix(keys[row]))


def _places(doc, tie, start, count) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(doc), pa.array(tie.astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))],
        names=["doc", "tie", "s", "n"],
    )


def _compared(width: int, slab: int):
    """Rows sorted by anchor and place: the strings that are not the first of theirs at the anchor."""
    def of(rows: pa.Table):
        key, doc, tie, start, count = (
            rows.column(c).to_numpy().astype(np.int64) for c in ("key", "doc", "tie", "s", "n")
        )
        row, inside, name = _string_hashes(binary(rows.column("bytes")), count, key.view(_U), width)
        order = np.argsort(name, kind="stable")  # within equal names: by place
        later = np.zeros(name.size, bool)
        later[order[1:]] = name[order[1:]] == name[order[:-1]]
        hit = np.flatnonzero(later)
        if not hit.size:
            return None
        edge = np.flatnonzero(np.r_[True, (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)])
        r = row[hit[edge]]
        return _places(doc[r], tie[r], start[r] + inside[hit[edge]], np.diff(np.append(edge, hit.size)))

    def compare(batches):
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.nbytes < slab:
                continue
            key = held.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))  # the last anchor may go on
            if cut:
                found = of(held.slice(0, cut).combine_chunks())
                held = held.slice(cut)
                if found is not None:
                    yield found
        if held is not None and held.num_rows:
            found = of(held.combine_chunks())
            if found is not None:
                yield found
    return compare


def _spread_strings(width: int):
    """A row per string of a run."""
    def spread(batches):
        for batch in batches:
            key, doc, tie, start, count = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "doc", "tie", "s", "n")
            )
            row, inside, name = _string_hashes(binary(batch.column("bytes")), count, key.view(_U), width)
            yield pa.record_batch([
                pa.array(name.view(np.int64)), pa.array(doc[row]), pa.array(tie[row].astype(np.int32)),
                pa.array((start[row] + inside).astype(np.int32)),
            ], names=["name", "doc", "tie", "s"])
    return spread


def identified(docs: DataFrame) -> DataFrame:
    """``doc, tie, text``: documents in their order. ``tie`` is 0 but for ids that may be repeated."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("doc"), F.coalesce("text", F.lit("")).alias("text")
    )
    several = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    known = member(bitmap(several.select(F.xxhash64("doc").alias("hash")), ID_BITS).value.tobytes(), "doc")
    tie = F.when(known, F.xxhash64("text").bitwiseAND(0x7FFFFFFF).cast("int")).otherwise(F.lit(0))
    return rows.select("doc", tie.alias("tie"), "text")


def member(bits: bytes, *columns: str) -> Column:
    """Whether the bit of the hash of ``columns`` is set in a bitmap."""
    spot = F.xxhash64(*columns).bitwiseAND((1 << ID_BITS) - 1).cast("int")
    byte = F.conv(F.hex(F.substring(F.lit(bits), F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, spot % 8).bitwiseAND(1) == 1


def repeats(rows: DataFrame, batches: int = BATCHES, width: int = WIDTH, core: int = CORE, crowd: int = CROWD, size: int = SLICE) -> DataFrame:
    """``doc, tie, s, n``: strings of ``width`` bytes that also start earlier, ``n`` of them from ``s`` on.

    ``rows`` are :func:`identified` documents.
    """
    cuts = rows.agg(F.percentile_approx("doc", [k / batches for k in range(1, batches)], 10_000).alias("cuts")).first()["cuts"]
    bounds = [None, *(cuts or []), None] if batches > 1 else [None, None]
    total = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    buckets = max(256, total >> 28)
    levels, stored = [], []
    for k, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
        batch = rows
        if low is not None:
            batch = batch.where(F.col("doc") > low)
        if high is not None:
            batch = batch.where(F.col("doc") <= high)
        levels, found = add_batch(levels, batch, buckets, k + 2 < len(bounds), width, core, size)
        stored.append(found)
    place = ["doc", "tie", "s", "n"]
    whole = [found.where("repeat").select(*place) for found in stored]

    # Anchors with several different runs: their bytes, each run once however often it was met.
    many = stored[0].where("open").select("key", *place)
    for found in stored[1:]:
        many = many.unionByName(found.where("open").select("key", *place))
    many = written(many.distinct(), "open-runs")
    once = rows.dropDuplicates(["doc", "tie"])
    taken = F.substring(F.col("text").cast("binary"), F.col("s") + 1, F.col("n") + (width - 1))
    filled = many.join(once, ["doc", "tie"]).select("key", *place, taken.alias("bytes"))
    crowded = small(written(many.groupBy("key").agg(F.count(F.lit(1)).alias("runs")).where(F.col("runs") > crowd).select("key"), "crowds"))
    filled = written(filled.join(crowded.withColumn("crowded", F.lit(True)), "key", "left"), "run-bytes")
    pairs = filled.where(F.col("crowded").isNull()).drop("crowded").repartition("key").sortWithinPartitions("key", "doc", "tie", "s")
    schema = "doc long, tie int, s int, n int"
    compared = pairs.mapInArrow(_compared(width, 4 << 20), schema)

    strings = filled.where("crowded").mapInArrow(_spread_strings(width), "name long, doc long, tie int, s int")
    least = strings.groupBy("name").agg(F.min(F.struct("doc", "tie", "s")).alias("least"), F.count(F.lit(1)).alias("times"))
    later = strings.join(least.where("times > 1"), "name").where(F.struct("doc", "tie", "s") > F.col("least"))
    out = compared.unionByName(later.select("doc", "tie", "s", F.lit(1).alias("n")))
    for one in whole:
        out = out.unionByName(one)
    return written(out, "repeated-strings")


def _cut(width: int, with_text: bool):
    """Texts without the bytes that their repeated strings cover."""
    names = ["doc", "tie", "n_removed", "spans", "kept_sha256", "kept"]
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])

    def cut(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                data = row["text"].encode()
                places = row["places"]
                begin = np.array([p["s"] for p in places], np.int64)
                end = begin + np.array([p["n"] for p in places], np.int64) + width - 1
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], np.maximum.accumulate(end[order])
                edge = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
                spans = list(zip(begin[edge].tolist(), end[np.append(edge[1:] - 1, end.size - 1)].tolist()))
                ends = [0, *[e for _, e in spans]]
                kept = b"".join(data[a:b] for a, b in zip(ends, [*[b for b, _ in spans], len(data)]))
                out.append((
                    row["doc"], row["tie"], len(data) - len(kept), [{"begin": b, "end": e} for b, e in spans],
                    hashlib.sha256(kept).hexdigest(), kept if with_text else None,
                ))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(span), pa.string(), pa.binary()]
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)
    return cut


def without_repeats(docs: DataFrame, with_text: bool = True, batches: int = BATCHES, width: int = WIDTH, core: int = CORE, crowd: int = CROWD, size: int = SLICE) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_sha256, kept`` of every row.

    ``spans`` are the removed ranges of bytes, ``kept`` the bytes that stay (null if not asked for; they may
    break characters).
    """
    rows = identified(docs)
    found = repeats(rows, batches, width, core, crowd, size)
    places = found.groupBy("doc", "tie").agg(F.collect_list(F.struct("s", "n")).alias("places"))
    once = rows.dropDuplicates(["doc", "tie"])
    schema = "doc long, tie int, n_removed long, spans array<struct<begin:long,end:long>>, kept_sha256 string, kept binary"
    cut = once.join(places, ["doc", "tie"]).select("doc", "tie", "text", "places").mapInArrow(_cut(width, with_text), schema)
    whole = rows.select(
        "doc", "tie", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256"),
        *([F.col("text").cast("binary").alias("bytes")] if with_text else []),
    )
    names = [c for c in whole.columns]
    counted = whole.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"))
    told = counted.join(cut, ["doc", "tie"], "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    gone = (F.col("copy") > 1) & (F.col("n_bytes") >= width)
    empty_hash = hashlib.sha256(b"").hexdigest()
    return told.select(
        F.when(F.col("doc") != _LOWEST, F.col("doc")).alias("doc_id"), "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end"))))
        .otherwise(F.coalesce("spans", F.array().cast("array<struct<begin:long,end:long>>"))).alias("spans"),
        F.when(gone, F.lit(empty_hash)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        (F.when(gone, F.lit(b"")).otherwise(F.coalesce("kept", "bytes")) if with_text else F.lit(None).cast("binary")).alias("kept"),
    )


def op12_suffix_levels(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), with_text=False).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


#: Strings are compared by a hash of their bytes, in hexadecimal.
ORACLE = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT doc_id, CAST(unnest(range(0, length(h) // 2 - 99)) AS INTEGER) AS s FROM docs WHERE length(h) >= 200
), strings AS (
  SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS g FROM starts JOIN docs USING (doc_id)
), repeats AS (
  SELECT doc_id, s FROM strings QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, s) > 1
), edges AS (
  SELECT doc_id, s, coalesce(s > max(s) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 100, true) AS opens
  FROM repeats
), islands AS (
  SELECT doc_id, s, count_if(opens) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM edges
), spans AS (
  SELECT doc_id, island, min(s) AS b, max(s) + 100 AS e FROM islands GROUP BY doc_id, island
), cuts AS (
  SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans, list(b ORDER BY b) AS bs, list(e ORDER BY b) AS es FROM spans GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
         CASE WHEN n_spans IS NULL THEN h ELSE array_to_string(list_transform(
           list_zip(list_prepend(0, es), list_append(bs, length(h) // 2)),
           lambda p: substr(h, 2 * p[1] + 1, 2 * (p[2] - p[1]))), '') END AS k
  FROM docs d LEFT JOIN cuts c ON d.doc_id = c.doc_id
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
       sha256(unhex(k)) AS kept_sha256 FROM kept
"""
