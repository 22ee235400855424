"""Repeated passages found by recompression: runs and pairs of symbols get global names.

Each word is a symbol. A round renames short runs of equal symbols (once, first), or every
adjacent pair whose left symbol is in the "left" half of the alphabet and whose right one
is in the "right" half. Halves and names are fixed hash functions of the symbols and the
round, so all tasks name alike without talking to each other, and equal passages get equal
symbols except near their ends: whether a symbol merges with a neighbour outside a
window depends on one symbol per side and round. What is left of a window after
dropping those is determined by the window's words alone, and so is its *anchor*, the
longest (then largest) symbol there. A window whose interior vanishes (inside long runs)
is its own anchor.

Three steps over blocks of documents, exchanged as packed columns:

1. every block sends the names of its anchors; names are counted over all blocks,
2. windows at anchors that occur more than once send a 96-bit hash of their words and
   their place, the first of each hash in a block only; the first place of each is found,
3. a window that is not the first of its words is a repeat, and its words go.

A window of ``WINDOW`` words repeats if the same words start earlier, in a smaller id or
in the same document before it. Null texts have no words. Rows with equal ids are ordered
by their text; equal rows of one id are copies of each other in either order, and all
copies but one lose their repeated words. Words compare by 64-bit hashes, windows
by 96 bits of hash over those.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskflow.llm.common import (
    WordHashes, binary, blocks_of, joined_hashes, mix, pack_sorted, part_edges, part_of, table, texts,
    unpack_sorted, with_block,
)

WINDOW = 20
#: Longest run of equal words that gets a name; a window may lie within a longer one.
LONGEST_RUN = 3
PAIR_ROUNDS = 3
#: Characters of a block, which is what one task holds at a time.
BLOCK_CHARS = 3_000_000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE2 = _U(0xC2B2AE3D27D4EB4F)
_ROUND = [_U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25), _U(0xD1B54A32D192ED03), _U(0xAEF17502108EF2D9)]
_MESSAGE = "block long, part long, kind int, a binary, b binary, c binary, d binary"
_FIELDS = ["block", "part", "kind", "a", "b", "c", "d"]
_SCHEMA = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("kind", pa.int32())] + [(n, pa.binary()) for n in "abcd"])


def _messages(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in _FIELDS]
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _run_lengths(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of maximal runs of equal symbols of one document."""
    new = np.ones(symbols.size, bool)
    new[1:] = (symbols[1:] != symbols[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, symbols.size))


def anchors(words: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all documents: first words, anchor names, and the places of the anchors.

    ``words`` are the hashes of all words in a row, ``ends`` the document bounds.
    """
    n = words.size
    lengths = np.diff(ends)
    owner = np.repeat(np.arange(lengths.size), lengths)
    at = np.arange(n)
    first = at[(ends[1:][owner] - at) >= window] if n else at
    if not first.size:
        return first, np.zeros(0, _U), first
    low, high = first.copy(), first + window  # the determined interior of every window

    # Runs of up to LONGEST_RUN equal words; at the ends of a window they may reach outside.
    starts, run = _run_lengths(words, owner)
    in_run = np.repeat(np.arange(starts.size), run)
    run_end = (starts + run)[in_run]
    run_start = starts[in_run]
    seen = np.minimum(run_end[low], high) - low
    low = np.where(seen <= LONGEST_RUN, low + seen, low)
    seen = high - np.maximum(run_start[high - 1], first)
    high = np.where(seen <= LONGEST_RUN, high - seen, high)

    named = (run > 1) & (run <= LONGEST_RUN)
    begins = np.ones(n, bool)
    inside = named[in_run]
    begins[inside] = run_start[inside] == at[inside]
    start = np.flatnonzero(begins)
    symbol = words[start]
    k = in_run[start]
    symbol = np.where(named[k], mix(symbol + _ROUND[3] * run[k].astype(_U)), symbol)

    for turn in range(PAIR_ROUNDS):
        right = (mix(symbol ^ _ROUND[turn]) >> _U(63)).astype(bool)
        index = np.zeros(n + 1, np.int64)  # the symbol that begins at a word
        index[start] = np.arange(start.size)
        stop = np.append(start[1:], n)
        live = low < high
        s = index[np.where(live, low, 0)]
        low = np.where(live & right[s], stop[s], low)
        s = np.searchsorted(start, np.where(live, high, 1)) - 1
        high = np.where(live & ~right[s], start[s], high)
        same = owner[start[1:]] == owner[start[:-1]]
        merge = np.append(~right[:-1] & right[1:] & same, False)
        symbol[merge] = mix(symbol[merge] * _BASE + symbol[np.flatnonzero(merge) + 1] + _ROUND[turn])
        keep = np.ones(start.size, bool)
        keep[1:] = ~merge[:-1]
        start, symbol = start[keep], symbol[keep]

    # Best symbol of each window: longest, then largest name, then leftmost.
    length = np.diff(np.append(start, n)).astype(_U)
    name = (length << _U(57)) | (symbol >> _U(7))
    a = np.searchsorted(start, low)
    b = np.searchsorted(start, np.minimum(high, n))
    filled = (low < high) & (b > a)
    best = np.zeros(first.size, np.int64)
    wide = np.where(filled, b - a, 0)
    level, tops = np.arange(start.size), 1
    while tops <= wide.max(initial=0):
        use = np.flatnonzero((wide >= tops) & (wide < 2 * tops))
        left, other = level[a[use]], level[b[use] - tops]
        best[use] = np.where(name[left] >= name[other], left, other)
        if level.size <= tops:
            break
        left, other = level[:-tops], level[tops:]
        level = np.where(name[left] >= name[other], left, other)
        tops *= 2
    own = window_hashes(words, first[~filled], window)[0] | _U(1 << 63)
    chosen = np.where(filled, name[best], _U(0))
    chosen[~filled] = own
    place = np.where(filled, start[best], -1 - first)
    return first, chosen, place


def window_hashes(words: np.ndarray, first: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of hash of the windows that begin at ``first``."""
    one, two = np.zeros(first.size, _U), np.zeros(first.size, _U)
    for j in range(window):
        w = words[first + j]
        one = one * _BASE + w
        two = (two ^ w) * _BASE2
        two ^= two >> _U(31)
    return mix(one), (mix(two) >> _U(32)).astype(np.uint32)


def _loaded(block: pa.Table) -> tuple[list, list[list[bytes]], np.ndarray, np.ndarray]:
    """Documents of a block in their order, with words and word hashes."""
    ids, data = block.column("doc_id").to_pylist(), binary(block.column("text"))
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, data[i]))
    documents = [data[i].split() for i in order]
    words, ends = joined_hashes(documents, WordHashes())
    return [ids[i] for i in order], documents, words, ends


def _sent_anchors(parts: int):
    def send(block: pa.Table) -> pa.Table:
        _, _, words, ends = _loaded(block)
        _, chosen, place = anchors(words, ends)
        if not chosen.size:
            return _messages([])
        new = np.ones(chosen.size, bool)  # windows in a row mostly share their anchor
        new[1:] = place[1:] != place[:-1]
        spot = np.unique(np.stack([chosen[new].view(np.int64), place[new]]), axis=1)
        names, times = np.unique(spot[0].view(_U), return_counts=True)
        mixed = mix(names)
        order = np.argsort(mixed)
        mixed, times = mixed[order], times[order]
        cuts = part_edges(mixed, 64, parts)
        b = block.column("block")[0].as_py()
        return _messages([
            (b, p, 0, pack_sorted(mixed[x:y]), np.packbits(times[x:y] > 1).tobytes(), None, None)
            for p, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x
        ])
    return send


def _shared_anchors(part: pa.Table) -> pa.Table:
    """Which of the names sent by each block occur more than once."""
    rows = part.to_pylist()
    names = [unpack_sorted(r["a"]) for r in rows]
    kinds, which = np.unique(np.concatenate(names), return_inverse=True)
    several = np.concatenate([
        np.unpackbits(np.frombuffer(r["b"], np.uint8), count=k.size) for r, k in zip(rows, names)
    ])
    times = np.bincount(which, weights=1.0 + several)
    shared, at, out = times[which] > 1, 0, []
    for r, k in zip(rows, names):
        mine = k[shared[at: at + k.size]]
        at += k.size
        if mine.size:
            out.append((r["block"], r["part"], 1, pack_sorted(mine), None, None, None))
    return _messages(out)


def _ordered_ids(ids: list) -> np.ndarray:
    """Ids as numbers in which a null comes first."""
    low = np.iinfo(np.int64).min
    return np.array([low if i is None else max(i, low + 1) for i in ids], np.int64)


def _sent_windows(parts: int):
    def send(block: pa.Table, shared: pa.Table) -> pa.Table:
        if not block.num_rows or not shared.num_rows:
            return _messages([])
        ids, _, words, ends = _loaded(block)
        first, chosen, _ = anchors(words, ends)
        known = np.concatenate([unpack_sorted(d) for d in shared.column("a").to_pylist()])
        first = first[np.isin(mix(chosen), known)]
        del chosen, known
        one, two = window_hashes(words, first)
        # The first of equal windows in the block speaks for them; first is in document order.
        order = np.lexsort((first, two, one))
        fresh = np.ones(order.size, bool)
        fresh[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
        sent = np.zeros(order.size, bool)
        sent[order[fresh]] = True
        document = np.searchsorted(ends, first, side="right") - 1
        number = _ordered_ids(ids)[document]
        place = first - ends[document]
        same = np.r_[False, np.diff(_ordered_ids(ids)) == 0]  # rows with equal ids, one after the other
        rank = np.arange(same.size) - np.maximum.accumulate(np.where(same, 0, np.arange(same.size)))
        place = place + (rank[document] << 40)
        b = block.column("block")[0].as_py()
        out = [(b, -1 - b, 2, first.astype(np.uint32).tobytes(), np.packbits(sent).tobytes(), None, None)]
        part = part_of(one, 64, parts)
        for p in np.unique(part[sent]):
            m = sent & (part == p)
            out.append((b, int(p), 2, one[m].tobytes(), two[m].tobytes(), number[m].tobytes(), place[m].tobytes()))
        return _messages(out)
    return send


def _first_windows(part: pa.Table) -> pa.Table:
    """Which of the windows sent by each block are the first of their words."""
    rows = part.to_pylist()
    if rows[0]["part"] < 0:
        return part.select(_FIELDS)
    one, two, number, place = (
        np.concatenate([np.frombuffer(r[c], kind) for r in rows])
        for c, kind in zip("abcd", (_U, np.uint32, np.int64, np.int64))
    )
    order = np.lexsort((place, number, two, one))
    best = np.ones(order.size, bool)
    best[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    leads = np.zeros(order.size, bool)
    leads[order[best]] = True
    out, at = [], 0
    for r in rows:
        n = len(r["a"]) // 8
        out.append((r["block"], r["part"], 3, np.packbits(leads[at: at + n]).tobytes(), None, None, None))
        at += n
    return _messages(out)


def _kept(parts: int, with_text: bool):
    def cut(block: pa.Table, told: pa.Table) -> pa.Table:
        ids, documents, words, ends = _loaded(block)
        covered = np.zeros(words.size + 1, np.int64)
        rows = told.to_pylist()
        own = next((r for r in rows if r["part"] < 0), None)
        if own is not None:
            first = np.frombuffer(own["a"], np.uint32).astype(np.int64)
            sent = np.unpackbits(np.frombuffer(own["b"], np.uint8), count=first.size).astype(bool)
            repeated = ~sent
            spots = np.flatnonzero(sent)
            part = part_of(window_hashes(words, first[sent])[0], 64, parts)
            for r in rows:
                if r["part"] >= 0:
                    mine = spots[part == r["part"]]
                    lead = np.unpackbits(np.frombuffer(r["a"], np.uint8), count=mine.size)
                    repeated[mine[lead == 0]] = True
            np.add.at(covered, first[repeated], 1)
            np.add.at(covered, first[repeated] + WINDOW, -1)
        gone = np.cumsum(covered)[:-1] > 0
        out = []
        for k, (i, all_words) in enumerate(zip(ids, documents)):
            mask = gone[ends[k]: ends[k + 1]]
            removed = int(mask.sum())
            kept = b" ".join(w for w, g in zip(all_words, mask.tolist()) if not g) if removed else b" ".join(all_words)
            out.append((i, len(all_words), removed, hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)
    return cut


def without_repeats(docs: DataFrame, block_chars: int = BLOCK_CHARS, with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` of every row; ``kept`` null if not asked for."""
    docs = texts(docs)
    blocks = blocks_of(docs, block_chars)
    parts = max(1, blocks // 2)
    dealt = with_block(docs, blocks).groupBy("block")
    shared = dealt.applyInArrow(_sent_anchors(parts), _MESSAGE).groupBy("part").applyInArrow(_shared_anchors, _MESSAGE)
    windows = dealt.cogroup(shared.groupBy("block")).applyInArrow(_sent_windows(parts), _MESSAGE)
    leads = windows.groupBy("part").applyInArrow(_first_windows, _MESSAGE)
    result = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    return dealt.cogroup(leads.groupBy("block")).applyInArrow(_kept(parts, with_text), result)


def op10_recompression_repeats(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


ORACLE = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS g FROM starts JOIN words USING (doc_id)
), repeats AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM windows
  ) WHERE k > 1
), gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(s, s + 20)))) AS g FROM repeats GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w) AS n, coalesce(g, []) AS g,
         list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(coalesce(g, []), x[2])) AS k
  FROM words LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(g) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_transform(k, lambda x: x[1]), ' ')) AS kept_sha256
FROM kept
"""
