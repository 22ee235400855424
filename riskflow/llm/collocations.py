"""Phrase collocations mined with weighted acyclic automata (count transducers).

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words. A phrase
of 2 to ``LONGEST`` words of a language that occurs ``LEAST`` times is a candidate; its score is the
least, over its cuts in two, of ``floor(1000 * a * n / (l * r))``.

1. Words are counted per language. A phrase has frequent words only, so all others end a piece from here on.
2. Adjacent pairs of frequent words are counted the same way (by 64-bit hash, for pruning alone).
3. Every task turns its n-grams into automata: the windows of all places are sorted, equal prefixes are
   one path, the weight of an arc is how often the n-gram that ends there occurs, and states with
   equal arcs are one state. Each *prefix range* (hash of language and first two words) is an automaton
   of its own; the automata of a range meet in a shuffle, and their union sums the weights of equal paths.
   Arcs below ``LEAST`` go: no longer phrase can be more frequent than its beginning.
4. The parts of all candidates are composed with the automata of their ranges, which gives their weights.

Frequent words and pairs reach the tasks as bitmaps of fixed size (``WORD_BITS``, ``PAIR_BITS``). A
bit that is set by chance only costs work: what is counted in step 3 is exact. The larger the corpus, the
fuller the bitmaps, and the less they prune. A task holds ``FLUSH`` words at a time, a range is
held by one task after its counts have been summed per task.

A null text has no words, a null language is ``und``; ids and other columns do not matter, repeated rows count
each time. Tables without candidates give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.llm.common import binary, bitmap, mix, small, table
from riskflow.sources.tables import written

LONGEST = 5
LEAST = 100
KEPT = 2000
WORD_BITS = 24
PAIR_BITS = 26
#: Words that a task counts at a time.
FLUSH = 2_000_000
#: Bytes of Parquet input a prefix range.
RANGE_BYTES = 16 << 20
#: Shares of a language that are ranked before all of it is.
SALTS = 64

_MARK = b"."
_FORM = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _MARK * 9 + b" "
)
_U = np.uint64
_AUTOMATON = "range int, words binary, source binary, label binary, weight binary, target binary"


# --- automata ----------------------------------------------------------------------------


class CountAutomaton:
    """A minimal acyclic automaton over words; ``weight`` of an arc counts the sequence that ends there.

    Arcs are sorted by source state and label; the start state is the last one, state 0 has no arcs.
    ``words`` are the labels' texts in ascending order.
    """

    def __init__(self, words: list[bytes], source, label, weight, target):
        self.words, self.source, self.label, self.weight, self.target = words, source, label, weight, target

    @classmethod
    def of(cls, words: list[bytes], paths: np.ndarray, weight: np.ndarray) -> CountAutomaton:
        """From sorted different ``paths`` (label numbers, behind the end -1), each with its own weight.

        Prefixes that are not paths themselves get the weight 0. States are built from the longest
        prefixes to the shortest, so that those with equal arcs are found equal at once.
        """
        rows, deep = paths.shape
        new = np.zeros((rows, deep), bool)  # a row begins a prefix of this length
        if rows:
            new[0] = True
            new[1:] = np.logical_or.accumulate(paths[1:] != paths[:-1], axis=1)
        new &= paths >= 0
        wide = (paths >= 0).sum(axis=1)
        arcs, below, states = [], None, 1
        for d in range(deep - 1, -1, -1):
            at = np.flatnonzero(new[:, d])  # the arcs into prefixes of length d + 1
            held = np.where(wide[at] == d + 1, weight[at], 0)
            leads = np.zeros(at.size, np.int64)
            if below is not None and below[0].size:
                at_below, out = below
                parent = np.searchsorted(at, at_below, side="right") - 1
                keys = mix(mix(out[0].astype(_U) * _U(0x9E3779B97F4A7C15) + out[1].astype(_U)) ^ (out[2].astype(_U) << _U(20)))
                first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
                sums = mix(np.add.reduceat(keys, first)) ^ np.diff(np.append(first, parent.size)).astype(_U)
                _, chosen, kind = np.unique(sums, return_index=True, return_inverse=True)
                leads[parent[first]] = states + kind
                spans = np.diff(np.append(first, parent.size))[chosen]
                take = np.repeat(first[chosen], spans) + np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
                arcs.append((np.repeat(states + np.arange(chosen.size), spans), *[o[take] for o in out]))
                states += chosen.size
            below = at, (paths[at, d].astype(np.int64), held, leads)
        label, held, leads = below[1] if below is not None else (np.zeros(0, np.int64),) * 3
        arcs.append((np.full(label.size, states, np.int64), label, held, leads))
        return cls(words, *[np.concatenate(column) for column in zip(*arcs)])

    @property
    def start(self) -> int:
        return int(self.source[-1]) if self.source.size else 0

    def paths(self, deep: int) -> tuple[np.ndarray, np.ndarray]:
        """All sequences of up to ``deep`` labels with a weight, and the weights."""
        count = np.bincount(self.source, minlength=self.start + 1)
        first = np.cumsum(count) - count
        state, so_far, found, weights = np.array([self.start]), np.full((1, deep), -1, np.int64), [], []
        for d in range(deep):
            n = count[state] if self.source.size else np.zeros(state.size, np.int64)
            arc = np.repeat(first[state], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            so_far = np.repeat(so_far, n, axis=0)
            so_far[:, d] = self.label[arc]
            state = self.target[arc]
            counted = self.weight[arc] > 0
            found.append(so_far[counted])
            weights.append(self.weight[arc][counted])
        return np.concatenate(found), np.concatenate(weights)

    def compose(self, sequences: list[list[bytes]]) -> np.ndarray:
        """Weights of sequences of words; 0 where there is no such path."""
        number = {word: i for i, word in enumerate(self.words)}
        base = len(self.words) + 1
        keys = self.source * base + self.label
        state = np.full(len(sequences), self.start, np.int64)
        weight = np.zeros(len(sequences), np.int64)
        if not keys.size:
            return weight
        for d in range(max(map(len, sequences), default=0)):
            going = np.flatnonzero([len(s) > d for s in sequences])
            label = np.array([number.get(sequences[i][d], len(self.words)) for i in going], np.int64)
            want = state[going] * base + label
            arc = np.minimum(np.searchsorted(keys, want), keys.size - 1)
            met = keys[arc] == want
            weight[going] = np.where(met, self.weight[arc], 0)
            state[going] = np.where(met, self.target[arc], 0)
        return weight

    def row(self, place: int) -> tuple:
        return (
            place, b"\n".join(self.words), self.source.astype("<i4").tobytes(), self.label.astype("<i4").tobytes(),
            self.weight.astype("<i8").tobytes(), self.target.astype("<i4").tobytes(),
        )

    @classmethod
    def read(cls, row: dict) -> CountAutomaton:
        kinds = {"source": "<i4", "label": "<i4", "weight": "<i8", "target": "<i4"}
        words = row["words"].split(b"\n") if row["words"] else []
        return cls(words, *[np.frombuffer(row[c], kind).astype(np.int64) for c, kind in kinds.items()])


def merged(words: list[bytes], paths: np.ndarray, weight: np.ndarray, least: int = 1) -> CountAutomaton:
    """The automaton of ``paths``, equal ones summed, with labels that are used and weights of ``least``."""
    used = np.unique(paths)
    used = used[used >= 0]
    names = sorted({words[i] for i in used.tolist()})
    place = {word: i for i, word in enumerate(names)}
    number = np.full(len(words) + 1, -1, np.int64)
    number[used] = [place[words[i]] for i in used.tolist()]
    paths = number[paths]  # behind the end: -1 takes the last number, which is -1
    order = np.lexsort(paths.T[::-1])
    paths, weight = paths[order], weight[order]
    first = np.flatnonzero(np.r_[True, (paths[1:] != paths[:-1]).any(axis=1)]) if len(paths) else np.zeros(0, np.int64)
    total = np.add.reduceat(weight, first) if first.size else weight
    keep = total >= least
    return CountAutomaton.of(names, paths[first[keep]], total[keep])


def union(automata: Iterable[CountAutomaton], deep: int, least: int = 1) -> CountAutomaton:
    """Weights of equal sequences summed; sequences below ``least`` go."""
    words, paths, weights = [], [np.zeros((0, deep), np.int64)], [np.zeros(0, np.int64)]
    for one in automata:
        path, weight = one.paths(deep)
        paths.append(np.where(path >= 0, path + len(words), -1))
        weights.append(weight)
        words += one.words
    return merged(words, np.concatenate(paths), np.concatenate(weights), least)


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.record_batch([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


# --- words of texts ----------------------------------------------------------------------


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _held(batches: Iterable[pa.RecordBatch], flush: int) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Language, its words, and their numbers in a row with 0 between pieces; up to about ``flush`` at a time."""
    held: dict[str, tuple[_Numbers, list]] = {}
    size = 0
    for batch in batches:
        langs, data = batch.column("lang").to_pylist(), binary(batch.column("text"))
        for lang, text in zip(langs, data):
            words = text.translate(_FORM).replace(_MARK, b" . ").split()
            if not words:
                continue
            numbers, parts = held.setdefault(lang, (_Numbers({_MARK: 0}), []))
            parts += [np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
            size += len(words)
            if size >= flush:
                yield from ((g, list(n), np.concatenate(p)) for g, (n, p) in held.items())
                held, size = {}, 0
    yield from ((g, list(n), np.concatenate(p)) for g, (n, p) in held.items())


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """Spark's ``xxhash64(lang, word)`` of each word."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), _U, len(words))


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _U(0x9E3779B97F4A7C15) + right)


def _set(bits: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
    at = hashes & _U((1 << size) - 1)
    return (bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


def frequent_words(docs: DataFrame, least: int = LEAST, flush: int = FLUSH) -> DataFrame:
    """``lang, word, f`` of frequent words, and of each language with a null word the number of all words."""
    def count(batches):
        for lang, words, ids in _held(batches, flush):
            times = np.bincount(ids, minlength=len(words))
            times[0] = 0
            yield _rows("lang string, word string, f long", [
                (lang, w.decode(), f) for w, f in zip(words[1:], times[1:].tolist())
            ] + [(lang, None, int(times.sum()))])

    counts = docs.mapInArrow(count, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
    return counts.where(F.col("word").isNull() | (F.col("f") >= least))


def frequent_pairs(docs: DataFrame, word_bits, least: int = LEAST, flush: int = FLUSH) -> DataFrame:
    """``hash`` of the pairs of frequent words that occur often next to each other."""
    def count(batches):
        for lang, words, ids in _held(batches, flush):
            hashes = word_hashes(lang, words)
            good = _set(word_bits.value, hashes, WORD_BITS)
            good[0] = False
            ids = np.where(good[ids], ids, 0).astype(np.int64)
            both = (ids[:-1] > 0) & (ids[1:] > 0)
            pairs, times = np.unique((ids[:-1][both] << 32) | ids[1:][both], return_counts=True)
            found = pair_hashes(hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF])
            yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(times.astype(np.int64))], names=["hash", "f"])

    counted = docs.mapInArrow(count, "hash long, f long").groupBy("hash").agg(F.sum("f").alias("f"))
    return counted.where(F.col("f") >= least).select("hash")


def _tag(lang: str) -> bytes:
    """A language as the first label of its paths; no word has this form."""
    return _MARK + lang.encode().hex().encode()


def _tagged(label: str) -> str:
    return bytes.fromhex(label[1:]).decode()


def _range_of(first: np.ndarray, second: np.ndarray, ranges: int) -> np.ndarray:
    return (mix(first ^ mix(second)) % _U(ranges)).astype(np.int64)


def _sliced(words: list[bytes], paths: np.ndarray, weight: np.ndarray, place: np.ndarray) -> list[tuple]:
    """A row per range: the automaton of its paths."""
    order = np.argsort(place, kind="stable")
    paths, weight, place = paths[order], weight[order], place[order]
    cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if place.size else []
    return [
        merged(words, paths[x:y], weight[x:y]).row(int(place[x]))
        for x, y in zip(cuts, np.append(cuts[1:], place.size))
    ]


def shard_automata(docs: DataFrame, word_bits, pair_bits, ranges: int, longest: int = LONGEST, flush: int = FLUSH) -> DataFrame:
    """Automata of the n-grams of two words and more, per task and range."""
    def build(batches):
        for lang, words, ids in _held(batches, flush):
            hashes = word_hashes(lang, words)
            good = _set(word_bits.value, hashes, WORD_BITS)
            good[0] = False
            ids = np.where(good[ids], ids, 0).astype(np.int64)
            joined = np.zeros(ids.size, bool)  # this word and the next may begin a phrase
            both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            joined[both] = _set(pair_bits.value, pair_hashes(hashes[ids[both]], hashes[ids[both + 1]]), PAIR_BITS)
            start = np.flatnonzero(joined)
            windows = np.full((start.size, longest), -1, np.int64)
            inside = np.ones(start.size, bool)
            windows[:, 0] = ids[start]
            for d in range(1, longest):
                inside = inside & joined[np.minimum(start + d - 1, ids.size - 1)]
                windows[inside, d] = ids[start[inside] + d]
            # Sorted windows: every prefix of two words and more is an n-gram, as often as it stands there.
            order = np.lexsort(windows.T[::-1])
            windows = windows[order]
            new = np.ones((start.size, longest), bool)
            new[1:] = np.logical_or.accumulate(windows[1:] != windows[:-1], axis=1)
            paths, times = [], []
            for d in range(1, longest):
                filled = windows[:, d] >= 0
                begin = np.flatnonzero(new[:, d] & filled)
                group = np.cumsum(new[:, d] & filled) - 1
                n = np.bincount(group[filled], minlength=begin.size)
                path = np.full((begin.size, longest + 1), -1, np.int64)
                path[:, 0] = len(words)
                path[:, 1: d + 2] = windows[begin, : d + 1]
                paths.append(path)
                times.append(n)
            path, n = np.concatenate(paths), np.concatenate(times)
            place = _range_of(hashes[path[:, 1]], hashes[path[:, 2]], ranges)
            yield _rows(_AUTOMATON, _sliced(words + [_tag(lang)], path, n, place))

    return docs.mapInArrow(build, _AUTOMATON)


def word_automata(frequent: DataFrame, ranges: int, longest: int = LONGEST) -> DataFrame:
    """Automata of the words alone."""
    def build(batches):
        for batch in batches:
            langs, words = batch.column("lang").to_pylist(), binary(batch.column("word"))
            tags = sorted(set(langs))
            paths = np.full((len(words), longest + 1), -1, np.int64)
            paths[:, 0] = [len(words) + tags.index(g) for g in langs]
            paths[:, 1] = np.arange(len(words))
            hashes = np.array([word_hashes(g, [w])[0] for g, w in zip(langs, words)], _U)
            place = _range_of(hashes, np.zeros(len(words), _U), ranges)
            weight = batch.column("f").to_numpy(zero_copy_only=False).astype(np.int64)
            yield _rows(_AUTOMATON, _sliced(words + [_tag(g) for g in tags], paths, weight, place))

    return frequent.mapInArrow(build, _AUTOMATON)


def united(shards: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """One automaton per range."""
    def unite(group: pa.Table) -> pa.Table:
        one = union(map(CountAutomaton.read, group.to_pylist()), longest + 1, least)
        return pa.Table.from_batches([_rows(_AUTOMATON, [one.row(group.column("range")[0].as_py())])])

    return shards.groupBy("range").applyInArrow(unite, _AUTOMATON)


def phrases(automata: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, words, a`` of all paths of two words and more."""
    schema = "lang string, words array<string>, a long"

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                one = CountAutomaton.read(row)
                paths, weight = one.paths(longest + 1)
                text = [w.decode() for w in one.words]
                yield _rows(schema, [
                    (_tagged(text[p[0]]), [text[i] for i in p[1:] if i >= 0], n)
                    for p, n in zip(paths.tolist(), weight.tolist()) if p[2] >= 0
                ])

    return automata.mapInArrow(read, schema)


def composed(parts: DataFrame, automata: DataFrame, ranges: int) -> DataFrame:
    """``lang, part, f``: the weights of word lists ``part``."""
    def placed(batches):
        for batch in batches:
            rows = batch.to_pylist()
            first = np.array([word_hashes(r["lang"], [r["part"][0].encode()])[0] for r in rows], _U)
            second = np.array([word_hashes(r["lang"], [r["part"][1].encode()])[0] if r["part"][1:] else 0 for r in rows], _U)
            yield batch.append_column("range", pa.array(_range_of(first, second, ranges).astype(np.int32)))

    def look(asked: pa.Table, known: pa.Table) -> pa.Table:
        rows, f = asked.to_pylist(), np.zeros(asked.num_rows, np.int64)
        for row in known.to_pylist():
            f += CountAutomaton.read(row).compose([[_tag(r["lang"]), *[w.encode() for w in r["part"]]] for r in rows])
        return pa.Table.from_batches([_rows("lang string, part array<string>, f long", [
            (r["lang"], r["part"], n) for r, n in zip(rows, f.tolist())
        ])])

    asked = parts.mapInArrow(placed, "lang string, part array<string>, range int").groupBy("range")
    return asked.cogroup(automata.groupBy("range")).applyInArrow(look, "lang string, part array<string>, f long")


# --- candidates --------------------------------------------------------------------------


def scored(candidates: DataFrame, automata: DataFrame, totals: DataFrame, ranges: int) -> DataFrame:
    """``lang, words, a, l, r, n, score`` by the lowest-scoring cut."""
    cut = candidates.select(
        "lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut")
    ).select("*", F.slice("words", F.lit(1), F.col("cut")).alias("first"), F.slice("words", F.col("cut") + 1, F.size("words")).alias("rest"))
    parts = cut.select("lang", F.explode(F.array("first", "rest")).alias("part")).distinct()
    weights = written(composed(parts, automata, ranges), "phrase-parts")
    left = weights.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = weights.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    wide = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(small(totals), "lang")
    exact = "CAST(CAST(1000 AS DECIMAL(38,0)) * a * n AS DECIMAL(38,0)) div (CAST(l AS DECIMAL(38,0)) * r)"
    best = F.min(F.struct(F.expr(exact).alias("score"), "cut", "l", "r")).alias("best")
    return wide.groupBy("lang", "words", "a", "n").agg(best).select(
        "lang", "words", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score")
    )


def unabsorbed(candidates: DataFrame) -> DataFrame:
    """Candidates that do not occur inside a longer candidate whenever they occur.

    One word longer is enough: what lies between two phrases of equal frequency has that frequency too.
    """
    n = F.size("words")
    inner = candidates.where(n > 2).select("a", "lang", F.explode(F.array(
        F.slice("words", F.lit(1), n - 1), F.slice("words", F.lit(2), n - 1)
    )).alias("words"))
    longer = inner.groupBy("lang", "words").agg(F.max("a").alias("longer_a"))
    return candidates.join(longer, ["lang", "words"], "left").where(
        F.col("longer_a").isNull() | (F.col("longer_a") < F.col("a"))
    ).drop("longer_a")


def top(rows: DataFrame, kept: int = KEPT, salts: int = SALTS) -> DataFrame:
    """The first ``kept`` of each language with ``rank``: shares of a language first, then what they leave."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    few = some.where(F.col("rank") <= kept).drop("share", "rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", rank).where(F.col("rank") <= kept)


def collocations(
    docs: DataFrame, least: int = LEAST, kept: int = KEPT, longest: int = LONGEST, ranges: int | None = None, flush: int = FLUSH
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of every language."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    frequent = written(frequent_words(rows, least, flush), "frequent-words")
    words = frequent.where(F.col("word").isNotNull())
    totals = frequent.where(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    if ranges is None:
        ranges = max(32, _scanned(docs) // RANGE_BYTES)
    word_bits = bitmap(words.select(F.xxhash64("lang", "word").alias("hash")), WORD_BITS)
    pair_bits = bitmap(frequent_pairs(rows, word_bits, least, flush), PAIR_BITS)
    shards = shard_automata(rows, word_bits, pair_bits, ranges, longest, flush).unionByName(word_automata(words, ranges, longest))
    automata = written(united(shards, least, longest), "phrase-automata")
    candidates = written(phrases(automata, longest), "phrases")
    best = scored(unabsorbed(candidates), automata, totals, ranges)
    return top(best.withColumn("phrase", F.concat_ws(" ", "words")), kept).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _scanned(docs: DataFrame) -> int:
    """Bytes the plan expects to scan."""
    return int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def op13_automata_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM docs
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM starts, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS k) WHERE i + k - 1 <= len(w)
  GROUP BY lang, k, phrase HAVING count(*) >= 100
), cuts AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, CAST(unnest(range(1, k)) AS INTEGER) AS c FROM grams WHERE k > 1
), valued AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.c, f.a AS l, s.a AS r, n,
         (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(f.a AS HUGEINT) * s.a) AS score
  FROM cuts c JOIN grams f ON f.lang = c.lang AND f.phrase = array_to_string(c.w[1:c.c], ' ')
  JOIN grams s ON s.lang = c.lang AND s.phrase = array_to_string(c.w[c.c + 1:], ' ') JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), left_over AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM grams g WHERE g.lang = b.lang AND g.k > b.k AND 100 * g.a >= 100 * b.a
      AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' '))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
