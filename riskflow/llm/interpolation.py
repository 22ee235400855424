"""Language model by deleted interpolation, and the scores it gives to documents.

Tokens are lower-cased (A-Z) words and one end token per document. The chance of a token
after another mixes three estimates: how often it followed that one, how often it occurs
at all, and an even share over the vocabulary and one unknown token:

    p(w | v) = a[b] c(v,w) / c(v) + u[b] c(w) / N + z[b] / (V + 1)

The mixture weights belong to a bucket ``b`` of context frequencies (powers of two of
``c(v)``). They are learned by expectation-maximisation on held-out counts: for each
training document of one fold in ``HELD_FOLDS`` the counts of that very document are
deleted from the corpus counts, and its tokens are predicted from what is left. The first
token of a document follows the end token. An unseen context has bucket 0.

Documents are dealt to blocks. A block sends its distinct words and word pairs with their
training counts to parts of the key space; each part sums them over the blocks and sends
the totals back. What a token needs (``c(w)``, ``c(v,w)``) is then written per document,
together with a table of held-out events per block; the events of all blocks are summed
into cells of rounded log-estimates, whose number does not grow with the corpus, and the
weights are fitted to the cells. Words meet by 64-bit hashes, pairs by 48-bit hashes.

A null or empty text consists of the end token alone. Without training documents
``N`` and ``V`` are zero, the base score is that of one unseen kind, and every token has
chance 1. Repeated rows are documents of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from riskflow.llm.common import (
    WordHashes, binary, blocks_of, fold, joined_hashes, mix, pack_sorted, part_edges, table, texts, unpack_sorted,
    with_block,
)
from riskflow.sources.tables import written

FOLDS, HELD_OUT = 7, 2
#: One training document in so many takes part in learning the weights.
HELD_FOLDS = 8
BLOCK_CHARS = 8_000_000
BUCKETS = 64
#: Cells per octave of the rounded estimates that the weights are fitted to.
STEPS = 4
END = b"\n"  # no word contains white space

_U = np.uint64
_PAIR = _U(0x9E3779B97F4A7C15)
_SENT = "block long, part long, words binary, word_counts binary, pairs binary, pair_counts binary"
_BACK = "block long, part long, word_counts binary, pair_counts binary, kinds long"
_FACTS = "doc_id long, role int, n_tokens long, counts binary, pair_counts binary, kinds long, tokens long"


def _block(block: pa.Table) -> dict:
    """Token hashes of a block in document order, with their contexts and documents."""
    ids, data = block.column("doc_id").to_pylist(), binary(block.column("text"))
    training, held = block.column("training").to_numpy(), block.column("held").to_numpy()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, data[i]))
    tokens, ends = joined_hashes((data[i].lower().split() + [END] for i in order), WordHashes())
    document = np.repeat(np.arange(len(order)), np.diff(ends))
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[ends[:-1]] = WordHashes()[END]
    words, word = np.unique(tokens, return_inverse=True)
    pairs, pair = np.unique(mix(context * _PAIR + tokens) >> _U(16), return_inverse=True)
    return {
        "ids": [ids[i] for i in order], "ends": ends, "document": document, "words": words, "word": word,
        "pairs": pairs, "pair": pair, "training": training[order].astype(bool), "held": held[order].astype(bool),
    }


def _sent(parts: int):
    def send(block: pa.Table) -> pa.Table:
        x = _block(block)
        learns = x["training"][x["document"]]
        word_counts = np.bincount(x["word"][learns], minlength=x["words"].size).astype("<u4")
        pair_counts = np.bincount(x["pair"][learns], minlength=x["pairs"].size).astype("<u4")
        w, p = part_edges(x["words"], 64, parts), part_edges(x["pairs"], 48, parts)
        n = range(parts)
        return pa.table({
            "block": pa.array([block.column("block")[0].as_py()] * parts, pa.int64()),
            "part": pa.array(n, pa.int64()),
            "words": pa.array([pack_sorted(x["words"][w[k]:w[k + 1]]) for k in n], pa.binary()),
            "word_counts": pa.array([_planes(word_counts[w[k]:w[k + 1]]) for k in n], pa.binary()),
            "pairs": pa.array([pack_sorted(x["pairs"][p[k]:p[k + 1]]) for k in n], pa.binary()),
            "pair_counts": pa.array([_planes(pair_counts[p[k]:p[k + 1]]) for k in n], pa.binary()),
        })
    return send


def _planes(counts: np.ndarray) -> bytes:
    """Counts below 2**32 byte by byte, as many bytes as the largest needs."""
    width = max(1, (int(counts.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(
        counts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    ).tobytes()


def _counts(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :width] = planes.T
    return wide.view("<u8").ravel().astype(np.int64)


def _summed(part: pa.Table) -> pa.Table:
    """Totals of the keys of one part, for every block in the order it sent them."""
    blocks = part.column("block").to_pylist()
    totals, kinds = {}, 0
    for keys, counts in (("words", "word_counts"), ("pairs", "pair_counts")):
        sent = [unpack_sorted(d) for d in part.column(keys).to_pylist()]
        amount = np.concatenate([_counts(d) for d in part.column(counts).to_pylist()])
        distinct, which = np.unique(np.concatenate(sent), return_inverse=True)
        total = np.bincount(which, weights=amount, minlength=distinct.size).astype(np.int64)
        if keys == "words":
            kinds = int((total > 0).sum())
        cuts = np.cumsum([s.size for s in sent])[:-1]
        totals[counts] = [_planes(t) for t in np.split(total[which], cuts)]
    number = part.column("part")[0].as_py()
    return pa.table({
        "block": pa.array([*blocks, -1 - number], pa.int64()),
        "part": pa.array([number] * (len(blocks) + 1), pa.int64()),
        "word_counts": pa.array([*totals["word_counts"], None], pa.binary()),
        "pair_counts": pa.array([*totals["pair_counts"], None], pa.binary()),
        "kinds": pa.array([None] * len(blocks) + [kinds], pa.int64()),
    })


def _facts(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = ["doc_id", "role", "n_tokens", "counts", "pair_counts", "kinds", "tokens"]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def _known(block: pa.Table, back: pa.Table) -> pa.Table:
    """Counts of the tokens of each document; roles: 0 training, 1 held out, 2 cells, 3 vocabulary."""
    if not block.num_rows:
        return _facts([(None, 3, None, None, None, k, None) for k in back.column("kinds").to_pylist()])
    x = _block(block)
    rows = sorted(back.to_pylist(), key=lambda r: r["part"])
    word_total = np.concatenate([_counts(r["word_counts"]) for r in rows])
    pair_total = np.concatenate([_counts(r["pair_counts"]) for r in rows])
    packer = zstandard.ZstdCompressor(level=1)
    ends, out = x["ends"], []
    end_total = word_total[x["word"][ends[1:] - 1]]
    cells: dict[tuple, int] = {}
    events = []
    for k, i in enumerate(x["ids"]):
        span = slice(ends[k], ends[k + 1])
        word, pair = x["word"][span], x["pair"][span]
        c, pc = word_total[word], pair_total[pair]
        out.append((
            i, 0 if x["training"][k] else 1, c.size, packer.compress(_planes(c)), packer.compress(_planes(pc)), None, None,
        ))
        if x["training"][k] and x["held"][k]:
            # Delete what this document itself has contributed.
            c = c - _own(word)
            pc = pc - _own(pair)
            before = np.concatenate([[end_total[k] - 1], c[:-1]])
            events.append(np.stack([bucket(before), _rounded(pc, before), _rounded(c, np.ones_like(c))]))
    if events:
        kinds, times = np.unique(np.concatenate(events, axis=1), axis=1, return_counts=True)
        out.append((None, 2, None, kinds.astype("<i4").tobytes(), times.astype("<i8").tobytes(), None, None))
    return _facts(out)


def _own(index: np.ndarray) -> np.ndarray:
    """How often each entry occurs among all entries."""
    _, which, times = np.unique(index, return_inverse=True, return_counts=True)
    return times[which]


def bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of a context frequency: 0 if unseen, else one per power of two."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


_NONE = -(1 << 20)


def _rounded(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Log of an estimate in steps, a mark where it is zero."""
    seen = (count > 0) & (of > 0)
    ratio = np.log2(np.where(seen, count, 1) / np.where(seen, of, 1))
    return np.where(seen, np.round(ratio * STEPS).astype(np.int64), _NONE)


@dataclass(frozen=True)
class InterpolatedModel:
    """Mixture weights per bucket, number of training tokens and of their kinds."""

    weights: np.ndarray
    tokens: int
    kinds: int

    def chances(self, count: np.ndarray, pair: np.ndarray, context: np.ndarray) -> np.ndarray:
        a, u, z = self.weights[bucket(context)].T
        after = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
        return a * after + u * count / max(self.tokens, 1) + z / (self.kinds + 1)


def fit_weights(cells: np.ndarray, times: np.ndarray, tokens: int, kinds: int, rounds: int = 60) -> np.ndarray:
    """Weights by expectation-maximisation over cells (bucket, pair step, word step)."""
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]
    if not times.size:
        return weights
    b, after, alone = cells
    estimates = np.stack([
        np.where(after == _NONE, 0.0, np.exp2(after / STEPS)),
        np.where(alone == _NONE, 0.0, np.exp2(alone / STEPS) / max(tokens, 1)),
        np.full(b.size, 1 / (kinds + 1)),
    ])
    n = times.astype(float)
    prior = 0.5 * weights  # so that a bucket without events keeps the weights it started with
    for _ in range(rounds):
        share = weights[b].T * estimates
        share *= n / share.sum(axis=0)
        new = prior + np.stack([np.bincount(b, weights=s, minlength=BUCKETS) for s in share], axis=1)
        new /= new.sum(axis=1, keepdims=True)
        new[0, 0], new[0, 1] = 0.0, new[0, 0] + new[0, 1]
        if np.abs(new - weights).max() < 1e-6:
            return new
        weights = new
    return weights


def _cells(facts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Held-out events of all blocks, summed by cell. The rounding bounds the number of cells."""

    def unpacked(parts):
        for batch in parts:
            for kinds, times in zip(batch.column("counts").to_pylist(), batch.column("pair_counts").to_pylist()):
                b, after, alone = np.frombuffer(kinds, "<i4").reshape(3, -1)
                yield pa.RecordBatch.from_pydict({"b": b, "after": after, "alone": alone, "times": np.frombuffer(times, "<i8")})

    found = (
        facts.where("role = 2").select("counts", "pair_counts")
        .mapInArrow(unpacked, "b int, after int, alone int, times long")
        .groupBy("b", "after", "alone").agg(F.sum("times").alias("times")).toPandas()
        .sort_values(["b", "after", "alone"])
    )
    return found[["b", "after", "alone"]].to_numpy(np.int64).T, found.times.to_numpy(np.int64)


def counted(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Written table of token counts per document, cells per block and vocabulary per part."""
    docs = texts(docs).select(
        "doc_id", "text", (fold("doc_id", FOLDS) != HELD_OUT).alias("training"),
        (F.pmod(F.xxhash64("doc_id", "text"), F.lit(HELD_FOLDS)) == 0).alias("held"),
    )
    blocks = blocks_of(docs, block_chars)
    parts = max(1, blocks // 2)
    dealt = with_block(docs, blocks).groupBy("block")
    totals = dealt.applyInArrow(_sent(parts), _SENT).groupBy("part").applyInArrow(_summed, _BACK)
    return written(dealt.cogroup(totals.groupBy("block")).applyInArrow(_known, _FACTS), "token-counts")


def train(facts: DataFrame) -> InterpolatedModel:
    tokens = facts.where("role = 0").agg(F.sum("n_tokens")).first()[0] or 0
    kinds = facts.where("role = 3").agg(F.sum("kinds")).first()[0] or 0
    return InterpolatedModel(fit_weights(*_cells(facts), tokens, kinds), tokens, kinds)


def scored(facts: DataFrame, model: InterpolatedModel) -> DataFrame:
    """Scores of every document of a table of counts."""
    documents = facts.where("role < 2").select("doc_id", "role", "counts", "pair_counts")

    def rate(parts):
        unpack = zstandard.ZstdDecompressor()
        for batch in parts:
            rows = []
            for i, role, c, pc in zip(*(batch.column(n).to_pylist() for n in documents_columns)):
                count, pair = _counts(unpack.decompress(c)), _counts(unpack.decompress(pc))
                context = np.concatenate([count[-1:], count[:-1]])  # the first token follows an end token
                base = np.log10((count + 1) / (model.tokens + model.kinds + 1)).sum()
                score = np.log10(model.chances(count, pair, context)).sum() if model.tokens else 0.0
                rows.append((i, role == 1, count.size, int((count > 0).sum()), model.tokens, float(base), float(score)))
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds)], names=result_columns)

    documents_columns = documents.columns
    result_columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return documents.mapInArrow(
        rate, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def document_scores(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    facts = counted(docs, block_chars)
    return scored(facts, train(facts))


def op5_interpolated_lm(spark, sf_dir: str) -> DataFrame:
    return document_scores(table(spark, sf_dir, "documents"))
