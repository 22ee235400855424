"""Token ids of whole texts from a public tokenizer file, with repeated pieces remembered.

The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``. Both vocabularies
split a text before they merge, so a text can be cut where such a split is certain, and
the ids of the pieces in a row are the ids of the text. The bytes of many texts are cut at once
into runs of letters, of digits (one vocabulary: single digits), of other marks and of white space; the last space
before a run belongs to it, or white space is dropped, as the vocabulary has it. Only ASCII and the letters of
Latin-1 are *plain*. What stands between white space and holds anything else (or an apostrophe, or the
``<`` of a special token) stays in one piece.

New plain pieces are what the vocabulary splits off, so they go to the merges of the tokenizer
without its normalizer and splits; the other new pieces go through all of it. Pieces that a process has met
are remembered as Arrow strings and flat arrays of ids.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Remembered pieces of a process and their bytes; beyond that it keeps only those of the texts at hand.
MOST_PIECES = 1_000_000
MOST_BYTES = 1 << 26
#: Bytes of the texts that are cut at a time.
GROUP_BYTES = 1 << 22
#: New plain pieces that the tokenizer gets as one text.
JOINED = 128

_WHITE, _LETTER, _DIGIT, _MARK, _ODD, _END = range(6)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[[ord(c) for c in "'<"]] = _ODD
_CLASS[ord("0"): ord("9") + 1] = _DIGIT
_CLASS[ord("A"): ord("Z") + 1] = _LETTER
_CLASS[ord("a"): ord("z") + 1] = _LETTER
_CLASS[[ord(c) for c in " \t\n\v\f\r"]] = _WHITE

#: First two bytes of special tokens and of other white space, in UTF-8: no cut is certain at white space beside them.
_WIDE = {ord("<"): (ord("|"),), 0xC2: (0x85, 0xA0), 0xE1: (0x9A, 0xA0), 0xE2: (0x80, 0x81), 0xE3: (0x80,)}


def _byte_letters() -> np.ndarray:
    """The character that stands for each byte in the vocabularies; 255 (in no text) is a line break."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = np.zeros(256, "<u2")
    letters[shown] = shown
    hidden = np.setdiff1d(np.arange(256), shown)
    letters[hidden] = 256 + np.arange(hidden.size)
    letters[255] = ord("\n")
    return letters


_BYTE_LETTERS = _byte_letters()


def path(name: str) -> str:
    """Place of a file of the installed vocabularies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _runs_with(inside: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Mask of the runs of ``inside`` that hold any of the ascending ``places``."""
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    hit = np.unique(np.searchsorted(begins, places, side="right") - 1)
    steps = np.zeros(inside.size + 1, np.int8)
    steps[begins[hit]] = 1
    steps[ends[hit]] = -1
    return np.cumsum(steps[:-1], dtype=np.int8).view(bool)


def _classes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of every byte; ``ends`` are the places of the bytes after each text."""
    kind = _CLASS[data]
    kind[ends] = _END
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    odd = np.flatnonzero(kind == _ODD)
    if odd.size:
        first, second = data[odd], data[odd + 1]
        wide = (first >= 0x1C) & (first <= 0x1F)
        for a, after in _WIDE.items():
            wide |= (first == a) & np.isin(second, after)
        if wide.any():
            blank = kind == _WHITE
            at = odd[wide]
            blank[at] = True
            for _ in range(2):  # the other bytes of these characters
                blank[1:] |= blank[:-1] & (data[1:] & 0xC0 == 0x80)
            kind[_runs_with(blank, at)] = _ODD
            odd = np.flatnonzero(kind == _ODD)
        kind[_runs_with((kind != _WHITE) & (kind != _END), odd)] = _ODD
    return kind


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(file)
        self._encode = tokenizer.encode_batch_fast
        self._drops_space = type(tokenizer.pre_tokenizer).__name__ == "Sequence"
        merges = Tokenizer(tokenizer.model)
        merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self._merge = merges.encode_batch  # the fast one does not tell words apart
        self._forget()

    def _forget(self) -> None:
        self._known = pa.array([], pa.binary())
        self._ids, self._ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def __call__(self, text: str) -> bytes:
        return self.batch([text])[0]

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        return self.column(pa.array(texts, pa.string()))

    def column(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of an Arrow column."""
        if not len(texts):
            return []
        after = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [*(np.flatnonzero(np.diff(after // GROUP_BYTES)) + 1).tolist(), len(texts)]
        out, begin = [], 0
        for cut in cuts:
            out += self._group(texts.slice(begin, cut - begin))
            begin = cut
        return out

    def _group(self, texts: pa.Array) -> list[bytes]:
        """What is new in some texts goes to the tokenizer at once."""
        listed = pa.ListArray.from_arrays([0, len(texts)], texts.cast(pa.binary()))
        joined = pc.binary_join(listed, b"\xff")[0].as_buffer()
        data = np.append(np.frombuffer(joined, np.uint8), np.uint8(255))
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False) + 1, dtype=np.int64) - 1
        begins, odd, last = self._cut(data, ends)
        offsets = np.append(begins, data.size).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), begins.size, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        piece = pieces.indices.to_numpy()
        odd_kinds = np.zeros(len(pieces.dictionary), bool)
        odd_kinds[piece] = odd
        where = self._places(pieces.dictionary, odd_kinds)[piece]
        counts = self._ends[where + 1] - self._ends[where]
        total = np.cumsum(counts)
        take = np.repeat(self._ends[where] - (total - counts), counts)
        take += np.arange(take.size)
        ids, cuts = self._ids[take], [0, *total[last].tolist()]
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _cut(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where pieces begin, which are odd, and which is the end of each text; letters are lowered in place."""
        kind = _classes(data, ends)
        bound = np.diff(kind, prepend=np.uint8(255)) != 0
        bound[ends] = True
        if self._drops_space:
            bound |= kind == _DIGIT
            data[(kind == _LETTER) & (data >= ord("A")) & (data <= ord("Z"))] += 32
            lead = np.flatnonzero((data == 0xC3) & (kind == _LETTER)) + 1
            data[lead[data[lead] <= 0x9E]] += 32
        else:
            after = np.flatnonzero(bound[1:] & (kind[:-1] == _WHITE) & (kind[1:] != _END)) + 1
            bound[after - 1] = True
            bound[after[data[after - 1] == ord(" ")]] = False
        begins = np.flatnonzero(bound)
        odd = kind[np.append(begins[1:], data.size) - 1] == _ODD
        return begins, odd, np.searchsorted(begins, ends)

    def _places(self, kinds: pa.Array, odd: np.ndarray) -> np.ndarray:
        """Where different pieces are remembered, after the tokenizer has got the new ones."""
        found = pc.index_in(kinds, value_set=self._known)
        is_new = found.is_null()
        new, where = kinds.filter(is_new), found.fill_null(0).to_numpy().astype(np.int64)
        is_new = is_new.to_numpy(zero_copy_only=False)
        ids, counts = self._tokenized(new, odd[is_new])
        if len(self._known) + len(new) > MOST_PIECES or self._known.nbytes + new.nbytes > MOST_BYTES:
            kept = where[~is_new]
            old = [self._ids[a:b] for a, b in zip(self._ends[kept].tolist(), self._ends[kept + 1].tolist())]
            known = kinds.filter(pa.array(~is_new))
            self._forget()
            self._remember(known, np.concatenate([self._ids, *old]), np.array([x.size for x in old], np.int64))
            where[~is_new] = np.arange(kept.size)
        where[is_new] = len(self._known) + np.arange(len(new))
        self._remember(new, ids, counts)
        return where

    def _remember(self, kinds: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self._known = pa.concat_arrays([self._known, kinds])
        self._ids = np.concatenate([self._ids, ids])
        self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(counts)])

    def _tokenized(self, kinds: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces in a row, and how many each has."""
        kinds = kinds.to_pylist()
        plain = np.array([i for i, k in enumerate(kinds) if not (odd[i] or self._silent(k))], np.int64)
        texts = []
        for begin in range(0, plain.size, JOINED):
            some = b"\xff".join([kinds[i] for i in plain[begin: begin + JOINED]])
            texts.append(_BYTE_LETTERS[np.frombuffer(some, np.uint8)].tobytes().decode("utf-16-le"))
        owners, found = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
        for begin in range(0, len(texts), 64):
            for k, e in enumerate(self._merge(texts[begin: begin + 64], add_special_tokens=False), begin):
                found.append(np.array(e.ids, "<u4"))
                owners.append(plain[k * JOINED + np.array(e.word_ids, np.int64)])
        rest = np.flatnonzero(odd)
        for begin in range(0, rest.size, 4096):
            some = rest[begin: begin + 4096]
            for i, e in zip(some, self._encode([kinds[i].decode() for i in some], add_special_tokens=False)):
                found.append(np.array(e.ids, "<u4"))
                owners.append(np.full(len(e.ids), i))
        owners, found = np.concatenate(owners), np.concatenate(found)
        return found[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(kinds))

    def _silent(self, kind: bytes) -> bool:
        """Ends of texts, and white space where it is dropped, have no ids."""
        return kind == b"\xff" or (self._drops_space and kind.isspace())


def encoder(file: str) -> Encoder:
    """The encoder of this process, so that tasks of one worker share what it remembers."""
    held = sys.modules.setdefault("_riskflow_encoders", types.ModuleType("_riskflow_encoders")).__dict__
    if file not in held:
        held[file] = Encoder(file)
    return held[file]
