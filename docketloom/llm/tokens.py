"""Token ids of whole texts by a public tokenizer, with a cache of pieces.

A byte-pair tokenizer with a pre-tokenizer never merges across the pre-tokenizer's cuts, so a text may be encoded piece by
piece wherever a cut is certain, and pieces repeat. :class:`Encoder` finds certain cuts in the bytes of a batch with numpy,
looks every piece up by its 64-bit hash and length in an open-addressing table, encodes each piece not met before by the
library, and gathers all ids at once. Texts in which a cut isn't certain go to the library whole. A piece of letters alone
is one word to the pre-tokenizer, so it goes to the library's model directly, many pieces in a call.

The table is emptied once it holds ``pieces`` pieces or eight times as many ids, which bounds a worker's memory: about 70 bytes a
piece.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from .common import utf8

#: Words in one call of the library, and what stands between them: a control character, a token that no word has.
_TOGETHER, _BETWEEN = 512, b"\n\x01\n"
_RNG = np.random.default_rng(20_240_602)
_BYTE = _RNG.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.concatenate([[np.uint64(1)], np.cumprod(np.full(1 << 16, _BASE, np.uint64))])
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LETTER = _ALNUM.copy()
_LETTER[48:58] = False


def _at(mask: np.ndarray, by: int) -> np.ndarray:
    """``mask`` moved ``by`` places to the right; False comes in."""
    out = np.zeros(len(mask), bool)
    if by > 0:
        out[by:] = mask[:-by]
    else:
        out[:by] = mask[-by:]
    return out


def _latin(raw: np.ndarray) -> np.ndarray:
    """Both bytes of the letters from À to ÿ."""
    lead = raw == 0xC3
    tail = _at(lead, 1) & (raw >= 0x80) & (raw <= 0xBF) & (raw != 0x97) & (raw != 0xB7)
    return tail | _at(tail, -1)


class Encoder:
    """kind "words": white space is dropped by the tokenizer, so it is a cut. kind "spaced": a single space belongs to the
    word behind it and a single line feed stands alone."""

    def __init__(self, path: str, kind: str, pieces: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.kind, self.pieces = kind, pieces
        self.slots = 1 << (2 * pieces - 1).bit_length()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.words = Tokenizer.from_file(path)
        self.words.encode_special_tokens = True
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: these bytes stand for themselves
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {**{b: b for b in shown}, **{b: 256 + k for k, b in enumerate(hidden)}, 10: 10}
        (self.between,) = self.tokenizer.encode("\x01", add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        self.keys, self.number = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int32)
        self.pool, self.ends, self.count = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        left, slot = np.arange(len(hashes)), (hashes & np.uint64(len(self.keys) - 1)).astype(np.int64)
        while len(left):
            seen = self.keys[slot]
            hit = seen == hashes[left]
            out[left[hit]] = self.number[slot[hit]]
            more = ~hit & (seen != 0)
            left, slot = left[more], (slot[more] + 1) & (len(self.keys) - 1)
        return out

    def _keep(self, hashes: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        """Enter new pieces, whose hashes differ, with their ids."""
        start = int(self.ends[self.count])
        while start + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.count + len(hashes) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.pool[start : start + len(flat)] = flat
        self.ends[self.count + 1 : self.count + len(hashes) + 1] = start + np.cumsum(lengths)
        number = np.arange(self.count, self.count + len(hashes))
        self.count += len(hashes)
        if self.count > 3 * len(self.keys) // 4:  # a single text with more pieces than the table is made for
            full = self.keys != 0
            hashes, number = np.concatenate([self.keys[full], hashes]), np.concatenate([self.number[full], number])
            size = 1 << (2 * self.count).bit_length()
            self.keys, self.number = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        self._enter(hashes, number)

    def _enter(self, hashes: np.ndarray, number: np.ndarray) -> None:
        slot = (hashes & np.uint64(len(self.keys) - 1)).astype(np.int64)
        while len(number):
            free = np.flatnonzero(self.keys[slot] == 0)
            self.keys[slot[free]] = hashes[free]  # of several for one slot, the last written stays
            own = self.keys[slot] == hashes
            self.number[slot[own]] = number[own]
            number, hashes, slot = number[~own], hashes[~own], (slot[~own] + 1) & (len(self.keys) - 1)

    def _sure(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of each text: can it be cut? For "spaced", white space must be single spaces and line feeds inside the text."""
        if self.kind == "words" or not len(raw):
            return np.ones(len(ends) - 1, bool)
        space = _SPACE[raw]
        bad = (space & (raw != 0x20) & (raw != 0x0A)) | (raw == 0) | ((raw >= 0x1C) & (raw <= 0x1F)) | (space & _at(space, 1))
        for lead in np.flatnonzero((raw == 0xC2) | ((raw >= 0xE1) & (raw <= 0xE3))).tolist():
            nxt = bytes(raw[lead : lead + 3])
            if nxt.decode("utf-8", "ignore")[:1].isspace():
                bad[lead] = True
        starts, stops = ends[:-1][ends[1:] > ends[:-1]], ends[1:][ends[1:] > ends[:-1]] - 1
        bad[starts] |= space[starts]
        bad[stops] |= space[stops]
        sums = np.concatenate([[0], np.cumsum(bad)])
        return sums[ends[1:]] == sums[ends[:-1]]

    def _pieces(self, raw: np.ndarray, ends: np.ndarray, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first byte, byte behind the last) of every piece; a text that isn't sure is one piece."""
        space = _SPACE[raw]
        last = np.zeros(len(raw), bool)
        last[ends[1:][ends[1:] > ends[:-1]] - 1] = True
        word = _ALNUM[raw] | (_latin(raw) & (raw < 0xC0))
        stop = ((raw == 0x2C) | (raw == 0x2E)) & _at(word, 1) & (_at(space, -1) | last)
        start = stop | _at(space, 1) | (space if self.kind == "spaced" else False)
        if self.kind == "spaced":  # a space goes with the word behind it
            start &= ~_at(raw == 0x20, 1)
        start[ends[:-1][ends[:-1] < len(raw)]] = True
        inside = np.repeat(sure, np.diff(ends))
        start &= inside
        start[ends[:-1][ends[1:] > ends[:-1]]] = True
        first = np.flatnonzero(start)
        if self.kind == "words":
            first = first[~space[first]]
            cut = np.flatnonzero(start | space)
            to = np.searchsorted(cut, first, "right")
            return first, np.concatenate([cut, [len(raw)]])[to]
        return first, np.concatenate([first[1:], [len(raw)]])

    def _hash(self, raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        if first[-1] + size[-1] == len(raw) and (first[1:] == first[:-1] + size[:-1]).all() and first[0] == 0:
            place = raw
        else:
            place = raw[np.repeat(first - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(int(size.sum()))]
        begin = np.cumsum(size) - size
        within = (np.arange(len(place)) - np.repeat(begin, size)) & 0xFFFF
        h = np.add.reduceat(_BYTE[place] * _POWER[within], begin) + size.astype(np.uint64) * _BASE
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        return np.where(h == 0, np.uint64(1), h)

    def _encode(self, data: bytes, first: np.ndarray, size: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, number of ids of each piece)."""
        flat, lengths = [], np.zeros(len(first), np.int64)
        easy, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        cuts = [data[a:b] for a, b in zip(first[easy].tolist(), (first + size)[easy].tolist(), strict=True)]
        joined = [_BETWEEN.join([*cuts[k : k + _TOGETHER], b""]) for k in range(0, len(cuts), _TOGETHER)]
        if self.kind == "words":
            joined = [x.decode().lower().encode() for x in joined]
        if joined:
            made = self.words.encode_batch_fast([x.decode("latin-1").translate(self.alphabet) for x in joined], add_special_tokens=False)
            ids = np.concatenate([np.array(x.ids, np.uint32) for x in made])
            between = np.flatnonzero(ids == self.between)
            lengths[easy] = np.diff(np.concatenate([[-1], between])) - 1
            flat.append(ids[ids != self.between])
        whole = [x.ids for x in self.tokenizer.encode_batch_fast([data[a:b].decode() for a, b in zip(first[rest].tolist(), (first + size)[rest].tolist(), strict=True)], add_special_tokens=False)]
        lengths[rest] = [len(x) for x in whole]
        flat.append(np.fromiter(chain.from_iterable(whole), np.uint32))
        order = np.concatenate([easy, rest])  # as the ids stand now; put them in the order of the pieces
        flat, own = np.concatenate(flat), lengths[order]
        begin = np.zeros(len(first), np.int64)
        begin[order] = np.cumsum(own) - own
        to = np.cumsum(lengths) - lengths
        return flat[np.repeat(begin - to, lengths) + np.arange(len(flat))], lengths

    def encode(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of the texts among them); an empty text has no ids."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
        if self.count > self.pieces or self.ends[self.count] > 8 * self.pieces:
            self._clear()
        first, last = self._pieces(raw, ends, self._sure(raw, ends))
        if not len(first):
            return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
        size = last - first
        hashes = self._hash(raw, first, size)
        number = self._find(hashes)
        missed = np.flatnonzero(number < 0)
        if len(missed):
            new, where = np.unique(hashes[missed], return_index=True)
            at = missed[where]
            letters = _LETTER[raw] | _latin(raw)
            sums = np.concatenate([[0], np.cumsum(letters)])
            lead = (raw[first[at]] == 0x20) & (self.kind == "spaced")
            plain = (sums[last[at]] - sums[first[at]] == size[at] - lead) & (size[at] > lead)
            self._keep(new, *self._encode(raw.tobytes(), first[at], size[at], plain))
            number[missed] = self._find(hashes[missed])
        begin, lengths = self.ends[number], self.ends[number + 1] - self.ends[number]
        to = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.pool[np.repeat(begin - to[:-1], lengths) + np.arange(to[-1])]
        return ids, to[np.searchsorted(first, ends)]


_MADE: dict[tuple[str, str, int], Encoder] = {}


def encoder(path: str, kind: str, pieces: int = 1_000_000) -> Encoder:
    """The worker's encoder for this file; one for another file goes, as a worker lives on between queries."""
    if (path, kind, pieces) not in _MADE:
        _MADE.clear()
        _MADE[path, kind, pieces] = Encoder(path, kind, pieces)
    return _MADE[path, kind, pieces]


def encoded(column: pa.Array, path: str, kind: str, end: int, pieces: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of a column of texts, with the id ``end`` behind each one's ids; a null text is empty."""
    ids, offsets = encoder(path, kind, pieces).encode(*utf8(column))
    return np.insert(ids, offsets[1:], end), offsets + np.arange(len(offsets))
