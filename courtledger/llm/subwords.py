"""Whole texts to subword ids, equal to what the tokenizers library gives for them.

Both vocabularies used here split a text before white space and between letters and signs,
and never merge across that. So a text is cut before each single space or line feed that
stands between two other characters and before a sign that follows a letter, every distinct piece is encoded once by the library and remembered, and the ids
of a text are those of its pieces one after the other. Where a piece could depend on its
surroundings (special strings, white space outside ASCII, information separators), the
whole text goes to the library instead.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from courtledger.llm.blocks import WHITE, first_of_text, groups, segment_hashes, texts_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces remembered by a worker; beyond that it starts afresh.
REMEMBERED = 2_000_000

SLOTS = 1 << 21

WORD = re.compile("[ \n]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Byte-level vocabularies write bytes as characters: printable ones as themselves, the
#: others in order from 256 on.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_later = iter(range(256, 512))
PRINTABLE = "".join(chr(b) if b in _SHOWN else chr(next(_later)) for b in range(256))
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _whole_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts must not be cut."""
    if len(data) < 3:
        return np.zeros(len(offsets) - 1, dtype=bool)
    a, b = data[:-1], data[1:]
    found = (a == 0x3C) & (b == 0x7C)
    found |= (a == 0xCE) & (b == 0xA3)  # a capital that is lowered by what surrounds it
    found |= (a >= 0x1C) & (a <= 0x1F) | (b >= 0x1C) & (b <= 0x1F)
    found |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    odd = np.flatnonzero((a == 0xE1) & (b == 0x9A) | (a == 0xE2) & ((b == 0x80) | (b == 0x81)) | (a == 0xE3) & (b == 0x80))
    if len(odd):
        third = data[np.minimum(odd + 2, len(data) - 1)]
        general = (data[odd] == 0xE2) & (data[odd + 1] == 0x80)
        spaces = np.where(
            general,
            (third <= 0x8B) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF),
            (third == 0x80) | (third == 0x9F),
        )
        found[odd[spaces]] = True
    at = np.flatnonzero(found)
    whole = np.zeros(len(offsets) - 1, dtype=bool)
    whole[np.searchsorted(offsets, at, "right") - 1] = True
    return whole


def _piece_starts(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> np.ndarray:
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 2:
        white = WHITE[data]
        middle = (data[1:-1] == 32) | (data[1:-1] == 10)
        cut[1:-2] = middle & ~white[:-2] & ~white[2:]
        # Signs never belong to the letters before them.
        letter = _LETTER[data]
        latin = np.flatnonzero(data[:-1] == 0xC3) + 1
        letter[latin] = (data[latin] != 0x97) & (data[latin] != 0xB7)
        cut[1:-1] |= letter[:-1] & _PUNCTUATION[data[1:]]
        for text in np.flatnonzero(whole):
            cut[offsets[text] : offsets[text + 1]] = False
        # A space that ends a text stands before nothing.
        ends = offsets[1:-1]
        ends = ends[ends > 0] - 1
        cut[ends] &= ~white[ends]
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Encodes batches of texts; one for each vocabulary and worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.lower = self.tokenizer.normalizer is not None
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.order = np.empty(0, np.int32)
        # Most pieces are found at once by the low bits of their hash.
        self.slot_hash = np.zeros(SLOTS, np.uint64)
        self.slot_place = np.zeros(SLOTS, np.int32)
        self.place = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _ids(self, piece: str) -> list[int]:
        # A word of Latin letters is one unit of the splitting rule: the library's model
        # takes it without the cost of going through normalisation and splitting.
        if WORD.fullmatch(piece):
            if self.lower:
                piece = piece.lstrip().lower()
            elif piece[0] == "\n":
                return [*self._ids("\n"), *self._ids(piece[1:])]
            if piece.isascii():
                mapped = piece.replace(" ", PRINTABLE[32])
            else:
                mapped = piece.encode().decode("latin-1").translate(PRINTABLE)
            return [token.id for token in self.model.tokenize(mapped)]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        ids = [self._ids(piece) for piece in pieces]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(length.sum()))
        place = np.cumsum(length) - length + len(self.flat)
        self.flat = np.concatenate([self.flat, flat])
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.order = np.insert(self.order, at, np.arange(len(pieces), dtype=np.int32) + len(self.place))
        self.place = np.append(self.place, place)
        self.length = np.append(self.length, length)

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where each piece is remembered; pieces not seen before are learnt."""
        hashes = segment_hashes(data, starts, ends)
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        at = self.slot_place[slot].astype(np.int64)
        missed = np.flatnonzero(self.slot_hash[slot] != hashes)
        if len(missed):
            distinct, example, which = np.unique(
                hashes[missed], return_index=True, return_inverse=True
            )
            found = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
            new = self.known[found] != distinct if len(self.known) else np.ones(len(distinct), dtype=bool)
            if new.any():
                raw = data.tobytes()
                pick = missed[example[new]]
                pieces = [raw[a:b].decode() for a, b in zip(starts[pick].tolist(), ends[pick].tolist())]
                self._learn(distinct[new], pieces)
                found = np.searchsorted(self.known, distinct)
            places = self.order[found]
            own = (distinct & np.uint64(SLOTS - 1)).astype(np.int64)
            self.slot_hash[own], self.slot_place[own] = distinct, places
            at[missed] = places[which]
        return at

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Yields ``low, high, ids, first``: ids of texts low to high, and where each begins."""
        for low, high in groups(offsets):
            base = offsets[low]
            yield low, high, *self._group(data[base : offsets[high]], offsets[low : high + 1] - base)

    def _group(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        if len(self.known) > REMEMBERED:
            self.forget()
        starts = _piece_starts(data, offsets, _whole_texts(data, offsets))
        ends = np.append(starts[1:], len(data))
        at = self._places(data, starts, ends)
        length = self.length[at]
        stop = np.cumsum(length)
        where = np.repeat(self.place[at] - (stop - length), length)
        where += np.arange(len(where))
        first = np.append(0, stop)[first_of_text(starts, offsets)]
        return self.flat[where], first


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; it outlives a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def ended_ids(column, path: str, end_id: int):
    """For each text of an Arrow column its ids followed by ``end_id``; null counts as empty."""
    data, offsets = texts_of(column)
    for _, _, ids, first in encoder(path).encode(data, offsets):
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield np.append(ids[a:b], np.uint32(end_id))
