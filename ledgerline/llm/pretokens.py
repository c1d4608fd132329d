"""Pre-tokens of many texts at once: the split pattern of the byte-level
vocabularies as numpy rules over character classes, and a numpy hash index.

``split`` gives the same pieces as matching ``public_tokenizers.PATTERN`` from left
to right (the tests hold it against the regular expression): a run of letters, of
numbers or of other signs, each with one plain space before it if there is one; the
English contractions; and white space, whose last sign before a word stands apart.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE = range(4)
#: The pattern's contractions and Unicode's White_Space characters.
SHORT_CONTRACTIONS, LONG_CONTRACTIONS = "stmd", ("re", "ve", "ll")
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    of = {"L": LETTER, "N": NUMBER}
    table = np.array([of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.int8)
    table[WHITE_SPACE] = SPACE
    return table


def split(data: np.ndarray, bounds: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all pre-tokens of the texts (``data`` is their UTF-8, one after
    another, text i at ``bounds[i]:bounds[i+1]``), and the number of each text's first one
    (one entry more than texts). ``cuts``: byte offsets that also begin a text of their own."""
    n_texts = len(bounds) - 1
    if not len(data):
        return np.empty(0, np.int64), np.zeros(n_texts + 1, np.int64)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.arange(len(data)) if len(code) == len(data) else np.flatnonzero((data & 0xC0) != 0x80)
    n = len(code)
    kind = classes()[code]
    begins = np.zeros(n + 1, bool)  # a text begins (or all end) here
    begins[np.searchsorted(at, bounds)] = True
    if cuts is not None:
        begins[np.searchsorted(at, cuts)] = True
    begins[n] = True
    start = begins[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    before_word = np.zeros(n, bool)
    before_word[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begins[1:n]
    start |= before_word
    start[np.flatnonzero(before_word & (code == 32)) + 1] = False
    quote = np.flatnonzero((code == 39) & start & ~begins[1:])
    if len(quote):
        ahead = np.append(code, [0, 0])
        inside = np.append(~begins[1:], [False, False])  # the text goes on after this character
        one = np.isin(ahead[quote + 1], [ord(c) for c in SHORT_CONTRACTIONS])
        two = np.zeros(len(quote), bool)
        for a, b in LONG_CONTRACTIONS:
            two |= (ahead[quote + 1] == ord(a)) & inside[quote + 1] & (ahead[quote + 2] == ord(b))
        start[quote[one | two] + 1] = False
        rest = np.concatenate([quote[one] + 2, quote[two] + 3])
        start[rest[rest < n]] = True
    starts = at[start]
    return starts, np.searchsorted(starts, bounds)


class HashIndex:
    """64-bit keys → int64 values: numpy arrays probed linearly, doubled when half full."""

    FREE = np.uint64(0)
    MULT = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, bits: int = 12):
        self.bits, self.size = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * self.MULT >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct new keys; 0 stands for a free slot, so it is stored as 1."""
        keys = np.maximum(keys, np.uint64(1))
        if 2 * (self.size + len(keys)) > len(self.keys):
            used = self.keys != self.FREE
            old = self.keys[used], self.values[used]
            while 2 * (self.size + len(keys)) > 1 << self.bits:
                self.bits += 1
            self.keys = np.zeros(1 << self.bits, np.uint64)
            self.values = np.zeros(1 << self.bits, np.int64)
            self._put(*old)
        self._put(keys, values)
        self.size += len(keys)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] == self.FREE
            self.keys[slot[todo[free]]] = keys[todo[free]]  # of several for one slot the last stays
            won = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[won]]] = values[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)

    def look(self, keys: np.ndarray, missing: int = -1) -> np.ndarray:
        keys = np.maximum(keys, np.uint64(1))
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.values[slot], missing)
        on = np.flatnonzero((seen != keys) & (seen != self.FREE))
        while len(on):
            slot[on] = (slot[on] + 1) & (len(self.keys) - 1)
            seen = self.keys[slot[on]]
            hit = seen == keys[on]
            out[on[hit]] = self.values[slot[on[hit]]]
            on = on[~hit & (seen != self.FREE)]
        return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... (length of them) of each range, one range after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return shift + np.arange(total)
