"""Token counts (operator 5): rank-synchronous merging over ragged arrays.

The pre-tokens a worker has not met yet lie one after another in a flat symbol array.
Each round looks up every neighbouring pair's rank, takes each sequence's lowest one,
and merges all places of that pair in the sequence at once (in a run of one symbol every
other place, from the left); sequences with no pair left are counted and leave. In a
trained vocabulary the merges that use a new symbol rank after the one that made it, so
this gives what merging one place at a time gives.

A count is the number of surviving symbols, summed over the text's pre-tokens; a special
token inside a text counts as one and splits the text, as the library does by default.
Null text: 0 tokens, 0 bytes. Texts of any length are counted whole; an empty table gives
an empty table. Columns the operator adds replace those of the same name; others pass through.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerline.llm.byte_bpe import mapped
from ledgerline.llm.common import text_bytes, word_hashes
from ledgerline.llm.pretokens import HashIndex, ragged, split

#: Counts a worker remembers (16 bytes each, up to twice that in the index); when full, the memory starts anew.
REMEMBERED = 1_500_000
#: Symbols merged together.
FLAT = 1 << 21
NONE = np.int64(1) << 40


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte: itself if it is a visible Latin-1
    character, else the next free code point from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankMerger:
    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without normalizer or prefix space is supported")
        vocab = model["vocab"]
        alphabet = byte_alphabet()
        self.byte_ids = np.zeros(256, np.int64)
        for char, byte in alphabet.items():
            self.byte_ids[byte] = vocab[char]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in merges)))
        self.made = made
        self.pairs = HashIndex()
        self.pairs.add(self._key(left, right), np.arange(len(merges)))
        special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip, normalise or need word bounds are not supported")
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(special, key=len, reverse=True))) if special else None
        self.known = HashIndex(16)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)) + np.uint64(1)

    def count_sequences(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Surviving symbols of each sequence (``symbols`` has them one after another)."""
        counts = lengths.copy()
        live = np.flatnonzero(lengths > 1)
        symbols = symbols[np.repeat(lengths > 1, lengths)]
        lengths = lengths[live]
        while len(live):
            begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            sequence = np.repeat(np.arange(len(live)), lengths)
            rank = np.full(len(symbols), NONE)
            inner = np.flatnonzero(sequence[:-1] == sequence[1:])
            rank[inner] = self.pairs.look(self._key(symbols[inner], symbols[inner + 1]), NONE)
            lowest = np.minimum.reduceat(rank, begin)
            done = lowest >= NONE
            counts[live[done]] = lengths[done]
            hit = (rank == lowest[sequence]) & ~done[sequence]
            at = np.flatnonzero(hit)
            if not len(at):
                break
            # overlapping places are those of a pair (x, x) in a run: keep every other one from the run's start
            fresh = np.concatenate(([True], (np.diff(at) != 1) | (sequence[at[1:]] != sequence[at[:-1]])))
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = ~done[sequence]
            keep[at + 1] = False
            lengths = np.bincount(sequence[keep], minlength=len(live))
            symbols = symbols[keep]
            live, lengths = live[~done], lengths[~done]
            if (single := lengths == 1).any():
                counts[live[single]] = 1
                symbols = symbols[np.repeat(~single, lengths)]
                live, lengths = live[~single], lengths[~single]
        return counts

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        edges = np.searchsorted(np.cumsum(lengths), np.arange(FLAT, int(lengths.sum()), FLAT)) + 1
        for part in np.split(np.arange(len(keys)), np.unique(edges)):
            if len(part):
                symbols = self.byte_ids[data[ragged(starts[part], lengths[part])]]
                self.known.add(keys[part], self.count_sequences(symbols, lengths[part]))

    def count(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of each text (``data`` its UTF-8, text i at ``bounds[i]:bounds[i+1]``)."""
        spans = np.array([m.span() for m in self.special.finditer(data.tobytes())], np.int64).reshape(-1, 2) if self.special else np.empty((0, 2), np.int64)
        text = np.searchsorted(bounds, spans[:, 0], side="right") - 1
        spans = spans[spans[:, 1] <= bounds[text + 1]] if len(spans) else spans  # not across two texts
        starts, first = split(data, bounds, spans.ravel() if len(spans) else None)
        lengths = np.diff(np.append(starts, len(data)))
        keys = word_hashes(data, starts, starts + lengths)
        if self.known.size > REMEMBERED:
            self.known = HashIndex(16)
        count = self.known.look(keys)
        new = np.flatnonzero(count < 0)
        if len(new):
            distinct, one = np.unique(keys[new], return_index=True)
            self._learn(distinct, data, starts[new[one]], lengths[new[one]])
            count[new] = self.known.look(keys[new])
        if len(spans):
            inside = np.searchsorted(spans[:, 0], starts, side="right") - 1
            covered = (inside >= 0) & (starts < spans[np.maximum(inside, 0), 1])
            count[covered] = np.isin(starts[covered], spans[:, 0])
        total = np.concatenate(([0], np.cumsum(count)))
        return total[first[1:]] - total[first[:-1]]


@lru_cache(maxsize=4)
def merger_of(path: str) -> RankMerger:
    with open(path, encoding="utf-8") as f:
        return RankMerger(json.load(f))


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` plus ``out``: tokens of each text by the tokenizers file at ``path``, which
    must lie at the same place on every executor."""
    return mapped(df, text, out, T.LongType(), lambda col: pa.array(merger_of(path).count(*text_bytes(col)), pa.int64()))
