"""Byte-level BPE encoding and decoding (operator 3).

Texts are split into pre-tokens (``pretokens.split``). The distinct ones of a slice
that a worker has not met yet are laid out in length-bucketed, padded numpy matrices,
one row a pre-token; each round every row merges its leftmost pair of minimum rank,
looked up in a hash table over (left id, right id), closes the gap, and rows with no
pair left leave the matrix (compaction). A row longer than ``LONG`` bytes would make
rounds of quadratic cost; it goes through a heap that merges in the same order.

Results: ``ids`` is a binary column of little-endian unsigned 32-bit ids.
Null text: treated as empty, no ids. Texts of any length are encoded whole, an empty
table gives an empty table. A column the operator adds replaces one of the same name
in its input; all others pass through.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import slices, small_batches, text_bytes, word_hashes
from ledgerline.llm.pretokens import HashIndex, ragged, split

#: Bytes of a pre-token beyond which a heap replaces the matrix.
LONG = 256
#: Pre-tokens a worker remembers (about 40 bytes each); when full, the memory starts anew.
REMEMBERED = 1_000_000
#: Cells of a matrix, and text bytes handled at a time.
CELLS, PIECE = 1 << 20, 1 << 19
NONE = np.int64(1) << 40


class ByteBpe:
    """Merges by rank. ``ranks``: token bytes → rank, which is its id too."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(a, b, rank) for token, rank in ranks.items() for i in range(1, len(token))
                 if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
        left, right, merged = np.array(pairs, np.int64).reshape(-1, 3).T
        self.pairs = HashIndex()
        self.pairs.add(self._key(left, right), merged)
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.token_data = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.token_at, self.token_len = np.cumsum(lengths) - lengths, lengths
        self._forget()

    def _forget(self) -> None:
        self.known = HashIndex(16)
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.at, self.len, self.n = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int32), 0

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)) + np.uint64(1)

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank (and id) of each pair's merge; NONE without one or beside padding (-1)."""
        ok = np.flatnonzero(right >= 0)
        out = np.full(len(left), NONE)
        out[ok] = self.pairs.look(self._key(left[ok], right[ok]), NONE)
        return out

    # -- learning new pre-tokens

    def _matrix(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int):
        """Ids of the rows, flat, and their number by row."""
        n = len(starts)
        ids = np.full((n, width), -1, np.int64)
        ids[np.arange(width) < lengths[:, None]] = self.byte_ids[data[ragged(starts, lengths)]]
        final, live = np.full((n, width), -1, np.int32), np.arange(n)
        columns = np.arange(width)
        ranks = self._look(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        while ranks.shape[1]:
            best = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(live)), best]
            done = lowest >= NONE
            if done.any():  # compaction: finished rows leave, and the matrix shrinks to its longest row
                final[live[done], :ids.shape[1]] = ids[done]
                keep = ~done
                live, best, lowest = live[keep], best[keep], lowest[keep]
                used = max(1, int((ids[keep] >= 0).any(axis=0).sum()))
                ids, ranks, columns = ids[keep, :used], ranks[keep, :used - 1], columns[:used]
                if not len(live):
                    break
            rows = np.arange(len(live))
            ids[rows, best] = lowest
            ids[:, :-1] = np.where(columns[:-1] > best[:, None], ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1  # the row got shorter by one
            ranks[:, :-1] = np.where(columns[:-2] > best[:, None], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            for at in (best - 1, best):  # the pairs the new symbol is part of
                ok = np.flatnonzero((at >= 0) & (at < ranks.shape[1]))
                ranks[ok, at[ok]] = self._look(ids[ok, at[ok]], ids[ok, at[ok] + 1])
        if len(live):
            final[live, :ids.shape[1]] = ids
        there = final >= 0
        return final[there].astype(np.uint32), there.sum(axis=1)

    def _long(self, word: np.ndarray) -> np.ndarray:
        """The same merges, leftmost lowest rank first, from a heap over linked symbols."""
        ids = self.byte_ids[word]
        n = len(ids)
        rank_at = {i: v for i, v in enumerate(self._look(ids[:-1], ids[1:]).tolist()) if v < NONE}
        heap = [(v, i) for i, v in rank_at.items()]
        heapq.heapify(heap)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        memo: dict[tuple[int, int], int] = {}
        while heap:
            rank, i = heapq.heappop(heap)
            if rank_at.get(i) != rank:
                continue  # this pair is gone
            j = after[i]
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            rank_at.pop(j, None)
            for at in (before[i], i):
                if at < 0:
                    continue
                rank_at.pop(at, None)
                if after[at] < n:
                    key = ids[at], ids[after[at]]
                    if key not in memo:
                        memo[key] = int(self._look(np.array(key[:1]), np.array(key[1:]))[0])
                    if memo[key] < NONE:
                        rank_at[at] = memo[key]
                        heapq.heappush(heap, (memo[key], at))
        return np.array([x for x in ids if x >= 0], np.uint32)

    def _remember(self, keys: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.n + len(keys) > len(self.at):
            self.at, self.len = (np.concatenate([x, np.empty_like(x)]) for x in (self.at, self.len))
        new = slice(self.n, self.n + len(keys))
        self.flat[self.used:self.used + len(flat)] = flat
        self.at[new], self.len[new] = self.used + np.cumsum(lengths) - lengths, lengths
        self.known.add(keys, np.arange(new.start, new.stop))
        self.used, self.n = self.used + len(flat), new.stop

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        width = np.where(lengths <= 16, lengths, 1 << np.ceil(np.log2(lengths)).astype(np.int64))
        for w in np.unique(width[lengths <= LONG]).tolist():
            group = np.flatnonzero(width == w)
            for part in np.split(group, range(max(1, CELLS // w), len(group), max(1, CELLS // w))):
                self._remember(keys[part], *self._matrix(data, starts[part], lengths[part], w))
        for i in np.flatnonzero(lengths > LONG).tolist():
            ids = self._long(data[starts[i]:starts[i] + lengths[i]])
            self._remember(keys[i:i + 1], ids, np.array([len(ids)]))

    # -- texts

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Ids of each text (``data`` its UTF-8, text i at ``bounds[i]:bounds[i+1]``)."""
        starts, first = split(data, bounds)
        lengths = np.diff(np.append(starts, len(data)))
        keys = word_hashes(data, starts, starts + lengths)
        if self.n > REMEMBERED:
            self._forget()
        entry = self.known.look(keys)
        new = np.flatnonzero(entry < 0)
        if len(new):
            distinct, one = np.unique(keys[new], return_index=True)
            self._learn(distinct, data, starts[new[one]], lengths[new[one]])
            entry[new] = self.known.look(keys[new])
        size = self.len[entry].astype(np.int64)
        ids = self.flat[ragged(self.at[entry], size)].astype("<u4").tobytes()
        edge = (4 * np.concatenate(([0], np.cumsum(size)))[first]).tolist()
        return [ids[a:b] for a, b in zip(edge, edge[1:])]

    def decode(self, ids: bytes) -> bytes:
        number = np.frombuffer(ids, "<u4")
        return self.token_data[ragged(self.token_at[number], self.token_len[number])].tobytes()


@lru_cache(maxsize=4)
def bpe_of(path: str) -> ByteBpe:
    with open(path, "rb") as f:
        return ByteBpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def mapped(df: DataFrame, column: str, out: str, kind: T.DataType, work) -> DataFrame:
    """``df`` plus the column ``out``, ``work`` of an Arrow array of ``column``."""
    small_batches(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name.lower() != out.lower()]
    schema = T.StructType([*kept, T.StructField(out, kind)])
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, PIECE):
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in names), work(part.column(column))], [*names, out])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` plus ``out``: each text's ids, as tiktoken's ``encode_ordinary`` gives them for the
    rank file at ``path``, which must lie at the same place on every executor."""
    return mapped(df, text, out, T.BinaryType(), lambda col: pa.array(bpe_of(path).encode(*text_bytes(col)), pa.binary()))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` plus ``out``: the bytes that the ids in ``ids`` stand for (null ids: empty)."""
    return mapped(df, ids, out, T.BinaryType(), lambda col: pa.array([bpe_of(path).decode(x.as_py() or b"") for x in col], pa.binary()))


def n_ids(column) -> F.Column:
    return F.coalesce(F.octet_length(column) / 4, F.lit(0)).cast("long")
