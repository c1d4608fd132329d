"""Benchmark decontamination (operator 9): suffix arrays over the training text.

Each slice of documents a task reads is a shard: its words get shard-local ranks and
its suffixes are sorted by their first words (prefix tripling over packed ranks). Every
benchmark suffix that begins a window is then binary-searched in the shard; the range it
finds holds the places where the window stands verbatim. Nothing is shuffled: a document
lies in one shard whole. The benchmark comes to the tasks in blocks of ``BLOCK_BYTES`` of
text, one pass over the documents a block, so no broadcast grows with it.

A window is ``window`` consecutive words of an item; an item with fewer words, but not
none, is one window. Words are runs of ASCII letters (lower-cased), digits and non-ASCII
characters. Null or empty texts have no words and are never contaminated; repeated rows
are handled row by row; items with the same id count once; a null item id counts as ''.
Columns the operator adds replace those of the same name; others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import mix, slices, small_batches, text_bytes, word_hashes, words_of

#: Benchmark text bytes per block, and document bytes per shard.
BLOCK_BYTES, SHARD_BYTES = 4 << 20, 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True

RESULT = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("hit_spans", T.ArrayType(T.LongType(), False)), T.StructField("longest", T.LongType()),
          T.StructField("items", T.ArrayType(T.StringType(), False))]


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column and the index of each text's first word."""
    data, bounds = text_bytes(column)
    starts, stops, first = words_of(data, bounds, _IS_WORD)
    return word_hashes(_LOWER[data], starts, stops), first


@dataclass
class Block:
    """Distinct windows of some benchmark items: window k's words are
    ``words[start[k]:start[k] + length[k]]``; ``item_of[item_at[k]:item_at[k + 1]]`` are its
    items' numbers; ``steps`` has the pairs of windows that follow one another in an item."""

    words: np.ndarray
    start: np.ndarray
    length: np.ndarray
    item_of: np.ndarray
    item_at: np.ndarray
    steps: np.ndarray
    ids: list[str]


def block_of(ids: list[str], texts: list[str | None], window: int) -> Block:
    hashes, first = words(pa.array(texts, pa.string()))
    n = np.diff(first)
    per = np.where(n == 0, 0, np.maximum(1, n - window + 1))
    item = np.repeat(np.arange(len(ids)), per)
    start = np.repeat(first[:-1], per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    length = np.minimum(window, n[item])
    # two 64-bit names a window, so that different windows are told apart at any size
    names = np.empty((len(start), 2), np.uint64)
    for k, salt in enumerate((1, 2)):
        name = mix(length.astype(np.uint64) + np.uint64(salt))
        for j in range(window):
            on = j < length
            name[on] = mix(name[on] * np.uint64(2 * salt + 1) + hashes[start[on] + j])
        names[:, k] = name
    _, one, kind = np.unique(names, axis=0, return_index=True, return_inverse=True)
    kind = kind.ravel()
    pairs = np.unique(np.stack([kind, item], 1), axis=0) if len(kind) else np.empty((0, 2), np.int64)
    follows = np.flatnonzero(item[1:] == item[:-1])
    steps = np.unique(kind[follows] * len(one) + kind[follows + 1]) if len(kind) else np.empty(0, np.int64)
    return Block(hashes, start[one], length[one], pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(one) + 1)), steps, ids)


def suffix_array(ranks: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Suffixes of ``ranks`` sorted by at least their first ``depth`` entries; and the
    sorted distinct packed prefixes of the first round, with their length and bits an entry."""
    span, current, first = 1, ranks, None
    while True:
        bits = max(1, int(current.max()).bit_length())
        pieces = max(2, min(63 // bits, -(-depth // span)))
        key = current.copy()
        for j in range(1, pieces):
            key <<= bits
            if j * span < len(current):
                key[:-j * span] |= current[j * span:]
        span *= pieces
        order = np.argsort(key) if span >= depth else None
        if first is None or order is None:
            values, inverse = np.unique(key, return_inverse=True) if order is None else (np.unique(key), None)
            first = first or (values, span, bits)
            current = inverse
        if order is not None:
            return order, *first


def search(order: np.ndarray, ranks: np.ndarray, query: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query row (its first ``length`` ranks) the range of ``order`` whose suffixes begin with it."""
    padded = np.append(ranks, np.zeros(query.shape[1], ranks.dtype))
    edges = []
    for upper in (False, True):
        low, high = np.zeros(len(query), np.int64), np.full(len(query), len(order))
        while (low < high).any():
            middle = np.minimum((low + high) // 2, len(order) - 1)
            at = order[middle]
            sign = np.zeros(len(query), np.int8)  # suffix against query
            for k in range(query.shape[1]):
                on = np.flatnonzero((sign == 0) & (k < length))
                if not len(on):
                    break
                sign[on] = np.sign(padded[at[on] + k] - query[on, k])
            right = (sign < 0) | ((sign == 0) & upper)
            open_ = low < high
            low = np.where(open_ & right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        edges.append(low)
    return edges[0], edges[1]


class Shard:
    """The suffix array of a column of texts; text t's words are ``first[t]`` to ``first[t + 1]``."""

    def __init__(self, column: pa.Array, depth: int):
        hashes, self.first = words(column)
        n_texts = len(self.first) - 1
        self.n = np.diff(self.first)
        self.vocabulary, rank = np.unique(hashes, return_inverse=True)
        # a 0 after each text keeps suffixes from matching on into the next text
        text = np.repeat(np.arange(n_texts), self.n)
        self.ranks = np.zeros(len(hashes) + n_texts, np.int64)
        self.ranks[np.arange(len(hashes)) + text] = rank + 1
        self.begin = self.first[:-1] + np.arange(n_texts)
        if len(hashes):
            self.order, self.prefixes, self.span, self.bits = suffix_array(self.ranks, depth)

    def find(self, block: Block, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (indices into ``ranks``) of the block's windows, and the windows' numbers."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(self.vocabulary) or not len(block.start):
            return none
        place = np.minimum(np.searchsorted(self.vocabulary, block.words), len(self.vocabulary) - 1)
        rank = np.append(np.where(self.vocabulary[place] == block.words, place + 1, -1), np.zeros(window, np.int64))
        query = rank[block.start[:, None] + np.arange(window)]
        query[np.arange(window) >= block.length[:, None]] = 0
        known = np.flatnonzero((query >= 0).all(axis=1))
        if self.span <= window:  # drop those whose first words never stand together in the shard
            key = query[known, 0]
            for j in range(1, self.span):
                key = key << self.bits | query[known, j]
            at = np.minimum(np.searchsorted(self.prefixes, key), len(self.prefixes) - 1)
            known = known[(self.prefixes[at] == key) | (block.length[known] < self.span)]
        if not len(known):
            return none
        low, high = search(self.order, self.ranks, query[known], block.length[known])
        size = high - low
        place = self.order[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]
        return place, np.repeat(known, size)


def _mark(batch: pa.RecordBatch, block: Block, window: int, text: str, kept: list[str], earlier: bool) -> pa.RecordBatch:
    shard = Shard(batch.column(text), window)
    n = batch.num_rows
    place, kind = shard.find(block, window)
    total = len(shard.ranks)
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + block.length[kind], -1)
    if earlier:  # what the blocks before this one hit
        for t, spans in enumerate(batch.column("hit_spans").to_pylist()):
            at = np.asarray(spans or [], np.int64) + shard.begin[t]
            np.add.at(edge, at[::2], 1)
            np.add.at(edge, at[1::2], -1)
    hit = np.cumsum(edge)[:total] > 0
    text_of = np.searchsorted(shard.begin, place, side="right") - 1
    change = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    owner = np.searchsorted(shard.begin, change[::2], side="right") - 1
    spans = change - np.repeat(shard.begin[owner], 2)
    span_at = np.searchsorted(np.repeat(owner, 2), np.arange(n + 1)).astype(np.int32)
    counted = np.concatenate(([0], np.cumsum(hit)))
    n_hit = counted[shard.begin + shard.n] - counted[shard.begin]
    longest = np.zeros(n, np.int64)
    if len(place):
        order = np.lexsort((kind, place))
        p, k = place[order], kind[order]
        full = block.length[k] == window
        np.maximum.at(longest, text_of, block.length[kind])
        p, k = p[full], k[full]
        if len(p):
            goes_on = np.concatenate(([False], (np.diff(p) == 1) & np.isin(k[:-1] * len(block.start) + k[1:], block.steps)))
            begin = np.maximum.accumulate(np.where(goes_on, 0, np.arange(len(p))))
            np.maximum.at(longest, np.searchsorted(shard.begin, p, side="right") - 1, window + np.arange(len(p)) - begin)
    seen = np.unique(np.stack([text_of, kind], 1), axis=0) if len(place) else np.empty((0, 2), np.int64)
    each = block.item_at[seen[:, 1] + 1] - block.item_at[seen[:, 1]]
    which = block.item_of[np.repeat(block.item_at[seen[:, 1]] - np.cumsum(each) + each, each) + np.arange(each.sum())]
    owners = np.unique(np.stack([np.repeat(seen[:, 0], each), which], 1), axis=0)
    before = batch.column("items").to_pylist() if earlier else None
    items = [sorted({block.ids[i] for i in g} | set(before[t] if earlier else ())) for t, g in
             enumerate(np.split(owners[:, 1], np.searchsorted(owners[:, 0], np.arange(1, n))))]
    if earlier:
        longest = np.maximum(longest, batch.column("longest").to_numpy(zero_copy_only=False))
    made = [pa.array(shard.n, pa.int64()), pa.array(n_hit, pa.int64()),
            pa.ListArray.from_arrays(pa.array(span_at), pa.array(spans, pa.int64())),
            pa.array(longest, pa.int64()), pa.array(items, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], [*kept, *(f.name for f in RESULT)])


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, window: int):
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"),
                                F.col(item_text).alias("t")).toLocalIterator():
        ids.append(row.i)
        texts.append(row.t)
        size += len(row.t or "")
        if size >= BLOCK_BYTES:
            yield block_of(ids, texts, window)
            ids, texts, size = [], [], 0
    if ids:
        yield block_of(ids, texts, window)


def find_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = 10) -> DataFrame:
    """``docs`` plus, for each row: ``n_words``; ``n_hit``, its words inside any occurrence of a
    window; ``hit_spans``, their word ranges [start, stop, start, stop, ...]; ``longest``, words in the
    longest stretch whose windows follow one another in the benchmark too; ``items``, the sorted
    ids of the items with an occurring window."""
    small_batches(docs.sparkSession)
    added = {f.name for f in RESULT}
    kept = [f for f in docs.schema.fields if f.name.lower() not in added]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *RESULT])
    out = docs.select(*names)
    empty = block_of([], [], window)
    for i, block in enumerate(_blocks(benchmark, item_id, item_text, window) if benchmark is not None else ()):
        out = _searched(out, block, window, text, names, schema, i > 0)
    return out if out.schema.names != names else _searched(out, empty, window, text, names, schema, False)


def _searched(df: DataFrame, block: Block, window: int, text: str, kept: list[str], schema: T.StructType, earlier: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, text, SHARD_BYTES):
                yield _mark(part, block, window, text, kept, earlier)

    return df.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows in which a window of the benchmark stands."""
    return find_matches(docs, benchmark, **options).filter("n_hit = 0").select(*docs.columns)
