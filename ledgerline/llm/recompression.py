"""Substring dedup (operator 4) by recompression.

A document's words are rewritten in rounds. A round first replaces every maximal run of
one symbol, then every pair whose left symbol falls in the round's left half of the
alphabet and whose right symbol falls in the right half. A run's or pair's name is the
hash of what it replaces, so all tasks name equal content alike, without a naming table.
Whether two neighbours merge depends on them alone: each symbol carries the word range
that decides it (``low`` to ``high``), and every occurrence of a stretch of text that
holds this range has the same symbol at the same place.

1. ``parse``: every window of ``window`` words takes the first symbol decided inside it,
   of the highest round that has one, as its anchor (else its own hash). A document keeps
   its distinct anchors and the name of its whole word sequence, its top symbol.
2. Anchors of two or more documents reveal what may repeat (partial aggregation, then a
   join back); documents with an earlier document's top symbol are copies throughout.
3. The windows under revealed anchors get names of 96 bits; a name's least document,
   aggregated before the shuffle, verifies which of them start earlier elsewhere.
4. The documents take those names back and drop the words their windows cover, with the
   windows that start earlier in the same document.

An anchor or window name stands in a shuffle once a document. Hot names are aggregated map-side; what was
aggregated is written before it is joined back, so that both sides of the join are shuffled and adaptive
execution can split a hot name's rows. Each step's result is a table in the shared folder.

Null text: no words. Documents shorter than a window keep all words. Rows that share an id
count as the same document for "earlier elsewhere" but are judged row by row within; a null id
sorts last. Columns the operator adds replace those of the same name; others pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import mix, pair_hash, release, slices, small_batches, text_bytes, word_hashes, words_of, written

ROUNDS = 3
LAST = 2**63 - 1  # stands for a null id
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


class Words:
    """The words of a batch of texts in one array, a separator before, between and after the texts."""

    def __init__(self, column: pa.Array):
        self.data, bounds = text_bytes(column)
        self.starts, self.stops, self.first = words_of(self.data, bounds, _IS_WORD)
        self.hash = word_hashes(self.data, self.starts, self.stops)
        self.n = np.diff(self.first)
        self.text = np.repeat(np.arange(len(self.n)), self.n)
        self.at = np.arange(len(self.hash)) + self.text + 1  # place of each word
        self.size = len(self.hash) + len(self.n) + 1
        self.names = np.zeros(self.size, np.uint64)
        self.names[self.at] = self.hash
        self.gap = np.ones(self.size, bool)
        self.gap[self.at] = False

    def windows(self, width: int) -> np.ndarray:
        """Places where a window of ``width`` words starts."""
        return self.at[np.arange(len(self.hash)) + width <= self.first[1:][self.text]]

    def window_names(self, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """64-bit and 32-bit name of the windows starting at ``at``."""
        a, b = np.full(len(at), width, np.uint64), np.full(len(at), width, np.uint64)
        second = mix(self.names + np.uint64(0x5851F42D4C957F2D))
        for j in range(width):
            a = a * np.uint64(0xD1342543DE82EF95) + self.names[at + j]
            a ^= a >> np.uint64(29)
            b = b * np.uint64(0x2545F4914F6CDD1D) + second[at + j]
        return mix(a), (mix(b) >> np.uint64(33)).astype(np.int32)

    def tops(self) -> np.ndarray:
        """Name of each text's whole word sequence."""
        place = np.arange(len(self.hash)) - self.first[:-1][self.text]
        total = np.concatenate(([np.uint64(0)], np.cumsum(mix(self.hash ^ mix(place.astype(np.uint64) + np.uint64(77))), dtype=np.uint64)))
        return mix(total[self.first[1:]] - total[self.first[:-1]] + self.n.astype(np.uint64))


def rounds_of(words: Words, rounds: int = ROUNDS):
    """After each round, the symbols it made: start, low, high and name."""
    name, gap = words.names, words.gap
    start = np.arange(words.size, dtype=np.int32)
    stop = start + 1
    low, high = start, stop
    for r in range(rounds):
        # runs; that a neighbour differs shows in its word next to this symbol, or else in all that decides it
        last_word, first_word = words.names[stop - 1], words.names[start]
        left, right = start.copy(), stop.copy()
        left[1:] = np.where((last_word[:-1] != last_word[1:]) | gap[:-1], start[1:] - 1, low[:-1])
        right[:-1] = np.where((first_word[1:] != first_word[:-1]) | gap[1:], stop[:-1] + 1, high[1:])
        fresh = np.ones(len(name), bool)
        fresh[1:] = (name[1:] != name[:-1]) | gap[1:] | gap[:-1]
        head = np.flatnonzero(fresh)
        if len(head) < len(name):
            count = np.diff(np.append(head, len(name)))
            tail = head + count - 1
            name = np.where(count > 1, pair_hash(name[head], count.astype(np.uint64), 2 * r + 1), name[head])
            low = np.minimum(np.minimum.reduceat(low, head), left[head])
            high = np.maximum(np.maximum.reduceat(high, head), right[tail])
            start, stop, gap = start[head], stop[tail], gap[head]
        else:
            low, high = np.minimum(low, left), np.maximum(high, right)
        # pairs
        is_left = (mix(name + np.uint64(0xA24BAED4963EE407 * (r + 1) % 2**64)) & np.uint64(1)).astype(bool)
        merge = np.zeros(len(name), bool)
        merge[:-1] = is_left[:-1] & ~is_left[1:] & ~gap[:-1] & ~gap[1:]
        new_low, new_high = low.copy(), high.copy()
        new_high[:-1] = np.where(is_left[:-1], np.maximum(high[:-1], high[1:]), high[:-1])  # its right neighbour decides
        new_low[1:] = np.where(is_left[1:], low[1:], np.minimum(low[1:], low[:-1]))  # its left neighbour decides
        a = np.flatnonzero(merge)
        new_low[a], new_high[a] = np.minimum(low[a], low[a + 1]), np.maximum(high[a], high[a + 1])
        name = name.copy()
        name[a] = pair_hash(name[a], name[a + 1], 2 * r + 2)
        stop = stop.copy()
        stop[a] = stop[a + 1]
        yield start[a], new_low[a], new_high[a], name[a]
        keep = np.ones(len(name), bool)
        keep[a + 1] = False
        name, gap, start, stop, low, high = (x[keep] for x in (name, gap, start, stop, new_low, new_high))


def anchors(words: Words, width: int, at: np.ndarray) -> np.ndarray:
    """Anchor name of each window starting at ``at``: decided by the window's words alone."""
    out = np.zeros(len(at), np.uint64)
    open_ = np.arange(len(at))
    for start, low, high, name in list(rounds_of(words))[::-1]:
        if not len(start):
            continue
        mine = open_
        candidate = np.searchsorted(start, at[mine])
        rest = [open_[:0]]
        while len(mine):
            there = candidate < len(start)
            c = np.minimum(candidate, len(start) - 1)
            s = at[mine]
            there &= start[c] < s + width
            inside = there & (low[c] >= s) & (high[c] <= s + width)
            out[mine[inside]] = name[c[inside]]
            rest.append(mine[~there])
            on = there & ~inside
            mine, candidate = mine[on], candidate[on] + 1
        open_ = np.sort(np.concatenate(rest))
    if len(open_):
        out[open_] = words.window_names(at[open_], width)[0]
    return out


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """``values`` (sorted by their ``owner``) as one list of longs a row."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)), pa.array(values.view(np.int64), pa.int64()))


def _once(owner: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Index of the first place of each (owner, name), by owner."""
    key = pair_hash(owner.astype(np.uint64), names, 9)
    return np.sort(np.unique(key, return_index=True)[1])


def _parse(batch: pa.RecordBatch, text: str, width: int):
    words = Words(batch.column(text))
    at = words.windows(width)
    names, owner = anchors(words, width, at), words.text[np.searchsorted(words.at, at)]
    if len(at):
        change = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]) | (owner[1:] != owner[:-1]))))
        change = change[_once(owner[change], names[change])]
        names, owner = names[change], owner[change]
    return [pa.array(words.n, pa.int64()), pa.array(words.tops().view(np.int64), pa.int64()), _lists(names, owner, batch.num_rows)]


def _of_rows(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each (null lists are empty)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    return np.asarray(column.flatten(), np.int64).view(np.uint64), np.repeat(np.arange(len(column)), size)


def _member(owner: np.ndarray, names: np.ndarray, list_owner: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return np.isin(pair_hash(owner.astype(np.uint64), names, 9), pair_hash(list_owner.astype(np.uint64), listed, 9))


def _candidates(batch: pa.RecordBatch, text: str, width: int) -> pa.RecordBatch:
    """Name rows of the distinct windows whose anchor the row's ``__marks`` lists."""
    words = Words(batch.column(text))
    at = words.windows(width)
    owner = words.text[np.searchsorted(words.at, at)]
    listed, list_owner = _of_rows(batch.column("__marks"))
    under = _member(owner, anchors(words, width, at), list_owner, listed)
    at, owner = at[under], owner[under]
    name, check = words.window_names(at, width)
    once = _once(owner, name)
    ids = np.asarray(batch.column("__id"), np.int64)[owner[once]]
    return pa.RecordBatch.from_arrays([pa.array(name[once].view(np.int64)), pa.array(check[once]), pa.array(ids)], ["name", "check", "doc"])


def _removed(batch: pa.RecordBatch, text: str, width: int):
    """Counts, kept text and removed word ranges from the names in ``__earlier`` and top symbols in ``__copied``."""
    n = batch.num_rows
    words = Words(batch.column(text))
    at = words.windows(width)
    index = np.searchsorted(words.at, at)
    owner = words.text[index]
    name, _ = words.window_names(at, width)
    later = np.ones(len(at), bool)
    later[_once(owner, name)] = False
    listed, list_owner = _of_rows(batch.column("__earlier"))
    if len(listed):
        later |= _member(owner, name, list_owner, listed)
    copied, copied_owner = _of_rows(batch.column("__copied"))
    if len(copied):
        later |= _member(np.arange(n), words.tops(), copied_owner, copied)[owner]
    edge = np.zeros(len(words.hash) + 1, np.int32)
    edge[index[later]] += 1
    np.add.at(edge, index[later] + width, -1)
    gone = np.cumsum(edge)[:-1] > 0
    counted = np.concatenate(([0], np.cumsum(gone)))
    n_removed = counted[words.first[1:]] - counted[words.first[:-1]]
    # kept words, each followed by one space, in one buffer; a text's last space is left out
    keep = np.flatnonzero(~gone)
    size = words.stops[keep] - words.starts[keep]
    target = np.cumsum(size + 1) - size - 1
    buffer = np.full(int((size + 1).sum()), 0x20, np.uint8)
    source = np.repeat(words.starts[keep] - np.cumsum(size) + size, size) + np.arange(size.sum())
    buffer[source + np.repeat(target - words.starts[keep], size)] = words.data[source]
    edges = np.append(target, len(buffer))[np.searchsorted(words.text[keep], np.arange(n + 1))]
    raw = buffer.tobytes()
    kept = [raw[a:max(a, b - 1)] for a, b in zip(edges.tolist(), edges[1:].tolist())]
    change = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))) if n else np.empty(0, np.int64)
    # a removed stretch ends with its text: runs that go on into the next text are cut there
    cut = words.first[1:-1][(words.first[1:-1] > 0) & (words.first[1:-1] < len(gone))] if len(gone) else np.empty(0, np.int64)
    cut = np.unique(cut[gone[cut] & gone[cut - 1]]) if len(cut) else cut
    change = np.sort(np.concatenate([change, cut, cut]))
    who = np.repeat(words.text[change[::2]], 2) if len(change) else change
    spans = (change - words.first[:-1][who]).astype(np.int64) if len(change) else np.empty(0, np.int64)
    return [pa.array(words.n, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
            _lists(spans, who, n)]


def _map(df: DataFrame, schema: T.StructType, text: str, work) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                yield work(part)

    return df.mapInArrow(run, schema)


RESULT = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
          T.StructField("kept_text", T.StringType()), T.StructField("removed_spans", T.ArrayType(T.LongType(), False))]


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 20) -> DataFrame:
    """``docs`` plus ``n_words``; ``n_removed``, words in a window whose word sequence also starts
    earlier; ``kept_text``, the other words joined by one space; ``removed_spans``, the removed word
    ranges [start, stop, ...]. Runs Spark jobs; the result reads their tables."""
    spark = docs.sparkSession
    small_batches(spark)
    added = {f.name for f in RESULT}
    fields = [f for f in docs.schema.fields if f.name.lower() not in added]
    names = [f.name for f in fields]
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("__id")
    texts = docs.select(key, F.col(text).alias("__text"))
    longs = T.ArrayType(T.LongType(), False)

    # 1. anchors and top symbols
    schema = T.StructType([T.StructField("__id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("top", T.LongType()), T.StructField("names", longs)])
    parsed = written(_map(texts, schema, "__text", lambda b: pa.RecordBatch.from_arrays([b.column("__id"), *_parse(b, "__text", window)], schema.names)), "recompression-parsed")

    # 2. what may repeat: copies by their top symbols, and documents with anchors that others have too
    tops = parsed.filter(F.col("n") >= window).select("__id", "top")
    least = written(tops.groupBy("top").agg(F.min("__id").alias("least"), F.max("__id").alias("most")).filter("least < most"), "recompression-tops")
    copied = written(tops.join(least, "top").filter("__id > least").select("__id", "top").distinct(), "recompression-copied")
    copies = written(copied.groupBy("__id").agg(F.collect_set("top").alias("__copied")), "recompression-copies")
    anchors_ = parsed.select("__id", F.explode("names").alias("name"))
    shared = written(anchors_.groupBy("name").agg(F.min("__id").alias("least"), F.max("__id").alias("most")).filter("least < most").select("name"), "recompression-shared")
    release(spark, least)
    own = parsed.join(copied, ["__id", "top"], "left_anti").select("__id", F.explode("names").alias("name"))  # rows that are no copies; others of their id stay
    marks = written(own.join(shared, "name").groupBy("__id").agg(F.collect_set("name").alias("__marks")), "recompression-marks")
    release(spark, parsed, copied, shared)

    # 3. names of the windows under shared anchors, and their least documents
    schema = T.StructType([T.StructField("name", T.LongType()), T.StructField("check", T.IntegerType()), T.StructField("doc", T.LongType())])
    rows = written(_map(texts.join(marks, "__id"), schema, "__text", lambda b: _candidates(b, "__text", window)), "recompression-windows")
    release(spark, marks)
    least = written(rows.groupBy("name", "check").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
                    .filter("least < most").select("name", "check", "least"), "recompression-least")
    release(spark)
    earlier = written(rows.join(least, ["name", "check"]).filter("doc > least").groupBy(F.col("doc").alias("__id")).agg(F.collect_set("name").alias("__earlier")), "recompression-earlier")
    release(spark, rows, least)

    # 4. the documents drop the words of those windows
    found = earlier.join(copies, "__id", "full_outer")
    schema = T.StructType([*fields, *RESULT])
    return _map(docs.select(*names, key).join(found, "__id", "left"), schema, text, lambda b: pa.RecordBatch.from_arrays(
        [*(b.column(c) for c in names), *_removed(b, text, window)], schema.names))
