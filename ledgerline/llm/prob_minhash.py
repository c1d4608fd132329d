"""Near-duplicate classes by ProbMinHash (operator 10).

A text is a weighted set: its shingles of ``shingle`` words (fewer words make one shingle),
each weighing as often as it occurs. Every element is a Poisson process whose rate is its
weight; an arrival falls on one of ``REGISTERS`` registers, which keep their earliest one. An
element stops once its next arrival would come after every register's, so long texts end early.
Two texts hold the same element in a register with the probability Jaccard of their weights,
which for plain sets is the Jaccard similarity. Registers are grouped into ``BANDS`` bands; texts
that share a band are candidates, and the exact probability Jaccard verifies each link.

Equal texts are one node (their least id). A bucket (texts of one band value) is never expanded
into pairs. The bands are taken a few at a time (``GROUPS``): in each bucket that holds several classes, the
members of other classes than its centre's (the member of least id) are held against the centre, and
what is alike becomes one class before the next bands are read. So a large family settles around its first text, and
its later buckets hold one class and cost nothing. Buckets of three and more members that still hold several classes
after all bands go on with more and more centres a round (``WIDTH``, and its square times as many each time) until each is done or all its members have been
centres. Crowded ones are dealt anew first, into buckets by rare shingles: in any order of all shingles,
two texts that are alike have their first common shingle where at least ``similarity`` of either
text's weight is still to come, so each text enters the buckets of its shingles up to there, in
order of (counted) frequency, and no link is lost. There a pair is only held together where what either has
before that shingle leaves room for its similarity. Classes are kept up to date from each round's new links alone.

Null text counts as empty; texts without words are only alike if equal. Rows that share an id are
one document, in the class of any of its texts; a null id has no class (null) and no links. Columns
the operator adds replace those of the same name; others pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import drop, mix, pair_hash, release, slices, small_batches, text_bytes, word_hashes, words_of, written

#: Six registers a band: of pairs at 0.8, 6 in 100,000 share none of the 32 bands; of pairs at 0.4, 7 in 8 share none.
REGISTERS, BANDS = 192, 32
#: Bands taken at a time; a bucket of more members than ``CROWD`` that is still mixed after all of them is dealt anew by rare shingles.
GROUPS, CROWD, WIDTH = (1, 7, 24), 16, 16
#: Counters of shingles' frequencies; shingles that share one only come later in the order.
SLOTS = 1 << 20
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def elements(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number (ascending), hash (ascending within), weight."""
    data, bounds = text_bytes(column)
    starts, stops, first = words_of(data, bounds, _IS_WORD)
    hashes = word_hashes(data, starts, stops)
    n = np.diff(first)
    per = np.where(n == 0, 0, np.maximum(1, n - shingle + 1))
    text = np.repeat(np.arange(len(n)), per)
    start = np.repeat(first[:-1] - np.cumsum(per) + per, per) + np.arange(per.sum())
    length = np.minimum(shingle, n[text])
    name = mix(length.astype(np.uint64))
    for j in range(shingle):
        if (length > j).all():
            name = mix(name * np.uint64(3) + hashes[start + j])
        else:
            on = length > j
            name[on] = mix(name[on] * np.uint64(3) + hashes[start[on] + j])
    order = np.lexsort((name, text))
    text, name = text[order], name[order]
    fresh = np.flatnonzero(np.concatenate(([True], (name[1:] != name[:-1]) | (text[1:] != text[:-1])))) if len(text) else order
    return text[fresh], name[fresh], np.diff(np.append(fresh, len(text))).astype(float)


def signatures(text: np.ndarray, name: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Element kept by each register of each of ``n`` texts (0 for texts without elements)."""
    earliest = np.full((n, REGISTERS), np.inf)
    kept = np.zeros((n, REGISTERS), np.uint64)
    time, active, arrival = np.zeros(len(text)), np.arange(len(text)), 0
    while len(active):
        e, t = name[active], text[active]
        draw = mix(e + np.uint64((0x9E3779B97F4A7C15 * (2 * arrival + 1)) % 2**64))
        time[active] -= np.log(((draw >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / weight[active]
        on = time[active] < earliest.max(axis=1)[t]
        active, e, t, draw = active[on], e[on], t[on], draw[on]
        register = (mix(draw ^ np.uint64(0x6A09E667F3BCC909)) % np.uint64(REGISTERS)).astype(np.int64)
        cell, at = t * REGISTERS + register, time[active]
        flat, who = earliest.ravel(), kept.ravel()
        np.minimum.at(flat, cell, at)
        won = at == flat[cell]
        who[cell[won]] = e[won]
        arrival += 1
    return kept


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Exact: the sum over common elements d of 1 / sum over all d' of max(wa'/wa_d, wb'/wb_d)."""
    if not len(a) or not len(b):
        return 0.0
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if (wa == 1).all() and (wb == 1).all():
        return len(common) / (len(a) + len(b) - len(common))
    x, y = wa[i], wb[j]
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    only_a = wa.sum() - x.sum()  # their ratio is infinite; those only in b have ratio 0
    only_b = wb.sum() - y.sum()
    values = ratio[order]
    below = np.searchsorted(values, ratio, side="left")  # elements of a smaller ratio count by their weight in b
    in_b = np.concatenate(([0.0], np.cumsum(y[order])))[below] + only_b
    in_a = x.sum() - np.concatenate(([0.0], np.cumsum(x[order])))[below] + only_a
    return float((1.0 / (in_a / x + in_b / y)).sum())


def _sign(batch: pa.RecordBatch, shingle: int) -> pa.RecordBatch:
    column, n = batch.column("text"), batch.num_rows
    data, bounds = text_bytes(column)
    kept = signatures(*elements(column, shingle), n)
    rows = REGISTERS // BANDS
    band = np.zeros((n, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(rows):
        band = pair_hash(band, kept[:, j::rows], j)
    some = (kept != 0).any(axis=1)
    size = np.where(some, BANDS, 0)
    bands = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(band[some].ravel().view(np.int64)))
    same = word_hashes(data, bounds[:-1], bounds[1:])
    return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(same.view(np.int64)), pa.array(np.diff(bounds)), bands], ["id", "same", "size", "bands"])


def _verified(batch: pa.RecordBatch, shingle: int, least: float) -> pa.RecordBatch:
    sides = []
    for side in ("text_a", "text_c"):
        text, name, weight = elements(batch.column(side), shingle)
        sides.append((name, weight, np.searchsorted(text, np.arange(batch.num_rows + 1))))
    (na, wa, ea), (nc, wc, ec) = sides
    alike = np.array([probability_jaccard(na[ea[k]:ea[k + 1]], wa[ea[k]:ea[k + 1]], nc[ec[k]:ec[k + 1]], wc[ec[k]:ec[k + 1]]) for k in range(batch.num_rows)])
    return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("c"), pa.array(alike, pa.float64())], ["a", "c", "similarity"]).filter(pa.array(alike >= least))


def _counts(batches, shingle: int):
    """(slot, n): shingles of the texts, counted by hash."""
    n = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            n += np.bincount((elements(part.column("text"), shingle)[1] % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
    slot = np.flatnonzero(n)
    for k in range(0, len(slot), 1 << 16):
        some = slot[k:k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some])], ["slot", "n"])


def rare_shingles(column: pa.Array, shingle: int, least: float, frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, before, rest) of every shingle from which on, by frequency, at least ``least`` of its text's weight
    is to come. The weights' common part bounds the probability Jaccard in either text, so texts that
    are alike have one of these in common. Shingles counted once are left out. ``before`` and
    ``rest``: the weight before the shingle and from it on (negative where the text repeats shingles), for ``possible``."""
    text, name, weight = elements(column, shingle)
    often = frequency[(name % np.uint64(SLOTS)).astype(np.int64)]
    order = np.lexsort((name, often, text))
    text, name, weight, often = text[order], name[order], weight[order], often[order]
    total = np.bincount(text, weight, len(column))
    before = np.cumsum(weight) - weight - (np.cumsum(total) - total)[text]
    on = (total[text] - before >= least * total[text] * (1 - 1e-9)) & (often > 1)
    repeats = np.bincount(text, weight > 1, len(column)) > 0
    return text[on], name[on], before[on], np.where(repeats[text[on]], -1, 1) * (total[text[on]] - before[on])


def _rare(batch: pa.RecordBatch, shingle: int, least: float, frequency: np.ndarray) -> pa.RecordBatch:
    text, name, before, rest = rare_shingles(batch.column("text"), shingle, least, frequency)
    return pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(text)), pa.array(name.view(np.int64)), pa.array(before), pa.array(rest)], ["node", "bucket", "before", "rest"])


def _rare_buckets(texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """(node, bucket, before, rest): the buckets by rare shingles of ``texts`` (id, text) that hold more than one node."""
    counted = texts.mapInArrow(lambda batches: _counts(batches, shingle), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(SLOTS, np.uint16)
    frequency[counted.column("slot").to_numpy()] = np.minimum(counted.column("n").to_numpy(), 2**16 - 1)
    rare = written(_mapped(texts, "node long, bucket long, before double, rest double", "text", lambda b: _rare(b, shingle, least, frequency))
                   .groupBy("node", "bucket").agg(*(F.when(F.count("*") == 1, F.min(c)).alias(c) for c in ROOM)), "minhash-rare")  # null: an id of several texts
    return rare.join(rare.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"), "bucket")


def _mapped(df: DataFrame, schema: str, by: str, work) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, by):
                yield work(part)

    return df.mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node connected with each node of ``links`` (a, c), by
    neighbours' least label and label's label in turn until nothing changes."""
    both = written(links.select("a", "c").union(links.select(F.col("c"), F.col("a"))).distinct(), "minhash-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("c").alias("m")).select("node", F.least("node", "m").alias("label")), "minhash-labels")
    while True:
        near = both.join(labels, both.c == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(step.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "minhash-labels")
        changed = new.filter("label <> old").limit(1).count()
        drop(links.sparkSession, labels)
        labels = new
        if not changed:
            drop(links.sparkSession, both)
            return labels.select("node", "label")


class Classes:
    """Classes of nodes so far: ``labels`` (node, label) of those with a link, all ``links`` (a, c, similarity), and
    the ``pool`` of texts (id, text) that pairs have asked for."""

    def __init__(self, texts: DataFrame, unique: bool, shingle: int, similarity: float):
        self.texts, self.unique, self.shingle, self.similarity = texts, unique, shingle, similarity
        self.spark, self.labels, self.links, self.pool = texts.sparkSession, None, None, None

    def labelled(self, rows: DataFrame, node: str = "node", out: str = "label") -> DataFrame:
        if self.labels is None:
            return rows.withColumn(out, F.col(node))
        labels = self.labels.select(F.col("node").alias(node), F.col("label").alias("_of"))
        return rows.join(labels, node, "left").withColumn(out, F.coalesce("_of", node)).drop("_of")

    def _fetch(self, pairs: DataFrame) -> None:
        """Adds the texts of ``pairs`` to the pool."""
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select("c")).distinct()
        if self.pool is not None:
            ends = ends.join(self.pool.select("id"), "id", "left_anti")
        part = self.texts.join(ends, "id", "left_semi")
        if not self.unique:
            part = part.withColumn("k", F.xxhash64("text")).dropDuplicates(["id", "k"]).drop("k")
        part = written(part, "minhash-texts")
        self.pool = part if self.pool is None else self.pool.union(part)

    def compare(self, pairs: DataFrame) -> None:
        """Verifies distinct ``pairs`` (a, c) of nodes of different classes, and unites the classes of those that are alike."""
        pairs = written(pairs, "minhash-pairs")
        if not pairs.limit(1).count():
            return
        self._fetch(pairs)
        shingle, similarity = self.shingle, self.similarity
        both = pairs.join(self.pool.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a") \
                    .join(self.pool.select(F.col("id").alias("c"), F.col("text").alias("text_c")), "c")
        found = written(_mapped(both, "a long, c long, similarity double", "text_a", lambda b: _verified(b, shingle, similarity)), "minhash-links")
        drop(self.spark, pairs)
        if found.limit(1).count():
            self.links = found if self.links is None else self.links.union(found)
            self._unite(found)

    def _unite(self, found: DataFrame) -> None:
        ends = found.select(F.col("a").alias("node")).union(found.select("c")).distinct()
        known = self.labelled(ends) if self.labels is None else self.labels.unionByName(ends.join(self.labels, "node", "left_anti").withColumn("label", F.col("node")))
        between = self.labelled(self.labelled(found.select("a", "c"), "a", "x"), "c", "y").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("c"))
        united = components(between).select(F.col("node").alias("label"), F.col("label").alias("new"))
        labels = written(known.join(united, "label", "left").select("node", F.coalesce("new", "label").alias("label")), "minhash-classes")
        if self.labels is not None:
            drop(self.spark, self.labels)
        self.labels = labels


#: What a text has before and from a rare shingle on; null in buckets by bands.
ROOM = ("before", "rest")


def possible(a: str, b: str, similarity: float):
    """Whether two texts, whose first common shingle is that of the bucket they meet in, can be alike: all weight before is in one of them
    only. For plain sets at most the lesser rest is common. With weights, each common shingle's part of the probability
    Jaccard is at most 1 / (before_a / x + before_b / y + max(rest_a / x, rest_b / y)), and as that is concave and homogeneous in its
    weights x and y, the parts' sum is at most its value at the two rests."""
    ba, bb, ra, rb = (F.col(f"{t}.{c}") for c in ROOM for t in (a, b))
    sets = F.least(ra, rb) >= similarity * (1 - 1e-9) * (ba + bb + F.greatest(ra, rb))
    weights = 1 + ba / F.abs(ra) + bb / F.abs(rb) <= 1 / similarity + 1e-9
    return F.coalesce(F.when((ra > 0) & (rb > 0), sets).otherwise(weights), F.lit(True))


def _centre() -> list:
    return [F.min("node").alias("c"), F.min_by("label", "node").alias("c_label"), *(F.min_by(c, "node").alias(c) for c in ROOM)]


def _mixed(rows: DataFrame) -> DataFrame:
    """(bucket, n, c, c_label, before, rest) of the buckets of ``rows`` (node, bucket, before, rest, label) that hold several classes, ``c`` their member of least id."""
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), *_centre()).filter("low < high").drop("low", "high")


def _against(rows: DataFrame, centres: DataFrame, similarity: float) -> DataFrame:
    """Distinct (a, c) of each node and the ``centres`` (bucket, c, c_label, before, rest) of its buckets that are of
    another class and that it can be alike with."""
    r, m = rows.alias("r"), centres.alias("m")
    held = r.join(m, (F.col("r.bucket") == F.col("m.bucket")) & (F.col("r.label") != F.col("m.c_label"))
                  & possible("r", "m", similarity))
    return held.select(F.least("r.node", "m.c").alias("a"), F.greatest("r.node", "m.c").alias("c")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row (doc_id, class_id, n_links) per row of ``docs``: the least id of its class, and how many other
    distinct texts its text was linked with (every link that was needed to settle the classes)."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null")
    signed = written(_mapped(texts, "id long, same long, size long, bands array<long>", "text", lambda b: _sign(b, shingle)), "minhash-signed")
    nodes = written(signed.groupBy("same", "size").agg(F.min("id").alias("node")), "minhash-nodes")

    group = F.element_at(F.array(*(F.lit(g) for g, n in enumerate(GROUPS) for _ in range(n))), F.col("band") + 1)
    banded = written(signed.join(nodes.select(F.col("node").alias("id"), "same", "size"), ["id", "same", "size"], "left_semi")
                     .select(F.col("id").alias("node"), F.posexplode("bands").alias("band", "bucket")).select("node", "bucket", group.alias("turn")), "minhash-bands", by="turn")
    any_room = [F.lit(None).cast("double").alias(c) for c in ROOM]
    unique = signed.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count() == 0
    classes = Classes(texts, unique, shingle, similarity)
    for turn in range(len(GROUPS)):
        rows = classes.labelled(banded.filter(F.col("turn") == turn).select("node", "bucket", *any_room))
        classes.compare(_against(rows, _mixed(rows), similarity))

    # what is still mixed, and more than one pair
    rows = classes.labelled(banded.select("node", "bucket", *any_room))
    left = written(rows.join(_mixed(rows).filter("n > 2").select("bucket", "n"), "bucket").select("node", "bucket", "n"), "minhash-left")
    release(spark, banded)
    crowded = written(left.filter(F.col("n") > CROWD).select("node").distinct(), "minhash-crowded")
    open_ = left.filter(F.col("n") <= CROWD).select("node", "bucket", *any_room)
    if crowded.limit(1).count():
        of_them = written(texts.join(crowded.select(F.col("node").alias("id")), "id", "left_semi"), "minhash-crowded-texts")
        open_ = open_.unionByName(_rare_buckets(of_them, shingle, similarity).select("node", "bucket", *ROOM))
    open_, width = written(open_.distinct(), "minhash-open"), WIDTH
    while True:
        rows = classes.labelled(open_)
        still = _mixed(rows).select("bucket")
        rows = written(rows.join(still, "bucket"), "minhash-mixed")
        if not rows.limit(1).count():
            drop(spark, rows)
            break
        centres = rows.groupBy("bucket", F.pmod(F.xxhash64("node", F.lit(width)), F.lit(width)).alias("k")).agg(*_centre())
        centres = written(centres.drop("k"), "minhash-centres")
        classes.compare(_against(rows, centres, similarity))
        # a centre has met all of its bucket
        new = written(rows.select("node", "bucket", *ROOM).join(centres.select("bucket", F.col("c").alias("node")), ["bucket", "node"], "left_anti"), "minhash-open")
        drop(spark, open_, rows, centres)
        open_, width = new, width * WIDTH**2
    drop(spark, open_)
    release(spark, left)
    labels, links = classes.labels, classes.links

    node_of = signed.join(nodes, ["same", "size"]).select("id", "node").distinct()
    if labels is None:
        settled = node_of.select("id", F.col("node").alias("label"), F.lit(0).cast("long").alias("n_links"))
    else:
        count = links.select("a", "c").union(links.select("c", "a")).distinct().groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n_links"))
        settled = node_of.join(labels, "node", "left").join(count, "node", "left") \
            .select("id", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    settled = settled.groupBy("id").agg(F.min("label").alias("class_id"), F.sum("n_links").alias("n_links"))
    return docs.select(F.col(doc_id).alias("doc_id")).join(settled, F.col("doc_id").cast("long") == F.col("id"), "left") \
        .select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with the document of the least id of each class (and rows without an id)."""
    dropped = near_duplicates(docs, doc_id=doc_id, **options).filter("class_id < doc_id").select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(dropped, doc_id, "left_anti").select(*docs.columns)
