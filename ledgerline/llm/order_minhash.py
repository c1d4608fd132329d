"""Document fingerprints by Order MinHash (operator 2), in DataFrame functions only.

A text's k-mers are runs of ``KMER`` words (all its words if it has fewer); a k-mer's hash takes
in how often it has occurred before. Each of ``SKETCHES`` sketches has its own order of the
hashes: upwards from its point of the hash ring. It selects the ``PAIR`` = 2 least k-mers of that
order, puts them back into text order and hashes the tuple, so that a sketch stays the same only
if both k-mers and their order do. The likeness of two fingerprints is their share of equal
sketches. One sort per text serves all sketches, and nothing but the text is shuffled.

Null text counts as empty. A text without words has an empty fingerprint, which is like another
empty one (1.0) and unlike any other (0.0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import release, sha, written

KMER, SKETCHES = 3, 64
LAST = 2**63 - 1  # stands for a null id


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row (as the only element of an array)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _kmers(words: Column) -> Column:
    n = F.size(words)
    return (F.when(n == 0, F.array().cast("array<bigint>"))
            .when(n < KMER, F.array(F.xxhash64(F.concat_ws(" ", words), n)))
            .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - KMER, F.lit(0))),
                                   lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(KMER))))))


def _occurrences(again: Column) -> Column:
    """Of entries sorted by hash: how many with the same hash stand before each, by a maximum
    scan (of the entries' group starts) in doubling steps."""
    starts = F.transform(again, lambda x, j: F.when((j == 0) | (F.get(again, j - 1)["h"] != x["h"]), j).otherwise(F.lit(0)))
    doublings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(again) + 1)).cast("int"))
    scanned = F.aggregate(doublings, starts, lambda acc, t: F.transform(
        acc, lambda x, j: F.when(j >= F.pow(F.lit(2), t), F.greatest(x, F.get(acc, j - F.pow(F.lit(2), t).cast("int")))).otherwise(x)))
    return _let(scanned, lambda s: F.transform(again, lambda x, j: F.struct(
        F.xxhash64(x["h"], j - F.get(s, j) + 1).alias("h"), x["p"].alias("p"))))


def _ring(kmers: Column) -> Column:
    """The k-mers' (hash, place) with occurrence numbers hashed in, sorted by hash."""
    entries = F.sort_array(F.transform(kmers, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))

    def numbered(s: Column) -> Column:
        repeated = lambda x, j: (j > 0) & (F.get(s, j - 1)["h"] == x["h"])
        return _let(F.filter(s, repeated), lambda again: F.when(F.size(again) == 0, s).otherwise(
            F.sort_array(F.concat(F.filter(s, lambda x, j: ~repeated(x, j)), _occurrences(again)))))

    return _let(entries, numbered)


def _sketches(ring: Column) -> Column:
    n = F.size(ring)
    steps = F.transform(F.sequence(F.ceil(F.log2(n + 1)).cast("int"), F.lit(0), F.lit(-1)), lambda t: F.pow(F.lit(2), t).cast("int"))

    def sketch(steps: Column, point: Column) -> Column:
        # entries below the sketch's point, by binary search; the next two of the ring are its least ones
        below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
            (at + step <= n) & (F.get(ring, at + step - 1)["h"] < point), at + step).otherwise(at))

        def pair(at: Column) -> Column:
            one, two = F.get(ring, at % n), F.get(ring, (at + 1) % n)
            return F.when(one["p"] <= two["p"], F.xxhash64(one["h"], two["h"])).otherwise(F.xxhash64(two["h"], one["h"]))

        return _let(below, pair).bitwiseAND(0xFFFF).cast("int")

    points = F.array(*(F.lit(-2**63 + k * (2**64 // SKETCHES)) for k in range(SKETCHES)))
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(
        _let(steps, lambda s: F.transform(points, lambda point: sketch(s, point))))


def fingerprint(text: Column) -> Column:
    """The text's ``SKETCHES`` sketch values (0 to 65535); an empty array without words."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return _let(words, lambda w: _let(_kmers(w), lambda k: _let(_ring(k), _sketches)))


def likeness(one: Column, two: Column) -> Column:
    """Share of equal sketches of two fingerprints."""
    same = F.aggregate(F.zip_with(one, two, lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    return F.when((F.size(one) == 0) & (F.size(two) == 0), 1.0).when((F.size(one) == 0) | (F.size(two) == 0), 0.0).otherwise(same / SKETCHES)


def as_text(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: F.lpad(F.lower(F.hex(x)), 4, "0")), "")


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with ``out``, each text's fingerprint in hexadecimal (replacing a column of that name)."""
    return df.withColumn(out, as_text(fingerprint(F.col(text))))


def successors(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, next_id, half): each distinct id, the next one (after the last the first), and half its text's
    length. Ranges of ids are numbered by their first id, so no task sees all of them."""
    ids = docs.groupBy(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id")).agg(F.max(F.coalesce(F.length(text), F.lit(0))).alias("n"))
    ranged = written(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "order-ids")
    heads = ranged.groupBy("part").agg(F.min("id").alias("head"))
    turn = Window.orderBy("part")  # one row a range
    heads = heads.select("part", F.coalesce(F.lead("head").over(turn), F.min("head").over(Window.partitionBy())).alias("next_head"))
    within = ranged.withColumn("follows", F.lead("id").over(Window.partitionBy("part").orderBy("id")))
    return within.join(heads, "part").select("id", F.coalesce("follows", "next_head").alias("next_id"), F.floor(F.col("n") / 2).cast("int").alias("half"))


def edit_sensitivity(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_chars``, ``fingerprint`` of its text, ``edited_sha256`` and
    ``edited_fingerprint`` of its text with the last half replaced by the start of the next document's (next id;
    after the last the first; of rows sharing an id the least text), and the likeness of its fingerprint to the
    edited text's (``near_edited``) and to the next document's (``near_next``). A null id comes last."""
    spark = docs.sparkSession
    # both joins below read this very frame by id, so its texts are shuffled once
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    follow = written(successors(docs, doc_id, text), "order-next")
    unique = texts.groupBy("id").count().filter("count > 1").limit(1).count() == 0
    ahead = texts.join(follow.select(F.col("next_id").alias("id"), F.col("id").alias("key"), "half"), "id") \
        .select(F.col("key").alias("id"), F.expr("substring(text, 1, half)").alias("ahead"))
    if not unique:
        ahead = ahead.groupBy("id").agg(F.min("ahead").alias("ahead"))
    n = F.length("text")
    edited = texts.join(ahead, "id").select(
        "id", n.cast("long").alias("n_chars"), fingerprint(F.col("text")).alias("own"),
        F.concat(F.col("text").substr(F.lit(1), n - F.floor(n / 2).cast("int")), F.expr("substring(ahead, 1, length(text) div 2)")).alias("edited"))
    marked = written(edited.select("id", "n_chars", "own", sha("edited").alias("edited_sha256"), fingerprint(F.col("edited")).alias("other")), "order-marked")
    release(spark)
    next_own = marked.select(F.col("id").alias("next_id"), F.col("own").alias("next_own"))
    if not unique:
        next_own = next_own.groupBy("next_id").agg(F.min("next_own").alias("next_own"))
    return marked.join(follow.select("id", "next_id"), "id").join(next_own, "next_id").select(
        F.when(F.col("id") < LAST, F.col("id")).cast(docs.schema[doc_id].dataType).alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"))
