"""Quality rules judged by host (operator 13), in DataFrame functions only.

Every text is measured (words, symbols, copied lines, words in repeated 3-word windows) and held against
``RULES``. Failures are added up by host, rule by rule. A host's own rate of failure is shrunk towards the other
hosts' by a beta prior fitted to all hosts' rates (method of moments, every host weighing the same, the
binomial noise of small hosts taken off): (failures + a) / (documents + a + b). So two bad pages do not
condemn a small host, and thousands do. A host fails where a shrunk rate reaches ``HOST_LIMIT``. Its verdict is joined back:
a document is kept if neither its own text fails the base rules nor its host fails.

The measures are written once (a few numbers a document; texts are not shuffled). Hosts are summed up in the
tasks before they are shuffled, and only failing hosts are joined back, by a join that Spark splits where one
host is large. The driver sees one row: the prior.

Repeated windows are found in one sort of a text's window hashes (96 bits). Null and empty texts have no words and
fail the base rules. Texts of any length are measured whole. A document without a host (null) is judged by its
text alone and counts for no host. Rows count as often as they occur, so do ids. An empty table gives
an empty table. Columns of the input with the name of a result column are not read (but for id, text and host).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small_reads, written

SYMBOLS = "#*$%&|<>"
#: A document fails a rule where this holds for its measures; base rules reject the document itself.
RULES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "few_words": lambda m: m("n_words") < 50,
    "repeated_words": lambda m: m("n_repeat_words") * 100 > m("n_words") * 50,
    "symbols": lambda m: m("n_symbols") * 10 > m("n_words"),
    "copied_lines": lambda m: m("n_dup_lines") * 10 > m("n_lines") * 3,
    "word_length": lambda m: (m("word_chars") < m("n_words") * 3) | (m("word_chars") > m("n_words") * 10),
}
BASE = ("few_words", "repeated_words")
#: Shrunk rate of failing documents from which a host fails.
HOST_LIMIT = 0.5
#: The prior weighs as much as this many documents at least and at most.
LEAST_WEIGHT, MOST_WEIGHT = 10.0, 10_000.0


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row (as the only element of an array)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that stand in a 3-word window which the text holds twice or more."""
    windows = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))), lambda i: F.struct(
        F.xxhash64(*(F.get(words, i + j) for j in range(3))).alias("h"), F.hash(*(F.get(words, i + j) for j in range(3))).alias("g"), i.alias("p")))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (a["g"] == b["g"]), F.lit(False))

    def covered(places: Column) -> Column:  # a window's words up to the next one's
        return F.aggregate(F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3)))), F.lit(0), lambda n, x: n + x)

    def repeats(sorted_: Column) -> Column:
        again = F.filter(sorted_, lambda x, j: same(x, F.get(sorted_, j - 1)) | same(x, F.get(sorted_, j + 1)))
        return _let(F.sort_array(F.transform(again, lambda x: x["p"])), covered)

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(F.sort_array(windows), repeats))


def measures(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    plain = F.translate(text, "\t\n\x0b\x0c\r", " " * 5)
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = _let(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again")))
    told = _let(lines, lambda rows: F.struct(F.size(rows).alias("n"), (F.size(rows) - F.size(F.array_distinct(rows))).alias("again")))
    return {
        "n_words": counted["n"], "n_repeat_words": counted["again"], "word_chars": F.length(F.translate(plain, " ", "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")), "n_lines": told["n"], "n_dup_lines": told["again"],
    }


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(doc_id, host, the measures as long, and a boolean ``fails_<rule>`` for each rule) of every row."""
    found = measures(F.col(text))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), F.struct(*(c.alias(n) for n, c in found.items())).alias("m"))
    return base.select("doc_id", "host", *(F.col(f"m.{n}").cast("long").alias(n) for n in found)) \
        .withColumns({f"fails_{rule}": holds(F.col) for rule, holds in RULES.items()})


def beta_prior(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """(a, b) of each rule's prior, from ``hosts`` (n, and ``f_<rule>``): one aggregate to one row."""
    rate = {rule: F.col(f"f_{rule}") / F.col("n") for rule in RULES}
    row = hosts.agg(F.count("*").alias("k"), F.sum(1 / F.col("n")).alias("noise"), *(F.avg(r).alias(f"m_{n}") for n, r in rate.items()),
                    *(F.var_pop(r).alias(f"v_{n}") for n, r in rate.items())).first()
    prior = {}
    for rule in RULES:
        mean, spread, k = row[f"m_{rule}"] or 0.0, row[f"v_{rule}"] or 0.0, row["k"]
        weight = MOST_WEIGHT
        if k > 1 and 0 < mean < 1:
            noise, all_ = (k - 1) / k * row["noise"] / k, (k - 1) / k
            apart = spread / (mean * (1 - mean)) - noise  # beyond what chance makes of equal hosts
            if all_ > noise and apart > 0:
                weight = (all_ - noise) / apart - 1
        weight = min(max(weight, LEAST_WEIGHT), MOST_WEIGHT)
        prior[rule] = (mean * weight, (1 - mean) * weight)
    return prior


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``host``, the measures, ``failed`` (its failed rules), ``base_failed``, ``host_failed``
    (the rules its host fails; empty for a sound host), ``kept``."""
    small_reads(docs.sparkSession)
    rows = written(measured(docs, doc_id, text, host), "host-measures")
    hosts = written(rows.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n"), *(F.sum(F.col(f"fails_{rule}").cast("long")).alias(f"f_{rule}") for rule in RULES)), "host-sums")
    prior = beta_prior(hosts)
    shrunk = {rule: F.round((F.col(f"f_{rule}") + a) / (F.col("n") + a + b), 9) for rule, (a, b) in prior.items()}
    named = F.array_compact(F.array(*(F.when(r >= limit, F.lit(rule)) for rule, r in shrunk.items())))
    bad = hosts.select("host", named.alias("host_failed")).filter(F.size("host_failed") > 0)
    base = F.lit(False)
    for rule in BASE:
        base = base | F.col(f"fails_{rule}")
    failed = F.array_compact(F.array(*(F.when(F.col(f"fails_{rule}"), F.lit(rule)) for rule in RULES)))
    return rows.join(bad, "host", "left").select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", failed.alias("failed"),
        base.alias("base_failed"), F.coalesce("host_failed", F.array().cast("array<string>")).alias("host_failed"),
        (~base & F.col("host_failed").isNull()).alias("kept"))
