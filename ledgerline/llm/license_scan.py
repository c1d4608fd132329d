"""License scans (operator 1), in DataFrame and SQL functions and Spark's DataFrame-based logistic regression.

A text is judged in units: a line of at most ``WINDOW`` words that contains a template's segment is a unit of its
own; the words of all other lines, line breaks aside, are read in windows of ``WINDOW`` words, ``STEP`` apart. So a
notice is found whether it is a line, wrapped over lines, or part of a long line, and what surrounds it does not
matter. Templates are cut into segments of at most ``SEGMENT`` words, each of which lies whole in some window.

A unit's features are the word 1- and 2-grams it shares with any template. A multinomial logistic regression with
elastic net (so most weights are nought) learns the families from the segments, alone, with every fifth word left
out and between ordinary words, and an unknown class from all units of the table that are compared with templates (see
below) but contain no segment. Half of them are held out to calibrate the unknown class: a family needs a probability
against it above all but one in a thousand of the table's units reach, where units that are not compared reach
none, and at least 0.5. Template comparison must confirm it: the unit contains ``CONFIRMED`` or
more of the distinct 2-grams of one of the family's segments, ``LEAST_PAIRS`` at least, and of no other family's
segment a higher share (so families that share wording are told apart; two notices contained alike both count).
Where families have a segment in common, it confirms the likeliest of them.

The scan scores every unit by the regression, also those that no template can confirm: a unit is a row, which
``CountVectorizer`` and the model turn into its scores. So a text's units that read like a licence notice which no template holds
are counted too (``n_unconfirmed``). Only the comparison, which a unit with fewer than ``LEAST_PAIRS`` 2-grams of templates
cannot pass, is made of the others alone.

Null or empty texts have no paragraphs and no licence. Very long texts are read whole; the windows cost time in
proportion to their words, in one task a row. Of families with equal share and
probability the earlier in ``TEMPLATES`` is taken. Overlapping windows of one family are one finding, at the
first. Repeated rows are scanned row by row. Only the id and the text are read, so clashing names do no harm. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import release, written

#: Least probability; least share and number of a segment's 2-grams.
LEAST, CONFIRMED, LEAST_PAIRS = 0.5, 0.6, 3
#: Words of a window and between the starts of two, so that each run of 17 words lies in one; most words of a segment.
WINDOW, STEP, SEGMENT = 32, 16, 16
UNKNOWN = "unknown"

#: Notices of well-known licences, by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later"],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.", "Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
        "You should have received a copy of the GNU Affero General Public License along with this program."],
    "BSD": [
        "Licensed under the BSD 3-Clause License.", "Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "ISC": [
        "Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "SPDX-License-Identifier: ISC"],
    "CC-BY": [
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "public-domain": [
        "This work is dedicated to the public domain under CC0 1.0 Universal.", "This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: CC0-1.0"],
}
#: Ordinary sentences with licence words, so that the unknown class knows some whatever the table holds.
ORDINARY = [
    "She renewed her driving license last week.", "The software was released in the spring and sold well.", "You may use the copy in the library free of charge.",
    "Version 3 of the program is faster than version 2.", "The work of the public library is open to any person.", "All rights and conditions of the contract were met.",
    "The source of the river lies in the hills.", "A licensed doctor works under the terms of the hospital.", "The Apache helicopter landed near the town.", "MIT is a university in Massachusetts.",
    "Licensed under the Harbour Company License, Version 2.0.", "This work is licensed under an agreement between both parties.",
]


def _words(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _per_pair(words: Column, body) -> Column:
    """``body`` of each two adjacent words."""
    n = F.size(words)
    return F.transform(F.slice(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(1), F.greatest(n - 1, F.lit(0))),
                       lambda i: body(F.get(words, i), F.get(words, i + 1)))


def _grams(words: Column) -> Column:
    return F.array_distinct(F.concat(words, _per_pair(words, lambda a, b: F.concat_ws(" ", a, b))))


def _pairs(words: Column) -> Column:
    """Hashes of adjacent words."""
    return _per_pair(words, lambda a, b: F.xxhash64(a, b))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def segments() -> list[tuple[int, list[str]]]:
    """(family, words) of the templates, cut into even runs of at most ``SEGMENT`` words."""
    out = []
    for k, templates in enumerate(TEMPLATES.values()):
        for words in (re.findall("[a-z0-9]+", t.lower()) for t in templates):
            size = math.ceil(len(words) / math.ceil(len(words) / SEGMENT))
            out += [(k, words[i:i + size]) for i in range(0, len(words), size)]
    return out


class Comparison:
    """How much of the segments a unit contains, as column expressions over hashed 2-grams."""

    def __init__(self, spark: SparkSession):
        rows = spark.createDataFrame(segments(), "k int, words array<string>").select("k", F.array_sort(F.array_distinct(_pairs(F.col("words")))).alias("pairs")).collect()
        self.known = sorted({h for r in rows for h in r.pairs})
        self.words = sorted({w for _, words in segments() for w in words})
        owners = {tuple(r.pairs): sorted({o.k for o in rows if o.pairs == r.pairs}) for r in rows if r.pairs}
        self._segments = F.array(*(F.struct(F.array(*map(F.lit, ks)).alias("k"), F.array(*map(F.lit, pairs)).alias("pairs")) for pairs, ks in owners.items()))

    def is_known(self, pair: Column) -> Column:
        return pair.isin(self.known)

    def best(self, pairs: Column) -> Column:
        """The highest confirmed share of a segment's 2-grams and, of each segment that reaches it, the families; 0 and none without."""
        def share(segment):
            hits = F.size(F.array_intersect(segment["pairs"], pairs))
            return _let(hits, lambda h: F.struct(F.when(h >= LEAST_PAIRS, h / F.size(segment["pairs"])).otherwise(0.0).alias("share"), segment["k"].alias("k")))

        def top(shares):
            return _let(F.array_max(shares)["share"], lambda t: F.struct(
                F.when(t >= CONFIRMED, t).otherwise(0.0).alias("share"),
                F.array_distinct(F.transform(F.filter(shares, lambda s: (t >= CONFIRMED) & (s["share"] == t)), lambda s: s["k"])).alias("families")))
        return _let(F.transform(self._segments, share), top)

    def units(self, lines: Column, every: bool = False) -> Column:
        """Units of a text's lines (word arrays) that may hold a notice: structs of place (line of the first word),
        window (number; -1 for a line) and words; with ``every`` also those that cannot, which have no words, and of each
        the ``grams`` it shares with templates."""
        def contains(words):
            pairs = F.filter(_pairs(words), self.is_known)
            return (F.size(words) <= WINDOW) & _let(pairs, lambda p: (F.size(p) >= LEAST_PAIRS) & (F.when(F.size(p) >= LEAST_PAIRS, self.best(p)["share"]) > 0))

        def pair_known(flat, i):
            return self.is_known(F.xxhash64(F.get(flat, i)["word"], F.get(flat, i + 1)["word"]))

        def unit(place, window, words, grams):
            return F.struct(place.alias("place"), window.alias("window"), words.alias("words"), *([grams.alias("grams")] if every else []))

        def windows(flat):
            if not every:
                return compared_and_others(flat, None)
            # the grams of templates at their places, which a window has between its ends
            known = F.struct(F.transform(flat, lambda w: F.when(w["word"].isin(self.words), w["word"])).alias("words"),
                             F.transform(flat, lambda w, i: F.when(pair_known(flat, i), F.concat_ws(" ", w["word"], F.get(flat, i + 1)["word"]))).alias("pairs"))
            return _let(known, lambda at: compared_and_others(flat, at))

        def compared_and_others(flat, grams):
            def of(numbers, compared):
                def window(k):
                    first = (k * STEP + 1).cast("int")
                    words = F.transform(F.slice(flat, first, F.lit(WINDOW)), lambda w: w["word"]) if compared else F.lit(None).cast("array<string>")
                    return unit(F.get(flat, (k * STEP).cast("int"))["place"], k, words, F.array_except(
                        F.concat(F.slice(grams["words"], first, F.lit(WINDOW)), F.slice(grams["pairs"], first, F.lit(WINDOW - 1))), F.array(F.lit(None).cast("string"))) if every else None)
                return F.transform(numbers, window)

            def all_of(numbers):
                last = F.floor((F.size(flat) - 1) / STEP).cast("int")
                others = F.array_except(F.when(F.size(flat) > 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>")), numbers)
                return F.concat(of(numbers, True), of(others, False)) if every else of(numbers, True)

            places = F.sequence(F.lit(0), F.greatest(F.size(flat) - 2, F.lit(0)))
            known = F.filter(places, lambda i: F.get(grams["pairs"], i).isNotNull() if every else pair_known(flat, i))
            return _let(known, lambda at: _let(
                F.array_distinct(F.flatten(F.transform(at, lambda i, j: _around(i, F.get(at, j + (LEAST_PAIRS - 1)))))), all_of))

        def both(judged):
            alone = F.transform(F.filter(judged, lambda x: x["alone"]), lambda x: unit(x["place"], F.lit(-1), x["words"], _grams(x["words"]) if every else None))
            # the place of a line that is a unit of its own holds one empty word, which no 2-gram matches
            flat = F.flatten(F.transform(judged, lambda x: F.transform(
                F.when(x["alone"], F.array(F.lit(""))).otherwise(x["words"]), lambda w: F.struct(x["place"].alias("place"), w.alias("word")))))
            return F.concat(alone, _let(flat, windows))

        judged = F.transform(lines, lambda words, i: F.struct(i.alias("place"), F.coalesce(contains(words), F.lit(False)).alias("alone"), words.alias("words")))
        return _let(judged, both)


def _around(first: Column, last: Column) -> Column:
    """Numbers of the windows that hold the 2-grams at ``first`` and ``last`` (none if null)."""
    k = F.floor(first / STEP).cast("int")
    return F.filter(F.array(k - 1, k), lambda w: (w >= 0) & F.coalesce(last + 1 < w * STEP + WINDOW, F.lit(False)))


@dataclass
class Scanner:
    families: list[str]  # class k's name; the last is the unknown class
    weights: list[tuple]  # (gram, its weights by class)
    intercepts: list[float]
    least: float
    units: int = 0  # of the table that taught and calibrated the unknown class
    vectors: object = None  # the fitted models
    model: object = None

    def table(self, spark: SparkSession) -> DataFrame:
        fields = ", ".join(["gram string", *(f"w{k} double" for k in range(len(self.families)))])
        return spark.createDataFrame(self.weights, fields)


def _lines(text: Column) -> Column:
    """The lines of a text that are not blank, as word arrays."""
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: F.trim(p) != ""), _words)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Scanner:
    spark = docs.sparkSession
    families = [*TEMPLATES, UNKNOWN]
    comparison = Comparison(spark)
    shown = spark.createDataFrame(segments(), "label int, words array<string>")
    vocabulary = [r.gram for r in shown.select(F.explode(_grams(F.col("words"))).alias("gram")).distinct().collect()]
    without_fifth = lambda k: F.filter("words", lambda w, i: i % 5 != k)
    beside = [F.array(*map(F.lit, re.findall("[a-z0-9]+", t.lower()))) for t in ORDINARY]
    variants = [F.col("words"), *map(without_fifth, range(5)), *(F.concat(w, F.array(F.lit("")), F.col("words")) for w in beside)]
    taught = shown.select("label", F.explode(F.array(*variants)).alias("words"))

    ordinary = spark.createDataFrame([(t,) for t in ORDINARY], "text string").select(_words(F.col("text")).alias("words"))

    # every unit of the table that the scan compares with templates; of the others, which no family can have, the number
    def counted(lines):
        n_words = F.aggregate(lines, F.lit(0), lambda n, words: n + F.size(words))
        n_units = F.size(lines) + F.floor(F.greatest(n_words - 1, F.lit(0)) / STEP) + 1
        return F.struct(n_units.alias("n"), F.transform(comparison.units(lines), lambda u: u["words"]).alias("words"))

    compared = written(docs.select(_let(_lines(F.col(text)), counted).alias("units")), "license-units")
    background = compared.select(F.explode("units.words").alias("words")).withColumn("held_out", F.pmod(F.xxhash64("words"), F.lit(2)))
    # the grams of templates in each row; a background row that contains a segment teaches nothing, our own sentences always do
    known = F.array_sort(F.lit(vocabulary))
    kept = lambda df: df.withColumn("grams", F.array_sort(F.array_intersect(_grams(F.col("words")), known)))
    plain = written(kept(background).filter(_let(_pairs(F.col("words")), comparison.best)["share"] == 0)
                    .groupBy("grams", "held_out").agg(F.count("*").alias("n")), "license-plain")
    rows = kept(taught).select("label", "grams", F.lit(1.0).alias("weight"))
    n_plain = plain.filter("held_out = 0").agg(F.sum("n")).first()[0] or 1
    weight = 0.4 * rows.count() / n_plain
    rows = rows.union(plain.filter("held_out = 0").select(F.lit(len(families) - 1), "grams", F.col("n") * weight))
    rows = rows.union(kept(ordinary).select(F.lit(len(families) - 1), "grams", F.lit(float(len(beside)))))
    # equal rows once: the fit passes over them some hundred times
    rows = written(rows.groupBy("label", "grams").agg(F.sum("weight").alias("weight")), "license-taught")
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=1.0).fit(rows)
    model = LogisticRegression(family="multinomial", regParam=0.0005, elasticNetParam=0.5, maxIter=80, weightCol="weight", standardization=False).fit(vectors.transform(rows))

    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray().tolist()
    table = [(gram, *map(float, matrix[:, i])) for i, gram in enumerate(vectors.vocabulary)]
    model.setProbabilityCol("").setPredictionCol("")  # the raw scores are enough
    scanner = Scanner(families, table, intercepts, LEAST, vectors=vectors, model=model)
    held = plain.filter("held_out = 1").select(F.monotonically_increasing_id().alias("row"), "n", F.explode_outer("grams").alias("gram"))
    scored = _probabilities(held.join(F.broadcast(scanner.table(spark)), "gram", "left").groupBy("row", "n"), scanner)
    # a unit that is not compared reaches no probability
    scanner.units = compared.agg(F.sum("units.n")).first()[0] or 0
    share = min(1.0, (plain.agg(F.sum("n")).first()[0] or 0) / max(1, scanner.units))
    level = scored.agg(F.expr(f"percentile(array_max(p), {max(0.0, 1 - 0.001 / share)}D, n)")).first()[0] if share else None
    scanner.least = max(LEAST, level or 0.0)
    release(spark, compared, plain, rows)
    return scanner


def _probabilities(groups, scanner: Scanner) -> DataFrame:
    """``p``: the probability of each family, against the unknown class, of each group of gram rows."""
    z = [F.coalesce(F.sum(f"w{k}"), F.lit(0.0)) + w for k, w in enumerate(scanner.intercepts)]
    return groups.agg(F.array(*(1 / (1 + F.exp(z[-1] - zk)) for zk in z[:-1])).alias("p"))


def _scored(units: DataFrame, scanner: Scanner) -> DataFrame:
    """``p`` of each row of ``units`` by its ``grams``: the probability of each family, against the unknown class."""
    n = len(scanner.families)
    scored = scanner.model.transform(scanner.vectors.transform(units))
    p = _let(vector_to_array("rawPrediction"), lambda z: F.transform(F.slice(z, 1, n - 1), lambda zk: 1 / (1 + F.exp(F.get(z, F.lit(n - 1)) - zk))))
    return scored.withColumn("p", p).drop("grams", "features", "rawPrediction")


def scan(docs: DataFrame, scanner: Scanner, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``; ``n_paragraphs``, its lines that are not blank; ``n_licensed``, its
    findings; ``families``, their families, sorted; ``best``, the highest probability among them (0 without);
    ``found``, the findings as structs (place: line of the first word; family, probability, share of a segment's
    2-grams), in text order; ``n_units``, its units; ``n_unconfirmed``, those of them in which a family reaches the probability
    of a finding but nothing is found; and ``highest``, the highest probability of any unit (0 without units)."""
    spark = docs.sparkSession
    comparison = Comparison(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       _let(_lines(F.col(text)), lambda lines: F.struct(F.size(lines).alias("n"), comparison.units(lines, every=True).alias("units"))).alias("d"))
    # a unit at place -1 stands for the document itself, whatever it holds
    itself = F.array(F.struct(F.lit(-1).alias("place"), F.lit(-1).alias("window"), F.lit(None).cast("array<string>").alias("words"), F.array().cast("array<string>").alias("grams")))
    rows = rows.select("doc_id", "row", F.col("d.n").alias("n"), F.explode(F.concat(itself, "d.units")).alias("u"))
    rows = _scored(rows.select("doc_id", "row", "n", "u.*"), scanner)
    compared = F.when(F.col("words").isNotNull(), _let(_pairs(F.col("words")), comparison.best))
    scored = rows.select("doc_id", "row", "n", "place", "window", "p", compared.alias("c")).select(
        "doc_id", "row", "n", "place", "window", "p", F.coalesce("c.share", F.lit(0.0)).alias("share"), F.coalesce("c.families", F.array().cast("array<array<int>>")).alias("k"))
    names = F.array(*map(F.lit, scanner.families))
    likeliest = F.transform("k", lambda ks: F.array_max(F.transform(ks, lambda k: F.struct(F.get("p", k).alias("probability"), (-k).alias("k")))))
    findings = F.array_distinct(F.transform(F.filter(likeliest, lambda b: b["probability"] >= scanner.least), lambda b: F.struct(
        F.get(names, -b["k"]).alias("family"), "window", "place", b["probability"].alias("probability"), "share")))
    is_unit, top = F.col("place") >= 0, F.array_max("p")
    judged = scored.select("doc_id", "row", "n", is_unit.alias("is_unit"), F.when(is_unit, top).alias("top"), findings.alias("f"))
    grouped = judged.groupBy("doc_id", "row").agg(
        F.max("n").cast("long").alias("n_paragraphs"), F.count_if("is_unit").alias("n_units"),
        F.count_if((F.col("top") >= scanner.least) & (F.size("f") == 0)).alias("n_unconfirmed"), F.coalesce(F.max("top"), F.lit(0.0)).alias("highest"),
        F.array_sort(F.flatten(F.collect_list(F.when(F.size("f") > 0, F.col("f"))))).alias("f"))

    def first_of_windows(f, i):
        before = F.get("f", i - 1)
        return (f["window"] < 0) | (i == 0) | (before["family"] != f["family"]) | (before["window"] != f["window"] - 1)

    found = F.array_sort(F.transform(F.filter("f", first_of_windows), lambda f: F.struct(
        f["place"].alias("place"), f["family"].alias("family"), f["probability"].alias("probability"), f["share"].alias("share"))))
    return grouped.select("doc_id", "n_paragraphs", found.alias("found"), "n_units", "n_unconfirmed", "highest").select(
        "doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_licensed"), F.array_sort(F.array_distinct("found.family")).alias("families"),
        F.coalesce(F.array_max("found.probability"), F.lit(0.0)).alias("best"), "found",
        "n_units", "n_unconfirmed", "highest")
